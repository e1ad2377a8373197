"""DataFrame operators: keys, joins, aggregates, labels, snapshots, evaluation and more."""
