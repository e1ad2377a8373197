"""Curate, classify, reconcile and evaluate case reports with Spark DataFrames.

Every public function takes and returns DataFrames or Columns and builds a lazy
plan; only the sinks, the trainer and the streaming entry start a job.
"""

__version__ = "0.1.0"
