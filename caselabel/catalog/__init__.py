"""Registered queries: each operator on the given tables, with its SQL twin."""

from __future__ import annotations

from caselabel.catalog import (  # noqa: F401  (importing registers the queries)
    q_aggregates,
    q_cases,
    q_columns,
    q_datasets,
    q_evaluation,
    q_joins,
    q_labels,
    q_privacy,
    q_scalars,
    q_sources,
    q_training,
)
from caselabel.catalog.registry import REGISTRY
