"""A new case file against the previous snapshot, as one lazy plan."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caselabel.functions import labels as lb
from caselabel.functions import text as tx
from caselabel.operators import labels as lo
from caselabel.operators import snapshots as sn


def prepare(cases: DataFrame, text: Column) -> DataFrame:
    """Normalised narrative and its word count."""
    return cases.withColumn("relato", tx.normalize_text(text)).withColumn(
        "cantidad_palabras", tx.word_count_space(F.col("relato"))
    )


def refresh(
    cases: DataFrame,
    previous: DataFrame | None,
    scorers: dict[str, lo.Scorer],
    run_time: dt.datetime,
    order_by: list[Column],
) -> DataFrame:
    """Score new cases, complete the previous snapshot, and merge the two.

    ``cases`` has ``NDD, relato, cantidad_palabras``.  ``scorers`` maps a label
    column to its scorer.  Without ``previous`` every case is scored.  One join
    tells new cases from known ones and brings the previous predictions along,
    so the narratives move at most once.
    """
    done = previous
    if previous is not None:
        for label, scorer in scorers.items():
            done = sn.backfill_missing(done, scorer, "cantidad_palabras", label, f"score_{label}")
        cases = sn.attach_previous(cases, done, "NDD", scorers, order_by)
    for label, scorer in scorers.items():
        also = None if previous is None else ~F.col("_seen")
        cases = lo.gate_and_score(cases, scorer, "cantidad_palabras", label, f"score_{label}", also=also)
    if previous is not None:
        return sn.settle(cases, done.columns, scorers, run_time)
    if len(scorers) == 2:
        first, second = scorers
        cases = cases.withColumn("compare", lb.agreement(F.col(first), F.col(second)))
    return cases
