"""Combining a new run with earlier snapshots."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caselabel import vocab
from caselabel.functions import labels as lb
from caselabel.functions import text as tx
from caselabel.operators import keys as ky
from caselabel.operators import labels as lo


def update_from(target: DataFrame, source: DataFrame, key: str, columns: list[str], order_by: list[Column]) -> DataFrame:
    """New version of ``target`` where matched rows take ``columns`` from ``source``.

    Values are copied as they are, NULL included; unmatched rows and all other
    columns stay.  A column that either side lacks is an error.  Write the
    result to a new path and swap.
    """
    for side, frame in (("target", target), ("source", source)):
        missing = [c for c in columns if c not in frame.columns]
        if missing:
            raise ValueError(f"the {side} has no column {', '.join(missing)}")
    last = ky.dedupe_last(source.where(F.col(key).isNotNull()), [key], order_by, keep=columns)
    values = last.select(key, *[F.col(c).alias(f"_new_{c}") for c in columns], F.lit(True).alias("_hit"))
    joined = target.join(values, key, "left")
    return joined.select(
        *[
            F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c)
            for c in target.columns
        ]
    )


def recode_update(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Repair stored labels; ``columns`` maps a column to its scheme."""
    for column, scheme in columns.items():
        df = lo.recode(df, column, vocab.repair_table(df.sparkSession, scheme))
    return df


def prior_snapshot_union(older: DataFrame, newer: DataFrame, key: str) -> DataFrame:
    """All keys of both snapshots, the newer row where both have one."""
    return ky.anti_new_keys(older, newer, key=key).unionByName(newer, allowMissingColumns=True)


def stamp_new(df: DataFrame, flag: str, column: str, run_time) -> DataFrame:
    """Update time on new keys only."""
    return df.withColumn(column, F.when(F.col(flag), F.lit(run_time).cast("timestamp")))


def select_mode(df: DataFrame, earlier: DataFrame | None, key: str, every: bool) -> DataFrame:
    """All cases, or only those whose key the earlier snapshot lacks."""
    return df if every or earlier is None else ky.anti_new_keys(df, earlier, key=key)


def unpredicted(df: DataFrame, label: str, key: str) -> DataFrame:
    """Keys of an earlier snapshot that carry no prediction."""
    return df.where(F.col(label).isNull()).select(key)


def backfill_missing(df: DataFrame, scorer: lo.Scorer, words: str, label: str, score: str) -> DataFrame:
    """Score the rows of an earlier snapshot that were left without a label.

    Rows that have a label keep it with its score.
    """
    missing = F.col(label).isNull()
    filled = lo.gate_and_score(df.withColumn("_missing", missing), scorer, words, "_fill", "_fill_score", also=F.col("_missing"))
    return filled.withColumns(
        {
            label: F.when(F.col("_missing"), F.col("_fill")).otherwise(F.col(label)),
            score: F.when(F.col("_missing"), F.col("_fill_score")).otherwise(F.col(score)),
        }
    ).drop("_missing", "_fill", "_fill_score")


def carried_columns(schemes: Iterable[str]) -> list[str]:
    """Columns a known case takes over from the previous snapshot."""
    return [c for s in schemes for c in (s, f"score_{s}")] + ["FechaActualizacion"]


def attach_previous(
    current: DataFrame, previous: DataFrame, key: str, schemes: Iterable[str], order_by: list[Column]
) -> DataFrame:
    """Set what comes from the previous snapshot (``_old_...``) beside each case; ``_seen`` marks known keys.

    These are the predictions and every column that only the previous snapshot has.
    """
    carried = carried_columns(schemes)
    carried += [c for c in previous.columns if c not in (*carried, key, *current.columns)]
    last = ky.dedupe_last(previous.where(F.col(key).isNotNull()), [key], order_by, keep=carried)
    old = last.select(key, *[F.col(c).alias(f"_old_{c}") for c in carried], F.lit(True).alias("_seen"))
    return current.join(old, key, "left").withColumn("_seen", F.coalesce("_seen", F.lit(False)))


def settle(attached: DataFrame, previous_columns: Iterable[str], schemes: Iterable[str], run_time) -> DataFrame:
    """Previous prediction for known keys, current one for new keys.

    Columns the previous snapshot does not have are dropped; columns that only
    it has, among them the labels of a scheme that did not run, come from the
    previous row and are NULL for new keys.  The update time is ``run_time`` for
    new keys.  Where both labels exist, the agreement flag is computed anew from
    the settled labels.
    """
    carried = carried_columns(schemes)
    previous_columns = list(previous_columns)
    now = attached.withColumn("FechaActualizacion", F.lit(run_time).cast("timestamp"))
    kept = [c for c in now.columns if c in set(previous_columns)]
    only_previous = [c for c in previous_columns if c not in now.columns and f"_old_{c}" in now.columns]
    out = now.select(
        *[F.when(F.col("_seen"), F.col(f"_old_{c}")).otherwise(F.col(c)).alias(c) if c in carried else F.col(c) for c in kept],
        *[F.col(f"_old_{c}").alias(c) for c in only_previous],
    )
    if {"delitos_seguimiento", "delitos_validados"} <= set(out.columns):
        out = out.withColumn("compare", lb.agreement(F.col("delitos_seguimiento"), F.col("delitos_validados")))
    return out


def merge_snapshots(
    current: DataFrame, previous: DataFrame, key: str, schemes: Iterable[str], run_time, order_by: list[Column]
) -> DataFrame:
    """Keep the current prediction for new keys and the previous one for the rest.

    ``schemes`` names the label columns the run produced; each has its
    ``score_<label>``.  See ``settle`` for the other columns.
    """
    schemes = list(schemes)
    if not schemes:
        raise ValueError("at least one label column must have been predicted")
    attached = attach_previous(current, previous, key, schemes, order_by)
    return settle(attached, previous.columns, schemes, run_time)


def commission_override(
    df: DataFrame, commission: DataFrame, key: str, columns: dict[str, str], allowed: dict[str, Iterable[str]], order_by: list[Column]
) -> DataFrame:
    """Take the commission's label where it is an allowed one, else keep ours.

    ``columns`` maps our label column to the commission's; ``allowed`` gives the
    label set of each, from which ``N/A`` is always left out.
    """
    last = ky.dedupe_last(commission.where(F.col(key).isNotNull()), [key], order_by, keep=set(columns.values()))
    theirs = last.select(key, *[F.col(c).alias(f"_theirs_{o}") for o, c in columns.items()])
    joined = df.join(theirs, key, "left")
    picks = {}
    for ours in columns:
        labels = [x for x in allowed[ours] if x != vocab.NOT_SCORED]
        accepted = F.coalesce(F.col(f"_theirs_{ours}").isin(*labels), F.lit(False))
        picks[ours] = F.when(accepted, F.col(f"_theirs_{ours}")).otherwise(F.col(ours))
    return joined.withColumns(picks).select(*df.columns)


def prefer_longer_source(first: Column, second: Column, min_words: int = vocab.MIN_WORDS) -> Column:
    """The first narrative when it is long enough to classify, else the second, else whichever exists."""
    enough = tx.word_count_space(tx.normalize_text(first)) >= min_words
    return F.when(enough, first).otherwise(F.coalesce(second, first))


def text_coverage(df: DataFrame, first: str, second: str) -> DataFrame:
    """Missing narratives of two sources side by side."""
    return df.agg(
        F.count_if(F.col(first).isNull()).alias("missing_first"),
        F.count_if(F.col(second).isNull()).alias("missing_second"),
        F.count_if(F.col(first).isNull() & F.col(second).isNull()).alias("missing_both"),
        F.count(F.lit(1)).alias("n_rows"),
    )
