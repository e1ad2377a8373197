"""Enrichment joins.  The right side is always reduced to one row per key first."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caselabel.functions import labels as lb
from caselabel.operators import keys as ky


def left_enrich(
    left: DataFrame, right: DataFrame, key: str, order_by: list[Column], suffix: str = "", salt: int = 1
) -> DataFrame:
    """Add the last right row of each key; the row count of ``left`` is kept.

    Adaptive execution splits a key with very many left rows in a single join.
    Where several joins on the key follow each other it cannot; ``salt`` then
    spreads each key over that many partitions, at the price of as many copies
    of the reduced right side.
    """
    last = ky.dedupe_last(right.where(F.col(key).isNotNull()), [key], order_by)
    if suffix:
        last = last.withColumnsRenamed({c: c + suffix for c in last.columns if c != key})
    if salt <= 1:
        return left.join(last, key, "left")
    spread = left.withColumn("_salt", F.pmod(F.xxhash64(*left.columns), F.lit(salt)))
    copies = last.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1)).cast("array<bigint>")))
    return spread.join(copies, [key, "_salt"], "left").drop("_salt")


def left_override(
    left: DataFrame, right: DataFrame, key: str, columns: list[str], order_by: list[Column]
) -> DataFrame:
    """Replace ``columns`` by the right side's values, NULL included."""
    last = left_enrich(left, right.select(key, *columns, *_extra(right, key, columns)), key, order_by, "__r")
    return last.select(*[F.col(f"{c}__r").alias(c) if c in columns else F.col(c) for c in left.columns])


def three_way(
    police: DataFrame, registry: DataFrame, commission: DataFrame, key: str, order_by: list[list[Column]], salt: int = 1
) -> DataFrame:
    """Police rows with the last registry and the last commission row of each key."""
    first = left_enrich(police, registry, key, order_by[0], "_registry", salt)
    return left_enrich(first, commission, key, order_by[1], "_comision", salt)


def full_compare(left: DataFrame, right: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    """Full join of two aggregated frames, missing measures as 0."""
    return left.join(right, keys, "full_outer").fillna(0, subset=measures)


def fuzzy_category_map(df: DataFrame, column: str, targets: Iterable[str], min_score: int = 85) -> DataFrame:
    """Best target of every distinct raw category: ``(raw, match, score)``."""
    raw = df.select(F.col(column).alias("raw")).where("raw IS NOT NULL").distinct()
    best = lb.best_match(F.col("raw"), targets, min_score)
    return raw.withColumn("_best", best).select("raw", "_best.match", "_best.score")


def _extra(df: DataFrame, key: str, columns: list[str]) -> list[str]:
    return [c for c in df.columns if c != key and c not in columns]
