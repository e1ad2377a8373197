"""Bounded samples for fitting: the only place where operators look at a part of a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

_STEPS = 1 << 30
#: Rows of each stratum beyond three times its quota that are ranked, so that small quotas find theirs too.
_SPARE = 20


def fold_of(doc_id: Column, folds: int) -> Column:
    """``crc32(doc_id as text) mod folds``; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def bounded_sample(df: DataFrame, stratum: str, per_stratum: int, max_rows: int) -> DataFrame:
    """At most ``per_stratum`` rows of each value of ``stratum`` and ``max_rows`` in all, by hash of ``doc_id``.

    Every value gets a row at least, so with more values than ``max_rows`` there
    is one row of each.  Repeatable.  Group counts give each stratum a hash threshold with a margin,
    so a little more than three times the wanted rows pass it whatever the table's size, and
    only those are ranked.  Null strata are left out.
    """
    counts = df.where(F.col(stratum).isNotNull()).groupBy(stratum).agg(F.count(F.lit(1)).alias("_rows"))
    share = F.count(F.lit(1)).over(W.partitionBy())
    quota = F.least(F.lit(per_stratum), F.floor(F.lit(max_rows) / share))
    counts = counts.withColumn("_quota", F.greatest(quota, F.lit(1)))  # one row per stratum
    place = F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(_STEPS))
    near = df.join(F.broadcast(counts), stratum).withColumn("_place", place)
    near = near.where(F.col("_place") < F.lit(float(_STEPS)) * (3 * F.col("_quota") + _SPARE) / F.col("_rows") + 1)
    rank = F.row_number().over(W.partitionBy(stratum).orderBy("_place", "doc_id"))
    return near.withColumn("_rank", rank).where("_rank <= _quota").drop("_rows", "_place", "_rank", "_quota")


def known_labels(labels: DataFrame, label: str, folds: int, held: int) -> tuple[DataFrame, dict[int, int]]:
    """``(doc_id, label)`` of all ids labelled 0 or 1 outside the held-out fold, the least label of each, and the class sizes."""
    known = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & (fold_of(F.col("doc_id"), folds) != held))
    known = known.groupBy("doc_id").agg(F.min(F.col(label).cast("int")).alias("label"))
    sizes = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    return known, sizes


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int, folds: int, held: int) -> tuple[DataFrame, dict[int, int]]:
    """``(doc_id, label, text)`` of at most ``per_class`` documents labelled 0 and as many labelled 1, and the class sizes.

    The sample is drawn from ``labels`` outside the held-out fold, so only its
    bounded id list meets the documents, by broadcast, and no text is shuffled
    but the sample's.  Of repeated ids one label and one text are taken, the
    least.  Null texts are left out.
    """
    known, sizes = known_labels(labels, label, folds, held)
    chosen = bounded_sample(known, "label", per_class, 2 * per_class)
    texts = docs.where("text IS NOT NULL").select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return texts.groupBy("doc_id", "label").agg(F.min("text").alias("text")), sizes
