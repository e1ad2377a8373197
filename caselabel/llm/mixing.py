"""Mixing sources to target weights by hash-random order and distributed prefix sums.

Every document gets a random but repeatable key from its id.  Within each
source the documents stand in key order, their running word count is a prefix
sum, and the source's budget cuts that order at an exact word.  A budget above
the source's size starts a second epoch over the same order.

The prefix sum is distributed: the key's leading digits cut each source into
``16 ** digits`` ranges, range totals are summed per source (a small table, one
row per source and range), and only the rows of one range are sorted together.
A hot source is therefore spread over as many tasks as a cluster has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from caselabel.llm.tables import written

WORD = r"[^\x20\x09-\x0D]+"
#: Hexadecimal digits of the key that make a range: 4096 ranges of each source.
RANGE_DIGITS = 3


def word_count(text):
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[int] = (3, 1, 2), share: float = 1.5, epochs: int = 2) -> DataFrame:
    """Word target of each source: ``share`` of all words by weight, none above ``epochs`` times its size.

    ``sizes`` has one row ``(source, source_size)`` per source.  Sources stand
    in code point order with null last and take the weights in turn.  What a
    full source can't take goes to the others by weight, again and again; the
    end of that is one level L with target = min(limit, L * weight).  With the
    sources ordered by limit / weight, L is found by prefix sums: if the first
    k are full, L = (all - their limits) / (weights of the rest), and the right
    k is the first whose L does not exceed the next source's ratio.

    One row per source meets in one task here, and no more.  Sources without
    words get a target of 0.  When everything is full, all targets are limits.
    """
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    by_ratio = W.orderBy("ratio", F.col("source").asc_nulls_last())
    everything = W.partitionBy()
    weight = F.element_at(
        F.array(*map(F.lit, weights)), (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int")
    )
    limit = F.col("source_size") * epochs
    ranked = sizes.withColumn("weight", weight.cast("double")).withColumn("limit", limit.cast("double"))
    ranked = ranked.withColumn("ratio", F.col("limit") / F.col("weight"))
    before = by_ratio.rowsBetween(W.unboundedPreceding, -1)
    level = (F.sum("source_size").over(everything) * F.lit(share) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    )
    ranked = ranked.withColumn("level", level)
    fits = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "level"))).over(everything)["level"]
    return ranked.select("source", "source_size", F.least("limit", F.coalesce(fits * F.col("weight"), "limit")).alias("target"))


def mix(
    docs: DataFrame,
    weights: Sequence[int] = (3, 1, 2),
    share: float = 1.5,
    epochs: int = 2,
    seed: str = "mix",
    range_digits: int = RANGE_DIGITS,
) -> DataFrame:
    """How many words of each document the mix takes.

    ``docs`` needs ``doc_id, text, source``; other columns are ignored.  Returns
    ``doc_id, size, source_size, target, taken``, one row per input row.  The
    cut is exact: a source's taken words sum to its target without its
    fraction, so the document at the cut is taken in part.  Null text has size
    0; a null source is a source of its own; rows with equal ids are taken in
    order of size, equal rows in any order, which gives the same result.  An
    empty table gives an empty result.
    """
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    sized = written(
        docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), key.alias("key")).withColumn(
            "range", F.substring("key", 1, range_digits)
        ),
        "mix-sizes",
    )
    in_source = ["has_source", "named"]
    marked = sized.withColumns({"has_source": F.col("source").isNotNull(), "named": F.coalesce("source", F.lit(""))})
    ranges = marked.groupBy(*in_source, "range").agg(F.sum("size").alias("range_size"))
    earlier = W.partitionBy(*in_source).orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    offsets = ranges.withColumn("offset", F.coalesce(F.sum("range_size").over(earlier), F.lit(0).cast("long")))
    goal = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, epochs).select(
        F.col("source").isNotNull().alias("has_source"), F.coalesce("source", F.lit("")).alias("named"), "source_size", "target"
    )
    in_range = W.partitionBy(*in_source, "range").orderBy("key", "doc_id", "size").rowsBetween(W.unboundedPreceding, -1)
    placed = marked.withColumn("within", F.coalesce(F.sum("size").over(in_range), F.lit(0).cast("long")))
    placed = placed.join(offsets.join(goal, in_source).drop("range_size"), [*in_source, "range"])
    budget = F.floor("target")
    start = F.col("offset") + F.col("within")
    # Words taken from position ``start`` on: whole epochs, and the part of the last one that reaches here.
    whole = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0)
    rest = budget - whole * F.col("source_size")
    part = F.least(F.col("size"), F.greatest(rest - start, F.lit(0)))
    taken = (whole * F.col("size") + part).cast("long")
    return placed.select("doc_id", "size", "source_size", "target", taken.alias("taken"))
