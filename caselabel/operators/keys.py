"""Key sets, deduplication and row differences.

Nothing here collects one key's rows in a task: duplicates are reduced by
aggregates that combine before the shuffle, so a hot key costs no more than its
share of the scan.  ``dedupe_last`` keeps whole rows, which Spark aggregates by
sorting within each task; name the columns to keep.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dedupe_last(
    df: DataFrame, keys: list[str], order_by: list[Column], keep: Iterable[str] | None = None
) -> DataFrame:
    """One row per key: the one that is last by ``order_by``.

    ``order_by`` must end in a tie-break that is unique within a key, otherwise
    any of the tied rows may come out; a hash of a long text does as well as the
    text.  ``keep`` names the columns wanted besides the keys (default: all);
    the others are not shuffled.
    """
    columns = df.columns if keep is None else [*keys, *keep]
    rest = [c for c in columns if c not in keys]
    last = F.max_by(F.struct(*[F.col(f"`{c}`") for c in rest]), F.struct(*order_by))
    reduced = df.groupBy(*keys).agg(last.alias("_last"))
    return reduced.select(*[F.col(f"`{c}`") if c in keys else F.col(f"_last.`{c}`").alias(c) for c in columns])


def key_counts(df: DataFrame, keys: list[str]) -> DataFrame:
    """Copies per key: ``(keys..., copies)``."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))


def duplicate_stats(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows, distinct keys, rows with a repeated key, extra copies, and the share in percent."""
    return key_counts(df, keys).agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("n_rows"),
        F.count(F.lit(1)).alias("n_keys"),
        F.coalesce(F.sum(F.when(F.col("copies") > 1, F.col("copies"))), F.lit(0)).alias("duplicated_rows"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("extra_copies"),
        F.try_divide(
            100.0 * F.sum(F.when(F.col("copies") > 1, F.col("copies")).otherwise(0)), F.sum("copies")
        ).alias("duplicated_pct"),
    )


def duplicated_rows(df: DataFrame, keys: list[str]) -> DataFrame:
    """All rows whose key occurs more than once."""
    repeated = key_counts(df, keys).where("copies > 1").select(*keys)
    return df.join(repeated, keys, "left_semi")


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    """Distinct known keys."""
    return df.select(key).where(F.col(key).isNotNull()).distinct()


def semi_known(df: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in ``known``.

    The distinct step leaves the keys partitioned as the join wants them, so it
    costs no shuffle of its own and a key with many copies travels once per task.
    """
    return df.join(known.select(key).distinct(), key, "left_semi")


def anti_new_keys(df: DataFrame, *earlier: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in none of the earlier snapshots."""
    seen = reduce(DataFrame.unionByName, [e.select(key) for e in earlier])
    return df.join(seen.distinct(), key, "left_anti")


def flag_new(df: DataFrame, earlier: DataFrame, key: str, flag: str = "is_new") -> DataFrame:
    """Mark rows whose key is absent from ``earlier``."""
    seen = distinct_keys(earlier, key).withColumn("_seen", F.lit(True))
    return df.join(seen, key, "left").withColumn(flag, F.col("_seen").isNull()).drop("_seen")


def _presence(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Distinct keys, NULL included, with the sides they occur on: one combining aggregate."""
    yes, no = F.lit(True), F.lit(False)
    tagged = left.select(key, yes.alias("_l"), no.alias("_r")).unionByName(
        right.select(key, no.alias("_l"), yes.alias("_r"))
    )
    return tagged.groupBy(key).agg(F.bool_or("_l").alias("_l"), F.bool_or("_r").alias("_r"))


def key_intersection(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Distinct keys present on both sides."""
    return _presence(left, right, key).where("_l AND _r").select(key)


def key_difference(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Distinct keys of ``left`` missing from ``right``."""
    return _presence(left, right, key).where("_l AND NOT _r").select(key)


def leaked_keys(train: DataFrame, test: DataFrame, key: str) -> DataFrame:
    """Test keys that were also trained on; empty for a clean split."""
    return semi_known(distinct_keys(test, key), train, key)


def assert_no_leak(train: DataFrame, test: DataFrame, key: str) -> None:
    """Raise when a test key was trained on."""
    if not leaked_keys(train, test, key).isEmpty():
        raise ValueError(f"test and training rows share values of {key}")


def row_difference(left: DataFrame, right: DataFrame, which: str | None = None) -> DataFrame:
    """Compare two frames on their shared columns, NULL equal to NULL.

    One row per distinct combination with its copies on each side and
    ``_merge`` in ``both``, ``left_only``, ``right_only``.  ``which=None`` keeps
    the rows that are not on both sides.  A joined result would repeat a
    ``both`` row ``n_left * n_right`` times; the two counts say the same
    without pairing up copies, and each side is combined before the shuffle.
    """
    shared = [c for c in left.columns if c in right.columns]
    if not shared:
        raise ValueError("the two frames share no column")
    tagged = left.select(*shared, F.lit(1).alias("_l"), F.lit(0).alias("_r")).unionByName(
        right.select(*shared, F.lit(0).alias("_l"), F.lit(1).alias("_r"))
    )
    sides = tagged.groupBy(*shared).agg(F.sum("_l").alias("n_left"), F.sum("_r").alias("n_right"))
    merge = (
        F.when(F.col("n_right") == 0, "left_only").when(F.col("n_left") == 0, "right_only").otherwise("both")
    )
    out = sides.withColumn("_merge", merge)
    return out.where(F.col("_merge") != "both") if which is None else out.where(F.col("_merge") == which)


def overlap_matrix(key: str, **snapshots: DataFrame) -> DataFrame:
    """Sizes of intersection and difference for every ordered pair of snapshots.

    Each key is reduced to one presence flag per snapshot, so the pairs are
    formed over snapshot names (a handful), never over rows.
    """
    names = list(snapshots)
    tagged = reduce(
        DataFrame.unionByName,
        [
            frame.select(key, *[F.lit(name == other).alias(f"_in_{other}") for other in names])
            for name, frame in snapshots.items()
        ],
    )
    present = tagged.where(F.col(key).isNotNull()).groupBy(key).agg(
        *[F.bool_or(f"_in_{n}").alias(f"_in_{n}") for n in names]
    )
    pairs = [(a, b) for a in names for b in names if a != b]
    sizes = present.agg(
        *[F.count_if(F.col(f"_in_{a}") & F.col(f"_in_{b}")).alias(f"both_{i}") for i, (a, b) in enumerate(pairs)],
        *[F.count_if(F.col(f"_in_{a}") & ~F.col(f"_in_{b}")).alias(f"only_{i}") for i, (a, b) in enumerate(pairs)],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(a).alias("left_set"),
                F.lit(b).alias("right_set"),
                F.col(f"both_{i}").alias("in_both"),
                F.col(f"only_{i}").alias("left_only"),
                (F.col(f"only_{i}") == 0).alias("contained"),
            )
            for i, (a, b) in enumerate(pairs)
        ]
    )
    return sizes.select(F.inline(rows))
