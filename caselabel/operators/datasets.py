"""Training, validation and test sets that are repeatable and grouped by key."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# The hash split compares the first 32 bits of the hash with the shares.
_HASH_RANGE = 1 << 32
# Rank buckets of the exact split: 2**16, from the first 4 hex digits of the hash.
_RANK_DIGITS = 4


def check_proportions(proportions: tuple[float, float, float]) -> None:
    """Raise unless the three shares add up to one."""
    if abs(sum(proportions) - 1) > 1e-9 or min(proportions) < 0:
        raise ValueError(f"proportions {proportions} do not add up to 1")


def split_sizes(df: DataFrame, proportions: tuple[float, float, float] = (0.7, 0.2, 0.1)) -> DataFrame:
    """Sizes of the three sets for the rows at hand, in one row."""
    check_proportions(proportions)
    n = F.count(F.lit(1))
    names = ("train_size", "valid_size", "test_size")
    return df.agg(n.alias("n_rows"), *[(n * F.lit(p)).alias(name) for name, p in zip(names, proportions)])


def key_hash(key: Column, seed: int) -> Column:
    """Hash of a key under a seed: 32 hex digits, the same on every engine."""
    return F.md5(F.concat(F.lit(f"{seed}#"), key))


def split_hash(
    df: DataFrame, key: str, seed: int = 42, proportions: tuple[float, float, float] = (0.7, 0.2, 0.1), out: str = "split"
) -> DataFrame:
    """Add ``train``/``valid``/``test`` from the key's hash; a map-side step.

    Copies of a key share a side, and adding rows moves none that exist.  Shares
    are kept to one part in 2^32.
    """
    check_proportions(proportions)
    place = F.conv(F.substring(key_hash(F.col(key), seed), 1, 8), 16, 10).cast("bigint")
    train = round(proportions[0] * _HASH_RANGE)
    valid = round((proportions[0] + proportions[1]) * _HASH_RANGE)
    return df.withColumn(out, F.when(place < train, "train").when(place < valid, "valid").otherwise("test"))


def split_exact(
    df: DataFrame, key: str, test_size: int | float, valid_share: float = 0.2, seed: int = 42
) -> DataFrame:
    """Distinct keys with their side, in exact numbers: ``(key, split)``.

    ``test_size`` is a number of keys or, below 1, a share rounded up;
    ``valid_share`` of the rest, rounded up, is for validation.  Keys are ranked
    by hash without a global sort: counts per hash prefix (65 536 at most) give
    each prefix its first and last rank, which settles all prefixes but the two
    that hold a boundary; only the keys of those are sorted.
    """
    digest = key_hash(F.col(key), seed)
    keys = df.select(key).where(F.col(key).isNotNull()).distinct()
    hashed = keys.withColumn("_h", digest).withColumn("_p", F.substring("_h", 1, _RANK_DIGITS))
    # one row per prefix: the unpartitioned window is bounded by the prefix count
    running = W.orderBy("_p").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        hashed.groupBy("_p")
        .agg(F.count(F.lit(1)).alias("_c"))
        .select(
            "_p",
            "_c",
            F.coalesce(F.sum("_c").over(running), F.lit(0)).alias("_before"),
            F.sum("_c").over(W.partitionBy()).alias("_n"),
        )
    )
    n = F.col("_n")
    test = F.lit(int(test_size)) if test_size >= 1 else F.ceil(n * F.lit(float(test_size)))
    valid = F.ceil((n - test) * F.lit(valid_share))

    def side(rank: Column) -> Column:
        return F.when(rank <= test, "test").when(rank <= test + valid, "valid").otherwise("train")

    placed = hashed.join(F.broadcast(offsets), "_p")
    first, last = side(F.col("_before") + 1), side(F.col("_before") + F.col("_c"))
    settled = placed.where(first == last).select(key, first.alias("split"))
    rank = F.col("_before") + F.row_number().over(W.partitionBy("_p").orderBy("_h", key))
    ranked = placed.where(first != last).withColumn("_rank", rank).select(key, side(F.col("_rank")).alias("split"))
    return settled.unionByName(ranked)


def seeded_sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """``n`` rows drawn by hash order: the same rows on every run.

    The first ``n`` of so many hashes almost surely lie below a threshold with a
    margin, so only about as many rows are ordered, whatever the table's size.
    Should too few lie below it, all rows are.  Both counts are scalar
    subqueries on the key.
    """
    hashed = df.withColumn("_h", key_hash(F.col(key), seed))
    place = F.conv(F.substring("_h", 1, 8), 16, 10).cast("bigint") / _HASH_RANGE
    margin = n + 8 * math.sqrt(n) + 32
    total = df.select(F.count(F.lit(1))).scalar()
    below = F.coalesce(place <= F.lit(margin) / F.greatest(total, F.lit(1)), F.lit(False))
    enough = hashed.where(below).select(F.count(F.lit(1))).scalar() >= n
    return hashed.where(below | ~enough).orderBy("_h", key).limit(n).drop("_h")


def split_balance(df: DataFrame, split: str, label: str) -> DataFrame:
    """Rows per split and label, with the label's share of its split and the split's share of all."""
    counts = df.groupBy(split, label).agg(F.count(F.lit(1)).alias("n"))
    of_split = F.sum("n").over(W.partitionBy(split))
    of_all = F.sum("n").over(W.partitionBy())
    return counts.select(
        split,
        label,
        "n",
        (100.0 * F.col("n") / of_split).alias("label_pct"),
        (100.0 * of_split / of_all).alias("split_pct"),
    )


def pair_sources(df: DataFrame, key: str, texts: dict[str, str], labels: list[str]) -> DataFrame:
    """One row per known narrative of a case: ``(key, labels..., source, relato)``.

    ``texts`` maps a source name to its text column.
    """
    sources = F.array(*[F.struct(F.lit(s).alias("source"), F.col(c).alias("relato")) for s, c in texts.items()])
    return df.select(key, *labels, F.inline(sources)).where(F.col("relato").isNotNull())


def class_ids(df: DataFrame, label: str) -> DataFrame:
    """Labels in alphabetical order with ids from 0: ``(label, id)``."""
    labels = df.select(F.col(label).alias("label")).where(F.col("label").isNotNull()).distinct()
    # one row per label of a closed scheme
    return labels.withColumn("id", (F.row_number().over(W.orderBy("label")) - 1).cast("int"))


def expected_sizes(n: int, test_size: int | float, valid_share: float = 0.2) -> tuple[int, int, int]:
    """Train, valid and test sizes that ``split_exact`` gives for ``n`` keys."""
    test = int(test_size) if test_size >= 1 else math.ceil(n * test_size)
    valid = math.ceil((n - test) * valid_share)
    return n - test - valid, valid, test
