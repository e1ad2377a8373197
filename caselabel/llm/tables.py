"""Shared helpers: written intermediate tables, reading the given tables, hot keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caselabel.session import workspace


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder.

    It is computed once however often it is used, its lineage ends here, and a
    lost executor costs no more than reading the files again.
    """
    path = workspace(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unused(name: str, *frames: DataFrame) -> str:
    """``name`` with as many underscores in front as no column of the frames has; case is ignored, as in Spark."""
    taken = {c.lower() for frame in frames for c in frame.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def hot_join(left: DataFrame, right: DataFrame, on: list[str], rows: str, total: int, share: int = 1000) -> DataFrame:
    """Inner join with a ``right`` of one row per key whose column ``rows`` counts the key's rows in ``left``.

    Keys with more than ``total / share`` rows are hot.  As the counts sum to
    ``total`` at most, there are at most ``share`` hot keys whatever the size:
    a proven bound, so their side is broadcast and their rows stay where they
    are.  The other keys are joined by a shuffle in which none is large.
    """
    bar = total // share
    hot = F.broadcast(right.where(F.col(rows) > bar).drop(rows))
    cold = right.where(F.col(rows) <= bar).drop(rows)
    rest = left.join(F.broadcast(right.where(F.col(rows) > bar).select(*on)), on, "left_anti")
    return left.join(hot, on).unionByName(rest.join(cold, on))
