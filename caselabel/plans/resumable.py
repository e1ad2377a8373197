"""Long scoring runs that store their results as they go and go on where they were stopped."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caselabel.sources.keyed import BUCKET


def finished_buckets(spark: SparkSession, target: str) -> set[int]:
    """Buckets whose results are stored whole; one number per bucket of the table."""
    try:
        log = spark.read.schema("done int").parquet(f"{target.rstrip('/')}_done")
        return {r["done"] for r in log.distinct().collect()}
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return set()


def run_resumable(
    spark: SparkSession, source: str, target: str, process: Callable[[DataFrame], DataFrame], buckets: int, per_step: int = 16
) -> list[list[int]]:
    """Process the keyed table ``source`` (``sources.keyed``) into ``target``; gives the buckets of each step taken.

    A step reads ``per_step`` buckets, which Spark prunes the scan to, stores their
    results, and only then notes them as finished.  A run that was stopped is
    called again with the same ``target``: finished buckets are not read, and one
    that was stopped half way is replaced.  ``process`` works row by row or on
    whole keys, of which each lies in one bucket; it is to keep the key.  Results
    are read with ``read_results``.
    """
    if per_step < 1:
        raise ValueError("a step has at least one bucket")
    done = finished_buckets(spark, target)
    pending = [b for b in range(buckets) if b not in done]
    steps = [pending[i : i + per_step] for i in range(0, len(pending), per_step)]
    table = spark.read.parquet(source)
    for step in steps:
        rows = table.where(F.col(BUCKET).isin(step)).drop(BUCKET)
        # The first unfinished bucket names the folder, so what a stopped step has left there is replaced.
        process(rows).write.mode("overwrite").parquet(f"{target}/_step={step[0]}")
        spark.createDataFrame([(b,) for b in step], "done int").coalesce(1).write.mode("append").parquet(f"{target.rstrip('/')}_done")
    return steps


def read_results(spark: SparkSession, target: str) -> DataFrame:
    """All results stored so far."""
    return spark.read.parquet(target).drop("_step")
