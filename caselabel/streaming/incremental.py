"""Incremental runs: every arriving batch adds the cases not seen before."""

from __future__ import annotations

import json
from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caselabel.operators import keys as ky


#: State that outgrows memory stays on the executors' disks; only what changed goes to the checkpoint.
_STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def incremental_batch(
    batch: DataFrame, seen: DataFrame | None, key: str, order_by: list[Column], process: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """Process the cases of one batch whose key no earlier batch had."""
    fresh = batch if seen is None else ky.anti_new_keys(batch, seen, key=key)
    return process(ky.dedupe_last(fresh, [key], order_by))


def run_available(
    spark: SparkSession,
    source: str,
    schema: T.StructType | str,
    target: str,
    checkpoint: str,
    key: str,
    order_by: list[Column],
    process: Callable[[DataFrame], DataFrame],
    prepare: Callable[[DataFrame], DataFrame] = lambda arrived: arrived,
    files_per_batch: int = 1000,
) -> list[dict]:
    """Process all parquet files that have arrived in ``source`` since the last call; gives the progress of each batch.

    ``prepare`` turns arriving rows into cases with the key, row by row;
    ``process`` works on the cases not seen before and keeps the key.  Rows
    without a key are no cases.  ``schema`` names the columns that the files hold.

    Which keys have been seen is keyed state of the stream: one entry per key,
    with the times of the first and the last batch that had it, in RocksDB.  A
    batch looks up its own keys only, so it costs the same however many came
    before, and nothing that earlier batches wrote is read again.  State holds no
    texts and no Python looks at it; the cases of new keys are then read from the
    batch's own files, whose names pass through the same state.

    Results go to ``target`` in one folder per batch.  A batch replayed after a
    failure starts from the state before it and overwrites its own folder, so
    every case is stored once.  ``target/_fresh`` lists the new keys of each batch.
    """
    arrived = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    cases = prepare(arrived).where(F.col(key).isNotNull()).select(F.col(key), F.lit(None).cast("string").alias("_file"))
    kind = cases.schema[key].dataType
    read_files = arrived.select(F.lit(None).cast(kind).alias(key), F.col("_metadata.file_path").alias("_file"))
    timed = cases.unionByName(read_files).withColumn("_now", F.current_timestamp())  # the batch's time, which a replay repeats
    names = timed.groupBy(key, "_file").agg(F.min("_now").alias("_first"), F.max("_now").alias("_last"))

    def write(batch: DataFrame, batch_id: int) -> None:
        session, log = batch.sparkSession, f"{target}/_fresh/batch_id={batch_id}"
        batch.write.mode("overwrite").parquet(log)  # the state is asked once
        told = session.read.schema(batch.schema).parquet(log)
        paths = [unquote(r["_file"]) for r in told.where(F.col("_file").isNotNull()).select("_file").collect()]  # files_per_batch at most
        fresh = told.where(F.col("_file").isNull() & (F.col("_first") == F.col("_last"))).select(key)
        rows = session.read.schema(schema).parquet(*paths) if paths else session.createDataFrame([], arrived.schema)
        cases = prepare(rows).join(fresh, key, "left_semi")
        process(ky.dedupe_last(cases, [key], order_by)).write.mode("overwrite").parquet(f"{target}/batch_id={batch_id}")

    before = {name: spark.conf.get(name, None) for name in _STATE}
    for name, value in _STATE.items():
        spark.conf.set(name, value)
    try:  # a query keeps the settings that it starts with
        query = (
            names.writeStream.outputMode("update")
            .foreachBatch(write)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    query.awaitTermination()
    return [json.loads(p.json) for p in query.recentProgress if p.numInputRows]
