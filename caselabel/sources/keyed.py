"""Tables kept in buckets of their key, of which an update rewrites only those it touches.

A keyed table is a Parquet folder with one partition per bucket, the bucket being
a hash of the key.  The keys of an update name the buckets to be read and
written; Spark prunes the scan to them and replaces their partitions, so the
update of a few keys costs those buckets, however large the table is.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caselabel.operators import keys as ky
from caselabel.operators import snapshots as sn

BUCKET = "_bucket"


def bucket_of(key: Column, buckets: int) -> Column:
    """Bucket of a key; a null key has one as well."""
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def save_keyed(df: DataFrame, path: str, key: str, buckets: int, rows_per_file: int = 0) -> str:
    """Replace the keyed table at ``path``; never the one ``df`` reads from.

    A bucket should be a few files large: about the table's size over 1 GB
    makes a good number of buckets.  ``rows_per_file`` cuts a bucket into files.
    """
    if BUCKET in df.columns:
        raise ValueError(f"the column {BUCKET} is the table's own")
    placed = df.withColumn(BUCKET, bucket_of(F.col(key), buckets)).repartition(BUCKET)
    writer = placed.write.mode("overwrite").partitionBy(BUCKET)
    (writer.option("maxRecordsPerFile", rows_per_file) if rows_per_file else writer).parquet(path)
    return path


def read_keyed(spark: SparkSession, path: str, key: str | None = None, keys: DataFrame | None = None, buckets: int = 0) -> DataFrame:
    """The table without its bucket column; with ``keys``, only the rows of these keys, read from their buckets."""
    table = spark.read.parquet(path)
    if keys is None:
        return table.drop(BUCKET)
    wanted = keys.select(key).where(F.col(key).isNotNull()).distinct()
    return _pruned(table, _buckets_of(wanted, key, buckets)).join(wanted, key, "left_semi").drop(BUCKET)


def _buckets_of(rows: DataFrame, key: str, buckets: int) -> list[int]:
    """Buckets in which the keys of ``rows`` lie: ``buckets`` numbers at most."""
    return sorted(r[0] for r in rows.select(bucket_of(F.col(key), buckets)).distinct().collect())


def _pruned(table: DataFrame, touched: list[int]) -> DataFrame:
    return table.where(F.col(BUCKET).isin(touched)) if touched else table.limit(0)


def _finished(spark: SparkSession, path: str) -> bool:
    try:
        return bool(spark.read.parquet(path).head(1))
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return False


def update_keyed(
    spark: SparkSession, path: str, source: DataFrame, key: str, columns: list[str], order_by: list[Column], buckets: int, journal: str
) -> list[int]:
    """Set ``columns`` of the rows whose key ``source`` has, in place; gives the buckets rewritten.

    Values are copied as ``snapshots.update_from`` does.  Only buckets in which a
    key of ``source`` is really found are rewritten; the files of all others stay
    as they are.

    The new partitions are first written to ``journal``, a folder of this update
    alone, and then replace the old ones.  A call that was stopped is repeated
    with the same ``journal``: what it holds when it is complete is put in place
    again, and a partition that was just being replaced is made whole.  Of
    updates of one table only one may run at a time.
    """
    done = f"{journal.rstrip('/')}_done"
    if not _finished(spark, done):
        last = ky.dedupe_last(source.where(F.col(key).isNotNull()), [key], order_by, keep=columns).select(key, *columns)
        table = spark.read.parquet(path)
        found = _pruned(table.select(key, BUCKET), _buckets_of(last, key, buckets)).join(last.select(key), key, "left_semi")
        touched = sorted(r[0] for r in found.select(BUCKET).distinct().collect())
        fresh = sn.update_from(_pruned(table, touched), last, key, columns, [F.col(c) for c in columns])
        fresh.repartition(BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(f"{journal}")
        spark.createDataFrame([(touched,)], "touched array<int>").coalesce(1).write.mode("overwrite").parquet(done)
    touched = spark.read.parquet(done).head()["touched"]
    if touched:
        fresh = spark.read.schema(spark.read.parquet(journal).schema).parquet(journal)
        writer = fresh.repartition(BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(BUCKET).parquet(path)
    return touched
