"""Writers: tables, dated CSV, database, and output names."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caselabel.sources import files


def save_table(df: DataFrame, path: str, partition_by: list[str] | None = None, rows_per_file: int = 0) -> str:
    """Replace the parquet table at ``path``; never the one ``df`` reads from."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.parquet(path)
    return path


def save_bucketed(df: DataFrame, table: str, key: str, buckets: int, path: str | None = None) -> None:
    """Replace a catalog table bucketed and sorted by key, in the warehouse or at ``path``.

    Later joins and updates of two such tables on the key need no shuffle.
    """
    writer = df.write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key)
    (writer.option("path", path) if path else writer).saveAsTable(table)


def save_csv(df: DataFrame, folder: str, name: str, run_date: dt.date, escape_lines: bool = False) -> str:
    """Write ``<folder>/<name>-<yyyy-mm-dd>`` as CSV with header.

    Missing texts and empty texts stay apart.  ``escape_lines`` writes line
    breaks as two characters, so that every record is one line and large files
    can be split; ``read_csv_typed`` undoes it.
    """
    path = f"{folder.rstrip('/')}/{name}-{run_date.isoformat()}"
    if escape_lines:
        texts = [c for c, kind in df.dtypes if kind == "string"]
        df = df.withColumns({c: files.escape_lines(F.col(c)) for c in texts})
    writer = df.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"')
    writer = writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    writer.option("nullValue", files.NULL_FIELD).option("emptyValue", '""').csv(path)
    return path


def save_jdbc(df: DataFrame, options: dict[str, str], table: str, batch_size: int = 1000) -> None:
    """Replace a database table with batched inserts; the caller brings the options."""
    df.write.format("jdbc").mode("overwrite").options(**options).option("dbtable", table).option(
        "batchsize", batch_size
    ).save()


def period_name(file_name: Column) -> Column:
    """Output table name for an input file named ``INEC_<yyyymmdd>_<yyyymmdd>``.

    Gives ``robosAI_<ddmmyy>_<ddmmyy>``, or ``RobosAI`` for other names.
    """
    pattern = r"INEC_([0-9]+)_([0-9]+)"

    def short(group: int) -> Column:
        digits = F.regexp_extract(file_name, pattern, group)
        return F.concat(F.substr(digits, F.lit(7)), F.substring(digits, 5, 2), F.substring(digits, 3, 2))

    return F.when(
        file_name.rlike(pattern), F.concat(F.lit("robosAI_"), short(1), F.lit("_"), short(2))
    ).otherwise("RobosAI")
