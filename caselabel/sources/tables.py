"""Reading case, commission and narrative tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caselabel import vocab
from caselabel.functions import text as tx
from caselabel.operators import keys as ky


def read_jdbc(
    spark: SparkSession,
    options: dict[str, str],
    table: str,
    partition_column: str | None = None,
    bounds: tuple[str, str] | None = None,
    partitions: int = 64,
    fetch_size: int = 10_000,
) -> DataFrame:
    """Read a database table; the caller brings the connection options.

    With a numeric, date or timestamp ``partition_column`` and the ``bounds`` of
    its values the table is read in parallel ranges, which replaces paging with
    LIMIT/OFFSET and key chunks.  Without them one task reads it.
    """
    if (partition_column is None) != (bounds is None):
        raise ValueError("partition_column and bounds go together")
    reader = spark.read.format("jdbc").options(**options).option("dbtable", table).option("fetchsize", fetch_size)
    if partition_column:
        low, high = bounds
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", low)
            .option("upperBound", high)
            .option("numPartitions", partitions)
        )
    return reader.load()


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Parquet table as it lies.

    Split sizes are the session's business (``spark.sql.files.maxPartitionBytes``
    and ``minPartitionNum``): tables are never shuffled just to spread them.
    """
    return spark.read.parquet(path)


def read_cases(
    table: DataFrame, text: str = "RELATO", words: str = "CANTIDAD_PALABRAS", key: str = "NDD", sample: int | None = None
) -> DataFrame:
    """Case table with the narrative normalised and its words counted."""
    if sample is not None:
        table = sample_first(table, key, sample)
    return table.withColumn(text, tx.normalize_text(F.col(text))).withColumn(words, tx.word_count_space(F.col(text)))


def read_commission(table: DataFrame, offence: str = "ROBO") -> DataFrame:
    """Commission labels of one offence type, projected and renamed."""
    return table.where(F.col("Tipo_Delito_PJ") == offence).select(
        "NDD",
        F.col("Tipo_Delito_PJ").alias("Tipo_Delito_PJ_comision"),
        F.col("delitos_seguimiento").alias("delitos_seguimiento_comision"),
        F.col("delitos_validados").alias("delitos_validados_comision"),
        F.col("Fecha_Incidente").alias("FechaIncidenteComision"),
        F.col("Fecha_Registro").alias("FechaRegistroComision"),
    )


def valid_narratives() -> Column:
    """Narratives that count: state 1 and not annulled."""
    return (F.col("estado") == 1) & (F.col("anulada") == "NO")


def narratives_for(narratives: DataFrame, keys: DataFrame, order_by: list[Column], clean=tx.strip_markup) -> DataFrame:
    """One valid narrative ``(NDD, RELATO)`` for every key in ``keys``.

    ``narratives`` has ``codfisc, obserinc, estado, anulada``.  The key set is a
    semi join instead of an IN list, so it may be as large as the table.
    """
    wanted = narratives.where(valid_narratives()).select(
        F.col("codfisc").alias("NDD"), F.col("obserinc").alias("RELATO"), *order_by
    )
    # Ties are broken by a hash, so that the narrative itself is carried once and never compared.
    order = [*[F.col(c) for c in wanted.columns[2:]], F.xxhash64("RELATO")]
    latest = ky.dedupe_last(ky.semi_known(wanted, keys, "NDD"), ["NDD"], order, keep=["RELATO"])
    return latest.select("NDD", clean(F.col("RELATO")).alias("RELATO"))


def since(df: DataFrame, column: str, start, end) -> DataFrame:
    """Rows dated from ``start`` to ``end``, both included; "now" is the caller's ``end``."""
    return df.where(F.col(column).between(F.lit(start), F.lit(end)))


def in_year(df: DataFrame, column: str, year: int) -> DataFrame:
    """Rows of one calendar year, written as a range so the scan can prune."""
    day = F.col(column)
    return df.where((day >= F.lit(f"{year}-01-01").cast("date")) & (day < F.lit(f"{year + 1}-01-01").cast("date")))


def sample_first(df: DataFrame, key: str = "NDD", n: int = 1000) -> DataFrame:
    """Trial run on the first ``n`` rows by key."""
    return df.orderBy(key).limit(n)


def key_column(number: Column, width: int = vocab.KEY_WIDTH) -> Column:
    """Text key of a numeric id."""
    return tx.zero_pad_key(number.cast("string"), width)
