"""Reading CSV and multi-file inputs with explicit schemas."""

from __future__ import annotations

import json
import re
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caselabel.functions import text as tx

#: How a missing text is written, so that empty text can stay empty.
NULL_FIELD = "\\N"


def read_csv_typed(
    spark: SparkSession,
    path,
    schema: T.StructType | str,
    header: bool = True,
    multiline: bool = False,
    escaped_lines: bool = False,
) -> DataFrame:
    """CSV with a given schema; keys stay text, bad lines land in ``_corrupt_record``.

    An unquoted empty field or ``\\N`` is NULL and ``""`` is empty text.  Texts with line
    breaks need one of two options: ``multiline`` reads breaks inside quotes,
    each file in one task; ``escaped_lines`` undoes what ``save_csv`` did with
    its own option, and large files stay splittable.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    schema = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    read = (
        spark.read.schema(schema)
        .option("header", header)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt_record")
        .option("multiLine", multiline)
        .option("quote", '"')
        .option("escape", '"')
        .option("nullValue", NULL_FIELD)
        .option("emptyValue", "")
        .csv(path)
    )
    if not escaped_lines:
        return read
    texts = [f.name for f in schema.fields if isinstance(f.dataType, T.StringType) and f.name != "_corrupt_record"]
    return read.withColumns({c: unescape_lines(F.col(c)) for c in texts})


def escape_lines(text: Column) -> Column:
    """Line breaks as ``\\n`` and ``\\r``, backslashes doubled."""
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.replace(F.replace(out, F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r"))


def unescape_lines(text: Column) -> Column:
    """The text that ``escape_lines`` was given."""
    parts = F.transform(
        F.split(text, r"\\\\", -1),
        lambda x: F.replace(F.replace(x, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r")),
    )
    # A doubled backslash separates the parts; what is left of single ones starts a break.
    return F.when(text.isNotNull(), F.array_join(parts, "\\"))


_YEAR = r"(?<![0-9])([0-9]{4})(?![0-9])"


def _year_of(path: str) -> int | None:
    found = re.search(_YEAR, path.rstrip("/").rsplit("/", 1)[-1])
    return int(found.group(1)) if found else None


def read_yearly_files(
    spark: SparkSession,
    paths: list[str],
    names: tuple[str, str] = ("NDD", "RELATO"),
    fmt: str = "parquet",
    readers: int = 16,
) -> DataFrame:
    """Concatenate files whose headers differ, taking the columns by position.

    The key is zero-padded to text and ``anio`` is the four-digit year in the
    last part of the path.  Headers are read first, ``readers`` at a time; then
    all files of one header are one scan, however many there are, with the year
    taken from each row's file.  Folders share a scan by header and year.  A path
    named twice is read twice.
    """
    if not paths:
        raise ValueError("there are no files to read")

    def reader():
        return (spark.read.option("header", True) if fmt == "csv" else spark.read).format(fmt)

    def header(path: str) -> tuple[T.StructType, bool]:
        frame = reader().load(path)
        held = [unquote(f) for f in frame.inputFiles()]
        return frame.schema, len(held) == 1 and held[0].endswith("/" + path.rstrip("/").rsplit("/", 1)[-1])

    with ThreadPoolExecutor(readers) as pool:
        headers = list(pool.map(header, paths))
    scans: dict[tuple, list[str]] = {}
    times: dict[str, int] = {}
    for path, (schema, is_file) in zip(paths, headers, strict=True):
        times[path] = times.get(path, 0) + 1
        year = None if is_file else _year_of(path)
        scans.setdefault((schema.json(), is_file, year, times[path]), []).append(path)
    parts = []
    for (schema, is_file, year, _), group in scans.items():
        part = reader().schema(T.StructType.fromJson(json.loads(schema))).load(group)
        first, second = (F.col(f"`{c}`") for c in part.columns[:2])
        in_name = F.regexp_extract(F.url_decode(F.col("_metadata.file_name")), _YEAR, 1).try_cast("int")
        part = part.select(
            tx.zero_pad_key(first.cast("string")).alias(names[0]),
            second.cast("string").alias(names[1]),
            (in_name if is_file else F.lit(year).cast("int")).alias("anio"),
        )
        parts.append(part)
    return reduce(DataFrame.unionByName, parts)


def read_labelled_splits(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Labelled text ``(relato, labels, split, _corrupt_record)`` from one CSV per split."""
    out = None
    for split, path in paths.items():
        part = read_csv_typed(spark, path, "relato string, labels string", multiline=True)
        part = part.select("relato", "labels", F.lit(split).alias("split"), "_corrupt_record")
        out = part if out is None else out.unionByName(part)
    return out
