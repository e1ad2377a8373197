"""Column renaming and selection; names are resolved from the schema only."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caselabel.operators.aggregates import null_profile


def add_null_columns(df: DataFrame, names: list[str], dtype: str = "string") -> DataFrame:
    """Append empty columns."""
    return df.withColumns({n: F.lit(None).cast(dtype) for n in names})


def drop_extra_columns(df: DataFrame, reference: DataFrame) -> DataFrame:
    """Drop the columns that ``reference`` does not have."""
    return df.drop(*[c for c in df.columns if c not in reference.columns])


def strip_prefix(name: str) -> str:
    """``f_x`` or ``d_x`` to upper-case ``X``; the prefix may stand inside the name."""
    found = re.search(r"[df]_(\w+)", name)
    if not found:
        raise ValueError(f"column {name!r} has no f_ or d_ prefix")
    return found.group(1).upper()


def strip_prefix_columns(df: DataFrame) -> DataFrame:
    """Remove the ``f_``/``d_`` prefix of every column."""
    return df.toDF(*[strip_prefix(c) for c in df.columns])


def camel_case(name: str) -> str:
    """``cantidad_palabras`` to ``cantidadPalabras``.

    A word is a run of letters and digits; everything else separates words and
    is left out.  The first word is lower case, the others start with a capital.
    """
    words = [w for w in re.split(r"[\W_]+", name) if w]
    if not words:
        raise ValueError(f"column {name!r} has neither letter nor digit")
    return words[0].lower() + "".join(w.capitalize() for w in words[1:])


def camel_case_columns(df: DataFrame) -> DataFrame:
    """Camel-case every column name."""
    return df.toDF(*[camel_case(c) for c in df.columns])


def suffix_columns(df: DataFrame, suffix: str, keep: list[str]) -> DataFrame:
    """Append a suffix to every column but ``keep``."""
    return df.withColumnsRenamed({c: c + suffix for c in df.columns if c not in keep})


def strip_suffix_columns(df: DataFrame, *suffixes: str) -> DataFrame:
    """Remove the suffixes wherever they stand in a name."""
    names = []
    for name in df.columns:
        for suffix in suffixes:
            name = name.replace(suffix, "")
        names.append(name)
    return df.toDF(*names)


def label_project(df: DataFrame, text: str, label: str) -> DataFrame:
    """Training pairs ``(relato, labels)`` of one scheme."""
    return df.select(F.col(text).alias("relato"), F.col(label).alias("labels"))


def column_symdiff(left: DataFrame, right: DataFrame) -> DataFrame:
    """Columns found in only one of two frames, with how many rows miss a value."""
    only_left = [c for c in left.columns if c not in right.columns]
    only_right = [c for c in right.columns if c not in left.columns]
    left_side = null_profile(left.select(*only_left)).withColumn("side", F.lit("left_only"))
    right_side = null_profile(right.select(*only_right)).withColumn("side", F.lit("right_only"))
    return left_side.unionByName(right_side)
