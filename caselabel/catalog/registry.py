"""Query registry and small helpers for the SQL twins."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caselabel.catalog.roles import Roles


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(roles) -> DataFrame`` with the SQL that must give the same rows."""

    def add(fn: Callable[[Roles], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(Roles(spark, sf_dir))

        REGISTRY[name] = Query(run, sql)
        return fn

    return add


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Round doubles so that engines with another summation order agree."""
    return df.withColumns({c: F.round(F.col(c), digits) for c in columns})


def dated(df: DataFrame, *columns: str, fmt: str = "yyyy-MM-dd") -> DataFrame:
    """Dates as text, which compares alike in every client."""
    return df.withColumns({c: F.date_format(c, fmt) for c in columns})
