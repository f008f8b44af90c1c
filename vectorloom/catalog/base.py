"""Registry of queries over the driver's tables, each with its SQL equivalent if there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        QUERIES[name] = query
        if sql is not None:
            ORACLES[name] = sql
        return query

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def as_line(*columns: str, sep: str = ",") -> Column:
    """The columns of a row as one delimited text line."""
    return F.concat_ws(sep, *[F.col(c).cast("string") for c in columns])
