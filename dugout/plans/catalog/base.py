"""Registry of runnable queries and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    """Register the function under its name, with its SQL where SQL can say it."""

    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLE[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def dealt(df: DataFrame) -> DataFrame:
    """Rows over all cores: a table of few bytes a row is one row group, and so one task, whatever is built of its rows."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


def payloads(df: DataFrame, body: Column, params: dict[str, Column] | None = None, *keep: str) -> DataFrame:
    """Rows of a table as raw payloads: JSON text and request parameters.

    The rows are dealt out first, as a landing table has its payloads in many files.
    """
    pairs = [part for name, value in (params or {}).items() for part in (F.lit(name), value.cast("string"))]
    mapped = F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")
    return dealt(df).select(*keep, F.to_json(body).alias("body"), mapped.alias("params"))


def obj(**fields) -> Column:
    """A struct of named columns; plain values become literals."""
    return F.struct(*[(v if isinstance(v, Column) else F.lit(v)).alias(k) for k, v in fields.items()])


def exact_sum(column: str) -> Column:
    """Sum of two-decimal amounts that does not depend on row order."""
    return F.sum(F.col(column).cast("decimal(18,2)")).cast("double")
