"""The registered queries: name, the operators each one exercises, and its SQL twin."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    covers: tuple[str, ...]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(covers: str, sql: str | None = None):
    """Register a function (spark, sf_dir) -> DataFrame under its own name.

    `covers` lists the operator ids of the survey; `sql` gives the same rows in DuckDB, and
    is left out where SQL can not express the operator.
    """

    def register(run):
        QUERIES[run.__name__] = Query(run, tuple(covers.split()), sql)
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def exact_sum(column: str | Column, scale: int = 4) -> Column:
    """A sum of doubles that does not depend on the order of the rows."""
    c = F.col(column) if isinstance(column, str) else column
    return F.sum(c.cast(f"decimal(18,{scale})")).cast("double")
