"""Sources that make their rows: literals, ranges, synthetic people."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarn.functions.columns import hashed_uniform


def literal_table(spark: SparkSession, rows, schema=None) -> DataFrame:
    """A small table from Python rows, a pandas frame or a list of dicts."""
    return spark.createDataFrame(rows, schema)


def number_range(spark: SparkSession, first: int, end: int, name: str = "id") -> DataFrame:
    """Whole numbers from `first` up to, not including, `end`."""
    return spark.range(first, end).withColumnRenamed("id", name)


def date_range(spark: SparkSession, start: datetime.date | str, n: int, name: str = "day") -> DataFrame:
    """`n` consecutive days from `start`."""
    day = F.date_add(F.lit(str(start)).cast("date"), F.col("id").cast("int"))
    return spark.range(n).select(day.alias(name))


# Fixed values of the people generator.
DEPARTMENTS = ["HR", "IT", "Sales", "Marketing", "Engineering"]
AGE_FROM, AGE_BELOW = 18, 80
SALARY_FROM, SALARY_TO = 30_000, 120_000
HIRED_WITHIN_DAYS = 1825
ACTIVE_SHARE = 0.9
SEED = 42


def synth_people(
    spark: SparkSession, n: int, seed: int = SEED, as_of: datetime.datetime | str | None = None
) -> DataFrame:
    """`n` synthetic people with id 1..n; see `add_person_columns`."""
    return add_person_columns(spark.range(1, n + 1), "id", seed, as_of)


def add_person_columns(
    df: DataFrame, id_column: str, seed: int = SEED, as_of: datetime.datetime | str | None = None
) -> DataFrame:
    """Name, age, salary, department, hire date and active flag for every id.

    All values follow from (seed, id) by hashing, so they do not depend on partitioning or
    on which task is rerun, as those of `rand` would.
    """

    def pick(label: str, low: int, size: int):
        return (F.floor(hashed_uniform(seed, label, id_column) * size) + low).cast("int")

    now = F.lit(str(as_of)).cast("timestamp") if as_of else F.current_timestamp()
    salary = SALARY_FROM + hashed_uniform(seed, "salary", id_column) * (SALARY_TO - SALARY_FROM)
    departments = F.lit(DEPARTMENTS)
    return df.select(
        F.col(id_column).alias("id"),
        F.concat(F.lit("Person_"), F.col(id_column) - 1).alias("name"),
        pick("age", AGE_FROM, AGE_BELOW - AGE_FROM).alias("age"),
        F.round(salary, 2).alias("salary"),
        F.get(departments, pick("department", 0, len(DEPARTMENTS))).alias("department"),
        (now - F.make_dt_interval(pick("hire_date", 0, HIRED_WITHIN_DAYS))).alias("hire_date"),
        (hashed_uniform(seed, "active", id_column) < ACTIVE_SHARE).alias("active"),
    )
