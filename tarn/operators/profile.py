"""Counts over many tables, column means, profiles and exact quantiles."""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tarn.operators.keys import POSITION_BITS, RANGE, STAMP, lay_out, range_number
from tarn.sources.writers import append_or_create


def count_tables(tables: dict[tuple[str, str, str], DataFrame]) -> DataFrame:
    """Row counts of many tables, keyed by (database, schema, table), as one plan.

    Spark runs the branches of the union side by side, so no threads are needed.
    """
    counts = [
        df.agg(F.count("*").alias("COUNT")).select(
            F.lit(database).alias("DATABASE_NAME"),
            F.lit(schema).alias("SCHEMA_NAME"),
            F.lit(table).alias("TABLE_NAME"),
            "COUNT",
        )
        for (database, schema, table), df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def count_objects(tables: dict[str, DataFrame], dummy: bool = True) -> DataFrame:
    """Distinct (Aantal, Object) count rows, seeded with a (0, dummy) row on request."""
    counts = [
        df.agg(F.count("*").alias("Aantal")).withColumn("Object", F.lit(name))
        for name, df in tables.items()
    ]
    if dummy:
        first = next(iter(tables.values()))
        counts.insert(
            0, first.sparkSession.range(1).select(F.lit(0).alias("Aantal"), F.lit("dummy").alias("Object"))
        )
    return reduce(DataFrame.unionByName, counts).distinct()


def highest(df: DataFrame, column: str, name: str = "highest") -> DataFrame:
    """The largest value of `column`, 0 for an empty table."""
    return df.agg(F.coalesce(F.max(column), F.lit(0)).alias(name))


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def present(df: DataFrame, column: str) -> Column:
    """The value, with NaN as NULL."""
    if isinstance(df.schema[column].dataType, (T.FloatType, T.DoubleType)):
        return F.nanvl(column, F.lit(None))
    return F.col(column)


def group_sums(df: DataFrame, keys: list[str], columns: list[str] | None = None) -> DataFrame:
    """Sums of the numeric columns per group; other columns are left out."""
    columns = columns or [c for c in numeric_columns(df) if c not in keys]
    return df.groupBy(*keys).agg(*[F.sum(present(df, c)).alias(c) for c in columns])


def column_means(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Mean of each numeric column, missing values skipped."""
    columns = columns or numeric_columns(df)
    return df.agg(*[F.avg(present(df, c)).alias(c) for c in columns])


QUARTILES = {"25%": 0.25, "50%": 0.5, "75%": 0.75}


def describe_long(df: DataFrame, columns: list[str] | None = None, exact: bool = False) -> DataFrame:
    """(column, stat, value): count, mean, std, min, quartiles, max of numeric columns.

    One pass; quartiles are approximate with a bounded sketch unless `exact`, which adds
    one distributed sort of the values.
    """
    columns = columns or numeric_columns(df)
    entries = []
    for c in columns:
        value = present(df, c).cast("double")
        stats = {
            "count": F.count(value).cast("double"),
            "mean": F.avg(value),
            "std": F.stddev_samp(value),
            "min": F.min(value),
            "max": F.max(value),
        }
        if not exact:
            marks = F.percentile_approx(value, list(QUARTILES.values()), 10_000)
            stats |= {name: F.get(marks, F.lit(i)) for i, name in enumerate(QUARTILES)}
        for stat, value in stats.items():
            entries.append(
                F.struct(F.lit(c).alias("column"), F.lit(stat).alias("stat"), value.alias("value"))
            )
    profile = df.agg(F.array(*entries).alias("__stats")).select(F.inline("__stats"))
    if exact:
        marks = exact_quantiles(df, columns, list(QUARTILES.values()))
        names = F.create_map(*[F.lit(x) for name, q in QUARTILES.items() for x in (q, name)])
        stat = names[F.col("quantile")].alias("stat")
        profile = profile.unionByName(marks.select("column", stat, "value"))
    return profile


#: Size of a quantile sketch; ranks are off by less than half a percent of the rows.
SKETCH_SIZE = 800


def profile_sketches(df: DataFrame, columns: list[str] | None = None, size: int = SKETCH_SIZE) -> DataFrame:
    """One row per numeric column that profiles can be merged from: column, n (values), mean,
    m2 (summed squares around the mean), low, high, sketch (of quantiles). One pass; a column
    without values has n = 0. Missing values, NaN among them, are left out."""
    entries = []
    for c in columns or numeric_columns(df):
        value = present(df, c).cast("double")
        entries.append(
            F.struct(
                F.lit(c).alias("column"),
                F.count(value).alias("n"),
                F.avg(value).alias("mean"),
                (F.var_pop(value) * F.count(value)).alias("m2"),
                F.min(value).alias("low"),
                F.max(value).alias("high"),
                F.kll_sketch_agg_double(value, F.lit(size)).alias("sketch"),
            )
        )
    return df.agg(F.array(*entries).alias("__rows")).select(F.inline("__rows"))


def merge_sketches(parts: DataFrame, size: int = SKETCH_SIZE) -> DataFrame:
    """The sketches of all rows of some loads, from those of each load, in the same form."""
    whole = Window.partitionBy("column")
    mean = F.sum(F.col("n") * F.col("mean")).over(whole) / F.nullif(F.sum("n").over(whole), F.lit(0))
    aside = F.col("m2") + F.col("n") * (F.col("mean") - F.col("all_mean")) ** 2
    return parts.withColumn("all_mean", mean).groupBy("column").agg(
        F.sum("n").alias("n"),
        F.max("all_mean").alias("mean"),
        F.sum(aside).alias("m2"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.kll_merge_agg_double("sketch", F.lit(size)).alias("sketch"),
    )


def sketched_profile(sketches: DataFrame) -> DataFrame:
    """(column, stat, value) as of `describe_long`, from one sketch row per column."""
    stats = {
        "count": F.col("n").cast("double"),
        "mean": F.col("mean"),
        "std": F.when(F.col("n") > 1, F.sqrt(F.col("m2") / (F.col("n") - 1))),
        "min": F.col("low"),
        "max": F.col("high"),
    }
    for name, q in QUARTILES.items():
        stats[name] = F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(q)))
    entries = [F.struct(F.lit(stat).alias("stat"), value.alias("value")) for stat, value in stats.items()]
    return sketches.select("column", F.inline(F.array(*entries)))


def append_profile(df: DataFrame, path: str, load: str, columns: list[str] | None = None) -> None:
    """Keep the sketches of one load in the table at `path`; a repeated load replaces its own.

    Only the rows of the load are read, however large the table they go to has become.
    """
    append_or_create(profile_sketches(df, columns), path, batch=load)


def stored_profile(spark: SparkSession, path: str) -> DataFrame:
    """The profile of all loads kept at `path`; it reads one row per load and column."""
    return sketched_profile(merge_sketches(spark.read.parquet(path).drop("batch")))


def exact_quantiles(df: DataFrame, columns: list[str], quantiles: list[float]) -> DataFrame:
    """(column, quantile, value) with linear interpolation, exact at any size.

    Values are counted first, so copies collapse before the exchange. The distinct values
    of all columns are then laid out in one global order, column after column. The driver
    sees row totals per range and column only; they tell which few ranges hold the wanted
    ranks, and just those are read again.
    """
    values = df.select(*[present(df, c).cast("double").alias(str(i)) for i, c in enumerate(columns)])
    long = values.unpivot([], [str(i) for i in range(len(columns))], "n", "value").dropna()
    counted = long.groupBy(F.col("n").cast("int").alias("n"), "value").agg(F.count("*").alias("copies"))
    laid = lay_out(counted, ["n", "value"], unique=True)
    totals = laid.groupBy("n", range_number().alias(RANGE)).agg(F.sum("copies").alias("copies"))
    parts = pd.DataFrame(totals.orderBy("n", RANGE).collect(), columns=["n", "range", "copies"])

    wanted = []  # (column number, quantile, share of the upper neighbour, range, rank in range)
    for n, part in parts.groupby("n"):
        ends = part["copies"].cumsum().to_numpy()
        for q in quantiles:
            place = q * float(ends[-1] - 1)
            for rank in (math.floor(place), math.ceil(place)):
                i = int(np.searchsorted(ends, rank, side="right"))
                before = int(ends[i - 1]) if i else 0
                wanted.append((int(n), float(q), place % 1, int(part["range"].iloc[i]), rank - before))
    schema = f"n int, quantile double, share double, {RANGE} bigint, rank bigint"
    ranks = df.sparkSession.createDataFrame(wanted, schema)

    inside = F.lit(False)
    for r in sorted({w[3] for w in wanted}):
        inside = inside | F.col(STAMP).between(r << POSITION_BITS, ((r + 1) << POSITION_BITS) - 1)
    order = Window.partitionBy(RANGE, "n").orderBy(STAMP).rowsBetween(Window.unboundedPreceding, 0)
    covered = laid.filter(inside).withColumn(RANGE, range_number())
    covered = covered.withColumn("upto", F.sum("copies").over(order))
    # one row per column, quantile and neighbour: as small as the two lists given
    hits = covered.join(F.broadcast(ranks), ["n", RANGE]).filter(
        (F.col("rank") < F.col("upto")) & (F.col("rank") >= F.col("upto") - F.col("copies"))
    )
    low, high = F.min("value"), F.max("value")
    marks = hits.groupBy("n", "quantile").agg((low + (high - low) * F.max("share")).alias("value"))
    return marks.select(F.get(F.lit(columns), F.col("n")).alias("column"), "quantile", "value")


def summarize(df: DataFrame, statistics: list[str] | None = None) -> DataFrame:
    """`DataFrame.summary`, strings included."""
    return df.summary(*(statistics or []))
