"""Missing data, label windows, transpose and checked concatenation."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def concat_same_schema(frames: list[DataFrame]) -> DataFrame:
    """Rows of all frames; names, order and types of the columns have to agree."""

    def shape(df: DataFrame) -> list[tuple[str, str]]:
        return [(f.name, f.dataType.simpleString()) for f in df.schema.fields]

    for df in frames[1:]:
        if shape(df) != shape(frames[0]):
            raise ValueError(f"schemas differ: {shape(frames[0])} and {shape(df)}")
    return reduce(DataFrame.unionByName, frames)


def drop_missing(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows without any NULL or NaN."""
    return df.na.drop("any", subset=columns)


def fill_missing(df: DataFrame, value, columns: list[str] | None = None) -> DataFrame:
    """NULL and NaN replaced by a constant."""
    return df.na.fill(value, subset=columns)


def reindex(df: DataFrame, label: str, labels: DataFrame, extra: dict[str, str] | None = None) -> DataFrame:
    """The rows of the wanted labels, an empty row for a label without any, plus empty
    columns `name -> type`.

    Both halves tolerate a hot label: the semi-join broadcasts or splits, and the missing
    labels are found against the distinct ones.
    """
    wanted = labels.select(label).distinct()
    found = df.join(wanted, label, "left_semi").select(*[f"`{c}`" for c in df.columns])
    missing = wanted.join(df.select(label).distinct(), label, "left_anti")
    rows = found.unionByName(missing, allowMissingColumns=True)
    return rows.select("*", *[F.lit(None).cast(t).alias(c) for c, t in (extra or {}).items()])


def assign_between(df: DataFrame, label: str, first, last, column: str, value) -> DataFrame:
    """`column` set to `value` where the label lies from `first` to `last`, both included."""
    inside: Column = F.col(label).between(F.lit(first), F.lit(last))
    return df.withColumn(column, F.when(inside, F.lit(value)).otherwise(F.col(column)))


def transpose(df: DataFrame, label: str, max_rows: int) -> DataFrame:
    """Columns become rows, and each row becomes a column named after its label.

    Only a bounded frame has a transpose a table can hold: one of more than `max_rows` rows
    is an error. Values take the type that Spark finds common to their columns, text if
    there is none.
    """
    labels = [row[0] for row in df.select(F.col(label).cast("string")).orderBy(label).head(max_rows + 1)]
    if len(labels) > max_rows:
        raise ValueError(f"more than {max_rows} rows can not become columns")
    if None in labels or len(set(labels)) < len(labels):
        raise ValueError(f"labels in {label} have to be unique and not null")
    values = [c for c in df.columns if c != label]
    try:
        common = df.select(F.coalesce(*[f"`{c}`" for c in values])).schema[0].dataType.simpleString()
    except AnalysisException:
        common = "string"
    wide = df.select(
        F.col(label).cast("string").alias("__label"), *[F.col(f"`{c}`").cast(common).alias(c) for c in values]
    )
    long = wide.unpivot("__label", values, "column", "__value")
    return long.groupBy("column").pivot("__label", labels).agg(F.first("__value"))
