"""Global order without one big task: surrogate keys, row indexes, cumulative values.

A plain `row_number() over (order by ...)` moves every row to a single partition. Here the
rows are range-partitioned and sorted once, and `monotonically_increasing_id` stamps each
row with its range (upper bits) and its position inside it (lower 33 bits). The stamped
rows are written out, so ranges can not shift between evaluations; after that only one
number per range is needed to turn positions into global ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tarn.session import as_columns, comes_in_file_order, stage

POSITION_BITS = 33  # layout of monotonically_increasing_id
STAMP = "__stamp"
_SALT = "__salt"
RANGE = "__range"


def _sortable(data_type: T.DataType) -> bool:
    if isinstance(data_type, T.ArrayType):
        return _sortable(data_type.elementType)
    if isinstance(data_type, T.StructType):
        return all(_sortable(f.dataType) for f in data_type.fields)
    return not isinstance(data_type, (T.MapType, T.VariantType))


def lay_out(df: DataFrame, order_by: list[str | Column], unique: bool = False) -> DataFrame:
    """`df` in global order, staged, with a `__stamp` of (range, position in range).

    `unique` promises that `order_by` has hardly any ties. Without it a hash of the other
    columns breaks ties, so the order does not depend on partitioning and no wide column is
    sampled or sorted, and a salt follows it so that even a huge group of identical rows is
    cut into several ranges. Name further columns in `order_by` for a tie order of your own. The salt numbers the rows as
    they come. A rerun task has to hand out the same ones, or copies could get lost, so the
    rows are staged first unless they come straight from a scan.
    """
    keys = as_columns(order_by)
    if unique:
        laid = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    else:
        named = {c for c in order_by if isinstance(c, str)}
        ties = [
            F.col(f"`{f.name}`")
            for f in df.schema.fields
            if _sortable(f.dataType) and f.name not in named
        ]
        tie = [F.xxhash64(*ties)] if ties else []
        steady = df if comes_in_file_order(df) else stage(df, "unordered")
        full = [*keys, *tie, F.col(_SALT)]
        salted = steady.withColumn(_SALT, F.monotonically_increasing_id())
        laid = salted.repartitionByRange(*full).sortWithinPartitions(*full).drop(_SALT)
    return stage(laid.withColumn(STAMP, F.monotonically_increasing_id()), "ordered")


def range_number() -> Column:
    return F.shiftright(F.col(STAMP), POSITION_BITS)


def position_in_range() -> Column:
    return F.col(STAMP).bitwiseAND(F.lit((1 << POSITION_BITS) - 1))


def before_ranges(laid: DataFrame, total: Column, combine) -> DataFrame:
    """Per range, `combine` of `total` over all earlier ranges.

    The window sorts one row per range, and the result is broadcast: both are bounded by
    the number of shuffle partitions, whatever the data size.
    """
    earlier = Window.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    per_range = laid.groupBy(range_number().alias(RANGE)).agg(total.alias("__total"))
    return per_range.select(RANGE, combine("__total").over(earlier).alias("__before"))


def with_row_index(
    df: DataFrame,
    order_by: list[str | Column],
    name: str = "row_index",
    start: int | Column = 0,
    unique: bool = False,
) -> DataFrame:
    """Dense row numbers in the order of `order_by`, counting from `start`."""
    laid = lay_out(df, order_by, unique)
    offsets = before_ranges(laid, F.count("*"), F.sum)
    first = start if isinstance(start, Column) else F.lit(start).cast("bigint")
    number = F.coalesce(F.col("__before"), F.lit(0)) + position_in_range() + first
    return (
        laid.withColumn(RANGE, range_number())
        .join(F.broadcast(offsets), RANGE)
        .withColumn(name, number)
        .drop(RANGE, "__before", STAMP)
    )


def assign_surrogate_keys(
    new: DataFrame,
    order_by: list[str | Column],
    start: int | Column = 0,
    name: str = "surrogate_key",
    unique: bool = False,
) -> DataFrame:
    """Dense keys `start + 1, start + 2, ...` for new members, put in the first column."""
    first = start if isinstance(start, Column) else F.lit(start).cast("bigint")
    keyed = with_row_index(new, order_by, name, first + 1, unique)
    return keyed.select(name, *[f"`{c}`" for c in new.columns])


def gappy_ids(df: DataFrame, name: str = "id") -> DataFrame:
    """Unique 64-bit ids without any shuffle; they have gaps and do not fit an INT column."""
    return df.withColumn(name, F.monotonically_increasing_id())


_CUMULATIVE = {"max": F.max, "min": F.min, "sum": F.sum}


def cumulative(
    df: DataFrame,
    order_by: list[str | Column],
    column: str,
    how: str = "max",
    name: str | None = None,
    unique: bool = False,
) -> DataFrame:
    """Running max, min or sum of `column`; missing values stay missing and are skipped.

    Running values inside a range need a second exchange on the range number, which spreads
    evenly because ranges are cut to equal size.
    """
    combine = _CUMULATIVE[how]
    name = name or f"cum{how}_{column}"
    is_float = isinstance(df.schema[column].dataType, (T.FloatType, T.DoubleType))
    value = F.nanvl(column, F.lit(None)) if is_float else F.col(column)
    laid = lay_out(df, order_by, unique)
    before = before_ranges(laid, combine(value), combine)
    running = Window.partitionBy(RANGE).orderBy(STAMP).rowsBetween(Window.unboundedPreceding, 0)
    here = F.col("__running")
    carried = F.col("__before")
    joined = {
        "max": F.greatest(here, carried),
        "min": F.least(here, carried),
        "sum": here + F.coalesce(carried, F.lit(0)),
    }[how]
    return (
        laid.withColumn(RANGE, range_number())
        .withColumn("__running", combine(value).over(running))
        .join(F.broadcast(before), RANGE)
        .withColumn(name, F.when(value.isNotNull(), joined))
        .drop(RANGE, "__running", "__before", STAMP)
    )
