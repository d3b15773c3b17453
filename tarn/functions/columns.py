"""Column expressions and small row-wise operators, all JVM-side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def band_label(column: str | Column, width: int = 10) -> Column:
    """`25` -> `20-30`; a multiple of the width is a band of its own, `30` -> `30-30`."""
    c = F.col(column) if isinstance(column, str) else column
    low, high = F.floor(c / width) * width, F.ceil(c / width) * width
    return F.concat(low.cast("string"), F.lit("-"), high.cast("string"))


def months_back(column: str | Column, months: int = 1) -> Column:
    """The day `months` earlier as `yyyyMMdd`, clamped to the end of a shorter month."""
    return F.date_format(F.add_months(column, -months), "yyyyMMdd")


def row_sum(df: DataFrame, columns: list[str], name: str = "row_sum") -> DataFrame:
    """Sum over the listed columns of each row; a missing value counts as 0."""
    total = F.lit(0)
    for c in columns:
        total = total + F.coalesce(F.col(c), F.lit(0))
    return df.withColumn(name, total)


_COMPARE = {
    "lessThan": lambda c, x: c < x,
    "lessThanOrEqual": lambda c, x: c <= x,
    "greaterThan": lambda c, x: c > x,
    "greaterThanOrEqual": lambda c, x: c >= x,
    "equal": lambda c, x: c == x,
    "notEqual": lambda c, x: c != x,
}


def flag_cells(
    df: DataFrame, column: str, rules: list[tuple[str, object, str]], name: str = "flag"
) -> DataFrame:
    """Label of the first rule (operator, value, label) that a cell meets, else NULL."""
    flag = F.lit(None).cast("string")
    for operator, value, label in reversed(rules):
        flag = F.when(_COMPARE[operator](F.col(column), F.lit(value)), F.lit(label)).otherwise(flag)
    return df.withColumn(name, flag)


def whitespace_fields(column: str | Column) -> Column:
    """The pieces of a line between runs of white space; commas stay inside their piece."""
    single_spaced = F.regexp_replace(column, r"\s+", " ")
    return F.filter(F.split(single_spaced, " "), lambda piece: piece != "")


def parse_whitespace_table(df: DataFrame, n: int = 4, column: str = "value") -> DataFrame:
    """Lines -> `column1` .. `column<n>`; a short line gives NULLs."""
    split = df.select(whitespace_fields(column).alias("__fields"))
    return split.select(*[F.get("__fields", F.lit(i)).alias(f"column{i + 1}") for i in range(n)])


def content_hash(column: str | Column) -> Column:
    """SHA-256 in lower-case hex."""
    return F.sha2(column, 256)


def hashed_uniform(seed: int, label: str, id_column: str) -> Column:
    """A uniform number in [0, 1) that depends only on (seed, label, id)."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.lit(label), F.col(id_column).cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") / F.lit(2.0**32)


def hashed_normal(seed: int, label: str, id_column: str) -> Column:
    """A standard normal number that depends only on (seed, label, id) (Box-Muller)."""
    radius = F.sqrt(-2 * F.log(1 - hashed_uniform(seed, label + "/r", id_column)))
    return radius * F.cos(2 * F.pi() * hashed_uniform(seed, label + "/a", id_column))
