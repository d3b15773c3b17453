"""Join helpers; every other join is `DataFrame.join` as it is."""

from __future__ import annotations

from pyspark.sql import DataFrame

# The accepted join type names.
JOIN_TYPES = [
    "inner", "outer", "full", "fullouter", "full_outer",
    "leftouter", "left", "left_outer", "rightouter", "right", "right_outer",
    "leftsemi", "left_semi", "semi", "leftanti", "left_anti", "anti", "cross",
]


def split_outer_join(left: DataFrame, right: DataFrame, on: list[str], how: str) -> DataFrame:
    """Outer join by name (`left`, `right` or `full`) that stands a hot key on either side.

    At run time Spark cuts an over-full partition of an inner join on both sides, but of an
    outer join only on the preserved one, and of a full join not at all. So the matches
    come from an inner join, and unmatched rows from anti-joins with distinct keys.
    """
    columns = [*on, *[c for c in left.columns if c not in on], *[c for c in right.columns if c not in on]]
    rows = left.join(right, on, "inner")
    if how in ("left", "full"):
        unmatched = left.join(right.select(*on).distinct(), on, "left_anti")
        rows = rows.unionByName(unmatched, allowMissingColumns=True)
    if how in ("right", "full"):
        unmatched = right.join(left.select(*on).distinct(), on, "left_anti")
        rows = rows.unionByName(unmatched, allowMissingColumns=True)
    return rows.select(*[f"`{c}`" for c in columns])


def combine_all(left: DataFrame, right: DataFrame) -> DataFrame:
    """Every left row with every right row; clashing names get `.x`, `.y`.

    All pairs are the feature here, so this one is a cross join: its result is as large as
    the product of both sides.
    """
    clash = {c.lower() for c in left.columns} & {c.lower() for c in right.columns}

    def named(df: DataFrame, suffix: str) -> DataFrame:
        return df.toDF(*[f"{c}{suffix}" if c.lower() in clash else c for c in df.columns])

    return named(left, ".x").crossJoin(named(right, ".y"))
