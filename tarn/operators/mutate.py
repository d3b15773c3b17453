"""Table changes as DataFrame expressions: merge, dimension renewal, densification.

Each function takes the current table and returns the next one; `tarn.sources.writers`
publishes the result. Nothing overwrites a path that the same plan reads.
"""

from __future__ import annotations

from functools import reduce
from urllib.parse import unquote

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarn.operators.keys import assign_surrogate_keys
from tarn.operators.validate import require_key
from tarn.session import stage
from tarn.sources.readers import rows_as_stored
from tarn.sources.writers import remove_folder

_HIT = "__hit"


def merge_update(
    target: DataFrame,
    source: DataFrame,
    on: list[str] | None = None,
    protect: list[str] | None = None,
) -> DataFrame:
    """Rows of `target`, with the columns of a matching `source` row put over them.

    `on` defaults to the second column. Columns in `protect` (default: the first one) keep
    their value. A key that occurs twice in `source` is an error.
    """
    on = on or [target.columns[1]]
    protect = [target.columns[0]] if protect is None else protect
    source = _named_like(source, target)
    require_key(source.dropna(subset=on), on, "merge source")
    changed = _changed(target, source, [*on, *protect])
    incoming = source.select(
        *on, *[F.col(f"`{c}`").alias(f"__new_{c}") for c in changed], F.lit(True).alias(_HIT)
    )
    joined = target.join(incoming, on, "left")
    return joined.select(*_overlaid(target, changed, F.col(_HIT)))


def _named_like(source: DataFrame, target: DataFrame) -> DataFrame:
    """Source columns under the names of the target, whatever their case; one that the
    target lacks is an error."""
    names = {c.lower(): c for c in target.columns}
    unknown = [c for c in source.columns if c.lower() not in names]
    if unknown:
        raise ValueError(f"the target has no columns {unknown}")
    return source.toDF(*[names[c.lower()] for c in source.columns])


def _changed(target: DataFrame, source: DataFrame, kept: list[str]) -> list[str]:
    return [c for c in target.columns if c in source.columns and c not in kept]


def _overlaid(target: DataFrame, changed: list[str], hit: Column) -> list[Column]:
    """The target's columns, `__new_` values over the changed ones where `hit` is true."""

    def value(c: str) -> Column:
        if c not in changed:
            return F.col(f"`{c}`")
        new = F.col(f"`__new_{c}`").cast(target.schema[c].dataType)
        return F.when(hit, new).otherwise(F.col(f"`{c}`")).alias(c)

    return [value(c) for c in target.columns]


def new_members(target: DataFrame, source: DataFrame, on: list[str]) -> DataFrame:
    """Source rows whose key the target does not have (`LEFT JOIN ... IS NULL`)."""
    known = target.select(*on).distinct()
    return source.join(known, on, "left_anti").select(*[f"`{c}`" for c in source.columns])


def merge_insert(target: DataFrame, source: DataFrame, on: list[str] | None = None) -> DataFrame:
    """`target` plus the source rows that match no target row, columns by name."""
    on = on or [target.columns[1]]
    return target.unionByName(new_members(target, source, on).select(*[f"`{c}`" for c in target.columns]))


def renew_dimension(
    dim: DataFrame, incoming: DataFrame, key: str | None = None, surrogate: str | None = None
) -> DataFrame:
    """Update known members, insert new ones with the next surrogate keys.

    Known members keep their surrogate key, new ones get `max + 1, max + 2, ...` in key
    order (from 1 on an empty dimension). The key of `incoming` has to be unique and not
    null: a NULL never matches and would be inserted again by every run. Columns are matched
    whatever their case, and one that `dim` lacks is an error. Both tables are read once, by
    one full join that is staged.
    """
    surrogate = surrogate or dim.columns[0]
    key = key or dim.columns[1]
    incoming = _named_like(incoming, dim)
    changed = _changed(dim, incoming, [key, surrogate])
    # one row per incoming key; the plan itself finds keys that are missing or repeated
    fields = F.struct(F.lit(True).alias(_HIT), *[F.col(f"`{c}`").alias(f"__new_{c}") for c in changed])
    per_key = incoming.groupBy(key).agg(F.count("*").alias("__n"), F.first(fields).alias("__fields"))
    wrong = F.raise_error(F.lit(f"incoming dimension rows: [{key!r}] is not a key"))
    checked = F.when(F.col(key).isNull() | (F.col("__n") > 1), wrong.cast(incoming.schema[key].dataType))
    rows = per_key.select(checked.otherwise(F.col(key)).alias(key), "__fields.*")
    try:
        both = stage(dim.withColumn("__known", F.lit(True)).join(rows, key, "full"), "renewed")
    except PySparkException as error:
        if "is not a key" in str(error):
            raise ValueError(f"incoming dimension rows: [{key!r}] is not a key") from None
        raise
    known = both.filter("__known").select(*_overlaid(dim, changed, F.col(_HIT)))
    highest = both.agg(F.coalesce(F.max(surrogate), F.lit(0)).cast("bigint")).scalar()
    fresh = both.filter("__known IS NULL").select(*_overlaid(dim, changed, F.lit(True)))
    keyed = assign_surrogate_keys(fresh.drop(surrogate), [key], highest, surrogate, unique=True)
    keyed = keyed.select(*[F.col(f"`{c}`").cast(dim.schema[c].dataType).alias(c) for c in dim.columns])
    return known.unionByName(keyed)


def merge_partitions(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    on: list[str],
    protect: list[str] | None = None,
    insert: bool = True,
) -> int:
    """Merge `source` into the partitioned Parquet table at `path`, rewriting only the
    partitions that it concerns; returns their number.

    Concerned are the partitions of rows with a matching key, which a scan of the key columns
    finds, and those that the source's rows belong to. Matching rows take the columns of the
    source but for `on` and `protect` (default: none); a new value in a partition column
    moves a row. With `insert` the other rows are added. Columns are matched whatever their
    case; one that the table lacks, or a key that occurs twice in the source, is an error, and
    so are new rows without the partition columns. Partition values are matched as text.
    Partitions are replaced when all new files are written; files of others stay as they are.
    A partition that has lost all its rows is removed after that; if that is interrupted, its
    rows are there twice until the merge is repeated.
    """
    target, partitions = rows_as_stored(spark, path)
    if not partitions:
        raise ValueError(f"{path} has no partitions; replace it by merge_update and merge_insert")
    source = _named_like(source, target)
    source = stage(source.withColumns({c: F.col(c).cast("string") for c in partitions if c in source.columns}), "source")
    placed = all(c in source.columns for c in partitions)
    if insert and not placed:
        raise ValueError(f"new rows need the partition columns {partitions}")
    folder = F.regexp_extract("_metadata.file_path", "(.*)/", 1)
    hit = target.select(*on, *partitions, folder.alias("__folder")).join(source.select(*on), on, "left_semi")
    concerned = hit.select(*partitions, "__folder").distinct()
    if placed:
        known = target.select(*partitions, folder.alias("__folder")).distinct()
        wanted = source.select(*partitions).distinct()
        same = reduce(Column.__and__, [known[c].eqNullSafe(wanted[c]) for c in partitions])
        concerned = concerned.unionByName(known.join(wanted, same, "left_semi")).distinct()
    listed = concerned.collect()  # one row per rewritten folder

    def of(row):
        return reduce(Column.__and__, [F.col(f"`{c}`").eqNullSafe(F.lit(row[c])) for c in partitions])

    old = target.filter(reduce(Column.__or__, map(of, listed), F.lit(False)))
    rows = merge_update(old, source, on, protect or [])
    if insert:
        fresh = new_members(old, source, on)
        rows = rows.unionByName(fresh, allowMissingColumns=True)
    rows = stage(rows.select(*[F.col(f"`{f.name}`").cast(f.dataType) for f in target.schema.fields]), "merged")
    written = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions)
    written.parquet(path)
    left = {tuple(r) for r in rows.select(*partitions).distinct().collect()}
    for row in listed:
        if tuple(row[c] for c in partitions) not in left:
            remove_folder(spark, unquote(row["__folder"]))
    spark.catalog.refreshByPath(path)
    return len({tuple(row[c] for c in partitions) for row in listed} | left)


def densify_missing(
    keys: DataFrame, key: str, first: int, last: int, name: str, existing: DataFrame
) -> DataFrame:
    """One row per new key and per number from `first` to `last`.

    Keys that `existing` holds at all are skipped whole, so a second run adds nothing. The
    numbers come from `explode(sequence(...))` on each key: no join partner, no shuffle
    beyond the distinct and the anti-join on the key.
    """
    known = existing.select(key).distinct()
    fresh = keys.select(key).distinct().join(known, key, "left_anti")
    return fresh.withColumn(name, F.explode(F.sequence(F.lit(first), F.lit(last))))
