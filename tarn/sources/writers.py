"""Sinks: appended, replaced, size-targeted and single-file output."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarn.session import settings

TARGET_MB = 256
ROW_GROUP_ROWS = 100_000


def _fs(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


# Text formats cut timestamps to milliseconds unless told otherwise.
_FULL_TIME = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def qualified_path(spark: SparkSession, path: str) -> str:
    """The path as file listings spell it, with scheme and without a trailing slash."""
    fs, p = _fs(spark, path)
    return fs.makeQualified(p).toString()


def write_csv(df: DataFrame, path: str, sep: str = ";", mode: str = "overwrite") -> None:
    writer = df.write.mode(mode).options(header="true", sep=sep, escape='"', **_FULL_TIME)
    writer.csv(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).options(ignoreNullFields="false", **_FULL_TIME).json(path)


def write_text(df: DataFrame, path: str, column: str = "value", mode: str = "overwrite") -> None:
    df.select(F.col(column).cast("string").alias("value")).write.mode(mode).text(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def write_single_csv(
    df: DataFrame, folder: str, name: str, sep: str = ",", max_rows: int | None = None
) -> str:
    """One CSV called `<folder>/<name>.csv`, replacing an older one; no marker files.

    One file means one writing task, so this is for exports; use `write_csv` for anything
    else. That task only sorts and writes: the rows are computed by as many tasks as `df` has
    and take their order along. With `max_rows` a larger frame is refused while it is written, and the older file
    stays.
    """
    spark = df.sparkSession
    part_folder = f"{folder.rstrip('/')}/_writing-{uuid.uuid4().hex}"
    place = next(n for n in ("__place", "__place_", "__place__") if n not in df.columns)
    single = df.withColumn(place, F.monotonically_increasing_id()).repartition(1).sortWithinPartitions(place).drop(place)
    if max_rows is not None:
        over = F.raise_error(F.lit(f"more than {max_rows} rows: not a single-file export"))
        numbered = single.withColumn("__n", F.monotonically_increasing_id())
        single = numbered.filter(F.when(F.col("__n") >= max_rows, over.cast("boolean")).otherwise(True)).drop("__n")
    fs, staged = _fs(spark, part_folder)
    try:
        write_csv(single, part_folder, sep)
    except Exception:
        fs.delete(staged, True)
        raise
    target = f"{folder.rstrip('/')}/{name}.csv"
    _, target_path = _fs(spark, target)
    for status in fs.listStatus(staged):
        if status.getPath().getName().startswith("part-"):
            fs.delete(target_path, False)
            fs.rename(status.getPath(), target_path)
    fs.delete(staged, True)
    return target


def replace_folder(df: DataFrame, path: str, write=None) -> None:
    """Replace the table at `path` by `df`, also when `df` reads that very path.

    The rows are written next to the table first. Only the finished folder is moved into
    place, so a failed job leaves the old table untouched.
    """
    base = path.rstrip("/")
    fresh = f"{base}__fresh-{uuid.uuid4().hex}"
    (write or write_parquet)(df, fresh)
    move_into_place(df.sparkSession, fresh, base)


def move_into_place(spark: SparkSession, fresh: str, path: str) -> None:
    """Make the finished folder `fresh` the one at `path`; an older one there is moved aside
    first and removed at the end."""
    base = path.rstrip("/")
    fs, target = _fs(spark, base)
    _, fresh_path = _fs(spark, fresh)
    _, old_path = _fs(spark, f"{base}__old-{uuid.uuid4().hex}")
    if fs.exists(target) and not fs.rename(target, old_path):
        raise OSError(f"cannot move {base} aside")
    fs.mkdirs(target.getParent())
    if not fs.rename(fresh_path, target):
        fs.rename(old_path, target)
        raise OSError(f"cannot move {fresh} to {base}")
    fs.delete(old_path, True)
    spark.catalog.refreshByPath(base)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder and all in it, if it is there."""
    fs, target = _fs(spark, path)
    fs.delete(target, True)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """The folders directly in a folder that may not be there."""
    fs, p = _fs(spark, path)
    found = fs.listStatus(p) if fs.exists(p) else []
    return [status.getPath().toString() for status in found if status.isDirectory()]


def truncate_and_load(df: DataFrame, path: str) -> None:
    """All old rows out, `df` in; a first run without a table is fine."""
    replace_folder(df, path)


def append_or_create(df: DataFrame, path: str, batch: str | None = None) -> None:
    """Append to the table at `path`, or create it.

    Plain appends add the rows again on a rerun. With `batch` the rows go to a `batch=`
    partition that a rerun replaces, whatever other threads write. Columns are matched by
    name; other names or types than those of the table are an error.
    """
    if path_exists(df.sparkSession, path):
        df = _fitted(df, path, "batch" if batch is not None else None)
    if batch is not None:
        rows = df.withColumn("batch", F.lit(batch)).write.mode("overwrite").partitionBy("batch")
        rows.option("partitionOverwriteMode", "dynamic").parquet(path)
    else:
        df.write.mode("append").parquet(path)


def _fitted(df: DataFrame, path: str, partition: str | None) -> DataFrame:
    """`df` in the column order of the table at `path`, or an error if it does not fit."""
    stored = df.sparkSession.read.parquet(path).schema.fields
    wanted = {f.name: f.dataType.simpleString() for f in stored if f.name != partition}
    given = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    if wanted != given:
        raise ValueError(f"{path} has {wanted}, the new rows have {given}")
    return df.select(*[f"`{c}`" for c in wanted])


def overwrite_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """Replace a catalog table; with `path` it is external."""
    writer = df.write.mode("overwrite").format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(name)


def write_sized(df: DataFrame, path: str, target_mb: int = TARGET_MB, columns: list[str] | None = None) -> None:
    """One overwrite in files of about `target_mb`; AQE merges small and splits large
    partitions at run time. `columns` keep equal values together where that fits."""
    with settings(
        df.sparkSession,
        spark__sql__adaptive__enabled="true",
        spark__sql__adaptive__advisoryPartitionSizeInBytes=f"{target_mb}m",
        spark__sql__adaptive__optimizeSkewsInRebalancePartitions__enabled="true",
    ):
        df.hint("rebalance", *(columns or [])).write.mode("overwrite").parquet(path)


def write_distinct_per_file(rows: DataFrame, stem: str, path: str, only_these: bool = False) -> None:
    """Distinct rows per source file into `<path>/<stem>=<name>/`, ZSTD, small row groups.

    One job for all files. Rows hash on all their columns, so one huge file spreads over
    all tasks and copies collapse before the shuffle; the rebalance by file keeps output
    files few, cutting a file that is larger than the advisory size. With `only_these` the
    folders of other files stay.
    """
    (
        rows.dropDuplicates()
        .hint("rebalance", stem)
        .write.mode("overwrite")
        .option("compression", "zstd")
        .option("parquet.block.row.count.limit", str(ROW_GROUP_ROWS))
        .option("partitionOverwriteMode", "dynamic" if only_these else "static")
        .partitionBy(stem)
        .parquet(path)
    )


def export_rows(df: DataFrame, max_rows: int):
    """A pandas frame of a bounded result; more than `max_rows` rows is an error."""
    head = df.limit(max_rows + 1).toPandas()
    if len(head) > max_rows:
        raise ValueError(f"more than {max_rows} rows: write them instead")
    return head
