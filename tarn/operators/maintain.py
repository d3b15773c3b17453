"""Compaction, retention planning, statistics, discovery and checksums of stored tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tarn.functions.columns import content_hash
from tarn.session import broadcast_if_small, stage
from tarn.sources.ranges import Opener, streamed_digests
from tarn.sources.readers import file_inventory, rows_as_stored
from tarn.sources.writers import TARGET_MB, replace_folder

RETAIN_HOURS = 168
#: Listed files, some 200 bytes each, that may be broadcast.
LISTED_FILES = 100_000
#: Bytes of a file that is hashed in one piece.
WHOLE_FILE = 256 << 20


def compact(spark: SparkSession, path: str, target_mb: int = TARGET_MB) -> bool:
    """Rewrite a Parquet table, or one partition folder of it, in files of about `target_mb`;
    False, and nothing is touched, if no folder has two files below half the target.

    One write for all folders: a listing deals small files whole into bins of the target size
    and large ones into several, a shuffle hands every task the rows of one bin, and the new
    folder takes the place of the old one when it is complete. If it is interrupted before,
    the table is as it was. Columns that only some of the files have stay, with NULL in the
    other rows; types that conflict are an error. Partition values keep their spelling.
    Hidden files are not taken along. Sizes are those of the files or of their rows in
    memory, whichever is more, so that no task reads much more than the target. To rewrite less than a whole table, name the folder of
    one partition.
    """
    base, target = path.rstrip("/"), target_mb << 20
    rows, partitions = rows_as_stored(spark, base)
    bins = stage(_dealt_files(spark, rows, base, target), "dealt-files")
    crowd, n_tasks = bins.agg(F.max("crowd"), F.max(F.col("task") + F.col("parts"))).first()
    if (crowd or 0) < 2:
        return False
    columns = [f"`{c}`" for c in rows.columns]
    placed = rows.select(*columns, F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__row"))
    files = broadcast_if_small(bins.select(F.col("file").alias("__file"), "task", "parts"), LISTED_FILES)
    task = (F.col("task") + F.col("__row") % F.col("parts")).cast("int")
    dealt = placed.join(files, "__file").repartitionById(n_tasks, task).select(*columns)

    def write(df: DataFrame, fresh: str) -> None:
        df.write.partitionBy(*partitions).parquet(fresh)

    replace_folder(dealt, base, write)
    return True


def _dealt_files(spark: SparkSession, rows: DataFrame, path: str, target: int) -> DataFrame:
    """(file, crowd, parts, task) of every Parquet file: a file of half the target or more is
    cut in `parts`, for tasks from `task` on; the small ones of a folder, `crowd` in number, are
    put together into bins, of one task each."""
    listing = spark.read.format("binaryFile").options(recursiveFileLookup="true", pathGlobFilter="*.parquet").load(path)
    stored = listing.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"))
    width = rows._jdf.schema().defaultSize()
    counted = rows.groupBy(F.col("_metadata.file_path").alias("file")).agg((F.count("*") * width).alias("size"))  # from the footers
    files = stored.union(counted).groupBy("file").agg(F.max("size").alias("size"))
    files = files.withColumn("folder", F.regexp_extract("file", "(.*)/", 1)).withColumn("small", F.col("size") < target // 2)
    alike = Window.partitionBy("folder", "small")
    before = alike.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    shared = F.concat_ws("/", "folder", F.floor(F.coalesce(F.sum("size").over(before), F.lit(0)) / target))
    files = files.select(
        "file", F.when(F.col("small"), shared).otherwise(F.col("file")).alias("bin"),
        F.when(F.col("small"), F.count("*").over(alike)).otherwise(0).alias("crowd"),
        F.greatest(F.ceil(F.col("size") / target), F.lit(1)).alias("parts"),
    )
    all_files = Window.orderBy("bin", "file")
    is_new = F.coalesce(F.lag("bin").over(all_files) != F.col("bin"), F.lit(True))
    files = files.withColumn("tasks", F.when(is_new, F.col("parts")).otherwise(0))
    return files.select("file", "crowd", "parts", (F.sum("tasks").over(all_files) - F.col("parts")).alias("task"))


def expired_files(
    inventory: DataFrame, live: DataFrame, hours: int = RETAIN_HOURS, now: Column | None = None
) -> DataFrame:
    """Files of the inventory that no live table uses and that are older than `hours`."""
    now = F.current_timestamp() if now is None else now
    old = F.col("modificationTime") < now - F.make_dt_interval(hours=F.lit(hours))
    return inventory.filter(old).join(live.select("path").distinct(), "path", "left_anti")


def table_stats(spark: SparkSession, path: str) -> DataFrame:
    """Files, rows, columns and bytes of a Parquet table; reads file footers only."""
    table = spark.read.parquet(path)
    per_file = table.groupBy("_metadata.file_path", "_metadata.file_size").agg(F.count("*").alias("n"))
    return per_file.agg(
        F.count("*").alias("n_files"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.lit(len(table.columns)).alias("n_columns"),
        F.coalesce(F.sum("file_size"), F.lit(0)).alias("n_bytes"),
    )


def discover_tables(keys: DataFrame, column: str = "path", marker: str = "_delta_log") -> DataFrame:
    """Sorted distinct parents of the marker folder among object keys."""
    inside = f"/{marker}/"
    return (
        keys.filter(F.col(column).contains(inside))
        .select(F.substring_index(column, inside, 1).alias("table_path"))
        .distinct()
        .orderBy("table_path")
    )


def checksum_manifest(
    spark: SparkSession, path: str, glob: str | None = None, whole: int = WHOLE_FILE, opener: Opener | None = None
) -> DataFrame:
    """Path, size and SHA-256 of every file, hashed in parallel. Files of up to `whole` bytes
    are read by Spark at once, larger ones, of any size, as a stream by a task each."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    small = reader.load(path).filter(F.col("length") <= whole)
    large = file_inventory(spark, path, glob).filter(F.col("size") > whole)
    return small.select("path", F.col("length").alias("size"), content_hash("content").alias("sha256")).union(
        streamed_digests(large, opener)
    )
