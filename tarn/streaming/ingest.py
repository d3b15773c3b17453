"""Incremental loading: new files only, each exactly once, then stop."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarn.sources.readers import read_folder
from tarn.sources.writers import move_into_place, path_exists, remove_folder, replace_folder, subfolders

PAGES_PER_FILE = 10
FILES_PER_BATCH = 50


def stream_schema(spark: SparkSession, src: str, location: str, fmt: str = "json") -> T.StructType:
    """The schema kept at `location`; inferred from `src` and kept there on first use."""
    if path_exists(spark, location):
        text = spark.read.text(location, wholetext=True).head()[0]
        return T.StructType.fromJson(json.loads(text))
    schema = read_folder(spark, src, fmt, glob="*").schema
    spark.createDataFrame([(schema.json(),)], "value string").coalesce(1).write.text(location)
    return schema


def renew_schema(spark: SparkSession, src: str, location: str, fmt: str = "json") -> T.StructType:
    """Take the fields of all files now in `src` for the kept schema, at every level; kept
    fields come first. Call it when a stream stops at a file with new fields."""
    kept = stream_schema(spark, src, location, fmt)
    schema = merged_type(kept, read_folder(spark, src, fmt, glob="*").schema)
    replace_folder(
        spark.createDataFrame([(schema.json(),)], "value string").coalesce(1), location, lambda df, p: df.write.text(p)
    )
    return schema


def merged_type(kept: T.DataType, found: T.DataType) -> T.DataType:
    """`kept` with the fields that only `found` has, in structs, arrays and maps at any depth.
    A field that both have keeps its type, unless both types are nested in the same way."""
    if isinstance(kept, T.StructType) and isinstance(found, T.StructType):
        other = {f.name: f for f in found.fields}
        fields = [
            T.StructField(f.name, merged_type(f.dataType, other[f.name].dataType), f.nullable, f.metadata)
            if f.name in other
            else f
            for f in kept.fields
        ]
        return T.StructType(fields + [f for f in found.fields if f.name not in kept.names])
    if isinstance(kept, T.ArrayType) and isinstance(found, T.ArrayType):
        return T.ArrayType(merged_type(kept.elementType, found.elementType), kept.containsNull)
    if isinstance(kept, T.MapType) and isinstance(found, T.MapType):
        return T.MapType(kept.keyType, merged_type(kept.valueType, found.valueType), kept.valueContainsNull)
    return kept


def _holds_structs(data_type: T.DataType) -> bool:
    if isinstance(data_type, T.ArrayType):
        return _holds_structs(data_type.elementType)
    if isinstance(data_type, T.MapType):
        return _holds_structs(data_type.valueType)
    return isinstance(data_type, T.StructType)


def unknown_paths(text: Column, data_type: T.DataType, path: str = "") -> Column:
    """The paths of fields in a JSON text that `data_type` does not have, as an array.

    Each level is read as raw JSON by name or by element, so only columns that hold structs
    are read further down. A value of another shape has no paths; reading it by the schema
    tells that it does not fit.
    """
    if isinstance(data_type, T.StructType):
        nested = [f for f in data_type.fields if _holds_structs(f.dataType)]
        keys = F.coalesce(F.json_object_keys(text), F.array().cast("array<string>"))
        known = F.array(*[F.lit(c) for c in data_type.names]).cast("array<string>")
        fresh = F.transform(F.array_except(keys, known), lambda key: F.concat(F.lit(path), key))
        if not nested:
            return fresh
        raw = F.from_json(text, T.StructType([T.StructField(f.name, T.StringType()) for f in nested]))
        return F.concat(fresh, *[unknown_paths(raw[f.name], f.dataType, f"{path}{f.name}.") for f in nested])
    if isinstance(data_type, T.ArrayType):
        inner, raw = data_type.elementType, F.from_json(text, "array<string>")
    else:
        inner, raw = data_type.valueType, F.map_values(F.from_json(text, "map<string,string>"))
    found = F.flatten(F.transform(raw, lambda part: unknown_paths(part, inner, path[:-1] + "[].")))
    return F.coalesce(F.array_distinct(found), F.array().cast("array<string>"))


def _file_stream(spark, src, fmt, schema, max_files, sep=","):
    """A stream of files, with `_metadata`. A record that does not fit the schema, a field
    the schema does not have, at any depth, and a CSV file with another header stop it."""
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if fmt == "csv":
        return reader.options(header="true", sep=sep, enforceSchema="false", mode="FAILFAST").schema(schema).csv(src).select(
            "*", "_metadata"
        )
    if fmt != "json":
        return reader.format(fmt).schema(schema).load(src).select("*", "_metadata")
    lines = reader.text(src).filter(F.trim("value") != "")
    unknown = unknown_paths(F.col("value"), schema)
    message = F.concat(F.lit("fields that the schema does not have: "), F.array_join(unknown, ", "))
    known = F.when(F.size(unknown) > 0, F.raise_error(message).cast("string")).otherwise(F.col("value"))
    return lines.select(F.from_json(known, _nullable(schema), {"mode": "FAILFAST"}).alias("__row"), "_metadata").select(
        "__row.*", "_metadata"
    )


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])


def ingest_stream(
    spark: SparkSession,
    src: str,
    table: str,
    checkpoint: str,
    fmt: str = "json",
    schema: T.StructType | None = None,
    path: str | None = None,
    max_files: int | None = None,
    sep: str = ",",
) -> None:
    """Load the files of `src` that no earlier run has loaded into `table`, and stop.

    Adds `source_file` and `processing_time`. Without `schema` it is inferred once and kept
    beside the checkpoint. Returns when the rows can be read. `path` makes the table
    external; `max_files` bounds the size of one micro-batch, not of the run. A record that
    does not fit and a field that the schema lacks stop the stream before its batch is
    written; see `renew_schema`.
    """
    schema = schema or stream_schema(spark, src, checkpoint.rstrip("/") + "_schema", fmt)
    rows = _file_stream(spark, src, fmt, schema, max_files, sep).select(
        *[f"`{c}`" for c in schema.names],
        F.col("_metadata.file_path").alias("source_file"),
        F.current_timestamp().alias("processing_time"),
    )
    writer = rows.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if path:
        writer = writer.option("path", path)
    writer.toTable(table).awaitTermination()


def reset_stream(spark: SparkSession, table: str, checkpoint: str) -> None:
    """Forget a stream: drop its table, its checkpoint and its kept schema."""
    spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:name)", {"name": table})
    for location in (checkpoint, checkpoint.rstrip("/") + "_schema"):
        path = spark._jvm.org.apache.hadoop.fs.Path(location)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def land_pages(
    spark: SparkSession,
    pages: str,
    out: str,
    checkpoint: str,
    schema: T.StructType,
    fmt: str = "json",
    pages_per_file: int = PAGES_PER_FILE,
    files_per_batch: int = FILES_PER_BATCH,
    keep: Callable[[DataFrame], DataFrame] | None = None,
    sep: str = ",",
) -> None:
    """Turn landed page files into Parquet files of about `pages_per_file` pages, resumably.

    One job lands `files_per_batch` such files side by side in a `batch_id=` folder of its
    own, with overwrite, and Spark moves the checkpoint on only after that write. A run
    killed in between writes the same folder again, so no page is lost or doubled. `keep`
    is applied to every batch, e.g. a date filter.
    """

    def save(batch: DataFrame, batch_id: int) -> None:
        n_pages = batch.select("_metadata.file_path").distinct().count()
        dealt = batch.repartition(max(1, -(-n_pages // pages_per_file)), "_metadata.file_path")
        rows = dealt.select(*[f"`{c}`" for c in schema.names])
        rows = keep(rows) if keep else rows
        rows.write.mode("overwrite").parquet(f"{out.rstrip('/')}/batch_id={batch_id}")

    query = (
        _file_stream(spark, pages, fmt, schema, pages_per_file * files_per_batch, sep)
        .writeStream.foreachBatch(save)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


@dataclass(frozen=True)
class Attempt:
    """One try at a paged run. What it fetches and lands lies in folders of its own, so that
    nothing of an earlier try, whatever became of it, is taken for its own."""

    day: str
    last: str | None  # the day of the last finished run
    number: int  # of the run, counting finished ones
    run: str  # the name of its folder under `out`
    pages: str
    landed: str
    checkpoint: str


def start_attempt(spark: SparkSession, pages: str, out: str, state: str, day: str) -> Attempt:
    """A new attempt at the run of `day`. A second run of the same day is a run of its own."""
    last, number = last_run(spark, f"{state}/last_run"), finished_runs(spark, f"{state}/last_run") + 1
    run, tag = (day if day != last else f"{day}-{number}"), uuid.uuid4().hex
    return Attempt(
        day, last, number, run,
        pages=f"{pages}/run={run}/attempt={tag}",
        landed=f"{out}/_attempts/{run}/{tag}",
        checkpoint=f"{state}/checkpoints/{run}/{tag}",
    )


def land_attempt(
    spark: SparkSession,
    attempt: Attempt,
    fetch: Callable[[str | None, str], None],
    schema: T.StructType,
    column: str,
    months: int = 1,
    fmt: str = "json",
) -> None:
    """Fetch the pages of an attempt and land their rows out of sight of readers of `out`."""
    fetch(attempt.last, attempt.pages)
    land_pages(
        spark, attempt.pages, attempt.landed, attempt.checkpoint, schema, fmt,
        keep=lambda rows: incremental_since(rows, column, attempt.last, months),
    )


def finish_attempt(spark: SparkSession, attempt: Attempt, pages: str, out: str, state: str) -> None:
    """Show what an attempt has landed, by one move of its folder, then set the stamp. What
    other attempts at this run have left is removed afterwards."""
    target = f"{out}/run={attempt.run}"
    if path_exists(spark, attempt.landed):
        move_into_place(spark, attempt.landed, target)
    else:  # no pages; an attempt that was stopped before its stamp may have had some
        remove_folder(spark, target)
    mark_run(spark, f"{state}/last_run", attempt.day, attempt.number)
    for left in (f"{out}/_attempts/{attempt.run}", f"{state}/checkpoints/{attempt.run}"):
        remove_folder(spark, left)
    for folder in subfolders(spark, f"{pages}/run={attempt.run}"):
        if folder.rsplit("/", 1)[1] != attempt.pages.rsplit("/", 1)[1]:
            remove_folder(spark, folder)


def run_increment(
    spark: SparkSession,
    fetch: Callable[[str | None, str], None],
    pages: str,
    out: str,
    state: str,
    schema: T.StructType,
    column: str,
    day: str,
    months: int = 1,
    fmt: str = "json",
) -> str | None:
    """One finished paged run: last stamp, pages, filter, landing, new stamp.

    `fetch(last_day, folder)` puts the pages of this run into `folder`; last_day is the day
    of the last finished run, or None. Only rows from `months` before that day on are
    landed, under `<out>/run=<day>`. A run that is stopped anywhere is repeated as a new
    attempt from the same day: with fresh pages, checkpoint and output, which take the place
    of all that the stopped one has shown. Runs of one `state` follow each other; two at a
    time are not supported. Returns the day of the run before.
    """
    attempt = start_attempt(spark, pages, out, state, day)
    land_attempt(spark, attempt, fetch, schema, column, months, fmt)
    finish_attempt(spark, attempt, pages, out, state)
    return attempt.last


def mark_run(spark: SparkSession, path: str, day: str, runs: int = 1) -> None:
    """Keep the day (`yyyy-MM-dd`) of the last finished run and how many are finished."""
    replace_folder(spark.createDataFrame([(day, runs)], "last_run string, runs int"), path)


def last_run(spark: SparkSession, path: str) -> str | None:
    return spark.read.parquet(path).head()[0] if path_exists(spark, path) else None


def finished_runs(spark: SparkSession, path: str) -> int:
    """The number of finished runs; a stamp without it counts as one."""
    return spark.read.parquet(path).head().asDict().get("runs", 1) if path_exists(spark, path) else 0


def incremental_since(
    df: DataFrame, column: str, last_run: str | Column | None, months: int = 1
) -> DataFrame:
    """Rows from `months` before the last run on, so that late entries are caught.

    Text columns hold `yyyyMMdd`; date and timestamp columns are compared as they are, so
    the filter reaches the scan. Without a last run all rows stay.
    """
    if last_run is None:
        return df
    day = F.lit(last_run).cast("date") if isinstance(last_run, str) else last_run
    since = F.add_months(day, -months)
    data_type = df.schema[column].dataType
    if isinstance(data_type, T.StringType):
        return df.filter(F.col(column) >= F.date_format(since, "yyyyMMdd"))
    return df.filter(F.col(column) >= since.cast(data_type))


def dedupe_exact(df: DataFrame) -> DataFrame:
    """One of each set of identical rows.

    Rows are dealt by a hash of all columns first: what a task holds is its share of them, not
    all distinct rows of a split of the input, whose size does not tell how many there are.
    """
    digest = next(n for n in ("__hash", "__hash_", "__hash__") if n not in df.columns)
    dealt = df.withColumn(digest, F.xxhash64(*[f"`{c}`" for c in df.columns])).repartition(digest)
    return dealt.dropDuplicates().drop(digest)


def dedupe_latest(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The last row per key by `order`; ties are broken by the other columns.

    `max` of a struct is combined before the shuffle, so a hot key sends one row per task.
    Such a buffer makes Spark sort the rows by key before and after the shuffle; it spills.
    """
    rest = [c for c in df.columns if c not in {*key, *order}]
    latest = df.groupBy(*key).agg(F.max(F.struct(*order, *rest)).alias("__row"))
    return latest.select(*key, "__row.*").select(*[f"`{c}`" for c in df.columns])
