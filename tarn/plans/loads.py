"""Raw folders to warehouse tables: the loader, its load list and the per-file variant."""

from __future__ import annotations

import json
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from graphlib import CycleError, TopologicalSorter
from urllib.parse import unquote

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarn.operators.names import sanitize_columns, table_name_from_folder
from tarn.sources.catalog import register_external
from tarn.sources.readers import (
    SUFFIXES,
    file_inventory,
    file_types,
    infer_schema_first_file,
    read_folder,
    read_folder_tolerant,
)
from tarn.sources.writers import append_or_create, path_exists, replace_folder, write_distinct_per_file


@dataclass(frozen=True)
class LoadSpec:
    """One dataset of a load list. `mode` is `append` (again on every run; with `batch` into a
    partition that a rerun replaces) or `replace`. `after` names the sources, by the last
    folder of their path, that have to be loaded before (see `run_graph`)."""

    source: str
    target: str
    fmt: str = "csv"
    sep: str = ";"
    mode: str = "append"
    on_error: str = "fail"
    schema_from: str = "all"
    multiline: bool = False
    table: str | None = None
    batch: str | None = None
    after: tuple[str, ...] = ()

    @property
    def name(self) -> str:
        return self.source.rstrip("/").rsplit("/", 1)[-1]


@dataclass(frozen=True)
class Loaded:
    """The path of a loaded table, and with `on_error="skip"` the report (path, n_rows, ok)
    on every file of the source."""

    path: str
    report: DataFrame | None = None


def load_folder(spark: SparkSession, spec: LoadSpec) -> Loaded:
    """Read a raw folder, clean its column names and publish it.

    CSV and JSON types are inferred from all files, or with `schema_from="first"` from the
    first one and imposed on the rest, which reads a large folder only once. With
    `on_error="skip"` files that do not fit the first one are left out and reported. A
    registered table shows the new rows when this returns.
    """
    options, report = {"sep": spec.sep, "multiline": spec.multiline}, None
    if spec.on_error == "skip":
        rows, report = read_folder_tolerant(spark, spec.source, spec.fmt, **options)
    else:
        schema = None
        if spec.schema_from == "first":
            schema = infer_schema_first_file(spark, spec.source, spec.fmt, **options)
        rows = read_folder(spark, spec.source, spec.fmt, schema=schema, **options)
    if spec.fmt == "csv" and len(rows.columns) == 1:
        print(f"{spec.source}: only one column, is the separator {spec.sep!r} right?")
    name = table_name_from_folder(spec.source.rstrip("/") + "/")
    path = f"{spec.target.rstrip('/')}/{name}"
    clean = sanitize_columns(rows)
    if spec.mode == "replace":
        replace_folder(clean, path)
    else:
        append_or_create(clean, path, spec.batch)
    if spec.table:
        register_external(spark, spec.table, path)
    return Loaded(path, report)


def run_loads(spark: SparkSession, specs: list[LoadSpec]) -> list[Loaded]:
    """The datasets of a load list, in order; a failing one stops the rest."""
    return [load_folder(spark, spec) for spec in specs]


def load_distinct_per_file(
    spark: SparkSession,
    src: str,
    dst: str,
    fmt: str = "csv",
    sep: str = ",",
    scope: str = "file",
    on_error: str = "fail",
    schema: T.StructType | str | None = None,
    own_schemas: bool = False,
) -> DataFrame | None:
    """Distinct rows of each source file (or of all, `scope="all"`) as ZSTD Parquet.

    The output is partitioned by `file_stem`. For `scope="all"` a row found in several files
    goes to the first of them by name. A `schema` saves the pass that infers it. With
    `own_schemas` every file keeps types of its own: one pass infers them all, and files with
    the same columns and types are written together.
    With `on_error="skip"` bad files are left out, and the report on all files is returned.
    """
    if own_schemas:
        for files, own in _files_by_schema(spark, src, fmt, sep):
            rows = spark.read.format(fmt).schema(own).option("mode", "FAILFAST")
            rows = rows.options(header="true", sep=sep, escape='"', enforceSchema="false") if fmt == "csv" else rows
            name = F.url_decode(F.replace(F.substring_index("_metadata.file_path", "/", -1), F.lit("+"), F.lit("%2B")))
            stem = F.regexp_replace(name, r"\.[^.]*$", "")
            write_distinct_per_file(rows.load(files).withColumn("file_stem", stem), "file_stem", dst, only_these=True)
        return None
    report = None
    if on_error == "skip":
        rows, report = read_folder_tolerant(spark, src, fmt, sep=sep, source_column="file_stem")
        columns = [f"`{c}`" for c in rows.columns if c != "file_stem"]
        file_name = F.col("file_stem")
    else:
        rows = read_folder(spark, src, fmt, sep, schema=schema)
        columns = [f"`{c}`" for c in rows.columns]
        file_name = F.col("_metadata.file_path")
    stem = F.regexp_replace(F.substring_index(file_name, "/", -1), r"\.[^.]*$", "")
    rows = rows.select(*columns, stem.alias("file_stem"))
    if scope == "all":
        rows = rows.groupBy(*columns).agg(F.min("file_stem").alias("file_stem"))
    write_distinct_per_file(rows, "file_stem", dst)
    return report


def _files_by_schema(spark: SparkSession, src: str, fmt: str, sep: str):
    """The files of a folder, by equal columns and types."""
    if fmt == "parquet":  # footers tell the types
        files = [f.path for f in file_inventory(spark, src, SUFFIXES[fmt], recursive=False).toLocalIterator()]
        groups: dict[str, list[str]] = {}
        for file in files:
            groups.setdefault(spark.read.parquet(file).schema.json(), []).append(file)
        return [(paths, T.StructType.fromJson(json.loads(schema))) for schema, paths in groups.items()]
    column = F.struct("position", "name", "type")
    per_file = file_types(spark, src, fmt, sep).groupBy("path").agg(F.sort_array(F.collect_list(column)).alias("columns"))
    alike = per_file.groupBy("columns").agg(F.collect_list("path").alias("files")).collect()

    def schema(columns):
        if fmt == "json":
            return T._parse_datatype_string(columns[0].type)
        return T.StructType([T.StructField(c.name, T._parse_datatype_string(c.type)) for c in columns])

    return [([unquote(f) for f in group.files], schema(group.columns)) for group in alike]


def run_together(jobs: list[Callable[[], object]], threads: int = 2) -> list[object]:
    """Independent writes side by side; results in the order of `jobs`.

    Each job runs in a thread with the caller's local properties and in a scheduler pool of
    its own, so with `spark.scheduler.mode=FAIR` (set by `get_session`) a long write does not
    hold up a short one. For reads prefer one plan (`count_tables`): frames are lazy, threads
    would not help.
    """
    spark = SparkSession.getActiveSession()

    def pooled(job: Callable[[], object], number: int) -> Callable[[], object]:
        def run():
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"together-{number}")
            return job()

        return inheritable_thread_target(spark)(run)

    with ThreadPoolExecutor(threads) as pool:
        waiting = [pool.submit(pooled(job, i) if spark else job) for i, job in enumerate(jobs)]
        return [done.result() for done in waiting]


STATUS = "name string, state string, message string"


def run_graph(spark: SparkSession, specs: list[LoadSpec], status: str, run: str, threads: int = 2) -> DataFrame:
    """Load datasets in the order that their `after` asks for; (name, state, message) of each.

    Datasets that do not wait for each other load side by side. One that fails (`failed`,
    with the error) stops only what comes after it (`waiting`, with the names); the others go
    on. What is loaded is noted in the table at `status` under `run`, and a repeated call
    with the same `run` loads only the rest, so it carries an interrupted run on. An appended
    dataset goes to the batch named by `run`, so its repetition replaces what an interrupted
    load has left. Names that occur twice, are unknown, or wait in a circle are an error.
    """
    by_name = {spec.name: spec for spec in specs}
    unknown = sorted({n for spec in specs for n in spec.after} - set(by_name))
    if len(by_name) < len(specs) or unknown:
        raise ValueError(f"datasets that occur twice or are unknown: {unknown or sorted(by_name)}")
    try:
        order = list(TopologicalSorter({n: spec.after for n, spec in by_name.items()}).static_order())
    except CycleError as circle:
        raise ValueError(f"datasets that wait for each other: {circle.args[1]}") from circle
    finished = set()
    if path_exists(spark, status):
        noted = spark.read.schema(f"{STATUS}, batch string").parquet(status)
        finished = {r.name for r in noted.filter(F.col("batch").startswith(f"{run}/")).collect()} & set(by_name)

    def load(name: str) -> tuple[str, str, str | None]:
        spec = by_name[name]
        try:
            load_folder(spark, replace(spec, batch=spec.batch or run) if spec.mode == "append" else spec)
        except Exception as error:  # any failure of one dataset, noted and reported
            return name, "failed", f"{type(error).__name__}: {error}"[:2_000]
        return name, "loaded", None

    results = {name: (name, "loaded before", None) for name in finished}
    while True:
        good = {n for n, (_, state, _) in results.items() if state.startswith("loaded")}
        ready = [n for n in order if n not in results and good.issuperset(by_name[n].after)]
        if not ready:
            break
        for result in run_together([lambda n=n: load(n) for n in ready], threads):
            results[result[0]] = result
            if result[1] == "loaded":
                append_or_create(spark.createDataFrame([result], STATUS), status, f"{run}/{result[0]}")
    for name in order:
        if name not in results:
            results[name] = (name, "waiting", ", ".join(n for n in by_name[name].after if n not in good))
    return spark.createDataFrame([results[name] for name in order], STATUS)


def with_parameters(spark: SparkSession, sql: str, params: dict[str, object], **frames: DataFrame) -> DataFrame:
    """A query with named parameters (`:name`, `IDENTIFIER(:name)`) and `{frame}` tables."""
    return spark.sql(sql, params, **frames)


def job_parameters(defaults: dict[str, object], given: dict[str, object] | None = None) -> dict[str, str]:
    """Job parameters: given over default, all as text, unknown names refused."""
    unknown = sorted(set(given or {}) - set(defaults))
    if unknown:
        raise KeyError(f"unknown parameters: {unknown}")
    return {name: str(value) for name, value in {**defaults, **(given or {})}.items()}
