"""Folder readers with schema control and bad-file reporting."""

from __future__ import annotations

import io
import itertools
import zipfile
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarn.session import scratch_path, stage

SUFFIXES = {"csv": "*.csv", "json": "*.json", "parquet": "*.parquet", "text": "*.txt"}
SAMPLE_ROWS = 100_000
_CORRUPT = "_corrupt_record"
_SOURCE = "__source_file"


def _reader(spark: SparkSession, fmt: str, sep: str, multiline: bool, glob: str | None, recursive: bool):
    if fmt not in ("csv", "json", "parquet"):
        raise ValueError(f"unsupported file format: {fmt}")
    reader = spark.read.format(fmt).option("pathGlobFilter", glob or SUFFIXES[fmt])
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    if fmt == "csv":
        # a header with other names, or in another order, than the schema is an error
        reader = reader.options(header="true", sep=sep, escape='"', enforceSchema="false")
    if fmt in ("csv", "json") and multiline:
        reader = reader.option("multiLine", "true")
    return reader


def read_folder(
    spark: SparkSession,
    path: str,
    fmt: str,
    sep: str = ";",
    schema: T.StructType | str | None = None,
    glob: str | None = None,
    recursive: bool = False,
    multiline: bool = False,
) -> DataFrame:
    """All files of one format in a folder as one table; other files are ignored.

    CSV has a header row. Without `schema`, CSV and JSON types are inferred from all files,
    which costs one extra pass; see `infer_schema_first_file` for large folders. Against a
    given `schema` a record that does not fit is an error, not a silent NULL. So is a CSV
    file whose header has other columns, or another order of them, than the schema.
    """
    reader = _reader(spark, fmt, sep, multiline, glob, recursive)
    if schema is not None:
        reader = reader.schema(schema)
        if fmt != "parquet":
            reader = reader.option("mode", "FAILFAST")
    elif fmt == "csv":
        reader = reader.option("inferSchema", "true")
    return reader.load(path)


def file_inventory(
    spark: SparkSession, path: str, glob: str | None = None, recursive: bool = True
) -> DataFrame:
    """Path, size in bytes and modification time of every file; contents are not read."""
    listing = _listing(spark, path, glob, recursive)
    return listing.select("path", F.col("length").alias("size"), "modificationTime")


def _listing(spark: SparkSession, path: str, glob: str | None, recursive: bool) -> DataFrame:
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path)


def infer_schema_first_file(
    spark: SparkSession,
    path: str,
    fmt: str,
    sep: str = ";",
    n: int | None = SAMPLE_ROWS,
    glob: str | None = None,
    multiline: bool = False,
) -> T.StructType:
    """Schema of the first file by name that has rows, from at most its first `n` rows.

    Impose it on the whole folder with `read_folder(schema=...)`. Only these `n` lines
    pass the driver; Parquet needs none, its footer holds the schema. With `n=None` all rows
    of that file are seen, by Spark's tasks. A multi-line file has no line limit to cut at
    and is inferred whole, by one task.
    """
    header = 1 if fmt == "csv" else 0
    files = file_inventory(spark, path, glob or SUFFIXES[fmt], recursive=False).orderBy("path")
    first, sample = None, []
    for file in files.toLocalIterator():  # the first file nearly always has rows
        if fmt == "parquet" or multiline:
            return read_folder(spark, file.path, fmt, sep, glob="*", multiline=multiline).schema
        if n is None and len(spark.read.text(file.path).head(header + 1)) > header:
            return read_folder(spark, file.path, fmt, sep, glob="*").schema
        first, sample = file.path, spark.read.text(file.path).head(header + (n or 0))
        if len(sample) > header:
            break
    if first is None:
        raise FileNotFoundError(f"no {fmt} files in {path}")
    lines = scratch_path(spark, "schema-sample")
    numbered = pa.table({"n": range(len(sample)), "value": [row[0] for row in sample]})
    ordered = spark.createDataFrame(numbered).repartition(1).sortWithinPartitions("n")
    ordered.select("value").write.text(lines)
    return read_folder(spark, lines, fmt, sep, glob="*").schema


def read_folder_tolerant(
    spark: SparkSession,
    path: str,
    fmt: str,
    schema: T.StructType | None = None,
    sep: str = ";",
    multiline: bool = False,
    glob: str | None = None,
    source_column: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The rows of all readable files, and a report (path, n_rows, ok) over every file.

    A file with one record that does not fit the schema, or with another header than the
    schema's names in their order, is left out whole; if no file is readable the call fails.
    The schema defaults to that of the first file, inferred from all its rows, and
    `source_column` keeps the path of each row's file. Records are parsed once, at full
    width, into a staged table: parsing lazily would let column pruning hide bad fields
    from later queries.
    """
    files = _listing(spark, path, glob or SUFFIXES[fmt], recursive=False)
    files = files.select(F.col("_metadata.file_path").alias(_SOURCE))
    if fmt == "parquet":
        rows, per_file = _tolerant_parquet(spark, path, schema, glob)
    else:
        schema = schema or infer_schema_first_file(spark, path, fmt, sep, None, glob, multiline)
        rows, per_file = _tolerant_records(spark, path, fmt, schema, sep, multiline, glob)
    report = stage(
        files.join(per_file, _SOURCE, "left").select(
            F.col(_SOURCE).alias("path"),
            F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
            F.coalesce("ok", F.lit(fmt != "parquet")).alias("ok"),
        ),
        "file-report",
    )
    if not report.filter("ok").head(1):
        raise ValueError(f"no readable {fmt} file in {path}")
    bad = report.filter(~F.col("ok")).select(F.col("path").alias(_SOURCE))
    good = rows.join(bad, _SOURCE, "left_anti")
    columns = [f"`{c}`" for c in rows.columns if c != _SOURCE]
    if source_column:
        return good.select(*columns, F.col(_SOURCE).alias(source_column)), report
    return good.select(*columns), report


def _tolerant_records(spark, path, fmt, schema, sep, multiline, glob):
    flagged = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    parsed = (
        _reader(spark, fmt, sep, multiline, glob, False)
        .schema(flagged)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", _CORRUPT)
        .option("enforceSchema", "true")
        .load(path)
    )
    rows = stage(parsed.select("*", F.col("_metadata.file_path").alias(_SOURCE)), "parsed")
    per_file = rows.groupBy(_SOURCE).agg(
        F.count("*").alias("n_rows"), F.max(F.col(_CORRUPT).isNotNull()).alias("bad")
    )
    per_file = per_file.select(_SOURCE, "n_rows", (~F.col("bad")).alias("ok"))
    if fmt == "csv":
        headers = _right_headers(spark, path, sep, schema.names, glob)
        per_file = headers.join(per_file, _SOURCE, "left").select(
            _SOURCE,
            F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
            (F.coalesce("ok", F.lit(True)) & F.col("right")).alias("ok"),
        )
    return rows.drop(_CORRUPT), per_file


def _right_headers(spark, path, sep, names, glob) -> DataFrame:
    """For every file with lines, whether its first block has the header line of `names`."""

    def bare(text: Column) -> Column:
        return F.regexp_replace(text, "[\"\\r\ufeff]", "")

    lines = spark.read.option("pathGlobFilter", glob or SUFFIXES["csv"]).text(path)
    header = (F.col("_metadata.file_block_start") == 0) & (bare(F.col("value")) == bare(F.lit(sep.join(names))))
    return lines.groupBy(F.col("_metadata.file_path").alias(_SOURCE)).agg(F.max(header).alias("right"))


def _tolerant_parquet(spark, path, schema, glob):
    """A file is good when all rows its footer announces could be decoded."""
    reader = _reader(spark, "parquet", "", False, glob, False).option("ignoreCorruptFiles", "true")
    source = (reader.schema(schema) if schema else reader).load(path)
    announced = source.groupBy(F.col("_metadata.file_path").alias(_SOURCE)).agg(
        F.count("*").alias("announced")
    )
    rows = stage(source.select("*", F.col("_metadata.file_path").alias(_SOURCE)), "decoded")
    decoded = rows.groupBy(_SOURCE).agg(F.count("*").alias("n_rows"))
    per_file = announced.join(decoded, _SOURCE, "left").select(
        _SOURCE, "n_rows", (F.col("announced") == F.coalesce("n_rows", F.lit(0))).alias("ok")
    )
    return rows, per_file


def rows_as_stored(spark: SparkSession, path: str) -> tuple[DataFrame, list[str]]:
    """All rows of a table with the columns of all its files, partition values as the text
    they have in their folders, and the names of the partition columns."""
    reader = spark.read.option("mergeSchema", "true")
    data = reader.option("recursiveFileLookup", "true").parquet(path)
    partitions = [c for c in spark.read.parquet(path).columns if c not in data.columns]
    if not partitions:
        return data, []
    schema = T.StructType(data.schema.fields + [T.StructField(c, T.StringType()) for c in partitions])
    return spark.read.schema(schema).parquet(path), partitions


# Texts that CSV and JSON readers take for a number or a day.
_WHOLE, _NUMBER = r"^[+-]?[0-9]+$", r"^([+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|NaN|-?Inf)$"
_DAY, _TIME = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$", r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9:.]+(Z|[+-][0-9:]+)?$"


def _fits(text: Column) -> dict[str, Column]:
    """The types of a CSV field, from the least to the widest, and whether a text has it."""
    def like(pattern: str, cast: str) -> Column:
        return text.rlike(pattern) & text.try_cast(cast).isNotNull()

    return {
        "int": like(_WHOLE, "int"), "bigint": like(_WHOLE, "bigint"), "decimal(38,0)": like(_WHOLE, "decimal(38,0)"),
        "double": like(_NUMBER, "string"), "date": like(_DAY, "date"), "timestamp": like(f"{_DAY}|{_TIME}", "timestamp"),
        "boolean": F.lower(text).isin("true", "false"),
    }


def file_types(spark: SparkSession, path: str, fmt: str, sep: str = ";", glob: str | None = None) -> DataFrame:
    """(path, position, name, type) of every column of every file in a folder: the least type
    that all values of that column in that file have, in DDL.

    One pass over all files. CSV files may have different headers; a column without values
    is a string. JSON types are merged by Spark's aggregate over variants. A field that no
    type fits but text is a string. Files without rows have their header's columns only.
    """
    if fmt == "json":
        lines = spark.read.option("pathGlobFilter", glob or SUFFIXES[fmt]).text(path).filter(F.trim("value") != "")
        merged = lines.groupBy(F.col("_metadata.file_path").alias("path")).agg(
            F.schema_of_variant_agg(F.parse_json("value")).alias("ddl")
        )
        # as the JSON reader infers them: fractions are doubles, what is always null is text
        for pattern, ddl in ((r"DECIMAL\([0-9]+,[0-9]+\)", "DOUBLE"), ("VOID", "STRING"), ("OBJECT<", "STRUCT<")):
            merged = merged.withColumn("ddl", F.regexp_replace("ddl", pattern, ddl))
        return merged.select("path", F.lit(0).alias("position"), F.lit(None).cast("string").alias("name"), F.col("ddl").alias("type"))
    if fmt != "csv":
        raise ValueError(f"types of {fmt} files are in their footers")
    headers = stage(_headers(spark, path, sep, glob), "headers")
    width = headers.agg(F.max(F.size("names"))).first()[0] or 0
    texts = T.StructType([T.StructField(str(i), T.StringType()) for i in range(width)])
    reader = _reader(spark, "csv", sep, False, glob, False).option("enforceSchema", "true").option("mode", "PERMISSIVE")
    rows = reader.schema(texts).load(path).groupBy(F.col("_metadata.file_path").alias("path"))
    checks = []
    for i in range(width):
        text, seen = F.col(f"`{i}`"), F.count(F.col(f"`{i}`")).alias("seen")
        checks.append(F.struct(seen, *[F.count_if(fits).alias(name) for name, fits in _fits(text).items()]).alias(f"c{i}"))
    counted = rows.agg(*checks) if checks else rows.count()
    least = []
    for i in range(width):
        kinds = [F.when(F.col(f"c{i}")[name] == F.col(f"c{i}.seen"), name) for name in _fits(F.lit(""))]
        least.append(F.when(F.col(f"c{i}.seen") > 0, F.coalesce(*kinds)))
    typed = counted.select("path", F.array(*least).cast("array<string>").alias("types"))
    both = headers.join(typed, "path", "left").select("path", F.posexplode("names").alias("position", "name"), "types")
    return both.select("path", "position", "name", F.coalesce(F.get("types", F.col("position")), F.lit("string")).alias("type"))


def _headers(spark, path, sep, glob) -> DataFrame:
    """(path, names) of every CSV file that has a line; its first line is in its first block."""
    lines = spark.read.option("pathGlobFilter", glob or SUFFIXES["csv"]).text(path).filter("_metadata.file_block_start = 0")
    numbered = lines.select(F.col("_metadata.file_path").alias("path"), F.struct(F.monotonically_increasing_id(), "value").alias("line"))
    first = F.regexp_replace(F.min("line")["value"], "[\"\r\ufeff]", "")
    return numbered.groupBy("path").agg(F.split(first, F.concat(F.lit("\\Q"), F.lit(sep), F.lit("\\E"))).alias("names"))


_WIDER = {
    "int": {"bigint", "double", "decimal(38,0)"}, "bigint": {"double", "decimal(38,0)"}, "decimal(38,0)": {"double"},
    "date": {"timestamp"},
}


def misfit_report(types: DataFrame, schema: T.StructType) -> DataFrame:
    """(path, position, name, type, expected) of the columns, by `file_types` of CSV files,
    that do not fit `schema`: another name at their place, a type that is no narrower one, or
    a column too few or too many (the other side null)."""
    wanted = F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("wanted"), F.lit(f.dataType.simpleString()).alias("expected"))
        for i, f in enumerate(schema.fields)
    ])
    every = types.select("path").distinct().select("path", F.inline(wanted))
    both = types.join(every, ["path", "position"], "full")
    pairs = [F.lit(f"{a}>{b}") for a, wider in _WIDER.items() for b in sorted(wider)]
    fits = (F.col("type") == F.col("expected")) | (F.col("expected") == "string")
    fits |= F.concat_ws(">", "type", "expected").isin(*pairs)
    good = F.col("name").eqNullSafe(F.col("wanted")) & F.coalesce(fits, F.lit(False))
    return both.filter(~good).select("path", "position", F.coalesce("name", "wanted").alias("name"), "type", "expected")


def widen_ints(df: DataFrame) -> DataFrame:
    """Every integer column as double, so that a later missing value fits."""
    return df.select(
        *[
            F.col(f"`{f.name}`").cast("double").alias(f.name)
            if isinstance(f.dataType, T.IntegralType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def read_text(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Lines of text files in one `value` column; there is no header line."""
    reader = spark.read
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.text(path)


def read_columnar_json(df: DataFrame, schema: T.StructType | str, column: str = "value") -> DataFrame:
    """Rows of JSON objects that hold one array per column.

    `schema` describes one row, e.g. `"Name string, Age int"`. Each document may be of any
    length; documents are spread over the tasks, each is unpacked where it lies. A document
    that is no such object, or whose arrays differ in length, is an error.
    """
    row = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    arrays = T.StructType([T.StructField(f.name, T.ArrayType(f.dataType)) for f in row.fields])
    # a select of its own: the optimizer does not repeat what is used more than once
    parsed = df.select(F.from_json(column, arrays, {"mode": "FAILFAST"}).alias("doc"))
    columns = [F.col("doc").getField(f.name).alias(f.name) for f in row.fields]
    sizes = F.array(*[F.coalesce(F.size(c), F.lit(-1)) for c in columns])
    zipped = F.arrays_zip(*columns)
    uneven = F.raise_error(F.lit("arrays of different lengths in a columnar document"))
    uneven = uneven.cast(parsed.select(zipped).schema[0].dataType)
    return parsed.select(F.inline(F.when(F.size(F.array_distinct(sizes)) > 1, uneven).otherwise(zipped)))


def unpack_archives(archives: DataFrame, suffix: str = ".csv", batch_lines: int = 10_000) -> DataFrame:
    """Archives (path, content) -> lines (archive, member, line_number, value).

    Archives are unpacked in parallel, one at a time per task, and their lines leave the
    task in batches. Parse them with `from_csv` / `from_json`. Archives in files are better
    read by `ranges.read_zip_members`, which deals out their members.
    """

    def unpack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for archive, content in zip(frame["path"], frame["content"], strict=True):
                with zipfile.ZipFile(io.BytesIO(content)) as opened:
                    for member in sorted(n for n in opened.namelist() if n.endswith(suffix)):
                        with io.TextIOWrapper(opened.open(member), encoding="utf-8") as text:
                            for start, lines in batches(text):
                                numbers = range(start, start + len(lines))
                                yield pd.DataFrame(
                                    {"archive": archive, "member": member, "line_number": numbers, "value": lines}
                                )

    def batches(text):
        start = 1
        while lines := [line.rstrip("\r\n") for line in itertools.islice(text, batch_lines)]:
            yield start, lines
            start += len(lines)

    return archives.mapInPandas(unpack, "archive string, member string, line_number bigint, value string")
