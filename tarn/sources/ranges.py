"""Files in byte ranges and archives by member: Spark lists and deals, tasks read streams.

Spark's reader of binary files holds a file whole, 2 GB at most. Here a listing becomes one
row per range or member, the rows are dealt over the tasks, and each task opens what it got
by its URI and holds one chunk of it. Files are opened with pyarrow (local and mounted
folders, `hdfs`, `s3`, `gs`, `abfs`); for other stores pass an `opener` of your own, a
function from a URI to a seekable binary stream. Spark's listing leaves out empty files.
"""

from __future__ import annotations

import zipfile
from collections.abc import Callable, Iterator
from typing import BinaryIO

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarn.functions.columns import content_hash
from tarn.session import stage
from tarn.sources.readers import file_inventory

CHUNK = 8 << 20
RANGE_BYTES = 64 << 20
#: Digests that are hashed together on one level of a tree.
FAN = 1_024
#: Bytes that a task is to read, if there is enough to do for all cores.
TASK_BYTES = 64 << 20
#: What the directory of an archive counts for.
DIRECTORY_BYTES = 1 << 20
#: Tasks that rows are dealt to at most; beyond it a task gets more bytes.
MOST_TASKS = 20_000

Opener = Callable[[str], BinaryIO]


def file_systems() -> Callable:
    """A function from a URI to (pyarrow file system, path); it travels to tasks by value."""

    def locate(uri: str):
        from pyarrow import fs

        scheme, _, rest = uri.partition(":")
        if not rest or scheme == "file" or "/" in scheme:
            path = rest if scheme == "file" else uri
            return fs.LocalFileSystem(), "/" + path.lstrip("/") if scheme == "file" else path
        authority, _, inside = rest.removeprefix("//").partition("/")
        scheme = {"s3a": "s3", "s3n": "s3"}.get(scheme, scheme)
        found, root = fs.FileSystem.from_uri(f"{scheme}://{authority}/")
        return found, f"{root.rstrip('/')}/{inside}"

    return locate


def opened_by_uri() -> Opener:
    """The opener that is used unless another is given."""
    locate = file_systems()

    def open_uri(uri: str) -> BinaryIO:
        store, path = locate(uri)
        return store.open_input_file(path)

    return open_uri


def dealt(rows: DataFrame, weight: str) -> DataFrame:
    """Few small rows that stand for the reading of `weight` bytes, dealt over the tasks.

    Such rows are too small for Spark to spread by size. They are staged, so that they are
    counted and dealt from the same listing.
    """
    kept = stage(rows, "dealt")
    n, size = kept.agg(F.count("*"), F.sum(weight)).first()
    cores = 2 * rows.sparkSession.sparkContext.defaultParallelism
    tasks = min(n, max(cores, -(-int(size or 0) // TASK_BYTES)), MOST_TASKS)
    return kept.repartition(max(tasks, 1))


def file_ranges(files: DataFrame, size: int = RANGE_BYTES) -> DataFrame:
    """Files (path, size) -> (path, size, piece, start, length); an empty one has one range."""
    last = F.greatest(F.col("size") - 1, F.lit(0).cast("long"))
    starts = F.sequence(F.lit(0).cast("long"), last, F.lit(size).cast("long"))
    cut = files.select("path", "size", F.posexplode(starts).alias("piece", "start"))
    length = F.least(F.col("size") - F.col("start"), F.lit(size).cast("long"))
    return cut.withColumn("piece", F.col("piece").cast("long")).withColumn("length", length)


def range_digests(ranges: DataFrame, opener: Opener | None = None, chunk: int = CHUNK) -> DataFrame:
    """`ranges` with the SHA-256 of each; a file that ends too early is an error."""
    open_file = opener or opened_by_uri()

    def digest(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import hashlib

        for frame in frames:
            digests = []
            for path, start, length in zip(frame["path"], frame["start"], frame["length"], strict=True):
                state, left = hashlib.sha256(), int(length)
                with open_file(path) as stream:
                    stream.seek(int(start))
                    while left:
                        data = stream.read(min(chunk, left))
                        if not data:
                            raise OSError(f"{path} ends before byte {start + length}")
                        state.update(data)
                        left -= len(data)
                digests.append(state.hexdigest())
            yield frame.assign(sha256=digests)

    columns = ["path", "size", "piece", "start", "length"]
    schema = "path string, size bigint, piece bigint, start bigint, length bigint, sha256 string"
    return dealt(ranges.select(*columns), "length").mapInPandas(digest, schema)


def streamed_digests(files: DataFrame, opener: Opener | None = None) -> DataFrame:
    """Files (path, size) with the SHA-256 of their bytes, each read by one task as a stream:
    the plain digest can not be put together from parts. See `tree_manifest`."""
    whole = files.select("path", "size", F.lit(0).cast("long").alias("piece"), F.lit(0).cast("long").alias("start"), F.col("size").alias("length"))
    return range_digests(whole, opener).select("path", "size", "sha256")


def tree_manifest(
    spark: SparkSession, path: str, glob: str | None = None, size: int = RANGE_BYTES, opener: Opener | None = None
) -> DataFrame:
    """Path, size and tree hash of every file; the ranges of one file are read by many tasks.

    A range of `size` bytes has its SHA-256; while a file has more than one digest, every
    `FAN` consecutive ones become the SHA-256 of their hex texts one after another. So a file
    of one range has its plain SHA-256.
    """
    digests = range_digests(file_ranges(file_inventory(spark, path, glob), size), opener)
    level = stage(digests.select("path", "size", "piece", "sha256"), "ranges")
    most = level.agg(F.max("piece")).first()[0] or 0
    while most:
        most //= FAN
        parts = F.sort_array(F.collect_list(F.struct("piece", "sha256")))["sha256"]
        run = level.groupBy("path", "size", F.floor(F.col("piece") / FAN).alias("run")).agg(parts.alias("parts"))
        # a run of one is the last of its file; it is hashed as well unless it is the only one
        several = (F.size("parts") > 1) | (F.col("run") > 0)
        joined = content_hash(F.array_join("parts", ""))
        level = run.select("path", "size", F.col("run").alias("piece"), F.when(several, joined).otherwise(F.col("parts")[0]).alias("sha256"))
    return level.select("path", "size", "sha256")


def zip_members(archives: DataFrame, suffix: str = ".csv", opener: Opener | None = None) -> DataFrame:
    """Archives (path) -> (archive, place, member, size); only the directory at the end of
    each archive is read."""
    open_file = opener or opened_by_uri()

    def listed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for archive in frame["path"]:
                with open_file(archive) as stream, zipfile.ZipFile(stream) as opened:
                    found = [(archive, i, m.filename, m.file_size) for i, m in enumerate(opened.infolist()) if m.filename.endswith(suffix)]
                yield pd.DataFrame(found, columns=["archive", "place", "member", "size"])

    named = archives.select("path", F.lit(DIRECTORY_BYTES).alias("size"))
    return dealt(named, "size").mapInPandas(listed, "archive string, place bigint, member string, size bigint")


def read_members(members: DataFrame, batch_lines: int = 10_000, opener: Opener | None = None) -> DataFrame:
    """Members (archive, place, size) -> lines (archive, member, line_number, value).

    Every member is unpacked by one task as a stream, so many tasks share a large archive,
    and a task holds `batch_lines` lines. Members that share a name are read one by one.
    """
    open_file = opener or opened_by_uri()

    def unpacked(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import io
        import itertools

        for frame in frames:
            for archive, rows in frame.groupby("archive", sort=False):
                with open_file(archive) as stream, zipfile.ZipFile(stream) as opened:
                    inside = opened.infolist()
                    for place in rows["place"]:
                        with io.TextIOWrapper(opened.open(inside[place]), encoding="utf-8") as text:
                            start = 1
                            while lines := [x.rstrip("\r\n") for x in itertools.islice(text, batch_lines)]:
                                numbers = range(start, start + len(lines))
                                member = inside[place].filename
                                yield pd.DataFrame({"archive": archive, "member": member, "line_number": numbers, "value": lines})
                                start += len(lines)

    lines = dealt(members.select("archive", "place", "size"), "size").sortWithinPartitions("archive", "place")
    return lines.mapInPandas(unpacked, "archive string, member string, line_number bigint, value string")


def read_zip_members(
    spark: SparkSession, path: str, suffix: str = ".csv", batch_lines: int = 10_000, opener: Opener | None = None
) -> DataFrame:
    """Lines of the members with `suffix` of all zip archives in a folder, of any size."""
    archives = file_inventory(spark, path, "*.zip", recursive=False)
    return read_members(zip_members(archives, suffix, opener), batch_lines, opener)
