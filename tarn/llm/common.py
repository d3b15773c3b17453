"""What several of the operators share: splits by checksum, batches, packed counters."""

from __future__ import annotations

import ctypes
import gc
import pickle
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tarn.operators.keys import RANGE, STAMP, lay_out, position_in_range, range_number
from tarn.session import broadcast_if_small, stage

_GOLDEN = 0x9E3779B97F4A7C15
#: (group, range) pairs, some 50 bytes each, that `ranked` may broadcast.
SPANS_BROADCAST = 50_000


def checksum_rest(column: str, modulus: int) -> Column:
    """crc32 of a key as text, modulo `modulus`; a null key counts as the empty text."""
    text = F.coalesce(F.col(column).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % modulus


def shared(spark: SparkSession, value):
    """A function that gives tasks a broadcast value; each task unpacks it once.

    Objects of this package are packed with their classes, which executors need not have.
    """
    packed, unpacked = spark.sparkContext.broadcast(cloudpickle.dumps(value)), []

    def get():
        if not unpacked:
            unpacked.append(pickle.loads(packed.value))
        return unpacked[0]

    return get


def read_table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def release_memory() -> None:
    """Give what a worker no longer uses back to the system. Workers go on from stage to
    stage, and what earlier tasks have freed would else count against the later ones."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def slabs(batches: Iterable[pa.RecordBatch], column: int, rows: int = 2_000, size: int = 8 << 20) -> Iterator:
    """Batches cut into runs of at most `rows` rows and, past one row, `size` bytes of a text
    column, so that memory in a task does not depend on how Spark cuts its batches. Memory of
    earlier tasks is given back before, and this one's afterwards."""
    release_memory()
    for batch in batches:
        texts = batch.column(column)
        start = 0
        while start < batch.num_rows:
            stop = min(start + rows, batch.num_rows)
            while stop - start > 1 and texts.slice(start, stop - start).nbytes > size:
                stop = start + (stop - start) // 2
            yield batch.slice(start, stop - start)
            start = stop
    release_memory()


def coded_words(texts: pa.Array, lower: bool = False, ascii: bool = False) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The distinct words of some texts, all words in order as numbers into them, and where
    the words of each text begin and end. Words are cut at white space; null has none.
    With `ascii`, only ASCII white space cuts, and only A-Z are lowered."""
    texts = pc.fill_null(texts, "")
    if lower:
        texts = pc.ascii_lower(texts) if ascii else pc.utf8_lower(texts)
    words = pc.ascii_split_whitespace(texts) if ascii else pc.utf8_split_whitespace(texts)
    coded = words.flatten().dictionary_encode()
    vocabulary, codes = coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False)
    starts = words.offsets.to_numpy().astype(np.int64) - words.offsets[0].as_py()
    if "" in vocabulary:  # what is left of and right of white space at the ends of a text
        empty = vocabulary.index("")
        kept = codes != empty
        starts = np.concatenate(([0], np.cumsum(kept)))[starts]
        codes = codes[kept]
        codes = codes - (codes > empty)
        del vocabulary[empty]
    return vocabulary, codes, starts


def ranked(rows: DataFrame, order: list[Column]) -> DataFrame:
    """`rows` (g, ...) with `rank`, the place in its group from 0, and `n`, the group's size.

    All rows are cut into ranges of equal size, so a group may span many tasks; offsets are
    known per (group, range), and no key of a join has more rows than a range.
    """
    laid = lay_out(rows, [F.col("g"), *order]).withColumn(RANGE, range_number())
    laid = laid.withColumn("place", position_in_range()).drop(STAMP)
    spans = laid.groupBy("g", RANGE).agg(F.count("*").alias("rows"), F.min("place").alias("first"))
    group = Window.partitionBy("g")
    earlier = group.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("rows").over(earlier), F.lit(0))
    spans = spans.select(
        F.col("g").alias("span_g"), F.col(RANGE).alias("span"),
        (before - F.col("first")).alias("shift"), F.sum("rows").over(group).alias("n"),
    )
    spans = stage(spans, "spans")
    same = laid["g"].eqNullSafe(spans["span_g"]) & (laid[RANGE] == spans["span"])
    joined = laid.join(broadcast_if_small(spans, SPANS_BROADCAST), same)
    return joined.withColumn("rank", F.col("place") + F.col("shift")).drop("place", "shift", "span_g", "span", RANGE)


def mix64(values: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit values (the finaliser of splitmix64)."""
    x = values.astype(np.uint64, copy=True)
    x += np.uint64(_GOLDEN)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct whole numbers, sorted, and the place of each one among them."""
    listed = sorted_once(np.sort(keys))
    return listed, places_in(listed)(keys)


def sorted_once(keys: np.ndarray) -> np.ndarray:
    """Sorted numbers without the repeated ones."""
    return keys[np.concatenate(([True], keys[1:] != keys[:-1]))[: len(keys)]]


def places_in(listed: np.ndarray):
    """A function that finds the places of whole numbers in a sorted list, without repeats, that
    has them all. A table by hash has one of those that meet there; the others are found in
    a smaller table of their own, the last few by search."""
    if len(listed) < 1 << 10:
        return lambda keys: np.searchsorted(listed, keys).astype(np.int32)
    shift, factor = np.uint64(63 - len(listed).bit_length()), np.uint64(_GOLDEN + 2 * len(listed))

    def slots(keys):
        return (keys.view(np.uint64) * factor) >> shift

    number, own = np.arange(len(listed), dtype=np.int32), slots(listed)
    table = np.zeros(1 << 64 - int(shift), np.int32)
    table[own] = number
    lost = np.flatnonzero(table[own] != number).astype(np.int32)
    if 2 * len(lost) > len(listed):  # numbers that the hash does not keep apart
        return lambda keys: np.searchsorted(listed, keys).astype(np.int32)
    rest = places_in(listed[lost])

    def find(keys):
        place = table[slots(keys)]
        wrong = np.flatnonzero(listed[place] != keys)
        if len(wrong):
            place[wrong] = lost[rest(keys[wrong])]
        return place

    return find


def by_group(group: np.ndarray, groups: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of things in the order of their groups, and where each group begins."""
    small = group.astype(np.uint16 if groups <= 1 << 16 else np.int64)  # short ones are sorted by their digits
    order = np.argsort(small, kind="stable")
    return order, np.concatenate(([0], np.cumsum(np.bincount(small, minlength=groups))))


def deflated(values) -> bytes:
    """Bytes or whole numbers from 0, made smaller (zstd, after their length); numbers byte
    plane by byte plane, as most are small, without the planes that no number reaches."""
    planes = b""
    if not isinstance(values, bytes):
        whole = np.asarray(values).astype("<i8")
        n = max(1, -(-int(whole.max(initial=0)).bit_length() // 8))
        planes, values = bytes([n]), np.ascontiguousarray(whole.view(np.uint8).reshape(-1, 8).T[:n])
    size = memoryview(values).nbytes
    return planes + size.to_bytes(8, "little") + pa.Codec("zstd", compression_level=1).compress(values, asbytes=True)


def inflated(data) -> bytes:
    data = memoryview(data)
    return pa.Codec("zstd").decompress(data[8:], int.from_bytes(data[:8], "little"), asbytes=True)


def numbers(data: bytes) -> np.ndarray:
    planes = np.frombuffer(inflated(memoryview(data)[1:]), np.uint8).reshape(data[0], -1)
    found = np.zeros((planes.shape[1], 8), np.uint8)
    found[:, : data[0]] = planes.T
    return found.view("<i8").ravel()


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series after moving the argument above 8."""
    shift = np.zeros_like(x)
    y = x.copy()
    for _ in range(8):
        low = y < 8
        shift -= np.where(low, np.log(y), 0)
        y = np.where(low, y + 1, y)
    return shift + (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)


def least_labels(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For n nodes and undirected links, the smallest node reachable from each."""
    label = np.arange(n)
    while len(left):
        low = np.minimum(label[left], label[right])
        before = label.copy()
        np.minimum.at(label, left, low)
        np.minimum.at(label, right, low)
        label = label[label]
        if np.array_equal(before, label):
            break
    return label
