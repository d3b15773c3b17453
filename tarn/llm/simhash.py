"""SimHash near-duplicates: fingerprints of word shingles and a bit-sliced comparison.

Fingerprints that differ in at most `RADIUS` of 64 bits link. If 64 bits are cut into
RADIUS + 2 blocks, two of the blocks agree in every linked pair, so comparing within the
buckets of every pair of blocks finds all links exactly. In a bucket the fingerprints lie
as bit planes: lane i of plane b is bit b of fingerprint i. XOR of planes and a carry-save
counter per lane update 64 distances with a few word operations; a block of lanes is left
as soon as each of them is past the radius.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarn.llm.common import least_labels, slabs
from tarn.llm.components import with_component
from tarn.session import stage

SHINGLE = 4
SEED = 42
RADIUS = 4
#: Rows of a bucket that one task compares with each other; larger buckets are cut in slices.
SLICE = 8_192
_SMALL = 63  # buckets up to this size are compared many at a time


# --- fingerprints


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """64 bits; a bit is set if it is set in more than half of the shingle hashes."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        hashes = np.array([digest(joined, seed)], dtype="<u8")
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = np.concatenate(([0], ends[:-1]))
        spans = zip(starts[: len(words) - shingle + 1].tolist(), (ends[shingle - 1 :] - 1).tolist(), strict=True)
        count = len(words) - shingle + 1
        hashes = np.fromiter((digest(joined[a:b], seed) for a, b in spans), "<u8", count)
    set_bits = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 4_096):
        part = hashes[at : at + 4_096].view(np.uint8).reshape(-1, 8)
        set_bits += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.uint16)
    return int(np.packbits(2 * set_bits > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, fingerprint as a signed long) of every row; a null text has fingerprint 0."""

    def of_texts(batches):
        for batch in slabs(batches, 1):
            values = np.array([fingerprint(t) for t in batch.column(1).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values.view(np.int64))], ["id", "fp"])

    ids = docs.select(F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{text_column}`").alias("text"))
    return ids.mapInArrow(of_texts, "id long, fp long")


# --- bit-sliced comparison


def bit_planes(values: np.ndarray) -> np.ndarray:
    """64 planes of packed lanes, uint64 words: plane b, lane i is bit b of values[i]."""
    lanes = -(-len(values) // 64) * 64
    padded = np.zeros(lanes, "<u8")
    padded[: len(values)] = values
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view("<u8")


def close_lanes(differences, shape, radius: int = RADIUS) -> np.ndarray:
    """Lanes with at most `radius` differing planes, as packed words.

    `differences` yields the XOR of a plane each time; it is not read to its end once all
    lanes are past the radius. The counter of each lane is carry-save: word k holds bit k
    of 64 counts, and a carry out of the last word marks the lane as past the radius.
    """
    width = (radius + 1).bit_length()
    counts = [np.zeros(shape, np.uint64) for _ in range(width)]
    past = np.zeros(shape, np.uint64)
    for n, carry in enumerate(differences, 1):
        for k in range(width):
            counts[k], carry = counts[k] ^ carry, counts[k] & carry
        past |= carry
        if n >= 12 and n % 6 == 0 and not (~_over(counts, past, radius)).any():
            return np.zeros(shape, np.uint64)
    return ~_over(counts, past, radius)


def _over(counts, past, radius: int) -> np.ndarray:
    """Lanes whose count is above the radius, comparing from the highest bit down."""
    above, equal = past, ~past
    for k in reversed(range(len(counts))):
        if radius >> k & 1:
            equal = equal & counts[k]
        else:
            above = above | (equal & counts[k])
            equal = equal & ~counts[k]
    return above


def _lanes(words: np.ndarray) -> np.ndarray:
    return np.unpackbits(np.ascontiguousarray(words).view(np.uint8), bitorder="little")


def neighbour_links(values: np.ndarray, bucket: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Links inside many small buckets at once; rows of a bucket lie together.

    Step d compares every row with the row d places on, for all buckets in the same words.
    """
    n, planes = len(values), bit_planes(values)
    after = np.concatenate((planes[:, 1:], np.zeros((64, 1), np.uint64)), axis=1)
    left, right = [], []
    for d in range(1, min(_SMALL, n - 1) + 1):
        together = np.zeros(planes.shape[1] * 64, bool)
        together[: n - d] = bucket[d:] == bucket[:-d]
        active = np.packbits(together, bitorder="little").view("<u8")
        words = np.flatnonzero(active)
        if not len(words):
            break
        low, high = np.uint64(d), np.uint64(64 - d)
        moved = ((plane[words] >> low) | (on[words] << high) for plane, on in zip(planes, after, strict=True))
        xors = (plane[words] ^ other for plane, other in zip(planes, moved, strict=True))
        hits = np.flatnonzero(_lanes(close_lanes(xors, len(words), radius) & active[words]))
        rows = words[hits // 64] * 64 + hits % 64
        left.append(rows)
        right.append(rows + d)
    empty = [np.zeros(0, np.int64)]
    return np.concatenate(left or empty), np.concatenate(right or empty)


def bucket_labels(values: np.ndarray, radius: int = RADIUS, rows: int = 64) -> np.ndarray:
    """For one bucket of any size, the least row reachable from each, without a list of pairs.

    `rows` fingerprints at a time are compared with all lanes; the rows that one of them
    links to are merged into one label.
    """
    n, planes = len(values), bit_planes(values)
    label = np.arange(n)
    ones = np.uint64(0xFFFFFFFFFFFFFFFF)
    for at in range(0, n, rows):
        own = values[at : at + rows]
        xors = (plane[None, :] ^ (((own >> np.uint64(b)) & np.uint64(1)) * ones)[:, None] for b, plane in enumerate(planes))
        close = close_lanes(xors, (len(own), planes.shape[1]), radius)
        for i, words in enumerate(close):
            linked = np.flatnonzero(_lanes(words)[:n])
            found = np.unique(label[linked])
            if len(found) > 1:
                label[np.isin(label, found)] = found[0]
    return label


# --- links over a whole table


def _bucket_keys(fp, radius: int):
    """One key per choice of two of radius + 2 blocks: number of the choice, then the bits."""
    edges = np.linspace(0, 64, radius + 3).round().astype(int)
    blocks = [
        F.shiftrightunsigned(fp, int(a)).bitwiseAND(F.lit((1 << int(b - a)) - 1).cast("long"))
        for a, b in zip(edges[:-1], edges[1:], strict=True)
    ]
    pairs = enumerate(combinations(range(radius + 2), 2))
    return F.array(*[
        F.shiftleft(F.lit(i).cast("long"), 48).bitwiseOR(F.shiftleft(blocks[a], 24)).bitwiseOR(blocks[b])
        for i, (a, b) in pairs
    ])


def fingerprint_links(distinct: DataFrame, radius: int = RADIUS, slice_rows: int = SLICE) -> DataFrame:
    """(u, v) links that join all near fingerprints: `distinct` has node and fp, each fp once.

    Not every near pair comes out, but pairs enough to connect what is connected. A bucket
    of more than `slice_rows` rows is cut in slices by a hash of the fingerprint, and every
    two slices meet in a cell of their own.
    """
    keyed = distinct.select("node", "fp", F.explode(_bucket_keys(F.col("fp"), radius)).alias("key"))
    shared = keyed.groupBy("key").count().filter("count > 1")
    rows = keyed.join(shared, "key").withColumn("slices", F.ceil(F.col("count") / slice_rows))
    mine = F.pmod(F.xxhash64("fp", "key"), F.col("slices"))
    other = F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)
    cell = F.transform(other, lambda j: F.least(j, mine) * F.col("slices") + F.greatest(j, mine))
    cells = rows.select("key", F.explode(cell).alias("cell"), "fp", "node")
    cells = cells.repartition("key", "cell").sortWithinPartitions("key", "cell")

    def compare(batches):
        kept: list[np.ndarray] = []  # the last bucket of what has been read may go on
        for batch in batches:
            rows = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)])
            kept.append(rows)
            if np.array_equal(kept[0][:2, 0], rows[:2, -1]):
                continue
            rows = np.concatenate(kept, axis=1)
            last = (rows[0] == rows[0, -1]) & (rows[1] == rows[1, -1])
            kept = [rows[:, last]]
            yield from linked(rows[:, ~last])
        if kept:
            yield from linked(np.concatenate(kept, axis=1))

    def linked(rows):
        key, cell, fp, node = rows
        starts = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]) | (cell[1:] != cell[:-1]))))
        sizes = np.diff(np.append(starts, len(key)))
        bucket = np.repeat(np.arange(len(starts)), sizes)
        values = fp.view(np.uint64)
        small = np.flatnonzero(sizes[bucket] <= _SMALL)
        out = []
        if len(small):
            left, right = neighbour_links(values[small], bucket[small], radius)
            label = least_labels(len(small), left, right)
            out.append((node[small], node[small[label]]))
        for b in np.flatnonzero(sizes > _SMALL):
            part = slice(starts[b], starts[b] + sizes[b])
            out.append((node[part], node[part][bucket_labels(values[part], radius)]))
        if out:
            u, v = (np.concatenate(x) for x in zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(u[u != v]), pa.array(v[u != v])], ["u", "v"])

    return cells.mapInArrow(compare, "u long, v long")


def near_prints(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(u, v) links that join all rows of (id, fp) with near fingerprints; a null id has none."""
    known = prints.filter("id IS NOT NULL")
    distinct = stage(known.groupBy("fp").agg(F.min("id").alias("node")), "distinct-fingerprints")
    same = known.join(distinct, "fp").filter("id <> node").select(F.col("id").alias("u"), F.col("node").alias("v"))
    return same.union(fingerprint_links(distinct, radius))


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", radius: int = RADIUS
) -> DataFrame:
    """id, fingerprint (16 hex digits) and component_id of every row of `docs`.

    Rows with the same id count as one document. A null id keeps its fingerprint and has no
    component. Null and empty texts have fingerprint zero and link like any other. Further
    columns of `docs` are not read.
    """
    prints = stage(fingerprints(docs, id_column, text_column), "fingerprints")
    return with_component(prints, "id", near_prints(prints, radius)).select(
        F.col("id").alias(id_column),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
    )
