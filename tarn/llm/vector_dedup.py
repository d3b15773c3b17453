"""Near-duplicate vectors: sign hashing by random hyperplanes, exact cosines, components.

Vectors of one label meet in hash tables, each keyed by the signs of random projections. A
pair at the threshold of 0.93 agrees in one sign with probability p = 1 - acos(0.93)/pi. Keys
have two bits more than it takes to number the rows of the largest label (`BITS` at least),
so that a bucket of unlike vectors holds a few rows at any size of the table; the number of
tables grows with 1/p a bit (`TABLES` at `BITS`), which keeps the chance to miss a pair at the
threshold at 1 in 6,000. So the work grows with a power of the rows of about 1.2, not with
their square. Only the keys travel first; a vector goes on to the tables where it has
company. Equal vectors count once, with a weight. All cosines of a bucket are computed, of
many small buckets at once; a pair is counted in the first table that has it together, so
links need no list of pairs: a bucket returns link counts per vector and a star per group.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarn.llm.common import least_labels
from tarn.llm.components import with_component
from tarn.session import stage

THRESHOLD = 0.93
BITS, TABLES = 14, 48
SEED = 7
#: Rows of a bucket that meet in one task; a larger bucket is cut in slices.
SLICE = 2_048
_BLOCK = 512
#: Buckets of at most so many rows are compared many at a time.
_SMALL = 64
_RUN_ROWS = 8_192
_RUN_VALUES = 4 << 20


def key_shape(rows: int, threshold: float = THRESHOLD) -> tuple[int, int]:
    """Bits of a key and number of tables for a largest label of so many rows."""
    bits = max(BITS, math.ceil(math.log2(max(rows, 1))) + 2)
    agree = 1 - math.acos(min(max(threshold, -1.0), 1.0)) / math.pi
    return bits, math.ceil(TABLES / agree ** (bits - BITS)) if agree else TABLES


def signatures(vectors: np.ndarray, bits: int = BITS, tables: int = TABLES, seed: int = SEED) -> np.ndarray:
    """(rows, tables): the signs of random projections. Rows are float64 of one length."""
    planes = np.random.default_rng([seed, vectors.shape[1]]).standard_normal((vectors.shape[1], bits * tables))
    keys, block = np.empty((len(vectors), tables), np.int64), max(_RUN_VALUES // (bits * tables), 1)
    for at in range(0, len(vectors), block):  # keys grow with the table, memory does not
        signs = (vectors[at : at + block] @ planes > 0).reshape(-1, tables, bits)
        keys[at : at + block] = signs @ (1 << np.arange(bits))
    return keys


def bucket_links(unit, weight, signs, table, slices, left: int, right: int, threshold: float = THRESHOLD):
    """Links counted in one cell of a bucket, and the least row linked to each row.

    `slices` tells the slice of every row; the cell compares slice `left` with slice `right`,
    and within a slice only if they are the same. Counts are weighted by the copies of the
    other side. A pair that shares a signature in an earlier table is counted there, not here.
    """
    n = len(unit)
    counts, label = np.zeros(n, np.int64), np.arange(n)
    a, b = np.flatnonzero(slices == left), np.flatnonzero(slices == right)
    for at in range(0, len(a), _BLOCK):
        rows = a[at : at + _BLOCK]
        others = b[b > rows[0]] if left == right else b
        if not len(others):
            continue
        # rounding of the product must not decide, so pairs near the threshold are done exactly
        cosine = unit[rows] @ unit[others].T
        near = cosine >= threshold
        if left == right:
            near &= others[None, :] > rows[:, None]
        for i, j in zip(*np.nonzero(np.abs(cosine - threshold) < 1e-9), strict=True):
            near[i, j] &= float(np.dot(unit[rows[i]], unit[others[j]])) >= threshold
        i, j = np.nonzero(near)
        if not len(i):
            continue
        x, y = rows[i], others[j]
        first = np.ones(len(x), bool)
        for start in range(0, len(x), 1 << 16):
            part = slice(start, start + (1 << 16))
            first[part] = ~(signs[x[part], :table] == signs[y[part], :table]).any(axis=1)
        np.add.at(counts, x[first], weight[y[first]])
        np.add.at(counts, y[first], weight[x[first]])
        while True:  # labels settle within a few rounds
            low = np.minimum(label[x], label[y])
            before = label.copy()
            np.minimum.at(label, x, low)
            np.minimum.at(label, y, low)
            label = label[label]
            if np.array_equal(label, before):
                break
    return counts, label


def small_bucket_links(unit, weight, signs, table, slices, apart, ends, threshold: float = THRESHOLD):
    """`bucket_links` for a run of cells laid end to end: `ends` holds, for each row, the row
    after the last of its cell, `table` the table, `apart` whether only rows of unlike slices
    are compared there. Pairs are made in blocks of a bounded number of values."""
    n = len(unit)
    counts, x, y = np.zeros(n, np.int64), [], []
    later = ends - np.arange(n) - 1
    before = np.concatenate(([0], np.cumsum(later)))
    block = max(_RUN_VALUES // unit.shape[1], 1)
    for start in range(0, int(before[-1]), block):
        pair = np.arange(start, min(start + block, int(before[-1])))
        i = np.searchsorted(before, pair, "right") - 1
        j = i + 1 + pair - before[i]
        cosine = np.einsum("ij,ij->i", unit[i], unit[j])
        near = cosine >= threshold
        for k in np.flatnonzero(np.abs(cosine - threshold) < 1e-9):
            near[k] = float(np.dot(unit[i[k]], unit[j[k]])) >= threshold
        near &= ~apart[i] | (slices[i] != slices[j])
        i, j = i[near], j[near]
        first = (signs[i] == signs[j]).argmax(axis=1) == table[i]
        np.add.at(counts, i[first], weight[j[first]])
        np.add.at(counts, j[first], weight[i[first]])
        x.append(i)
        y.append(j)
    return counts, least_labels(n, np.concatenate(x), np.concatenate(y)) if x else np.arange(n)


def near_vectors(
    rows: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
    threshold: float = THRESHOLD,
    bits: int | None = None,
    tables: int | None = None,
) -> DataFrame:
    """id, n_links, component_id and kept of every row.

    Rows link if their labels are equal and not null and the cosine of their vectors, in
    double precision, is at least `threshold`. A vector that is null, empty, zero or holds
    nulls or non-finite components links with nothing; so do vectors of unequal length. A
    row with a null id keeps null fields; rows that share an id count as links of each other
    like any other rows, and are one node of a component. Further columns are not read.
    Without `bits` and `tables`, keys are as `key_shape` says for the largest label.
    """
    source = rows.select(
        F.col(f"`{id_column}`").cast("long").alias("id"),
        F.col(f"`{vector_column}`").cast("array<double>").alias("vector"),
        F.col(f"`{label_column}`").cast("string").alias("label"),
    )
    usable = (
        F.col("id").isNotNull() & F.col("label").isNotNull()
        & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("vector", lambda x: x != 0)
    )
    # equal vectors of a label become one node
    groups = source.filter(usable).groupBy("label", "vector").agg(
        F.min("id").alias("least"), F.count("*").alias("copies")
    )
    numbered = groups.withColumn("node", F.monotonically_increasing_id())
    nodes = stage(numbered.withColumn("size", F.size("vector")), "nodes")
    if bits is None or tables is None:
        largest = nodes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
        shape = key_shape(largest, threshold)
        bits, tables = bits or shape[0], tables or shape[1]

    def sign(batches):
        for batch in batches:
            names, sizes = batch.column(0), batch.column(2).to_numpy()
            vectors = batch.column(1).flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum(sizes)
            for size in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == size)
                block = np.stack([vectors[e - size : e] for e in ends[at]])
                with np.errstate(over="ignore"):
                    keys = signatures(_unit(block), bits, tables).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [names.take(pa.array(at)), pa.array(list(keys), pa.list_(pa.int32()))], ["node", "signs"]
                )

    signs = stage(nodes.select("node", "vector", "size").mapInArrow(sign, "node long, signs array<int>"), "signs")
    # a bucket: label, length, table, signs; only buckets with company go on
    keys = nodes.select("node", "label", "size").join(signs, "node")
    keyed = keys.select("node", "label", "size", F.posexplode("signs").alias("table", "key"))
    bucket = F.xxhash64("label", "size", "table", "key").alias("bucket")
    keyed = keyed.select("node", bucket, F.col("table").cast("short").alias("table"))
    shared = keyed.groupBy("bucket").agg(F.count("*").alias("rows")).filter("rows > 1")
    cut = keyed.join(shared, "bucket").withColumn("cuts", F.ceil(F.col("rows") / SLICE))
    mine = F.pmod(F.xxhash64("node", "bucket"), F.col("cuts"))
    every = F.sequence(F.lit(0).cast("long"), F.col("cuts") - 1)
    cells = F.transform(every, lambda j: F.struct(F.least(j, mine).alias("left"), F.greatest(j, mine).alias("right")))
    visits = cut.select("node", "bucket", "table", mine.alias("slice"), F.explode(cells).alias("cell"))
    full = nodes.select("node", "label", "vector", "copies").join(signs, "node")
    meeting = visits.join(full, "node").select("bucket", "table", "slice", "cell.left", "cell.right", "node", "label", "vector", "copies", "signs")
    order = ["bucket", "left", "right"]
    meeting = meeting.repartition(*order).sortWithinPartitions(*order)

    def compare(batches):
        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows < _RUN_ROWS:
                continue
            data = pa.Table.from_batches(held).combine_chunks()
            key = [data.column(c).to_numpy() for c in order]
            change = np.flatnonzero(np.logical_or.reduce([k[1:] != k[:-1] for k in key])) + 1
            if len(change):  # the last cell may go on in the next batch
                yield from cells_of(data.slice(0, change[-1]))
                data = data.slice(change[-1])
            held, rows = data.to_batches(), data.num_rows
        if rows:
            yield from cells_of(pa.Table.from_batches(held))

    def cells_of(data):
        data = data.combine_chunks()
        names = ("bucket", "left", "right", "table", "slice", "node", "copies")
        column = {c: data.column(c).to_numpy() for c in names}
        # checksums of buckets may collide: labels and lengths are compared as they are
        column["label"] = data.column("label").combine_chunks().dictionary_encode().indices.to_numpy()
        column["size"] = pc.list_value_length(data.column("vector")).to_numpy()
        signs = data.column("signs").combine_chunks().flatten().to_numpy().reshape(data.num_rows, -1)
        values = data.column("vector").combine_chunks().flatten().to_numpy()
        stops = np.cumsum(column["size"])
        same = ("bucket", "left", "right", "label", "size", "table")
        for size in np.unique(column["size"]):
            at = np.flatnonzero(column["size"] == size)
            at = at[np.lexsort([column[c][at] for c in reversed(same)])]
            cut = np.flatnonzero(np.logical_or.reduce([column[c][at][1:] != column[c][at][:-1] for c in same])) + 1
            bounds = np.concatenate(([0], cut, [len(at)]))
            lengths = np.diff(bounds)
            wide = np.repeat(lengths, lengths)
            groups = [at[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True) if b - a > _SMALL]
            small = at[(wide > 1) & (wide <= _SMALL)]
            unit_of = lambda rows, size=size: _unit(values[(stops[rows] - size)[:, None] + np.arange(size)])
            for group in groups:
                yield from linked(column["node"][group], *bucket_links(
                    unit_of(group), column["copies"][group], signs[group], int(column["table"][group[0]]), column["slice"][group],
                    int(column["left"][group[0]]), int(column["right"][group[0]]), threshold,
                ))
            if len(small):
                kept = lengths[(lengths > 1) & (lengths <= _SMALL)]
                ends = np.repeat(np.cumsum(kept), kept)
                apart = column["left"][small] != column["right"][small]
                yield from linked(column["node"][small], *small_bucket_links(
                    unit_of(small), column["copies"][small], signs[small], column["table"][small], column["slice"][small],
                    apart, ends, threshold,
                ))

    def linked(node, counts, label):
        at = np.flatnonzero((counts > 0) | (label != np.arange(len(node))))
        if len(at):
            yield pa.RecordBatch.from_arrays(
                [pa.array(node[at]), pa.array(counts[at]), pa.array(node[label[at]])], names=["node", "links", "with"]
            )

    found = stage(meeting.mapInArrow(compare, "node long, links long, with long"), "vector-links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    counted = nodes.select("label", "vector", "node", "least", "copies").join(links, "node", "left")
    # copies link with each other too
    facts = counted.select(
        F.col("label").alias("__l"),
        F.col("vector").alias("__v"),
        "least",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    )
    joined = source.withColumn("__ok", F.coalesce(usable, F.lit(False))).join(
        facts, F.col("__ok") & (F.col("label") == F.col("__l")) & (F.col("vector") == F.col("__v")), "left"
    )
    placed = stage(joined.select("id", "least", F.coalesce("n_links", F.lit(0)).alias("n_links")), "placed")
    same = placed.filter("least <> id").select(F.col("id").alias("u"), F.col("least").alias("v"))
    names = nodes.select("node", "least")
    between = (
        found.filter("node <> with").select("node", "with")
        .join(names, "node").select(F.col("least").alias("u"), F.col("with").alias("node"))
        .join(names, "node").select("u", F.col("least").alias("v"))
    )
    return with_component(placed, "id", same.union(between)).select(
        F.col("id").alias(id_column),
        "n_links",
        "component_id",
        (F.col("id") == F.col("component_id")).alias("kept"),
    )


def _unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled first, so that large or tiny components do not overflow."""
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))
