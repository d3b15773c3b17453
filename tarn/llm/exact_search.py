"""Exact top-k search by inner product over an index of pivot distances.

With M the largest norm, a vector x gets one more coordinate, sqrt(M^2 - |x|^2), and a query
a zero there. Then d(q, x)^2 = |q|^2 + M^2 - 2 q.x, so the largest inner products are the
nearest neighbours and the triangle inequality holds. Every vector is keyed by its nearest
pivot and its distance to it; sorted by this key the vectors are packed into blocks, thin
annuli around a pivot. Queries are packed into batches alike. A batch first visits the
annuli next to it, which bounds its k-th best product; then only annuli go on that hold a
distance within these bounds, and of an annulus only the rows that do. Scores are exact
integers; the distances, which are not, only decide with a margin what is not visited.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tarn.session import stage

K = 5
#: Pivots, a bounded sample by a hash of the id; every vector is indexed.
PIVOTS = 16
BLOCK_ROWS = 2_048
BATCH_ROWS = 256
#: Annuli that a batch visits before it has bounds.
SEEDS = 2
_MARGIN = 1e-6
_EXACT = float(1 << 53)


def _matrix(batch: pa.RecordBatch, column: int, width: int) -> np.ndarray:
    """The vectors of a batch as int64 rows; shorter ones are filled up with zeros."""
    listed = batch.column(column)
    sizes = np.diff(listed.offsets.to_numpy())
    out = np.zeros((batch.num_rows, width), np.int64)
    values = listed.flatten().to_numpy(zero_copy_only=False)
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return out


def _products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact integer inner products; beyond a long they are an error."""
    bound = float(np.abs(left).max(initial=0)) * float(np.abs(right).max(initial=0)) * max(1, left.shape[1])
    if bound < _EXACT:
        return (left.astype(float) @ right.T.astype(float)).astype(np.int64)
    found = left.astype(object) @ right.T.astype(object)
    if found.size and (found.max() >= 2**63 or found.min() < -(2**63)):
        raise OverflowError("an inner product is beyond a long")
    return found.astype(np.int64)


def _distances(vectors: np.ndarray, extra: np.ndarray, pivots: np.ndarray, pivot_extra: np.ndarray) -> np.ndarray:
    x = np.concatenate((vectors.astype(float), extra[:, None]), axis=1)
    p = np.concatenate((pivots.astype(float), pivot_extra[:, None]), axis=1)
    return np.stack([np.sqrt(((x - one) ** 2).sum(axis=1)) for one in p], axis=1)


def _height(vectors: np.ndarray, top: float) -> np.ndarray:
    """The coordinate that gives every vector the norm of the largest."""
    return np.sqrt(np.maximum(top - (vectors.astype(float) ** 2).sum(axis=1), 0))


def top_products(rows: DataFrame, is_query: Column, id_column: str, vector_column: str, k: int = K) -> DataFrame:
    """query_id, rank, vec_id and score of the k best candidates of every query.

    `vector_column` holds integer arrays; rows with a null id, a null vector or a null
    component take no part, and shorter vectors count as filled up with zeros. `is_query`
    picks the queries. The candidates of a query are all rows with another id. Of rows that
    share an id every one is a candidate; as a query the smallest vector stands for the id.
    Scores descend, ties go to the smaller id.
    """
    spark = rows.sparkSession
    taken = rows.filter(is_query.isNotNull()).select(
        F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{vector_column}`").cast("array<long>").alias("v"), is_query.alias("asks")
    )
    taken = taken.filter(F.col("id").isNotNull() & F.col("v").isNotNull() & F.forall("v", lambda x: x.isNotNull()))
    norm = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    facts = taken.agg(F.max(norm).alias("top"), F.max(F.size("v")).alias("width")).head()
    width, top = facts.width or 0, (facts.top or 0.0) * (1 + _MARGIN)
    sample = taken.orderBy(F.xxhash64("id"), "id", "v").limit(PIVOTS).select("v").collect()
    pivots = np.zeros((max(1, len(sample)), width), np.int64)
    for i, r in enumerate(sample):
        pivots[i, : len(r.v)] = r.v
    pivot_extra = _height(pivots, top)
    slack = _MARGIN * np.sqrt(max(top, 1.0))

    # --- the index: blocks of vectors around a pivot, queries likewise

    def key(with_height: bool):
        def near(batches):
            for batch in batches:
                vectors = _matrix(batch, 1, width)
                height = _height(vectors, top) if with_height else np.zeros(len(vectors))
                far = _distances(vectors, height, pivots, pivot_extra)
                near = far.argmin(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(near), pa.array(far[np.arange(len(near)), near])],
                    names=["id", "v", "pivot", "far"],
                )

        return near

    def pack(limit: int):
        def blocks(batches):
            number, held, pivot = TaskContext.get().partitionId() << 32, [], None
            for batch in batches:
                pivots_here, start = batch.column(2).to_numpy(), 0
                while start < batch.num_rows:
                    if pivots_here[start] != pivot or sum(len(h) for h in held) >= limit:
                        if held:
                            yield block(held, number, pivot)
                            number += 1
                        held, pivot = [], pivots_here[start]
                    room = limit - sum(len(h) for h in held)
                    same = np.flatnonzero(pivots_here[start:] != pivot)
                    stop = min(start + room, start + same[0] if len(same) else batch.num_rows)
                    held.append(batch.slice(start, stop - start))
                    start = stop
            if held:
                yield block(held, number, pivot)

        def block(held, number, pivot):
            vectors = np.concatenate([_matrix(h, 1, width) for h in held])
            ids = np.concatenate([h.column(0).to_numpy() for h in held])
            far = np.concatenate([h.column(3).to_numpy() for h in held])
            kind = np.int64
            for small in (np.int16, np.int32):
                if not vectors.size or (vectors.min() >= np.iinfo(small).min and vectors.max() <= np.iinfo(small).max):
                    kind = small
                    break
            return pa.RecordBatch.from_arrays(
                [pa.array([x]) for x in (number, int(pivot), float(far[0]), float(far[-1]), ids.astype("<i8").tobytes(),
                                         far.astype("<f8").tobytes(), np.dtype(kind).str, vectors.astype(kind).tobytes())],
                names=["block", "pivot", "low", "high", "ids", "fars", "kind", "vectors"],
            )

        return blocks

    keyed_schema = "id long, v array<long>, pivot long, far double"
    block_schema = "block long, pivot long, low double, high double, ids binary, fars binary, kind string, vectors binary"
    order = ["pivot", "far", "id", "v"]

    def packed(source: DataFrame, with_height: bool, limit: int, label: str) -> DataFrame:
        keyed = source.select("id", "v").mapInArrow(key(with_height), keyed_schema)
        ranged = keyed.repartitionByRange(*order).sortWithinPartitions(*order)
        return stage(ranged.mapInArrow(pack(limit), block_schema), label)

    index = packed(taken, True, BLOCK_ROWS, "index")
    questions = taken.filter("asks").groupBy("id").agg(F.min("v").alias("v"))
    asked = packed(questions, False, BATCH_ROWS, "questions").withColumnRenamed("block", "batch")
    annuli = index.select("block", "pivot", "low", "high")

    # --- visits

    def unpack(ids, kind, vectors):
        return np.frombuffer(ids, "<i8"), np.frombuffer(vectors, kind).reshape(-1, width) if width else np.zeros((len(ids) // 8, 0), np.int64)

    def best(ids: np.ndarray, scores: np.ndarray) -> np.ndarray:
        if len(scores) > 4 * k:  # all that tie with the k-th stay
            kept = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
            return kept[np.lexsort((ids[kept], -scores[kept]))][:k]
        return np.lexsort((ids, -scores))[:k]

    def visit(batches):
        for part in batches:
            for r in part.to_pylist():
                q_ids, q = unpack(r["q_ids"], r["q_kind"], r["q_vectors"])
                ids, x = unpack(r["ids"], r["kind"], r["vectors"])
                fars = np.frombuffer(r["fars"], "<f8")
                floor = np.frombuffer(r["floors"], "<f8") if r["floors"] is not None else np.full(len(q_ids), -np.inf)
                reach = _reach(q, floor, top, slack)
                own = _distances(q, np.zeros(len(q)), pivots[r["pivot"] : r["pivot"] + 1], pivot_extra[r["pivot"] : r["pivot"] + 1])[:, 0]
                # of the sorted annulus only the rows that some query of the batch can reach
                a = np.searchsorted(fars, (own - reach).min(), side="left")
                b = np.searchsorted(fars, (own + reach).max(), side="right")
                asking = np.flatnonzero((own + reach >= fars[0]) & (own - reach <= fars[-1]))
                if a >= b or not len(asking):
                    continue
                scores = _products(q[asking].astype(np.int64), x[a:b].astype(np.int64))
                found = []
                for row, i in zip(scores, asking.tolist(), strict=True):
                    at = np.flatnonzero((row >= floor[i]) & (ids[a:b] != q_ids[i]))
                    top_k = at[best(ids[a:b][at], row[at])]
                    found += [(r["batch"], i, int(q_ids[i]), int(ids[a + j]), int(row[j])) for j in top_k.tolist()]
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*found, strict=True)], names=names)

    names = ["batch", "place", "query_id", "vec_id", "score"]
    found_schema = "batch long, place long, query_id long, vec_id long, score long"
    first = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    def visited(pairs: DataFrame, floors: DataFrame | None) -> DataFrame:
        asking = asked.select(
            "batch", F.col("ids").alias("q_ids"), F.col("kind").alias("q_kind"), F.col("vectors").alias("q_vectors")
        )
        asking = asking.withColumn("floors", F.lit(None).cast("binary")) if floors is None else asking.join(floors, "batch", "left")
        met = pairs.join(asking, "batch").join(index.drop("low", "high"), "block")
        columns = ["batch", "q_ids", "q_kind", "q_vectors", "floors", "pivot", "ids", "fars", "kind", "vectors"]
        scored = met.select(*columns).mapInArrow(visit, found_schema)
        return scored.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= k)

    beside = asked.select("batch", "pivot", ((F.col("low") + F.col("high")) / 2).alias("middle")).join(annuli, "pivot")
    gap = F.greatest(F.col("low") - F.col("middle"), F.col("middle") - F.col("high"), F.lit(0.0))
    nearest = Window.partitionBy("batch").orderBy(gap, "low", "block")
    seeds = beside.withColumn("n", F.row_number().over(nearest)).filter(F.col("n") <= SEEDS).select("batch", "block")
    start = stage(visited(seeds, None), "seeds")

    # the k-th best product so far of every query, and how far from each pivot that reaches
    kth = start.filter(F.col("rank") == k).groupBy("batch").agg(
        F.collect_list(F.struct("place", "score")).alias("kth")
    )  # at most BATCH_ROWS entries
    bounded = asked.select("batch", "ids", "kind", "vectors").join(kth, "batch", "left")

    def bound(batches):
        for part in batches:
            for r in part.to_pylist():
                _, q = unpack(r["ids"], r["kind"], r["vectors"])
                floor = np.full(len(q), -np.inf)
                for one in r["kth"] or []:
                    floor[one["place"]] = one["score"]
                reach = _reach(q, floor, top, slack)
                far = _distances(q, np.zeros(len(q)), pivots, pivot_extra)
                low, high = (far - reach[:, None]).min(axis=0), (far + reach[:, None]).max(axis=0)
                n = len(pivots)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["batch"]] * n), pa.array([floor.tobytes()] * n), pa.array(np.arange(n)), pa.array(low), pa.array(high)],
                    names=["batch", "floors", "pivot", "from", "to"],
                )

    reached = stage(
        bounded.mapInArrow(bound, "batch long, floors binary, pivot long, `from` double, `to` double"), "reach"
    )
    within = reached.select("batch", "pivot", "from", "to").join(annuli, "pivot")
    pairs = within.filter((F.col("high") >= F.col("from")) & (F.col("low") <= F.col("to"))).select("batch", "block")
    floors = reached.filter("pivot = 0").select("batch", "floors")
    return visited(pairs, floors).select("query_id", "rank", "vec_id", "score")


def _reach(queries: np.ndarray, floor: np.ndarray, top: float, slack: float) -> np.ndarray:
    """The distance within which a vector can still have a product of `floor` or more."""
    square = (queries.astype(float) ** 2).sum(axis=1) + top - 2 * floor
    return np.sqrt(np.maximum(square, 0) * (1 + _MARGIN)) + slack
