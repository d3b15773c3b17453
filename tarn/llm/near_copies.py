"""Near copies by the share of common word shingles, exactly confirmed.

Two texts are near copies if the Jaccard similarity of their sets of `SHINGLE`-word
shingles is at least 0.8. Texts meet through their SimHash fingerprints over such shingles,
compared in bit planes as `simhash` does: all that differ in few bits. Fingerprints that
near do not reach down to a similarity of 0.8, so texts also meet through `BANDS` min-hash
keys of `ROWS` values each: a pair at exactly 0.8 shares none of them about 5 times in a
million, a closer one more rarely. What meets, directly or over others, is one candidate
group, and there the sets themselves are compared.

A large group is cut in slices. Each slice meets the first text of the group, which settles
a group of copies of one text in one pass; only groups that are still in parts after that
have every two slices meet.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarn.llm import simhash
from tarn.llm.common import coded_words, mix64, slabs
from tarn.llm.components import with_component
from tarn.session import stage

SHINGLE = 5
BANDS, ROWS = 40, 6
#: Shingles, and texts, of one slice of a candidate group, about.
SLICE_SHINGLES = 200_000
SLICE = 1_000
_CHUNK = 1_024


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text. Words are cut at ASCII white space
    and A-Z lowered; a shorter text is one shingle, and one without words has none."""
    words, codes, starts = coded_words(texts, lower=True, ascii=True)
    hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in words), np.uint64, len(words))[codes]
    out = []
    for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
        count = max(1, b - a - SHINGLE + 1) if b > a else 0
        mixed = np.zeros(count, np.uint64)
        for k in range(min(SHINGLE, b - a)):
            mixed = mix64(mixed * np.uint64(3) ^ hashes[a + k : a + k + count])
        out.append(np.unique(mixed))
    return out


_FACTORS = mix64(np.arange(BANDS * ROWS, dtype=np.uint64)) | np.uint64(1)
_ADDENDS = mix64(np.arange(BANDS * ROWS, dtype=np.uint64) + np.uint64(1 << 20))


def band_keys(shingles: np.ndarray) -> np.ndarray:
    """`BANDS` keys; two sets share each with about the `ROWS`th power of their similarity."""
    if not len(shingles):
        return np.zeros(0, np.int64)
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), _CHUNK):
        part = shingles[None, at : at + _CHUNK] * _FACTORS[:, None] + _ADDENDS[:, None]
        np.minimum(least, part.min(axis=1), out=least)
    key = np.arange(BANDS, dtype=np.uint64)
    for column in least.reshape(BANDS, ROWS).T:
        key = mix64(key * np.uint64(3) ^ column)
    return key.view(np.int64)


def linked(sets: list[np.ndarray]) -> np.ndarray:
    """For each set the least row reachable over pairs at a similarity of at least 0.8."""
    n, sizes = len(sets), np.array([len(s) for s in sets], np.int64)
    ends = np.cumsum(sizes)
    kinds, codes = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(codes, kind="stable")
    holder = np.repeat(np.arange(n), sizes)[order]
    first = np.searchsorted(codes[order], np.arange(len(kinds) + 1))
    label, left = np.full(n, -1), n
    for seed in range(n):
        if label[seed] >= 0:
            continue
        label[seed], left, waiting = seed, left - 1, [seed]
        while waiting and left:
            i = waiting.pop()
            own = codes[ends[i] - sizes[i] : ends[i]]
            reps = first[own + 1] - first[own]
            place = np.arange(reps.sum()) + np.repeat(first[own] - np.cumsum(reps) + reps, reps)
            common = np.bincount(holder[place], minlength=n)
            # common / (sizes[i] + sizes - common) >= 0.8
            found = np.flatnonzero((label < 0) & (9 * common >= 4 * (sizes[i] + sizes)))
            label[found], left = seed, left - len(found)
            waiting.extend(found.tolist())
    return label


def sketches(docs: DataFrame) -> DataFrame:
    """(id, digest of the set of shingles, its size, its band keys, fingerprint over shingles)
    of every row of (id, text)."""

    def of_texts(batches):
        for batch in slabs(batches, 1):
            sets = shingle_sets(batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                 pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([band_keys(s) for s in sets], pa.list_(pa.int64())),
                 pa.array(np.array([simhash.fingerprint(t, SHINGLE) for t in batch.column(1).to_pylist()], np.uint64).view(np.int64))],
                ["id", "digest", "size", "keys", "fp"],
            )

    return docs.mapInArrow(of_texts, "id long, digest binary, size long, keys array<long>, fp long")


def _confirmed(cells: DataFrame) -> DataFrame:
    """(u, v) links that join all near copies among the (id, text) of each (grp, cell)."""

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        ids = frame["id"].to_numpy()
        to = ids[linked(shingle_sets(pa.array(frame["text"], pa.string())))]
        return pd.DataFrame({"u": ids[ids != to], "v": to[ids != to]})

    return cells.select("grp", "cell", "id", "text").groupBy("grp", "cell").applyInPandas(compare, "u long, v long")


def near_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """id and component_id, the least id that near copies lead to, of every row of `docs`.

    Rows with the same id count as one document. A null id has no component. Texts without
    words are copies of each other. Further columns of `docs` are not read.
    """
    source = docs.select(F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{text_column}`").alias("text"))
    prints = stage(sketches(source), "sketches")
    known = prints.filter("id IS NOT NULL")
    distinct = stage(known.groupBy("digest", "size", "keys").agg(F.min("id").alias("node"), F.min_by("fp", "id").alias("fp")), "distinct-sketches")
    same = known.join(distinct.select("digest", "node"), "digest").filter("id <> node").select("id", "node")

    keyed = distinct.select("node", F.explode("keys").alias("key"))
    met = keyed.groupBy("key").agg(F.min("node").alias("low"), F.count("*").alias("n")).filter("n > 1")
    meetings = keyed.join(met.select("key", "low"), "key").filter("node <> low").select("node", "low")
    near = simhash.near_prints(distinct.select(F.col("node").alias("id"), "fp"))
    grouped = stage(with_component(distinct.select("node", "size"), "node", near.union(meetings), "grp"), "candidates")
    slices = F.ceil(F.greatest(F.sum("size") / SLICE_SHINGLES, F.count("*") / SLICE)).alias("slices")
    sizes = grouped.groupBy("grp").agg(slices, F.count("*").alias("n")).filter("n > 1").drop("n")
    members = grouped.join(sizes, "grp").select("node", "grp", "slices").distinct()
    mine = F.pmod(F.xxhash64("id", "text"), F.col("slices"))
    texts = source.join(members, F.col("id") == F.col("node")).drop("node").withColumn("mine", mine)
    texts = stage(texts, "candidate-texts")

    every = F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)
    cell = F.explode(F.when(F.col("id") == F.col("grp"), every).otherwise(F.array("mine")))
    links = stage(_confirmed(texts.withColumn("cell", cell)), "copies-in-slices")
    cut = texts.filter("slices > 1").select("id", "grp").distinct()
    parts = with_component(cut, "id", links, "part").groupBy("grp").agg(F.min("part").alias("a"), F.max("part").alias("b"))
    still = stage(parts.filter("a < b").select("grp"), "groups-in-parts")
    if still.head(1):
        others = F.filter(every, lambda j: j != F.col("mine"))
        pair = F.transform(others, lambda j: F.least(j, "mine") * F.col("slices") + F.greatest(j, "mine"))
        links = links.union(_confirmed(texts.join(still, "grp").withColumn("cell", F.explode(pair))))
    found = with_component(prints.select("id"), "id", same.union(links))
    return found.withColumnRenamed("id", id_column)
