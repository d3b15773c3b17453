"""Best-fit packing of tokenized documents into sequences of a fixed length.

Documents are tokenized and cut into pieces where they stand. The lengths are then packed
in a tree: groups of a few thousand items best-fit locally; bins that are nearly full are
done, the underfull ones go on as single items of the next level, where a best fit over
several groups' leftovers is made, until one group is left or nothing fits together any
more. Only lengths travel, and no group grows with the data.
"""

from __future__ import annotations

import os
import zlib
from bisect import bisect_left, insort
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tarn.llm import bpe
from tarn.llm.common import shared, slabs
from tarn.session import stage

CAPACITY = 4096
END_ID = 1
#: A bin with less room than this share of the capacity is done.
FULL_SHARE = 0.998
#: Items that are packed together at one node of the tree.
GROUP = 4_000


# --- tokens


class WordEncoder(bpe.Encoder):
    """Token ids of texts by the tokenizers library, from the ids of their distinct parts.

    Texts are cut and parts remembered as `bpe.Encoder` does; the library's model gives the
    ids of new parts, which is quicker than making their merges in Python.
    """

    def __init__(self, merges: bpe.Merges):
        super().__init__(merges)
        self.model = Tokenizer(Tokenizer.from_buffer(merges.definition).model)  # neither normalizes nor cuts
        self.ends_part = np.zeros(merges.size, bool)
        if merges.ending:
            self.ends_part[[i for t, i in merges.vocabulary.items() if t.endswith(merges.ending)]] = True

    def _merged(self, shown: list[str]) -> list[bytes]:
        if not self.merges.ending:  # nothing in the ids tells where a part ends
            return super()._merged(shown)
        found = []
        for at in range(0, len(shown), 500):  # few at a time, as an encoding is much larger than its ids
            own = shown[at : at + 500]
            (encoded,) = self.model.encode_batch_fast([own], is_pretokenized=True, add_special_tokens=False)
            ids = np.array(encoded.ids, "<i4")
            ends = (4 * (np.flatnonzero(self.ends_part[ids]) + 1)).tolist()
            data = ids.tobytes()
            found += [data[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]
        return found


def pieces(
    docs: DataFrame,
    tokenizer_path: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: item (unique), the id column, piece, start, length, ids_crc32, and
    on request the ids themselves.

    A document is its token ids and `end_id`; a null or empty text is the end alone. Only
    documents longer than `capacity` are cut, and only their last piece is shorter. Rows
    with the same id are packed as documents of their own.
    """
    with open(tokenizer_path, "rb") as file:
        merges = shared(docs.sparkSession, bpe.Merges(file.read()))
    ending = np.array([end_id], "<u4").tobytes()
    width = 4 * capacity

    def cut(batches):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task for every core
        encoder, item = WordEncoder(merges()), TaskContext.get().partitionId() << 40
        for batch in slabs(batches, 1, size=2 << 20):
            ids, ends = encoder.encode(batch.column(1))
            rows = []
            for key, start, end in zip(batch.column(0).to_pylist(), ends[:-1].tolist(), ends[1:].tolist(), strict=True):
                data = ids[start:end].tobytes() + ending
                for at in range(0, len(data), width):
                    part = data[at : at + width]
                    rows.append((item, key, at // width, at // 4, len(part) // 4, zlib.crc32(part), part))
                    item += 1
            columns = list(zip(*rows, strict=True))
            if with_ids:
                columns[6] = [np.frombuffer(p, "<i4") for p in columns[6]]
            arrays = [pa.array(c, f.type) for c, f in zip(columns, schema, strict=False)]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    fields = ["item long", "id long", "piece int", "start long", "length long", "ids_crc32 long"]
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    if with_ids:
        fields.append("ids array<int>")
        types.append(pa.list_(pa.int32()))
    schema = pa.schema([(f.split()[0], t) for f, t in zip(fields, types, strict=True)])
    source = docs.select(F.col(f"`{id_column}`").cast("long"), F.col(f"`{text_column}`"))
    return source.mapInArrow(cut, ", ".join(fields)).withColumnRenamed("id", id_column)


# --- bins


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best fit in decreasing order: bin and offset of each item, and the fill of each bin."""
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    fill: list[int] = []
    rooms: list[int] = []  # the distinct free spaces, sorted
    with_room: dict[int, list[int]] = {}
    for i in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[i])
        at = bisect_left(rooms, length)
        if at < len(rooms):
            room = rooms[at]
            b = with_room[room].pop()
            if not with_room[room]:
                del with_room[room], rooms[at]
        else:
            b, room = len(fill), capacity
            fill.append(0)
        bins[i], offsets[i] = b, fill[b]
        fill[b] += length
        room -= length
        if room:
            if room not in with_room:
                with_room[room] = []
                insort(rooms, room)
            with_room[room].append(b)
    return bins, offsets, np.array(fill, np.int64)


def _pack_level(items: DataFrame, level: int, groups: int, capacity: int) -> DataFrame:
    """(child, bin, offset, fill, leads): the bin of each item (item, length)."""
    dealt = items.withColumn("group", F.pmod(F.xxhash64("item", F.lit(level)), F.lit(groups)))

    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("item", ignore_index=True)  # the same bins again in a rerun
        bins, offsets, fill = best_fit(frame["length"].to_numpy(), capacity)
        first = (level << 56) + (int(frame["group"].iloc[0]) << 24)
        return pd.DataFrame({
            "child": frame["item"], "bin": first + bins, "offset": offsets,
            "fill": fill[bins], "leads": offsets == 0,
        })

    packed = dealt.groupBy("group").applyInPandas(pack, "child long, bin long, offset long, fill long, leads boolean")
    return stage(packed, "packed")


def pack(items: DataFrame, capacity: int = CAPACITY, full_share: float = FULL_SHARE, group: int = GROUP) -> DataFrame:
    """(item, sequence_id, offset) for `items` (item, unique; length from 1 to capacity).

    Offsets are gapless from 0 in each sequence. A length outside the range is an error.
    """
    fits = F.col("length").between(1, capacity)
    wrong = F.raise_error(F.lit(f"lengths must be from 1 to {capacity}"))
    items = items.select("item", F.when(fits, F.col("length")).otherwise(wrong.cast("long")).alias("length"))
    placed = items.filter(F.col("length") == capacity).select(
        "item", F.col("item").alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    levels: list[DataFrame] = []
    open_items, level, count = items.filter(F.col("length") < capacity), 1, None
    count = open_items.count()
    while count:
        groups = -(-count // group)
        packed = _pack_level(open_items, level, groups, capacity)
        levels.append(packed)
        bins = packed.filter("leads").select(F.col("bin").alias("item"), F.col("fill").alias("length"))
        open_items = bins.filter(F.col("length") <= int(capacity * full_share))
        before, count = count, open_items.count()
        if groups == 1 or (level > 1 and count == before):
            break
        level += 1
    if levels:
        # from the top of the tree down: every bin gets its sequence and its place there
        place = levels[-1].select(F.col("child").alias("item"), F.col("bin").alias("sequence_id"), "offset")
        for lower in reversed(levels[:-1]):
            parent = place.select(F.col("item").alias("bin"), "sequence_id", F.col("offset").alias("base"))
            place = lower.join(parent, "bin", "left").select(
                F.col("child").alias("item"),
                F.coalesce("sequence_id", "bin").alias("sequence_id"),
                (F.col("offset") + F.coalesce("base", F.lit(0))).alias("offset"),
            )
        placed = placed.union(place)
    return placed


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
) -> DataFrame:
    """Every piece of every document with its sequence and its place in it."""
    cut = stage(pieces(docs, tokenizer_path, id_column, text_column, capacity, end_id), "pieces")
    return cut.join(pack(cut.select("item", "length"), capacity), "item").drop("item")


def tokenizer_file(name: str = "word_bpe_49k.json", path: Callable[[str], str] | None = None) -> str:
    """The place of an installed public tokenizer."""
    if path is None:
        from public_tokenizers import path
    return path(name)
