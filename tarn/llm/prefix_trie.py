"""A trie over conversations, counted in ternary search trees by range shard.

Turns get dictionary ids, and a conversation becomes the sequence of its turns' ids. What
follows the first turn that no other conversation has is a chain of nodes with one member;
those rows are written as they are. The trunks before are sorted and dealt into shards by
ranges, so that each shard holds a stretch of the trie. A shard builds a ternary search
tree of its distinct trunks, balanced by inserting medians first, and one pass over its
nodes, from the last made to the first, adds members, leaves and savings to the parents.

Nodes on the paths of a shard's first and last trunk may go on in a neighbour shard. They
travel as partial nodes, without their children that are such nodes themselves, and are
merged in a tree: 64 neighbours at a time, until one stretch is left.

Equal trunks are split by conversation id, turns and conversations that hold a good part of
all rows meet their ids by broadcast, and places of turns come from ranges. What one task
has to hold at least is the trunk of one conversation, 16 bytes a turn.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarn.llm.common import ranked
from tarn.session import broadcast_if_small, stage

#: Turns of trunks in a shard, and stretches merged at a time.
SHARD_TURNS = 200_000
FAN_IN = 64
#: Conversation ids in one piece of the text that a digest is taken of.
PIECE = 500
#: A table of at most so many rows (some 60 bytes each) is broadcast whole; of a larger one
#: the keys of more than this share of all rows are, which are fewer than 5,000.
BROADCAST_ROWS = 100_000
HOT_SHARE = 1 / 5_000
_NO_ENDS = hashlib.sha256(b"").hexdigest()
_NODE_FIELDS = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens".split()
#: A node on its way: `path` and `parent` identify it and its parent by digests of their
#: turns, `side` tells whether it lies on the first (1) or last (2) path of its stretch, and
#: is 0 if the node is done. Rows with `piece` carry ids of conversations that end at `path`.
_PARTIAL = pa.schema(
    [(name, pa.int64()) for name in _NODE_FIELDS]
    + [("ends_sha256", pa.string()), ("path", pa.binary()), ("parent", pa.binary()), ("words", pa.int64())]
    + [("side", pa.int64()), ("stretch", pa.int64()), ("piece_at", pa.int64()), ("piece", pa.string())]
)
_SPARK_TYPES = {pa.int64(): "long", pa.string(): "string", pa.binary(): "binary"}
_PARTIAL_SQL = ", ".join(f"{f.name} {_SPARK_TYPES[f.type]}" for f in _PARTIAL)


# --- turns


def turn_key(role: str = "role", text: str = "text") -> Column:
    """The identity of a turn: a SHA-256 of role and text, null as the empty text."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in (role, text))
    return F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256))


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, key, words) of `conversations` (conv_id, turn, role, text): places from
    0 in order of `turn`, null first; equal numbers stand in order of the turn's key. Rows
    without a conv_id are left out. Texts are read once; only their keys travel."""
    rows = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("g"), "turn", turn_key().alias("key"), word_count().alias("words")
    )
    placed = ranked(stage(rows, "turns"), [F.col("turn").asc_nulls_first(), F.col("key")])
    return placed.select(F.col("g").alias("conv_id"), F.col("rank").alias("pos"), "key", "words")


def _looked_up(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """`rows` joined with the row of `table` (key, uses, ...) for their key; `uses` tells how
    many rows have it, so that those of a hot key need not meet in one task."""
    count, total = table.agg(F.count("*"), F.coalesce(F.sum("uses"), F.lit(0))).first()
    if count <= BROADCAST_ROWS:
        return rows.join(F.broadcast(table.drop("uses")), key)
    is_hot = F.col("uses") > total * HOT_SHARE
    hot, rest = F.broadcast(table.filter(is_hot).drop("uses")), table.filter(~is_hot).drop("uses")
    columns = [*rows.columns, *[c for c in rest.columns if c != key]]
    others = rows.join(hot.select(key), key, "left_anti").join(rest, key)
    return rows.join(hot, key).select(columns).unionByName(others.select(columns))


def _coded(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, turn, words, length, trunk) of `turns` (conv_id, place, key, words):
    the dictionary id of the turn, the turns of its conversation and how many of them are
    the trunk, which ends with the first turn that is its conversation's own."""
    keyed = stage(turns, "keyed")
    conv = F.col("conv_id")
    held = keyed.groupBy("key").agg(F.count("*").alias("uses"), (F.min(conv) == F.max(conv)).alias("single"))
    dictionary = stage(held.withColumn("turn", F.monotonically_increasing_id() + 1), "dictionary")
    coded = stage(_looked_up(keyed, dictionary, "key").drop("key"), "coded")
    placed = ranked(coded.withColumnRenamed("conv_id", "g"), [F.col("place")])
    placed = placed.withColumn("depth", F.col("rank") + 1).withColumnsRenamed({"g": "conv_id", "n": "length"})
    placed = stage(placed.select("conv_id", "depth", "turn", "words", "length", "single"), "placed")
    own = placed.groupBy("conv_id").agg(
        F.count("*").alias("uses"), F.min(F.when(F.col("single"), F.col("depth"))).alias("own")
    )
    whole = _looked_up(placed.drop("single"), stage(own, "own"), "conv_id")
    return stage(whole.withColumn("trunk", F.coalesce("own", "length")).drop("own"), "cut")


def _tails(cut: DataFrame) -> DataFrame:
    """The nodes behind the trunks; each has one member."""
    ends, one = F.col("depth") == F.col("length"), F.lit(1).cast("long")
    digest = F.when(ends, F.sha2(F.col("conv_id").cast("string").cast("binary"), 256)).otherwise(F.lit(_NO_ENDS))
    return cut.filter("depth > trunk").select(
        "conv_id", "depth", F.col("conv_id").alias("parent_conv_id"), one.alias("n_convs"),
        F.when(ends, 0).otherwise(1).cast("long").alias("n_children"), one.alias("n_leaves"),
        F.lit(0).cast("long").alias("saved_tokens"), digest.alias("ends_sha256"),
    )


# --- shards


class TernaryTree:
    """Sequences of ids; every node stands for a prefix and knows its parent prefix.

    Node 0 is the root, the empty sequence. `less` and `more` lead to siblings with smaller
    and larger ids, `down` to longer prefixes. Parents are made before their children.
    """

    def __init__(self) -> None:
        self.symbol, self.parent, self.depth, self.words = [0], [-1], [0], [0]
        self.less, self.down, self.more = [-1], [-1], [-1]

    def add(self, sequence: tuple[int, ...], words: list[int]) -> int:
        """The node of a sequence, made where it is missing."""
        symbol, less, down, more = self.symbol, self.less, self.down, self.more
        at = 0
        for depth, (wanted, size) in enumerate(zip(sequence, words, strict=True), 1):
            links, slot = down, at
            node = down[at]
            while node >= 0 and symbol[node] != wanted:
                links, slot = (less, node) if wanted < symbol[node] else (more, node)
                node = links[slot]
            if node < 0:
                node = links[slot] = len(symbol)
                for field, value in ((symbol, wanted), (self.parent, at), (self.depth, depth), (self.words, size),
                                     (less, -1), (down, -1), (more, -1)):
                    field.append(value)
            at = node
        return at


def medians_first(n: int) -> Iterator[int]:
    """0 to n - 1, the middle of every stretch before its halves."""
    stretches = [(0, n)]
    while stretches:
        low, high = stretches.pop()
        if low < high:
            middle = (low + high) // 2
            yield middle
            stretches += [(middle + 1, high), (low, middle)]


def _joined(ids: list[int]) -> Iterator[tuple[int, str]]:
    for at in range(0, len(ids), PIECE):
        yield at, ",".join(map(str, ids[at : at + PIECE]))


def _digest_of(pieces: Iterable[str]) -> str:
    digest = hashlib.sha256()
    for i, piece in enumerate(pieces):
        digest.update((("," if i else "") + piece).encode())
    return digest.hexdigest()


def _finish(node: int, above: int, count: list, words: list, children: list, leaves: list, saved: list) -> None:
    """A node whose subtree is complete: its own share, then all of it to the parent."""
    leaves[node] = leaves[node] or 1
    saved[node] += (count[node] - 1) * words[node]
    if above >= 0:
        children[above] += 1
        leaves[above] += leaves[node]
        saved[above] += saved[node]


def shard_nodes(conv_ids: list[int], turns: list[tuple], words: list[list[int]], goes_on: list[bool], stretch: int):
    """All nodes of one shard of trunks that are sorted by turns and conv_id, as columns of
    `_PARTIAL`, and the pieces (path, at, text) of ids that end at nodes of its outer paths."""
    starts = [i for i in range(len(turns)) if not i or turns[i] != turns[i - 1]]
    spans = list(zip(starts, [*starts[1:], len(turns)], strict=True))
    tree, own = TernaryTree(), {}
    for i in medians_first(len(spans)):
        own[tree.add(turns[spans[i][0]], words[spans[i][0]])] = spans[i]
    n, parent = len(tree.symbol), tree.parent

    side = [0] * n
    for mark, row in ((1, 0), (2, -1)):
        node = tree.add(turns[row], words[row])
        while node >= 0:
            side[node] |= mark
            node = parent[node]
    path: list[bytes | None] = [b"", *[None] * (n - 1)]
    for node in range(1, n):
        if side[node]:
            path[node] = hashlib.sha256(path[parent[node]] + tree.symbol[node].to_bytes(8, "little")).digest()

    count, least, children, leaves, saved = [0] * n, [None] * n, [0] * n, [0] * n, [0] * n
    ends, pieces = [_NO_ENDS] * n, []
    for node in reversed(range(n)):
        low, high = own.get(node, (0, 0))
        if low < high:
            count[node] += high - low
            least[node] = conv_ids[low] if least[node] is None else min(least[node], conv_ids[low])
            if goes_on[low]:  # the only member, its own last turn of the trunk
                children[node] += 1
                leaves[node] += 1
            elif side[node]:
                pieces += [(path[node], at, text) for at, text in _joined(conv_ids[low:high])]
            else:
                ends[node] = _digest_of(text for _, text in _joined(conv_ids[low:high]))
        above = parent[node]
        if not side[node]:
            _finish(node, above, count, tree.words, children, leaves, saved)
        if above >= 0:
            count[above] += count[node]
            least[above] = least[node] if least[above] is None else min(least[above], least[node])
    inner = [a >= 0 and not side[a] for a in parent]
    return {
        "conv_id": least, "depth": tree.depth, "n_convs": count, "n_children": children, "n_leaves": leaves,
        "saved_tokens": saved, "parent_conv_id": [least[a] if i else None for a, i in zip(parent, inner, strict=True)],
        "ends_sha256": ends, "path": path, "words": tree.words, "side": side, "stretch": [stretch] * n,
        "parent": [None if i or a < 0 else path[a] for a, i in zip(parent, inner, strict=True)],
    }, pieces


def merged_nodes(rows: list[dict], top: bool):
    """Partial nodes of neighbouring stretches as nodes of one, in columns of `_PARTIAL`. Those
    on its own first and last path stay partial, unless it is the top."""
    first, last = min(r["stretch"] for r in rows), max(r["stretch"] for r in rows)
    nodes: dict[bytes, dict] = {}
    for row in rows:
        outer = (row["side"] & 1 if row["stretch"] == first else 0) | (row["side"] & 2 if row["stretch"] == last else 0)
        node = nodes.get(row["path"])
        if node is None:
            nodes[row["path"]] = row | {"side": 0 if top else outer, "stretch": first // FAN_IN}
        else:
            node["conv_id"] = min(node["conv_id"], row["conv_id"])
            node["side"] |= 0 if top else outer
            for name in ("n_convs", "n_children", "n_leaves", "saved_tokens"):
                node[name] += row[name]
    whole = sorted(nodes.values(), key=lambda node: -node["depth"])
    place = {node["path"]: i for i, node in enumerate(whole)}
    columns = {name: [node[name] for node in whole] for name in _PARTIAL.names}
    for i, node in enumerate(whole):
        if not node["side"]:
            _finish(i, -1 if node["parent"] is None else place[node["parent"]],
                    *(columns[c] for c in ("n_convs", "words", "n_children", "n_leaves", "saved_tokens")))
    return columns


def _table(columns: dict) -> pa.Table:
    rows = len(next(iter(columns.values())))
    return pa.table([pa.array(columns.get(f.name, [None] * rows), f.type) for f in _PARTIAL], schema=_PARTIAL)


def _shards(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's range of trunks (conv_id, turns, words, goes_on)."""
    shard = [b for b in batches if b.num_rows]
    if shard:
        conv_ids, turns, words, goes_on = (c.to_pylist() for c in pa.Table.from_batches(shard).columns)
        stretch = TaskContext.get().partitionId()
        nodes, pieces = shard_nodes(conv_ids, [tuple(t) for t in turns], words, goes_on, stretch)
        yield from _table(nodes).to_batches(max_chunksize=20_000)
        if pieces:
            path, at, piece = map(list, zip(*pieces, strict=True))
            ends = {"path": path, "piece_at": at, "piece": piece, "stretch": [stretch] * len(path)}
            yield from _table(ends).to_batches(max_chunksize=2_000)


def _merge(top: bool):
    def merge(table: pa.Table) -> pa.Table:
        return _table(merged_nodes(table.to_pylist(), top))

    return merge


def _boundary_nodes(partial: DataFrame, stretches: int) -> DataFrame:
    """The nodes on outer paths of stretches, merged level by level until all are done."""
    done = None
    while True:
        top = stretches <= FAN_IN
        group = F.floor(F.col("stretch") / FAN_IN).alias("group")
        merged = stage(partial.groupBy(group).applyInArrow(_merge(top), _PARTIAL_SQL), "merged")
        finished = merged.filter("side = 0")
        done = finished if done is None else done.unionByName(finished)
        if top:
            return done
        partial, stretches = merged.filter("side <> 0"), -(-stretches // FAN_IN)


def _end_digests(pieces: DataFrame) -> DataFrame:
    """(path, digest) of partial nodes. A SHA-256 can not be put together from parts, so the
    pieces of a node pass one task in order; it holds one batch of them at a time."""

    def digests(batches):
        current, digest = None, None
        for batch in batches:
            found = []
            for path, piece in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if path == current:
                    digest.update(b"," + piece.encode())
                    continue
                if current is not None:
                    found.append((current, digest.hexdigest()))
                current, digest = path, hashlib.sha256(piece.encode())
            yield from _digest_batches(found)
        if current is not None:
            yield from _digest_batches([(current, digest.hexdigest())])

    ordered = pieces.repartition("path").sortWithinPartitions("path", "stretch", "piece_at")
    return ordered.select("path", "piece").mapInArrow(digests, "path binary, digest string")


def _digest_batches(found: list[tuple[bytes, str]]) -> Iterator[pa.RecordBatch]:
    if found:
        path, digest = zip(*found, strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(path, pa.binary()), pa.array(digest)], ["path", "digest"])


# --- the trie


def prefix_trie(turns: DataFrame, conversations: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row per node of the trie of `conversations` (conv_id), whose turns are `turns`
    (conv_id, place, key, words; places order the turns of a conversation).

    A node is a distinct sequence of first turns; the root is the empty one. Columns: conv_id
    (the smallest member), depth, parent_conv_id (null for the root), n_convs, n_children,
    n_leaves (childless nodes in its subtree, itself included), saved_tokens (over its
    subtree, words of the last turn times members but one) and ends_sha256 (digest of the
    ids, ascending and with commas, of members that end here). Conversations without turns
    are members of the root; without any conversation there is no node. Rows without a
    conv_id take no part; further columns are not read.
    """
    named = turns.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long"), "place", "key", F.col("words").cast("long")
    )
    cut = _coded(named)
    trunk = cut.filter("depth <= trunk")
    listed = F.sort_array(F.collect_list(F.struct("depth", "turn", "words")))
    grouped = trunk.groupBy("conv_id").agg(listed.alias("own"), F.max(F.col("length") > F.col("trunk")).alias("goes_on"))
    trunks = grouped.select("conv_id", F.col("own.turn").alias("turns"), F.col("own.words").alias("words"), "goes_on")
    empty = F.array().cast("array<long>")
    every = conversations.filter("conv_id IS NOT NULL").select(F.col("conv_id").cast("long")).distinct()
    silent = every.join(trunks, "conv_id", "left_anti").select(
        "conv_id", empty.alias("turns"), empty.alias("words"), F.lit(False).alias("goes_on")
    )
    trunks = stage(trunks.unionByName(silent), "trunks")
    size = trunks.agg(F.sum(F.size("turns") + 1)).first()[0]

    laid = trunks.repartitionByRange(-(-(size or 1) // shard_turns), "turns", "conv_id")
    nodes = stage(laid.sortWithinPartitions("turns", "conv_id").mapInArrow(_shards, _PARTIAL_SQL), "nodes")
    counted = nodes.filter("piece IS NULL")
    partial = counted.filter("side <> 0")
    stretches = (partial.agg(F.max("stretch")).first()[0] or 0) + 1
    digests = _end_digests(nodes.filter("piece IS NOT NULL"))
    boundary = _boundary_nodes(partial, stretches).join(digests, "path", "left")
    boundary = stage(boundary.withColumn("ends_sha256", F.coalesce("digest", F.lit(_NO_ENDS))).drop("digest"), "boundary")

    columns = [*_NODE_FIELDS, "ends_sha256"]
    inner = counted.filter("side = 0 AND parent IS NULL").select(columns)
    below = counted.filter("side = 0 AND parent IS NOT NULL").unionByName(boundary)
    above = boundary.select(F.col("path").alias("above"), F.col("conv_id").alias("above_id"))
    below = below.join(broadcast_if_small(above, BROADCAST_ROWS), F.col("parent") == F.col("above"), "left")
    below = below.withColumn("parent_conv_id", F.col("above_id")).select(columns)
    return inner.unionByName(below).unionByName(_tails(cut).select(columns))
