"""The conversation trie against a plain dictionary of prefixes."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tarn.llm import prefix_trie as trie
from tarn.llm.queries import QUERIES

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
TURNS = "conv_id long, turn long, role string, text string"


def expected(sequences):
    """Nodes of {conv_id: tuple of (role, text)}."""
    members = {}
    for conv, turns in sequences.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(conv)
    children, leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for prefix in sorted(members, key=len, reverse=True):
        leaves[prefix] = leaves[prefix] or 1
        if prefix:
            words = len(re.findall(r"[^\x20\x09-\x0D]+", prefix[-1][1]))
            saved[prefix] += (len(members[prefix]) - 1) * words
            children[prefix[:-1]] += 1
            leaves[prefix[:-1]] += leaves[prefix]
            saved[prefix[:-1]] += saved[prefix]
    rows = []
    for prefix, own in members.items():
        ends = ",".join(str(c) for c in sorted(own) if sequences[c] == prefix)
        rows.append((
            min(own), len(prefix), min(members[prefix[:-1]]) if prefix else None, len(own), children[prefix],
            leaves[prefix], saved[prefix], hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(rows, key=repr)


def rebuilt(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))

    def key(t):
        return t[:2], hashlib.sha256(f"{len(t[2].encode())}:{t[2]}{t[3]}".encode()).digest()

    own = {c: [t[2:] for t in sorted(ts, key=key)] for c, ts in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        lead = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        out[c] = tuple(own.get(lead, [])[:h] + turns[h:])
    return out


def collected(df):
    assert df.columns == COLUMNS
    return sorted(map(tuple, df.collect()), key=repr)


def trie_of(spark, sequences, **options):
    rows = [(c, d, r, t, "x") for c, turns in sequences.items() for d, (r, t) in enumerate(turns)]
    frame = spark.createDataFrame(rows, "conv_id long, place long, role string, text string, depth string")
    turns = frame.withColumns({"key": trie.turn_key(), "words": trie.word_count()})
    convs = spark.createDataFrame([(c,) for c in [*sequences, None]], "conv_id long")
    return trie.prefix_trie(turns, convs, **options)


@pytest.mark.parametrize(("shard_turns", "fan_in"), [(200_000, 64), (150, 2), (20, 3)])
def test_shards_and_merges_change_nothing(spark, monkeypatch, shard_turns, fan_in):
    """A third of all conversations alike, shared openings, prefixes of others, no turns."""
    monkeypatch.setattr(trie, "FAN_IN", fan_in)
    monkeypatch.setattr(trie, "PIECE", 7)
    rnd = random.Random(2)
    turns = [("user", f"turn {i} of\tmany \x0b words" * (i % 3)) for i in range(5)] + [("bot", "")]
    sequences = {i: tuple(rnd.choice(turns) for _ in range(rnd.randrange(7))) for i in range(0, 900, 3)}
    sequences |= {i: (turns[1], turns[2], turns[5]) for i in range(1, 450, 3)}
    sequences |= {-i: (turns[0], ("user", f"only {i}"), turns[0], ("bot", f"last {i}")) for i in range(1, 40)}
    sequences[2**60 + 1] = (turns[0],) * 300
    sequences[2**60 + 3] = (turns[0],) * 310
    assert collected(trie_of(spark, sequences, shard_turns=shard_turns)) == expected(sequences)


def test_hot_keys_meet_by_broadcast(spark, monkeypatch):
    """The way taken where dictionaries are too large to broadcast."""
    monkeypatch.setattr(trie, "BROADCAST_ROWS", 3)
    monkeypatch.setattr(trie, "HOT_SHARE", 0.1)
    sequences = {i: (("user", "hi"), ("bot", f"hello {i % 4}"), ("user", f"bye {i}")) for i in range(60)}
    sequences[60] = tuple(("user", f"long {i % 9}") for i in range(200))
    assert collected(trie_of(spark, sequences)) == expected(sequences)


def test_no_conversations_and_no_turns(spark):
    assert collected(trie_of(spark, {})) == []
    silent = {5: (), 3: (), 10: ()}
    assert collected(trie_of(spark, silent)) == expected(silent)


def test_medians_come_first():
    order = list(trie.medians_first(1_000))
    assert sorted(order) == list(range(1_000)) and order[0] == 500
    tree = trie.TernaryTree()
    for i in order:
        tree.add((i + 1,), [1])
    depth, at = 0, tree.down[0]
    while at >= 0:
        depth, at = depth + 1, tree.more[at]
    assert depth <= 10


def test_query_rebuilds_conversations(spark, tmp_path):
    """Nulls in every column, repeated turn numbers and rows, absent and short leads, negative ids."""
    rnd = random.Random(4)
    texts = ["Hello there", "", None, "a b\tc", "é  😀", "word " * 50_000]
    rows = []
    for conv in [*range(0, 130), *range(-30, 0), 1_007, 1_011, None]:
        for _ in range(rnd.randrange(1, 6)):
            rows.append((conv, rnd.choice([None, 0, 1, 2, 3]), rnd.choice(["user", "bot", None, ""]), rnd.choice(texts)))
    rows += [(40, 1, "user", "again")] * 3
    spark.createDataFrame(rows, TURNS).withColumn("depth", F.lit("x")).write.parquet(f"{tmp_path}/conversations.parquet")
    got = collected(QUERIES["op12_conversation_prefix_trie"](spark, str(tmp_path)))
    assert got == expected(rebuilt(rows))


def test_query_over_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], TURNS).write.parquet(f"{tmp_path}/conversations.parquet")
    assert collected(QUERIES["op12_conversation_prefix_trie"](spark, str(tmp_path))) == []
