"""The tree over running text against a dictionary of contexts."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from tarn.llm import common, language_model, queries, text_tree
from tarn.llm.common import checksum_rest, read_table

SF = "/root/testdata/sf0.001"
D = text_tree.DEPTH


def written(before, word):
    """Each byte of a word and its blank, with the bytes before it, the newest first."""
    line = bytes([9] * D) + before + b" " + word + b" "
    for at in range(len(line) - len(word) - 1, len(line)):
        yield line[at], line[at - D : at][::-1]


class BruteTree:
    def __init__(self, pairs):
        self.seen = defaultdict(lambda: [0, 0])
        self.children = defaultdict(set)
        for (before, word), times in pairs.items():
            for byte, context in written(before, word):
                for k in range(8):
                    for d in range(D + 1):
                        self.seen[context[:d], (byte | 256) >> (8 - k)][byte >> (7 - k) & 1] += times
                        if d:
                            self.children[context[: d - 1], (byte | 256) >> (8 - k)].add(context[:d])
        self.done = {}

    def weighted(self, context, node):
        """Logs of the own estimate, the product of longer contexts, and their mixture."""
        key = context, node
        if key not in self.done:
            zeros, ones = self.seen[key]
            alone = math.lgamma(zeros + 0.5) + math.lgamma(ones + 0.5) - math.log(math.pi) - math.lgamma(zeros + ones + 1)
            if len(context) == D:
                self.done[key] = alone, alone, alone
            else:
                longer = sum(self.weighted(c, node)[2] for c in self.children[key])
                self.done[key] = alone, longer, float(np.logaddexp(alone, longer)) - math.log(2)
        return self.done[key]

    def log10(self, before, word):
        total = 0.0
        for byte, context in written(before, word):
            for k in range(8):
                node, chance = (byte | 256) >> (8 - k), None
                for d in range(D, -1, -1):
                    if (context[:d], node) not in self.seen:
                        continue
                    zeros, ones = self.seen[context[:d], node]
                    kt, (alone, longer, _) = (ones + 0.5) / (zeros + ones + 1), self.weighted(context[:d], node)
                    own = 1 / (1 + math.exp(min(500, max(-500, longer - alone))))
                    chance = kt if chance is None else own * kt + (1 - own) * chance
                chance = 0.5 if chance is None else chance
                total += math.log10(chance if byte >> (7 - k) & 1 else 1 - chance)
        return total


def test_running_scores_equal_brute_force(spark, monkeypatch):
    """All training text is counted, as often as it occurs and across blanks, over several runs and parts."""
    monkeypatch.setattr(language_model, "SLOTS", 1 << 9)
    monkeypatch.setattr(language_model, "GROUP_WORDS", 150)
    monkeypatch.setattr(language_model, "GROUP_PAIRS", 100)
    docs = read_table(spark, SF, "documents").limit(25).select("doc_id", F.substring("text", 1, 400).alias("text"))
    odd = [(901, None), (902, ""), (903, "\x00 a\x00\x00b  é"), (904, "the the the"), (None, "the end"), (904, "the the the")]
    docs = docs.union(spark.createDataFrame(odd, docs.schema)).repartition(3).cache()
    got = language_model.score_documents(docs, checksum_rest("doc_id", 10) == 0, running=True).collect()
    texts = [(r.doc_id, re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]+", lambda m: m[0].lower(), (r.text or "").encode()))) for r in docs.collect()]
    learned = [words for i, words in texts if zlib.crc32(b"" if i is None else str(i).encode()) % 10]
    counts, pairs = Counter(w for words in learned for w in words), Counter()
    counts[b"\n"] = len(learned)
    for words in learned:
        pairs.update(zip([b"\n", *words], [*words, b"\n"], strict=True))
    tree = BruteTree(pairs)
    want = []
    for i, words in texts:
        steps = list(zip([b"\n", *words], [*words, b"\n"], strict=True))
        logs = [tree.log10(a, b) for a, b in steps]
        score = sum(math.log10((pairs[p] + (counts[p[0]] + 0.5) * 10**x) / (2 * counts[p[0]] + 0.5)) for p, x in zip(steps, logs, strict=True))
        want.append((-1 if i is None else i, score, sum(logs), -sum(logs) / math.log10(2) / sum(len(b) + 1 for _, b in steps)))
    found = sorted((-1 if r.doc_id is None else r.doc_id, r.score, r.tree_score, r.bits_per_byte) for r in got)
    assert np.allclose(found, sorted(want), rtol=1e-4, atol=1e-3)


def test_running_chances_sum_to_one():
    words = [b"banana", b"bandana", b"the", b"\n"]
    before, after = np.array([3, 0, 1, 2, 2]), np.array([0, 1, 2, 2, 3])
    keys, pair, place = text_tree.listed_bytes(words, before, after)
    times = np.bincount(place, weights=np.array([5, 1, 2, 3, 1])[pair], minlength=len(keys))
    contexts = np.unique(keys >> np.uint64(8))
    every = np.unique(np.concatenate([contexts << np.uint64(8) | np.uint64(b) for b in range(256)]))
    often = np.zeros(len(every))
    often[np.searchsorted(every, keys)] = times
    top = text_tree.Top([np.zeros(0, np.uint64)] * 3, [np.zeros(0)] * 3, [np.zeros(0)] * 3)
    chance = 10 ** text_tree.key_log10(every, often, top)
    assert np.allclose(np.add.reduceat(chance, np.arange(0, len(every), 256)), 1)


def test_counts_of_bytes_equal_brute_force():
    """Times above one byte, none at all, and pairs that share their bytes in context."""
    draw = random.Random(5)
    words = [*{bytes(draw.choices(b"abc\xc3\xff", k=draw.randint(1, 9))) for _ in range(900)}, b"\n"]
    before, after = (np.array([draw.randrange(len(words)) for _ in range(3_000)]) for _ in range(2))
    times = np.array([draw.choice([0, 1, 2, 255, 256, 510, 70_000]) for _ in before])
    keys, often = text_tree.counted_bytes(words, before, after, times)
    listed, pair, place = text_tree.listed_bytes(words, before, after)
    want = Counter()
    for b, a, n in zip(before, after, times, strict=True):
        for byte, context in written(words[b], words[a]):
            want[int.from_bytes(bytes([*context, byte]), "big")] += int(n)
    assert dict(zip(keys.tolist(), often.tolist(), strict=True)) == want
    assert listed.tolist() == sorted(want) and np.bincount(place, weights=times[pair]).tolist() == [want[k] for k in sorted(want)]
    none = text_tree.counted_bytes([b"\n"], *[np.zeros(0, np.int64)] * 3)
    assert [len(x) for x in none] == [0, 0]


def test_places_of_numbers_that_the_hash_does_not_keep_apart():
    keys = np.random.default_rng(1).integers(0, 1 << 40, 50_000).astype(np.uint64)
    for listed in (np.unique(keys), np.unique(keys) << np.uint64(24), np.arange(1 << 12, dtype=np.uint64) << np.uint64(52)):
        asked = np.concatenate((listed[::-1], listed))
        assert np.array_equal(listed[common.places_in(listed)(asked)], asked)
    for some in (np.array([5, 1, 5, 3]), np.zeros(0, np.int64), keys % np.uint64(9_000)):
        assert all(np.array_equal(*pair) for pair in zip(common.distinct(some), np.unique(some, return_inverse=True), strict=True))


def test_tree_alone_beats_the_base(spark):
    """The tree carries the score: alone it is above the counts of words, and the word before adds to it."""
    scores = queries.QUERIES["op9_context_tree_scores"](spark, "/root/testdata/sf0.01").filter("held_out")
    found = scores.agg(*(F.sum(c).alias(c) for c in ("score", "tree_score", "base_score"))).head()
    assert found.tree_score > 0.98 * found.base_score and found.score > 0.77 * found.base_score


def test_running_scores_without_training(spark):
    docs = read_table(spark, SF, "documents").limit(5)
    assert language_model.score_documents(docs.limit(0), F.lit(False), running=True).count() == 0
    found = language_model.score_documents(docs, F.lit(True), running=True).filter("abs(bits_per_byte - 8) < 1e-4 AND train_tokens = 0")
    assert found.count() == 5
