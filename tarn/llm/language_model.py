"""Language-model scores by context-tree weighting over bytes.

A word is written as its bytes and a blank, the end of a text as one byte of its own. Each
byte is eight binary decisions, and each decision is predicted in the contexts of the 0 to
`DEPTH` bytes before it in the word (a new word starts with an empty context). Every context
keeps a Krichevsky-Trofimov estimate; context-tree weighting mixes the estimates of all
depths by how well each has coded the distinct training words. Contexts are kept as they
are, and the tree grows with them: its branches under the same last `ROOT` bytes lie in one
part, where they are counted, weighed from the longest contexts up, and asked; only the
depths above, at most 258 contexts of 255 decisions and the root, are added up for all.

Two contexts beyond the bytes of a word grow with the corpus. A whole word that was seen c
times keeps c - `DISCOUNT` of its count, and what all words give up goes to the tree. Under
the word before, words seen after it weigh as much as that mixture (half and half, as at
every node of the tree). All parts add up to one, and so does their mixture.

Documents are read once and become runs: the distinct words and pairs of neighbours of a few
thousand texts, and which text has which pair how often. The words of all runs meet by a
checksum, the pairs by a 64-bit hash; there they get their counts over the corpus, each
distinct word its code length, and these go back to the runs, where the texts are scored.
Runs are of bounded size, and a frequent word or pair is one entry per run. No text is
shuffled.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarn.llm import text_tree
from tarn.llm.common import by_group, coded_words, distinct, inflated, mix64, shared, slabs
from tarn.llm.common import deflated as _deflated
from tarn.llm.common import log_gamma as _log_gamma
from tarn.llm.common import numbers as _numbers
from tarn.session import stage

DEPTH = 6
#: Bytes of words, each with its context, that meet in one part of the tree, about.
SLOTS = 1 << 20
#: Contexts with the same last bytes, so many, are in the same part of the tree.
ROOT = 2
END = b"\n"
#: Words that meet in one group, about.
GROUP_WORDS = 400_000
#: Pairs of neighbours that meet in one group, about.
GROUP_PAIRS = 1_000_000
#: What each distinct word gives up of its count for the words that the tree codes.
DISCOUNT = 0.75
_PAIR_BITS = 40
_ALPHA = 0.1
_RUN_ROWS, _RUN_BYTES = 2_000, 8 << 20
_BATCH_WORDS = 30_000
_BATCH_KEYS = 200_000


# --- runs of documents


def _runs(docs: DataFrame) -> DataFrame:
    """Runs of `docs` (id, text, train). Per run: the ids, `train` and number of words of
    its texts; its distinct words, joined by blanks, with their times in training texts; its
    distinct pairs, as numbers of words (one past the last is the start of a text, or its
    end), with their times in training texts; and the texts of each pair: how many, which,
    and how often each. All but the ids are deflated."""

    def invert(batches):
        run = TaskContext.get().partitionId() << 32
        for batch in slabs(batches, 1, rows=_RUN_ROWS, size=_RUN_BYTES):
            n, train = batch.num_rows, batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
            words, codes, starts = coded_words(batch.column(1), lower=True, ascii=True)
            edge, codes = len(words), codes.astype(np.int64)
            pair = np.insert(codes, starts[:-1], edge) * (edge + 1) + np.insert(codes, starts[1:], edge)
            pair, times = np.unique(pair * n + np.repeat(np.arange(n), np.diff(starts) + 1), return_counts=True)
            pair, text = pair // n, pair % n
            first = np.flatnonzero(np.diff(pair, prepend=-1))
            before, after = pair[first] // (edge + 1), pair[first] % (edge + 1)
            trained = np.add.reduceat(times * train[text], first)
            of_words = np.bincount(after, weights=trained, minlength=edge + 1)[:-1]
            pairs, uses = [before, after, trained], [np.diff(first, append=len(pair)), text, times]
            yield pa.RecordBatch.from_arrays(
                [pa.array([run]), pa.array([batch.column(0).to_pylist()], pa.list_(pa.int64())), pa.array([train]),
                 pa.array([np.diff(starts)]), pa.array([edge]), pa.array([len(first)]),
                 pa.array([_deflated(" ".join(words).encode())]), pa.array([_deflated(of_words)]),
                 pa.array([[_deflated(p) for p in pairs]]), pa.array([[_deflated(u) for u in uses]])],
                names=["run", "ids", "train", "sizes", "n", "n_pairs", "words", "trained", "pairs", "uses"],
            )
            run += 1

    return docs.mapInArrow(
        invert,
        "run long, ids array<long>, train array<boolean>, sizes array<long>, n long, n_pairs long, "
        "words binary, trained binary, pairs array<binary>, uses array<binary>",
    )


def _groups_of(words: list[bytes], groups: int) -> tuple[np.ndarray, np.ndarray]:
    """The words in the order of their checksum groups, and where each group begins."""
    return by_group(np.fromiter(map(zlib.crc32, words), np.int64, len(words)) % groups, groups)


def _pair_groups(words: list[bytes], before: np.ndarray, after: np.ndarray, groups: int):
    """The pairs in the order of their groups and hashes, where each group begins, and the
    hashes in that order."""
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    left, right = np.append(mix64(hashes), np.uint64(1)), np.append(hashes, np.uint64(2))
    both = mix64(left[before] ^ right[after])
    group = both % np.uint64(groups)
    key = (group << np.uint64(_PAIR_BITS)) | (both >> np.uint64(64 - _PAIR_BITS))
    order = np.argsort(key)  # pairs of one key are told the same
    key = key[order]
    starts = np.searchsorted(key, np.arange(groups + 1, dtype=np.uint64) << np.uint64(_PAIR_BITS))
    return order, starts, (key & np.uint64((1 << _PAIR_BITS) - 1)).astype(np.int64)


def _corpus_words(runs: DataFrame, groups: int) -> DataFrame:
    """(grp, words, trained, runs, codes) of every checksum group: its distinct words and how
    often each is in all training texts; and per run that has some of them, which ones."""

    def deal(batches):
        for batch in batches:
            for run, blob, trained in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                words, times = inflated(blob).split(), _numbers(trained)
                order, starts = _groups_of(words, groups)
                for group in np.flatnonzero(np.diff(starts)).tolist():
                    own = order[starts[group] : starts[group + 1]]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([group]), pa.array([run]), pa.array([_deflated(b" ".join([words[i] for i in own]))]),
                         pa.array([_deflated(times[own])])],
                        names=["grp", "run", "words", "trained"],
                    )

    def count(frame: pd.DataFrame) -> pd.DataFrame:
        numbers: dict[bytes, int] = {}
        lists = (inflated(blob).split() for blob in frame["words"])
        coded = [np.array([numbers.setdefault(w, len(numbers)) for w in words]) for words in lists]
        times = [_numbers(t) for t in frame["trained"]]
        total = np.bincount(np.concatenate(coded), weights=np.concatenate(times), minlength=len(numbers))
        return pd.DataFrame({
            "grp": frame["grp"].head(1), "words": [_deflated(b" ".join(numbers))], "trained": [_deflated(total)],
            "runs": [frame["run"].to_numpy()], "codes": [[_deflated(c) for c in coded]],
        })

    dealt = runs.select("run", "words", "trained").mapInArrow(deal, "grp long, run long, words binary, trained binary")
    schema = "grp long, words binary, trained binary, runs array<long>, codes array<binary>"
    return dealt.groupBy("grp").applyInPandas(count, schema)


_BACK = "run long, grp long, pairs boolean, trained binary, log10 binary"


def _word_answers(corpus: DataFrame, answers: DataFrame, parts: int) -> DataFrame:
    """For every run and group, of its words in their order there: how often they are in all
    training texts, and their log10 probability in the tree."""

    def answer(key, group: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        found = group.iloc[0]
        total = _numbers(found["trained"])
        logs = _log10_of(_listed(found["words"]), told, parts).astype("<f4")
        codes = [_numbers(c) for c in found["codes"]]
        return pd.DataFrame({
            "run": found["runs"], "grp": found["grp"], "pairs": False, "trained": [_deflated(total[c]) for c in codes],
            "log10": [_deflated(logs[c].tobytes()) for c in codes],
        })

    return corpus.groupBy("grp").cogroup(answers.groupBy("grp")).applyInPandas(answer, _BACK)


def _word_counts(corpus: DataFrame) -> DataFrame:
    """For every run and group, how often its words, in their order there, are in all
    training texts."""

    def back(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                grp, trained, runs, codes = (batch.column(k)[i].as_py() for k in range(4))
                total = _numbers(trained)
                for run, code in zip(runs, codes, strict=True):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([run]), pa.array([grp]), pa.array([False]), pa.array([_deflated(total[_numbers(code)])], pa.binary()),
                         pa.array([None], pa.binary())],
                        names=["run", "grp", "pairs", "trained", "log10"],
                    )

    return corpus.select("grp", "trained", "runs", "codes").mapInArrow(back, _BACK)


def _pair_answers(runs: DataFrame, groups: int) -> DataFrame:
    """For every run and group, how often its pairs, in their order there, are in all
    training texts. Only hashes of pairs travel, as sorted differences."""

    def deal(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                run, blob, (before, after, trained) = (batch.column(k)[i].as_py() for k in range(3))
                words, times = inflated(blob).split(), _numbers(trained)
                order, starts, hashes = _pair_groups(words, _numbers(before), _numbers(after), groups)
                for group in np.flatnonzero(np.diff(starts)).tolist():
                    own = slice(starts[group], starts[group + 1])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([group]), pa.array([run]), pa.array([_deflated(np.diff(hashes[own], prepend=0))]),
                         pa.array([_deflated(times[order[own]])])],
                        names=["grp", "run", "hashes", "trained"],
                    )

    def count(frame: pd.DataFrame) -> pd.DataFrame:
        hashes = [np.cumsum(_numbers(h)) for h in frame["hashes"]]
        ends = np.cumsum([0, *map(len, hashes)])
        _, code = distinct(np.concatenate(hashes))
        total = np.bincount(code, weights=np.concatenate([_numbers(t) for t in frame["trained"]]))
        back = [_deflated(total[code[a:b]]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
        return pd.DataFrame({"run": frame["run"], "grp": frame["grp"], "pairs": True, "trained": back, "log10": None})

    dealt = runs.select("run", "words", "pairs").mapInArrow(deal, "grp long, run long, hashes binary, trained binary")
    return dealt.groupBy("grp").applyInPandas(count, _BACK)


# --- the model


def _paths(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all bytes of the words, each followed by a blank: word number, byte, and the
    contexts (bytes, depths) with how many of the depths exist. A context is a whole number of
    nine bits a byte, the last byte lowest: 1 is the start of the word, 0 is nothing."""
    data = np.frombuffer(b" ".join(words) + b" ", np.uint8)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    word = np.repeat(np.arange(len(words)), sizes)
    place = np.arange(len(data)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    contexts = np.zeros((len(data), DEPTH + 1), np.uint64)
    for depth in range(1, DEPTH + 1):
        before = np.concatenate((np.zeros(depth, np.uint8), data[:-depth]))[: len(data)]
        symbol = np.where(place >= depth, before.astype(np.int64) + 2, np.where(place == depth - 1, 1, 0))
        contexts[:, depth] = contexts[:, depth - 1] | (symbol.astype(np.uint64) << np.uint64(9 * (depth - 1)))
    depths = np.minimum(place + 1, DEPTH)
    return word, data, contexts, depths


def _decisions(data: np.ndarray):
    for k in range(8):
        yield (data.astype(np.int64) | 256) >> (8 - k), (data >> (7 - k)) & 1


def _byte_keys(data: np.ndarray, contexts: np.ndarray) -> np.ndarray:
    """Longest context and byte in one number: all that is predicted depends on them alone."""
    return (contexts[:, DEPTH] << np.uint64(8)) | data.astype(np.uint64)


def _of_keys(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes, contexts and depths of such numbers."""
    longest = keys >> np.uint64(8)
    contexts = np.stack([longest & _mask(depth) for depth in range(DEPTH + 1)], axis=1)
    depths = sum((contexts[:, d] != contexts[:, d - 1]).astype(np.int64) for d in range(1, DEPTH + 1))
    return (keys & np.uint64(255)).astype(np.uint8), contexts, depths


def _mask(depth: int) -> np.uint64:
    return np.uint64((1 << (9 * depth)) - 1)


def _nodes(contexts: np.ndarray, depth: int, node: np.ndarray) -> np.ndarray:
    """A binary decision in a context; `node` is 1 and the bits of the byte so far."""
    return (contexts[:, depth] << np.uint64(8)) | node.astype(np.uint64)


def _word_keys(words: list[bytes], weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys of all bytes of the words, and the sum of weights of each."""
    keys, sums = [np.zeros(0, np.uint64)], [np.zeros(0)]
    for at in range(0, len(words), _BATCH_WORDS):
        word, data, contexts, _ = _paths(words[at : at + _BATCH_WORDS])
        own, inverse = np.unique(_byte_keys(data, contexts), return_inverse=True)
        keys.append(own)
        sums.append(np.bincount(inverse, weights=None if weights is None else weights[at + word], minlength=len(own)))
    keys, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    return keys, np.bincount(inverse, weights=np.concatenate(sums), minlength=len(keys))


def _sum_by(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    keys, inverse = np.unique(keys, return_inverse=True)
    return keys, *(np.bincount(inverse, weights=v, minlength=len(keys)).astype(float) for v in values)


@dataclass
class Model:
    """Per depth the decisions that training has seen, sorted; kt: their chance of a 1; own:
    their weight against the longer contexts that extend them. Depths that are not here have
    none."""

    nodes: list[np.ndarray]
    kt: list[np.ndarray]
    own: list[np.ndarray]

    def byte_log10(self, data: np.ndarray, contexts: np.ndarray, depths: np.ndarray) -> np.ndarray:
        logs = np.zeros(len(data))
        for node, bit in _decisions(data):
            chance, found = np.full(len(data), 0.5), np.zeros(len(data), bool)
            for depth in range(DEPTH, -1, -1):
                listed = self.nodes[depth]
                if not len(listed):
                    continue
                wanted = _nodes(contexts, depth, node)
                at = np.minimum(np.searchsorted(listed, wanted), len(listed) - 1)
                known = (listed[at] == wanted) & (depths >= depth)
                own = np.where(found, self.own[depth][at], 1.0)  # the longest context seen speaks for the longer ones
                chance = np.where(known, own * self.kt[depth][at] + (1 - own) * chance, chance)
                found |= known
            logs += np.log10(np.where(bit == 1, chance, 1 - chance))
        return logs

    def key_log10(self, keys: np.ndarray) -> np.ndarray:
        parts = (self.byte_log10(*_of_keys(keys[at : at + _BATCH_KEYS])) for at in range(0, len(keys), _BATCH_KEYS))
        return np.concatenate([np.zeros(0), *parts])

    def word_log10(self, words: list[bytes]) -> np.ndarray:
        """log10 probability of each word and the blank after it; -log2(10) times that, over
        the number of bytes, is the code length per byte."""
        keys, _ = _word_keys(words)
        return _sum_words(words, keys, self.key_log10(keys))


def _sum_words(words: list[bytes], keys: np.ndarray, logs: np.ndarray) -> np.ndarray:
    """Per word the sum of `logs` over its bytes; `keys` are sorted."""
    total = np.zeros(len(words))
    for at in range(0, len(words), _BATCH_WORDS):
        part = words[at : at + _BATCH_WORDS]
        word, data, contexts, _ = _paths(part)
        place = np.searchsorted(keys, _byte_keys(data, contexts))
        total[at : at + len(part)] = np.bincount(word, weights=logs[place], minlength=len(part))
    return total


def _count_nodes(keys: np.ndarray, times: np.ndarray, depths: range) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per depth the decisions seen, and how often they were 0 and 1."""
    keys, times = keys[times > 0], times[times > 0]
    data, contexts, reach = _of_keys(keys)
    counted = []
    for depth in depths:
        real = reach >= depth
        found = [(_nodes(contexts[real], depth, node[real]), bit[real]) for node, bit in _decisions(data)]
        bit = np.concatenate([b for _, b in found])
        weight = np.tile(times[real], 8)
        counted.append(_sum_by(np.concatenate([k for k, _ in found]), weight * (1 - bit), weight * bit))
    return counted


def _weigh(counted, below: dict[int, tuple[np.ndarray, np.ndarray]] | None = None, least: int = 0):
    """Weights from counts of the depths from `least` on, the longest contexts first, each
    estimate against the product of those of the contexts that extend it. `below` has such
    products, by decision, for the last depth. Returns the model, and the products by decision
    for the depth above `least`."""
    none = np.zeros(0, np.uint64), np.zeros(0)
    model = Model([none[0]] * (DEPTH + 1), [none[1]] * (DEPTH + 1), [none[1]] * (DEPTH + 1))
    parents, products = below or none
    for depth, (nodes, zeros, ones) in reversed(list(enumerate(counted, least))):
        alone, longer, parted = _log_kt(zeros, ones), np.zeros(len(nodes)), np.zeros(len(nodes), bool)
        at = np.searchsorted(nodes, parents)
        longer[at], parted[at] = products, True
        own = np.where(parted, 1 / (1 + np.exp(np.clip(longer - alone, -500, 500))), 1.0)
        model.nodes[depth], model.kt[depth], model.own[depth] = nodes, (ones + 0.5) / (zeros + ones + 1), own
        if depth:
            # log of half the own estimate and half the product of the longer contexts
            weighted = np.where(parted, np.logaddexp(alone, longer) - np.log(2), alone)
            context = (nodes >> np.uint64(8)) & _mask(depth - 1)
            parents, products = _sum_by((context << np.uint64(8)) | (nodes & np.uint64(255)), weighted)
    return model, (parents, products)


def _log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of a sequence with these counts."""
    return _log_gamma(ones + 0.5) + _log_gamma(zeros + 0.5) - np.log(np.pi) - _log_gamma(zeros + ones + 1)


def _listed(blob: bytes) -> list[bytes]:
    text = inflated(blob)
    return [END] if text == END else text.split()


def train(words: DataFrame) -> Model:
    """The whole tree in one place, for word lists that the driver can hold: rows of distinct
    words joined by blanks, and their counts, both deflated. All words with a count above 0
    are learned, each once. One more word, `END`, may be given as a row of its own."""
    every, times = [], []
    for r in words.select("words", "trained").collect():
        every += _listed(bytes(r.words))
        times.append(_numbers(bytes(r.trained)) > 0)
    keys, weights = _word_keys(every, np.concatenate([np.zeros(0), *times]))
    return _weigh(_count_nodes(keys, weights, range(DEPTH + 1)))[0]


# --- the tree over the whole corpus


def _part_starts(keys: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """The keys in the order of their parts, and where each part begins. All contexts with
    the same last `ROOT` bytes are in one part, so a part has whole branches of the tree."""
    part = mix64((keys >> np.uint64(8)) & _mask(ROOT)) % np.uint64(parts)
    order = np.argsort(part, kind="stable")
    return order, np.searchsorted(part[order], np.arange(parts + 1))


def _tree_parts(corpus: DataFrame, parts: int) -> DataFrame:
    """(part, keys, times, grps, codes): the distinct bytes in context of each part of the
    tree with their times in the distinct training words; and per checksum group that has some
    of them, which ones."""

    def deal(batches):
        for batch in batches:
            for grp, blob, trained in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                keys, times = _word_keys(_listed(blob), (_numbers(trained) > 0).astype(float))
                order, starts = _part_starts(keys, parts)
                for part in np.flatnonzero(np.diff(starts)).tolist():
                    own = order[starts[part] : starts[part + 1]]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([part]), pa.array([grp]), pa.array([_deflated(np.diff(keys[own].view(np.int64), prepend=0))]),
                         pa.array([_deflated(times[own])])],
                        names=["part", "grp", "keys", "times"],
                    )

    def gather(frame: pd.DataFrame) -> pd.DataFrame:
        listed = [np.cumsum(_numbers(k)) for k in frame["keys"]]
        ends = np.cumsum([0, *map(len, listed)])
        keys, code = np.unique(np.concatenate(listed), return_inverse=True)
        times = np.bincount(code, weights=np.concatenate([_numbers(t) for t in frame["times"]]))
        return pd.DataFrame({
            "part": frame["part"].head(1), "keys": [_deflated(np.diff(keys, prepend=0))], "times": [_deflated(times)],
            "grps": [frame["grp"].to_numpy()],
            "codes": [[_deflated(code[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]],
        })

    dealt = corpus.select("grp", "words", "trained").mapInArrow(deal, "part long, grp long, keys binary, times binary")
    schema = "part long, keys binary, times binary, grps array<long>, codes array<binary>"
    return dealt.groupBy("part").applyInPandas(gather, schema)


def _branches(keys: bytes, times: bytes):
    """The keys of a part, the branches they span, and the products for the depth above."""
    listed, times = np.cumsum(_numbers(keys)).view(np.uint64), _numbers(times).astype(float)
    return listed, times, *_weigh(_count_nodes(listed, times, range(ROOT, DEPTH + 1)), least=ROOT)


def _top(tree: DataFrame) -> Model:
    """The depths above `ROOT`, which do not grow with the corpus. Each part gives their
    counts and the products of its branches, and Spark adds them up."""

    def above(batches):
        for batch in batches:
            for keys, times in zip(*(batch.column(i).to_pylist() for i in range(2)), strict=True):
                listed, times, _, (parents, products) = _branches(keys, times)
                for depth, (nodes, zeros, ones) in enumerate(_count_nodes(listed, times, range(ROOT))):
                    product, split = np.zeros(len(nodes)), np.zeros(len(nodes), np.int32)
                    if depth == ROOT - 1:
                        at = np.searchsorted(nodes, parents)
                        product[at], split[at] = products, 1
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(nodes), depth)), pa.array(nodes.view(np.int64)), pa.array(zeros), pa.array(ones),
                         pa.array(product), pa.array(split)],
                        names=["depth", "node", "zeros", "ones", "product", "split"],
                    )

    found = tree.select("keys", "times").mapInArrow(
        above, "depth long, node long, zeros double, ones double, product double, split int"
    )
    sums = found.groupBy("depth", "node").agg(*(F.sum(c).alias(c) for c in ("zeros", "ones", "product")), F.max("split").alias("split"))
    rows = sums.orderBy("depth", "node").toArrow()
    depth, node, zeros, ones, product, split = (rows.column(i).to_numpy() for i in range(6))
    node = node.view(np.uint64)
    counted = [tuple(x[depth == d] for x in (node, zeros, ones)) for d in range(ROOT)]
    parted = (depth == ROOT - 1) & (split > 0)
    return _weigh(counted, (node[parted], product[parted]))[0]


def _key_answers(tree: DataFrame, get_top) -> DataFrame:
    """For every checksum group and part, the log10 chances of its bytes in their order there."""

    def answer(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                part, keys, times, grps, codes = (batch.column(k)[i].as_py() for k in range(5))
                listed, _, model, _ = _branches(keys, times)
                top = get_top()
                logs = Model(*([*t[:ROOT], *m[ROOT:]] for t, m in (
                    (top.nodes, model.nodes), (top.kt, model.kt), (top.own, model.own)
                ))).key_log10(listed).astype("<f4")
                for grp, coded in zip(grps, map(_numbers, codes), strict=True):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([grp]), pa.array([part]), pa.array([_deflated(logs[coded].tobytes())])],
                        names=["grp", "part", "logs"],
                    )

    return tree.mapInArrow(answer, "grp long, part long, logs binary")


def _log10_of(words: list[bytes], answers: pd.DataFrame, parts: int) -> np.ndarray:
    """log10 probability in the tree of the words of a checksum group."""
    keys, _ = _word_keys(words)
    order, starts = _part_starts(keys, parts)
    logs = np.zeros(len(keys))
    for part, blob in zip(answers["part"], answers["logs"], strict=True):
        logs[order[starts[part] : starts[part + 1]]] = np.frombuffer(inflated(blob), "<f4")
    return _sum_words(words, keys, logs)


# --- scores


def _word_mixture(trained: np.ndarray, logs: np.ndarray, n_train: int, n_words: int) -> np.ndarray:
    """log10 probability of words by their counts, mixed with `logs`, that of the tree."""
    if not n_train:
        return logs
    with np.errstate(divide="ignore"):
        counted = np.log10(np.maximum(trained - DISCOUNT, 0) / n_train)
    return _log10_sum(counted, logs + np.log10(DISCOUNT * n_words / n_train))


def _pair_log10(seen: np.ndarray, before: np.ndarray, logs: np.ndarray) -> np.ndarray:
    """log10 probability of words seen `seen` times after a word that training has `before`
    times, mixed with `logs`, their probability whatever the word before."""
    with np.errstate(divide="ignore"):
        return _log10_sum(np.log10(seen), logs + np.log10(before + 0.5)) - np.log10(2 * before + 0.5)


def _log10_sum(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return np.logaddexp(left * np.log(10), right * np.log(10)) / np.log(10)


def _tree_of_words(corpus: DataFrame, groups: int, ends: int, n_listed: int) -> tuple[DataFrame, float]:
    """The answers to the words of all runs, and the log10 probability of the end."""
    spark = corpus.sparkSession
    end_row = [(groups, bytearray(_deflated(END)), bytearray(_deflated([ends])))]
    every = corpus.select("grp", "words", "trained").union(spark.createDataFrame(end_row, "grp long, words binary, trained binary"))
    parts = max(1, -(-8 * n_listed // SLOTS))
    tree = stage(_tree_parts(every, parts), "tree")
    top = shared(spark, _top(tree))
    of_end = _key_answers(tree.filter(F.array_contains("grps", groups)), top).filter(F.col("grp") == groups)
    end_log = float(_log10_of([END], of_end.toPandas(), parts)[0])
    answers = _key_answers(tree, top).filter(F.col("grp") < groups)
    return _word_answers(corpus, answers, parts), end_log


def score_documents(
    docs: DataFrame, held_out: Column, id_column: str = "doc_id", text_column: str = "text", running: bool = False
) -> DataFrame:
    """id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row; if
    `running`, also the score of the tree alone and its bits per byte.

    Rows that are not held out train both models. Tokens are the lower-cased (A-Z) words
    between ASCII white space, and one end. `base_score` is the add-0.1 unigram score of the
    tokens, `score` the log10 probability of the same tokens under the model. A null text is
    empty: one end. Ids may be null or repeated; each row is scored by itself, and further
    columns are not read. Without training rows the tree gives each bit one half.

    The tree codes the distinct words, below their counts; or, if `running`, all training
    text as it runs (see `text_tree`), and only the word before is a context beside it.
    """
    spark = docs.sparkSession
    source = docs.select(
        F.col(f"`{id_column}`").cast("long").alias("id"),
        F.col(f"`{text_column}`").alias("text"),
        (~held_out).alias("train"),
    )
    runs = stage(_runs(source), "runs")
    sums = (F.coalesce(F.sum(c), F.lit(0)).alias(name) for c, name in (
        ("n", "words"), ("n_pairs", "pairs"), (F.size(F.filter("train", lambda t: t)), "ends")
    ))
    listed = runs.agg(*sums).head()
    groups, pair_groups = max(1, -(-listed.words // GROUP_WORDS)), max(1, -(-listed.pairs // GROUP_PAIRS))
    corpus = stage(_corpus_words(runs, groups), "corpus-words")

    def sizes(batches):
        for batch in batches:
            for trained in batch.column(0).to_pylist():
                times = _numbers(trained)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(times.sum())]), pa.array([int((times > 0).sum())])], names=["n", "v"]
                )

    total = corpus.select("trained").mapInArrow(sizes, "n long, v long")
    total = total.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("v"), F.lit(0)).alias("v")).head()
    ends = listed.ends
    n_train, n_words = total.n + ends, total.v + (ends > 0)
    scale = n_train + _ALPHA * (n_words + 1)

    if running:
        parts = max(1, -(-listed.pairs // SLOTS))
        tree = stage(text_tree.tree_parts(runs, parts), "tree")
        answers = text_tree.key_answers(tree, shared(spark, text_tree.top_of(tree)))
        told = answers.selectExpr("run", "part AS grp", "CAST(NULL AS boolean) AS pairs", "CAST(NULL AS binary) AS trained", "logs AS log10")
        told, end_log = _word_counts(corpus).union(told), 0.0
    else:
        told, end_log = _tree_of_words(corpus, groups, ends, listed.words)

    def score(key, run: pd.DataFrame, counted: pd.DataFrame) -> pd.DataFrame:
        found = run.iloc[0]
        words = inflated(found["words"]).split()
        before, after, _ = map(_numbers, found["pairs"])
        of_words, of_pairs = _groups_of(words, groups), _pair_groups(words, before, after, pair_groups)
        trained, logs, seen, in_tree = np.zeros(len(words)), np.zeros(len(words)), np.zeros(len(before)), []
        for group, pairs, times, log in zip(*(counted[c] for c in ("grp", "pairs", "trained", "log10")), strict=True):
            if times is None:
                in_tree.append((group, log))
                continue
            order, starts, *_ = of_pairs if pairs else of_words
            own = order[starts[group] : starts[group + 1]]
            (seen if pairs else trained)[own] = _numbers(times)
            if log is not None:
                logs[own] = np.frombuffer(inflated(log), "<f4")
        trained, logs = np.append(trained, ends), np.append(logs, end_log)
        base = np.log10((trained + _ALPHA) / scale)
        if running:
            listed_words = [*words, END]
            alone = text_tree.pair_log10(listed_words, before, after, in_tree, parts)
            length = np.fromiter(map(len, listed_words), np.int64, len(listed_words)) + 1
        else:
            alone = _word_mixture(trained, logs, n_train, n_words)[after]
        own = _pair_log10(seen, trained[before], alone)
        shown, text, times = map(_numbers, found["uses"])
        pair, n = np.repeat(np.arange(len(before)), shown), len(found["ids"])
        per_pair = [(trained > 0)[after], base[after], own, *([alone, length[after]] if running else [])]
        known, base, own, *of_tree = (np.bincount(text, weights=value[pair] * times, minlength=n) for value in per_pair)
        scored = pd.DataFrame({
            "id": pd.array([None if v is None or v != v else int(v) for v in found["ids"]], dtype="Int64"),
            "held_out": ~np.array(found["train"], bool),
            "n_tokens": np.array(found["sizes"]) + 1,
            "n_known": known.astype(np.int64),
            "train_tokens": n_train,
            "base_score": base,
            "score": own,
        })
        if running:
            scored["tree_score"], scored["bits_per_byte"] = of_tree[0], of_tree[0] / of_tree[1] * -np.log2(10)
        return scored

    schema = "id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    schema += ", tree_score double, bits_per_byte double" if running else ""
    ours = runs.select("run", "ids", "train", "sizes", "words", "pairs", "uses").groupBy("run")
    theirs = told.union(_pair_answers(runs, pair_groups)).groupBy("run")
    return ours.cogroup(theirs).applyInPandas(score, schema).withColumnRenamed("id", id_column)
