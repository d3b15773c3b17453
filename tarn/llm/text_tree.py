"""Context-tree weighting over running text, in parts.

All bytes of all training texts are counted, as often as they occur: a text is its words,
each with a blank, and an end. Each byte is eight binary decisions, and each decision has a
Krichevsky-Trofimov estimate in the contexts of the 0 to `DEPTH` bytes before it. Contexts
run on across the blank into the word before; what lies before that word reads as `MARK`,
which no word holds. Context-tree weighting mixes the estimates of all depths.

A byte in its context is one number, the newest byte of the context highest, so that sorted
numbers have the contexts of every depth together. The runs of `language_model` list theirs
once; the branches under the same newest `ROOT` bytes lie in one part, where they are
counted, weighed from the longest contexts up, and asked. The depths above are added up for
all.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarn.llm.common import by_group, deflated, distinct, inflated, log_gamma, mix64, numbers, places_in, sorted_once

DEPTH, ROOT = 6, 3
MARK = 9
#: Pairs of words that are written out at a time.
_PAIRS = 40_000
#: Keys that are weighed at a time, about.
_SLICE = 150_000
#: Logs travel as multiples of one over this.
_STEPS = 1 << 16
_TABLE = 4_096


# --- bytes in context


def _written(words: list[bytes], before: np.ndarray, after: np.ndarray):
    """For some pairs of words at a time: the first of them, and of each byte of the second
    words, with a blank, the pair and the number of the byte in its context."""
    data = np.frombuffer(b" ".join(words) + b" ", np.uint8).astype(np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    starts = np.cumsum(sizes) - sizes
    place = np.arange(len(data)) - np.repeat(starts, sizes)
    # what a word gives itself to its bytes, and what it gives to the first byte of the next one
    inner, left = data.copy(), np.zeros(len(words), np.uint64)
    for depth in range(1, DEPTH + 1):
        shift = np.uint64(8 * (DEPTH + 1 - depth))
        inner[depth:] |= np.where(place[depth:] >= depth, data[:-depth], 0).astype(np.uint64) << shift
        left |= np.where(sizes >= depth, data[starts + sizes - np.minimum(sizes, depth)], MARK).astype(np.uint64) << shift
    gone, high = 8 * np.minimum(place, DEPTH).astype(np.uint64), ~np.uint64(255)
    for at in range(0, len(after), _PAIRS):
        right = after[at : at + _PAIRS]
        length = sizes[right]
        pair = np.repeat(np.arange(len(right)), length)
        here = np.arange(len(pair)) + (starts[right] - np.cumsum(length) + length)[pair]
        yield at, pair, inner[here] | (left[before[at : at + _PAIRS]][pair] >> gone[here] & high)


def listed_bytes(words: list[bytes], before: np.ndarray, after: np.ndarray):
    """The distinct bytes in context of some pairs of words, sorted; and of each byte that
    the pairs have, the pair and its place among the distinct ones."""
    keys, pairs = [np.zeros(0, np.uint64)], [np.zeros(0, np.int32)]
    for at, pair, written in _written(words, before, after):
        keys.append(written)
        pairs.append((at + pair).astype(np.int32))
    every = np.concatenate(keys)
    every.sort()
    listed = sorted_once(every)
    del every
    find = places_in(listed)
    return listed, np.concatenate(pairs), np.concatenate([find(k) for k in keys])


def counted_bytes(words: list[bytes], before: np.ndarray, after: np.ndarray, times: np.ndarray):
    """The distinct bytes in context of some pairs of words, sorted, and how often each is in
    texts that have the pairs so many times. A byte is sorted with up to 255 of its times."""
    often = np.flatnonzero(times > 255)
    more = np.repeat(often, times[often] // 255)
    before, after = np.concatenate((before, before[more])), np.concatenate((after, after[more]))
    times = np.concatenate((np.where(times > 255, times % 255, times), np.full(len(more), 255))).astype(np.uint64)
    parts = [np.zeros(0, np.uint64)]
    for at, pair, written in _written(words, before, after):
        parts.append((written << np.uint64(8)) | times[at + pair])
    every = np.concatenate(parts)
    every.sort()
    keys = every >> np.uint64(8)
    starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))[: len(keys)])
    return keys[starts], np.add.reduceat((every & np.uint64(255)).astype(np.int64), starts) if len(keys) else np.zeros(0, np.int64)


def part_starts(keys: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted keys in the order of their parts, and where each part begins."""
    return by_group(mix64(keys >> np.uint64(8 * (DEPTH - ROOT + 1))) % np.uint64(parts), parts)


# --- estimates and weights


_HALF, _WHOLE = log_gamma(np.arange(_TABLE) + 0.5), log_gamma(np.arange(_TABLE) + 1.0)


def _log_gamma_from(table: np.ndarray, counts: np.ndarray, more: float) -> np.ndarray:
    found = table[np.minimum(counts, _TABLE - 1).astype(np.int64)]
    large = counts >= _TABLE
    found[large] = log_gamma(counts[large] + more)
    return found


def _log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of a sequence with these counts."""
    both = _log_gamma_from(_HALF, zeros, 0.5) + _log_gamma_from(_HALF, ones, 0.5)
    return both - np.log(np.pi) - _log_gamma_from(_WHOLE, zeros + ones, 1.0)


def _own_weight(alone: np.ndarray, longer: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(np.clip(longer - alone, -500, 500)))


def _levels(keys: np.ndarray, times: np.ndarray, stop: int):
    """From the longest contexts up to those of `stop` bytes: depth, the contexts with their
    bytes as sorted numbers, how often each was seen, and the place there of each one of the
    depth below."""
    listed, seen, place = keys, times, None
    for depth in range(DEPTH, stop - 1, -1):
        if depth < DEPTH:
            shorter = (listed >> np.uint64(16) << np.uint64(8)) | (listed & np.uint64(255))
            listed, place = distinct(shorter)
            seen = np.bincount(place, weights=seen, minlength=len(listed))
        yield depth, listed, seen, place


def _decision(listed: np.ndarray, seen: np.ndarray, bit: int):
    """Of the decision on one bit of the bytes: its number for each byte in context, where
    each begins, and how often it was 0 and 1."""
    prefix = listed >> np.uint64(8 - bit)
    starts = np.flatnonzero(np.concatenate(([True], prefix[1:] != prefix[:-1])))
    number = np.repeat(np.arange(len(starts)), np.diff(starts, append=len(listed)))
    is_one = (listed >> np.uint64(7 - bit) & np.uint64(1)).astype(float)
    ones = np.add.reduceat(seen * is_one, starts)
    return number, starts, np.add.reduceat(seen, starts) - ones, ones


def _weighed(keys: np.ndarray, times: np.ndarray, stop: int):
    """The longest contexts first, per depth and bit: the bytes in context, where each one of
    the depth below is among them, the number of the decision of each, where each decision
    begins, its counts, the log of its own estimate, and of the product of those of the
    contexts that extend it."""
    below: list = [None] * 8
    for depth, listed, seen, place in _levels(keys, times, stop):
        for bit in range(8):
            number, starts, zeros, ones = _decision(listed, seen, bit)
            alone = weighted = _log_kt(zeros, ones)
            longer = np.zeros(len(starts))
            if below[bit] is not None:
                first, products = below[bit]
                longer = np.bincount(number[place[first]], weights=products, minlength=len(starts))
                # log of half the own estimate and half the product of the longer contexts
                weighted = np.where(zeros + ones > 0, np.logaddexp(alone, longer) - np.log(2), 0)
            below[bit] = starts, weighted
            yield depth, bit, listed, place, number, starts, zeros, ones, alone, longer


def _mixed(chance: np.ndarray, known: np.ndarray, kt: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Chances of a 1 with one more, shorter, context: nan as long as none was seen, and the
    longest that was speaks for the longer ones."""
    return np.where(known, np.where(np.isnan(chance), kt, own * kt + (1 - own) * chance), chance)


def _nodes(listed: np.ndarray, bit: int) -> np.ndarray:
    """The number of a decision: its context, then 1 and the bits of the byte so far."""
    node = (listed & np.uint64(255) | np.uint64(256)) >> np.uint64(8 - bit)
    return (listed >> np.uint64(8) << np.uint64(8)) | node


@dataclass
class Top:
    """Per depth above `ROOT` the decisions that training has seen, sorted; kt: their chance
    of a 1; own: their weight against the longer contexts."""

    nodes: list[np.ndarray]
    kt: list[np.ndarray]
    own: list[np.ndarray]


def _slices(keys: np.ndarray):
    """Runs of whole branches of some `_SLICE` sorted keys, or one larger branch."""
    branch = keys >> np.uint64(8 * (DEPTH - ROOT + 1))
    at = 0
    while at < len(keys):
        end = np.searchsorted(branch, branch[min(at + _SLICE, len(keys)) - 1], "right")
        yield slice(at, end)
        at = end


def key_log10(keys: np.ndarray, times: np.ndarray, top: Top) -> np.ndarray:
    """log10 chance of the sorted keys of a part, seen so many times in training."""
    return np.concatenate([np.zeros(0), *(_log10_of(keys[own], times[own], top) for own in _slices(keys))])


def _log10_of(keys: np.ndarray, times: np.ndarray, top: Top) -> np.ndarray:
    chances, place = np.full((8, len(keys)), np.nan), np.arange(len(keys))
    for depth, bit, _, shorter, number, _, zeros, ones, alone, longer in _weighed(keys, times, ROOT):
        if depth < DEPTH and not bit:
            place = shorter[place]
        here, seen = number[place], zeros + ones
        kt, own = (ones + 0.5) / (seen + 1), _own_weight(alone, longer)
        chances[bit] = _mixed(chances[bit], (seen > 0)[here], kt[here], own[here])
    for depth in range(ROOT - 1, -1, -1):
        context = keys >> np.uint64(8 * (DEPTH - depth + 1))
        listed, place = distinct((context << np.uint64(8)) | (keys & np.uint64(255)))
        stored = top.nodes[depth]
        if not len(stored):
            continue
        for bit in range(8):
            wanted = _nodes(listed, bit)
            at = np.minimum(np.searchsorted(stored, wanted), len(stored) - 1)
            known, kt, own = (stored[at] == wanted)[place], top.kt[depth][at][place], top.own[depth][at][place]
            chances[bit] = _mixed(chances[bit], known, kt, own)
    logs = np.zeros(len(keys))
    for bit in range(8):
        chance = np.where(np.isnan(chances[bit]), 0.5, chances[bit])
        logs += np.log10(np.where(keys >> np.uint64(7 - bit) & np.uint64(1), chance, 1 - chance))
    return logs


# --- over all runs


def tree_parts(runs: DataFrame, parts: int) -> DataFrame:
    """(part, keys, times, runs, codes): the distinct bytes in context of each part of the
    tree, how often each is in all training texts, and per run that has some of them, which
    ones. `runs` has run, words, and pairs (the words before and after, and the times in
    training texts)."""

    def deal(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                run, blob, pairs = (batch.column(k)[i].as_py() for k in range(3))
                before, after, trained = map(numbers, pairs)
                keys, times = counted_bytes(run_words(blob), before, after, trained)
                order, starts = part_starts(keys, parts)
                for part in np.flatnonzero(np.diff(starts)).tolist():
                    own = order[starts[part] : starts[part + 1]]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([part]), pa.array([run]), pa.array([deflated(np.diff(keys[own].view(np.int64), prepend=0))]),
                         pa.array([deflated(times[own])])],
                        names=["part", "run", "keys", "times"],
                    )

    def gather(frame: pd.DataFrame) -> pd.DataFrame:
        listed = [np.cumsum(numbers(k)) for k in frame["keys"]]
        ends = np.cumsum([0, *map(len, listed)])
        keys, code = distinct(np.concatenate(listed))
        times = np.bincount(code, weights=np.concatenate([numbers(t) for t in frame["times"]]))
        return pd.DataFrame({
            "part": frame["part"].head(1), "keys": [deflated(np.diff(keys, prepend=0))], "times": [deflated(times)],
            "runs": [frame["run"].to_numpy()],
            "codes": [[deflated(np.diff(code[a:b], prepend=0)) for a, b in zip(ends[:-1], ends[1:], strict=True)]],
        })

    dealt = runs.select("run", "words", "pairs").mapInArrow(deal, "part long, run long, keys binary, times binary")
    schema = "part long, keys binary, times binary, runs array<long>, codes array<binary>"
    return dealt.groupBy("part").applyInPandas(gather, schema)


def run_words(blob: bytes) -> list[bytes]:
    """The words of a run and, past the last, the start or end of a text."""
    return [*inflated(blob).split(), b"\n"]


def _keys_of(keys: bytes, times: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.cumsum(numbers(keys)).view(np.uint64), numbers(times).astype(float)


def top_of(tree: DataFrame) -> Top:
    """The depths above `ROOT`. Each part gives their counts and the products of its branches,
    and Spark adds them up."""

    def above(batches):
        for batch in batches:
            for blob, often in zip(*(batch.column(i).to_pylist() for i in range(2)), strict=True):
                keys, times = _keys_of(blob, often)
                keys, times = keys[times > 0], times[times > 0]
                levels = (level for own in _slices(keys) for level in _weighed(keys[own], times[own], 0))
                for depth, bit, listed, _, _, starts, zeros, ones, _, longer in levels:
                    if depth >= ROOT:
                        continue
                    node = _nodes(listed[starts], bit)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(node), depth)), pa.array(node.view(np.int64)), pa.array(zeros), pa.array(ones),
                         pa.array(longer if depth == ROOT - 1 else np.zeros(len(node)))],
                        names=["depth", "node", "zeros", "ones", "product"],
                    )

    found = tree.select("keys", "times").mapInArrow(above, "depth long, node long, zeros double, ones double, product double")
    sums = found.groupBy("depth", "node").agg(*(F.sum(c).alias(c) for c in ("zeros", "ones", "product")))
    rows = sums.orderBy("depth", "node").toArrow()
    depths, node, zeros, ones, product = (rows.column(i).to_numpy() for i in range(5))
    node, top = node.view(np.uint64), Top([], [], [])
    parents, products = None, None
    for depth in range(ROOT - 1, -1, -1):
        here = depths == depth
        nodes, zero, one, longer = node[here], zeros[here], ones[here], product[here]
        if parents is not None:
            longer = np.bincount(np.searchsorted(nodes, parents), weights=products, minlength=len(nodes))
        alone = _log_kt(zero, one)
        top.nodes.insert(0, nodes)
        top.kt.insert(0, (one + 0.5) / (zero + one + 1))
        top.own.insert(0, _own_weight(alone, longer))
        parents = (nodes >> np.uint64(16) << np.uint64(8)) | (nodes & np.uint64(255))
        products = np.logaddexp(alone, longer) - np.log(2)
    return top


def key_answers(tree: DataFrame, get_top) -> DataFrame:
    """For every run and part, the log10 chances of its bytes in their order there, as whole
    numbers of steps."""

    def answer(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                part, blob, often, runs, codes = (batch.column(k)[i].as_py() for k in range(5))
                logs = np.rint(-_STEPS * key_log10(*_keys_of(blob, often), get_top()))
                for run, code in zip(runs, codes, strict=True):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([run]), pa.array([part]), pa.array([deflated(logs[np.cumsum(numbers(code))])])],
                        names=["run", "part", "logs"],
                    )

    return tree.mapInArrow(answer, "run long, part long, logs binary")


def pair_log10(words: list[bytes], before: np.ndarray, after: np.ndarray, answers, parts: int) -> np.ndarray:
    """log10 probability in the tree of the second word of each pair of a run; `answers` has
    the logs of each part."""
    keys, pair, place = listed_bytes(words, before, after)
    order, starts = part_starts(keys, parts)
    logs = np.zeros(len(keys))
    for part, blob in answers:
        logs[order[starts[part] : starts[part + 1]]] = numbers(blob) / -_STEPS
    return np.bincount(pair, weights=logs[place], minlength=len(before))
