"""Sampled segmentations of texts into SentencePiece pieces, and their decoding.

The pieces of a vocabulary span a lattice over a text; a segmentation is a path, and its
probability is the product of its piece weights over the sum of all paths. Distinct paths
are drawn without replacement by the Gumbel top-k method: the tree of partial paths is
searched best first, each node holding the largest perturbed log probability among its
completions. That value is drawn at the root, and handed down so that one child inherits it
and the others draw theirs under it. The first k complete paths are the sample; the value
of the next one gives each path the chance that a sample includes it.

Which child inherits does not depend on the value: it is a draw by the children's shares. So
the way down from a node is drawn for all parts of all texts of a batch at once, as the parts
are independent. The children left aside hold the rest of the node's weight: their largest
value is drawn for all of them together, and handed down to parts of the path only as long
as it can still be among the best.

Blanks are shown as U+2581. As no piece of the vocabulary goes on across a blank after a
letter, the lattice is cut before such blanks, and each distinct part is built only once.
"""

from __future__ import annotations

import math
import random
import re
import zlib
from bisect import bisect_right, insort
from collections.abc import Callable
from dataclasses import dataclass
from itertools import accumulate, chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarn.llm.common import mix64, shared, slabs

BLANK = "▁"
SAMPLES = 4
#: Arcs, some 25 bytes each, that a sampler keeps between batches.
_CACHE_ARCS = 3_000_000
#: Steps of a path at which children aside are looked for before all of them are weighed.
_NEAR = 32
_PART = re.compile(" +[^ ]*")
_NO_LETTER = 0x110000
#: Between the draws at neighbouring places of a text: the step of splitmix64.
_STEP = 0x9E3779B97F4A7C15


@dataclass
class Vocabulary:
    """pieces: ids and log weights by text; bytes: the ids of the 256 byte pieces; byte_cost:
    log weight of one byte piece; texts: piece by id."""

    pieces: dict[str, tuple[int, float]]
    bytes: list[int]
    byte_cost: float
    texts: list[str]
    longest: int

    def __post_init__(self):
        byte_of = {i: bytes([b]) for b, i in enumerate(self.bytes)}
        self.shown = [byte_of.get(i, t.replace(BLANK, " ").encode()) for i, t in enumerate(self.texts)]
        # a trie: edges are sorted by node and letter, node 0 is the root
        nodes, edges = {"": 0}, {}
        for piece in self.pieces:
            node = 0
            for end in range(1, len(piece) + 1):
                below = nodes.setdefault(piece[:end], len(nodes))
                edges[node << 21 | ord(piece[end - 1])] = node = below
        self.edges = np.array(sorted(edges), np.int64)
        self.targets = np.array([edges[e] for e in sorted(edges)], np.int64)
        # one edge by hash; of places where several meet, all but one are looked up in a list
        self.shift = np.uint64(62 - max(len(edges), 1).bit_length())
        slots, number = self._slots(self.edges), np.arange(len(edges), dtype=np.int32)
        self.edge_at = np.zeros(1 << 64 - int(self.shift), np.int32)
        self.edge_at[slots] = number
        self.meeting = np.zeros(len(self.edge_at), bool)
        self.others = np.flatnonzero(self.edge_at[slots] != number)
        self.meeting[slots[self.others]] = True
        self.piece_at, self.weight_of = np.full(len(nodes), -1, np.int32), np.zeros(len(self.texts))
        for piece, (number, weight) in self.pieces.items():
            self.piece_at[nodes[piece]], self.weight_of[number] = number, weight

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(_STEP)) >> self.shift).view(np.int64)

    def edges_of(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of some edges the trie has, and their numbers."""
        slots = self._slots(keys)
        edges = self.edge_at.take(slots)
        on = self.edges.take(edges) == keys
        if len(self.others):
            rest = np.flatnonzero(self.meeting.take(slots) & ~on)
            others, asked = self.edges[self.others], keys.take(rest)
            at = np.minimum(np.searchsorted(others, asked), len(others) - 1)
            found = np.flatnonzero(others.take(at) == asked)
            rest = rest.take(found)
            edges[rest], on[rest] = self.others.take(at.take(found)), True
        return on, edges.take(np.flatnonzero(on))

    @classmethod
    def load(cls, model_path: str, sharpness: float = 1.0) -> Vocabulary:
        """The pieces of a SentencePiece file. Weights follow Zipf's law over the order of
        the file, most frequent first: log weight -sharpness * log(rank + 1)."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        texts = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        plain = [i for i in range(len(texts)) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
        pieces = {texts[i]: (i, -sharpness * math.log(rank + 2)) for rank, i in enumerate(plain)}
        crossing = [p for p in pieces if BLANK in p.lstrip(BLANK)]
        if crossing:
            raise ValueError(f"pieces across a blank: {crossing[:3]}")
        cost = -sharpness * math.log(len(plain) + 2)
        byte_ids = [i for i in range(len(texts)) if model.is_byte(i)]
        return cls(pieces, byte_ids, cost, texts, max(map(len, pieces)))


@dataclass
class _Text:
    """One text under search. starts (begins), bases: where its parts begin in the text and in
    the store; waiting: nodes (-value, number, log probability, path, how many of its arcs,
    position, arc); paths: what was drawn, as (value, log probability, arcs)."""

    starts: np.ndarray
    begins: list[int]
    bases: np.ndarray
    length: int
    chance: random.Random
    seed: int
    waiting: list[tuple]
    paths: list[tuple]
    born: int = 1


class Sampler:
    """Draws segmentations; keeps the lattices of the parts it has seen.

    The store is flat: positions of all parts one after the other, arcs grouped by position,
    the widest first. An arc has a width in characters (below 0 if the part ends there), the
    log of its share of the paths from there, the summed shares up to it, and a piece; a
    character that is spelled in bytes has -1 - its code point instead. Arrays are longer than
    what they hold, so that most of the time new parts need no copy of them.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.byte_ids = np.array(vocabulary.bytes, np.int32)
        self.shown = pa.array(vocabulary.shown, pa.binary())
        from_root = vocabulary.edges <= _NO_LETTER
        self.below_root = np.zeros(_NO_LETTER + 1, np.int32)
        self.below_root[vocabulary.edges[from_root]] = vocabulary.targets[from_root]
        size = _CACHE_ARCS + _CACHE_ARCS // 4
        self.first = np.zeros(size // 2, np.int32)
        self.width, self.piece = np.empty(size, np.int16), np.empty(size, np.int32)
        self.share, self.upto = np.empty(size), np.empty(size)
        self._clear()

    def _clear(self) -> None:
        self.known: dict[str, int] = {}
        self.n_spots = self.n_arcs = 0

    def _keep(self, name: str, at: int, values: np.ndarray) -> None:
        kept, end = getattr(self, name), at + len(values)
        if end > len(kept):
            longer = np.empty(max(end, 3 * len(kept) // 2), kept.dtype)
            longer[:at] = kept[:at]
            kept = longer
            setattr(self, name, kept)
        kept[at:end] = values

    def _learn(self, words: list[str]) -> np.ndarray:
        """Adds the lattices of new parts, a blank and a word, to the store, all of them at once,
        and returns where they begin."""
        lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
        stops = np.cumsum(lengths)
        size, bases = int(stops[-1]), self.n_spots + stops - lengths
        self.known.update(zip(words, bases.tolist(), strict=True))
        n_arcs, width, piece, weight = self._arcs(" " + " ".join(words), stops)
        first = np.concatenate(([0], np.cumsum(n_arcs)))
        to = np.repeat(np.arange(size), n_arcs) + width
        stop = np.zeros(size + 1, bool)
        stop[stops] = True
        ends = np.flatnonzero(stop.take(to))
        to[ends] = size  # all ends are one place, of weight 0
        width[ends] *= -1

        # log weights of all paths from a position, from the ends of the parts to their starts
        left = np.repeat(stops, lengths) - np.arange(size)
        turns = np.cumsum(np.bincount(left))
        if lengths.max() < 1 << 16:
            left = left.astype(np.uint16)  # sorted by its digits
        spots = np.argsort(left, kind="stable")
        counts = n_arcs.take(spots)
        begins = np.concatenate(([0], np.cumsum(counts)))
        group = np.repeat(np.arange(size), counts)
        order = (first.take(spots) - begins[:-1]).take(group) + np.arange(len(to))
        to, weight = to.take(order), weight.take(order)
        after, share, part = np.zeros(size + 1), np.empty(len(to)), np.empty(len(to))
        bounds = begins[turns].tolist()
        for i, (lo, hi) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
            own = slice(int(turns[i]), int(turns[i + 1]))
            firsts, mine = begins[own] - lo, group[lo:hi] - turns[i]
            score = weight[lo:hi] + after.take(to[lo:hi])
            top = np.maximum.reduceat(score, firsts)
            chance = np.exp(score - top.take(mine))
            sums = np.add.reduceat(chance, firsts)
            total = top + np.log(sums)
            after[spots[own]] = total
            share[lo:hi] = score - total.take(mine)
            part[lo:hi] = chance / sums.take(mine)
        in_place = np.empty(len(to)), np.empty(len(to))
        in_place[0][order], in_place[1][order] = share, part
        share, upto = in_place

        many, i = np.flatnonzero(n_arcs > 1), 1
        while len(many):
            arcs = first.take(many) + i
            upto[arcs] = upto.take(arcs) + upto.take(arcs - 1)
            i += 1
            many = many.take(np.flatnonzero(n_arcs.take(many) > i))
        upto[first[1:] - 1] = 1.0
        self._keep("first", self.n_spots + 1, first[1:] + self.n_arcs)
        for name, values in (("width", width), ("piece", piece), ("share", share), ("upto", upto)):
            self._keep(name, self.n_arcs, values)
        self.n_spots, self.n_arcs = self.n_spots + size, self.n_arcs + len(to)
        return bases

    def _arcs(self, text: str, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """How many arcs each position has, and their widths, pieces and log weights, by position,
        the widest first. All positions go down the trie of pieces together. A character that is
        no piece of its own is spelled in bytes, and so is a U+2581 of the text itself."""
        v = self.vocabulary
        letters = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
        shown = np.where(letters == ord(BLANK), _NO_LETTER, np.where(letters == ord(" "), ord(BLANK), letters))
        shown = np.append(shown, _NO_LETTER)
        # a piece that goes on across a blank has only blanks: it may leave a part that has no letter
        bounded = (shown[stops - 1] == ord(BLANK)).any()
        stop = np.repeat(stops, np.diff(stops, prepend=0)) if bounded else None
        nodes = self.below_root.take(shown[:-1]).astype(np.int64)
        spots = np.flatnonzero(nodes)
        nodes, found = nodes.take(spots), []
        for width in range(1, v.longest + 1):
            ids = v.piece_at.take(nodes)
            here = np.flatnonzero(ids >= 0)
            found.append((spots.take(here), ids.take(here)))
            if bounded:
                further = np.flatnonzero(spots + width < stop.take(spots))
                spots, nodes = spots.take(further), nodes.take(further)
            on, edges = v.edges_of((nodes << 21) | shown.take(spots + width))
            spots, nodes = spots.take(np.flatnonzero(on)), v.targets.take(edges)
            if not len(spots):
                break
        n_arcs = np.zeros(len(letters), np.int64)
        for at, _ in found:
            n_arcs[at] = n_arcs.take(at) + 1
        bare = np.ones(len(letters), bool)
        bare[found[0][0]] = False
        bare = np.flatnonzero(bare)
        n_arcs[bare] += 1
        place = np.cumsum(n_arcs)
        widths, pieces = np.ones(place[-1], np.int16), np.empty(place[-1], np.int32)
        bare_at = place[bare] - 1
        pieces[bare_at] = -1 - letters[bare]
        place[bare] = bare_at
        for width, (at, ids) in enumerate(found, 1):
            own = place.take(at) - 1
            widths[own], pieces[own], place[at] = width, ids, own
        weights = v.weight_of.take(np.maximum(pieces, 0))
        n_bytes = 1 + sum((letters[bare] >= bound).astype(np.int64) for bound in (0x80, 0x800, 0x10000))
        weights[bare_at] = v.byte_cost * n_bytes
        return n_arcs, widths, pieces, weights

    def lattices(self, text: str) -> list[list[list[tuple[int, tuple[int, ...], float]]]]:
        """For every part and position the arcs (end, ids, log share), to look at."""
        found = []
        for part in _PART.findall(" " + text):
            if part[1:] not in self.known:
                self._learn([part[1:]])
            base = self.known[part[1:]]
            arcs = [range(self.first[base + at], self.first[base + at + 1]) for at in range(len(part))]
            found.append([[(at + abs(int(self.width[a])), self._ids(a), float(self.share[a])) for a in some] for at, some in enumerate(arcs)])
        return found

    def _ids(self, arc: int) -> tuple[int, ...]:
        return tuple(self._spelled(np.array([arc]))[0].tolist())

    def _spelled(self, arcs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Piece ids of arcs with characters spelled in bytes, where these were, and how many
        ids more than one each became."""
        pieces = self.piece.take(arcs)
        at = np.flatnonzero(pieces < 0)
        letters = [chr(-1 - p).encode() for p in pieces[at].tolist()]
        more = np.array([len(b) - 1 for b in letters], np.int64)
        # the further bytes of a character are put in behind it
        ids = np.insert(pieces, np.repeat(at + 1, more), -1) if more.any() else pieces
        ids[np.flatnonzero(ids < 0)] = self.byte_ids[np.frombuffer(b"".join(letters), np.uint8)]
        return ids, at, more

    def sample(self, text: str, k: int, seed: int) -> list[tuple[list[int], float, float]]:
        """Up to k distinct segmentations (ids, log probability, chance to be in a sample),
        in the order drawn; fewer only if the text has no more."""
        _, ids, ends, logps, inclusions = self.sample_all([text], k, [seed])
        return [(s.tolist(), lp, inc) for s, lp, inc in zip(np.split(ids, ends[:-1]), logps, inclusions, strict=True)]

    def sample_all(self, texts: list[str], k: int, seeds: list[int]) -> tuple[list[int], np.ndarray, np.ndarray, list[float], list[float]]:
        """The samples of some texts one after the other: the number of the text, all ids,
        where the ids of each sample end, log probabilities and chances to be included."""
        if self.n_arcs > _CACHE_ARCS:
            self._clear()
        searches = []
        for bases, starts, seed in zip(*self._cut(texts), seeds, strict=True):
            chance = random.Random(seed)
            root = -math.log(chance.expovariate(1.0))
            length = int(starts[-1])
            searches.append(_Text(starts[:-1], starts[:-1].tolist(), bases, length, chance, seed & (2**64 - 1), [(-root, 0, 0.0, None, 0, -1, -1)], []))
        for drawn in range(k):
            active = [t for t in searches if t.waiting]
            if active:
                self._complete(active, k - drawn, drawn)
        owners, logps, inclusions, chosen = [], [], [], []
        for number, t in enumerate(searches):
            bound = -t.waiting[0][0] if t.waiting else -math.inf
            for _, logp, path in t.paths:
                owners.append(number)
                logps.append(logp)
                inclusions.append(1.0 if bound == -math.inf else -math.expm1(-math.exp(min(logp - bound, 700.0))))
                chosen.append(path)
        arcs = np.concatenate(chosen) if chosen else np.empty(0, np.int64)
        ids, at, more = self._spelled(arcs)
        ends = np.cumsum([len(c) for c in chosen], dtype=np.int64)
        ends += np.concatenate(([0], np.cumsum(more)))[np.searchsorted(at, ends)]
        return owners, ids, ends, logps, inclusions

    def _cut(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Where the parts of each text begin in the store, and in the text, with its end."""
        split = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        coded, stops = split.flatten().dictionary_encode(), split.offsets.to_numpy()
        words, codes = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy()
        odd, empty = {}, words.index("") if "" in words else -1
        if empty >= 0:  # an empty text, or blanks side by side or at an end
            for n in np.unique(np.searchsorted(stops, np.flatnonzero(codes == empty), "right") - 1).tolist():
                odd[n] = [p[1:] for p in _PART.findall(" " + texts[n])] if texts[n] else []
        base_of = np.fromiter(map(self.known.get, words, repeat(-1)), np.int64, len(words))
        fresh = np.flatnonzero(base_of < 0)
        fresh = fresh[fresh != empty]
        more = [w for w in dict.fromkeys(chain(*odd.values())) if w not in self.known]
        more = sorted(set(more).difference(words[i] for i in fresh.tolist())) if more else more
        if len(fresh) or more:
            base_of[fresh] = self._learn([words[i] for i in fresh.tolist()] + more)[: len(fresh)]
        length_of = pc.utf8_length(coded.dictionary).to_numpy() + 1
        bases, starts = [], []
        for n, (lo, hi) in enumerate(zip(stops[:-1].tolist(), stops[1:].tolist(), strict=True)):
            own = codes[lo:hi]
            lengths = length_of.take(own) if n not in odd else np.array([len(w) + 1 for w in odd[n]], np.int64)
            bases.append(base_of.take(own) if n not in odd else np.array([self.known[w] for w in odd[n]], np.int64))
            starts.append(np.concatenate(([0], np.cumsum(lengths))))
        return bases, starts

    def _complete(self, active: list[_Text], spare: int, drawn: int) -> None:
        """Takes the best node of each text down to a complete path, and puts the `spare`
        best nodes it leaves aside in waiting."""
        first, width, upto = self.first, self.width, self.upto
        path = np.full(sum(t.length for t in active), -1, np.int32)
        taken, spots, places, sizes, inside, keys, offset, offsets = [], [], [], [], [], [], 0, []
        for t in active:
            value, _, logp, parent, n, at, arc = t.waiting.pop(0)
            at = at + abs(int(width[arc])) if arc >= 0 else 0
            taken.append((-value, logp, parent, n, arc))
            begin = bisect_right(t.begins, at) - 1
            if at < t.length:
                spots.append(t.bases[begin:])
                places.append(t.starts[begin:])
                sizes.append(len(t.begins) - begin)
                inside.append(at - t.begins[begin])
                keys.append((t.seed + drawn * 0xD1342543DE82EF95) & (2**64 - 1))
            else:
                sizes.append(0)
            offsets.append(offset)
            offset += t.length
        spots, places = (np.concatenate(c) if c else np.empty(0, np.int64) for c in (spots, places))
        counts, inside = np.array(sizes, np.int64), np.array(inside, np.int64)
        starts = (np.cumsum(counts) - counts)[counts > 0]
        spots[starts] += inside
        places[starts] += inside
        # a draw depends on the text's seed, the round and the place in the text alone
        keys = np.repeat(np.array(keys, np.uint64), counts[counts > 0]) + places.view(np.uint64) * np.uint64(_STEP)
        places += np.repeat(offsets, counts)
        while len(spots):
            u = (mix64(keys) >> np.uint64(11)) * 2.0**-53
            arcs = first.take(spots)
            past = np.flatnonzero(u >= upto.take(arcs))
            while len(past):
                ahead = arcs.take(past) + 1
                arcs[past] = ahead
                past = past.take(np.flatnonzero(u.take(past) >= upto.take(ahead)))
            path[places] = arcs
            wide = width.take(arcs)
            on = np.flatnonzero(wide > 0)
            wide = wide.take(on).astype(np.int64)
            spots, places = spots.take(on) + wide, places.take(on) + wide
            keys = keys.take(on) + wide.view(np.uint64) * np.uint64(_STEP)
        steps = np.flatnonzero(path >= 0)
        rest = path.take(steps)
        shares, cuts = self.share.take(rest), np.searchsorted(steps, [*offsets, offset]).tolist()
        for i, (t, (value, logp, parent, n, arc)) in enumerate(zip(active, taken, strict=True)):
            own = slice(cuts[i], cuts[i + 1])
            head = n + (arc >= 0)
            arcs = np.empty(head + own.stop - own.start, np.int32)
            if head:
                arcs[:n], arcs[n] = parent[:n], arc
            arcs[head:] = rest[own]
            lost = float(shares[own].sum())
            t.paths.append((value, logp + lost, arcs))
            self._leave_aside(t, arcs, steps[own], offsets[i], shares[own], lost, value, logp, spare)

    def _leave_aside(self, t: _Text, arcs, steps, offset: int, shares, whole: float, value: float, logp: float, spare: int) -> None:
        """Puts the best of the children aside of a path in waiting.

        A run of steps whose largest value aside is known is split at the step that has it,
        drawn by the weights aside; the runs before and after it draw theirs under it.
        """
        waiting, chance, n = t.waiting, t.chance.random, len(steps)
        del waiting[spare:]
        # the log of what the path has lost before each step: the first steps are mostly enough
        near, falls = _NEAR, list(accumulate((-shares[:_NEAR]).tolist(), initial=0.0))
        runs = [(0, n, value)]
        while runs:
            lo, hi, bound = runs.pop()
            if lo >= hi:
                continue
            while len(falls) <= max(lo, hi if hi < n else 0):
                near *= 4
                falls = list(accumulate((-shares[:near]).tolist(), initial=0.0))
            before = falls[lo]
            lost = before - (falls[hi] if hi < len(falls) else -whole)
            if lost >= 0.0:
                continue
            top = _under(logp - before + math.log(-math.expm1(lost)), bound, chance)
            if len(waiting) == spare and top <= -waiting[-1][0]:
                continue
            line = before - math.log1p(chance() * math.expm1(lost))
            while line >= falls[-1] and len(falls) <= n:
                near *= 4
                falls = list(accumulate((-shares[:near]).tolist(), initial=0.0))
            j = min(max(bisect_right(falls, line) - 1, lo), hi - 1)
            at, place = int(steps[j]) - offset, logp - falls[j]
            mine = int(arcs[len(arcs) - n + j])
            part = bisect_right(t.begins, at) - 1
            spot = int(t.bases[part]) + at - t.begins[part]
            first, last = self.first[spot : spot + 2].tolist()
            aside = [(a, s) for a, s in enumerate(self.share[first:last].tolist(), first) if a != mine]
            best = 0
            if len(aside) > 1:
                upto = list(accumulate(math.exp(s) for _, s in aside))
                best = bisect_right(upto, chance() * upto[-1], 0, len(upto) - 1)
            for i, (arc, share) in enumerate(aside):
                v = top if i == best else _under(place + share, top, chance)
                if len(waiting) < spare or v > -waiting[-1][0]:
                    insort(waiting, (-v, t.born, place + share, arcs, len(arcs) - n + j, at, arc))
                    t.born += 1
                    del waiting[spare:]
            runs += [(j + 1, hi, top), (lo, j, top)]


def _under(place: float, bound: float, chance: Callable[[], float]) -> float:
    """A Gumbel value at `place`, given that it is below `bound`."""
    return min(bound, place - math.log(math.exp(min(place - bound, 700.0)) - math.log(1.0 - chance())))


def decode(ids: list[int], vocabulary: Vocabulary) -> str:
    """The text of some ids: bytes are joined to characters, the first blank is dropped."""
    return b"".join([vocabulary.shown[i] for i in ids]).decode(errors="replace").removeprefix(" ")


def sample_segmentations(
    rows: DataFrame,
    model_path: str,
    key_columns: list[str],
    text_column: str = "text",
    samples: int = SAMPLES,
    sharpness: float = 1.0,
    seed: int = 0,
    with_ids: bool = True,
) -> DataFrame:
    """For every row up to `samples` rows: the key columns, sample (from 0), ids, n_pieces,
    ids_crc32 (of the ids as little-endian unsigned 32-bit numbers), log_prob, inclusion,
    and decodes (whether the ids give back the text).

    The draws of a row depend on `seed` and its key alone. A null text is empty; an empty
    text has one segmentation, without pieces. Rows that share a key draw alike. Further
    columns are not read.
    """
    spark = rows.sparkSession
    get = shared(spark, Vocabulary.load(model_path, sharpness))
    keys = [F.col(f"`{c}`").cast("long").alias(f"k{i}") for i, c in enumerate(key_columns)]
    source = rows.select(
        F.coalesce(F.col(f"`{text_column}`"), F.lit("")).alias("text"),
        F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in key_columns]).alias("row_seed"),
        *keys,
    )
    n_keys = len(keys)

    def draw(batches):
        sampler = Sampler(get())
        for batch in slabs(batches, 0, rows=2_000, size=1 << 20):
            texts, written = batch.column(0).to_pylist(), batch.column(0).cast(pa.binary()).to_pylist()
            owners, ids, ends, logps, inclusions = sampler.sample_all(texts, samples, batch.column(1).to_pylist())
            begins = np.concatenate(([0], ends))
            spelled = sampler.shown.take(pa.array(ids))
            at = np.frombuffer(spelled.buffers()[1], np.int32)[begins]
            bytes_of = memoryview(spelled.buffers()[2] or b"")
            crcs, decodes, little = [], [], ids.astype("<u4")
            for n, owner in enumerate(owners):
                crcs.append(zlib.crc32(little[begins[n] : begins[n + 1]]))
                decodes.append(bytes(bytes_of[at[n] : at[n + 1]]).removeprefix(b" ") == written[owner])
            firsts = np.searchsorted(owners, owners)
            found = [
                pa.array(np.arange(len(owners)) - firsts, pa.int32()),
                pa.ListArray.from_arrays(pa.array(begins, pa.int32()), pa.array(ids, pa.int32())),
                pa.array(np.diff(begins), pa.int32()), pa.array(crcs, pa.int64()),
                pa.array(logps, pa.float64()), pa.array(inclusions, pa.float64()), pa.array(decodes, pa.bool_()),
            ]
            taken = [batch.column(2 + j).take(pa.array(owners)) for j in range(n_keys)]
            yield pa.RecordBatch.from_arrays([*taken, *found], names)

    fields = "sample int, ids array<int>, n_pieces int, ids_crc32 long, log_prob double, inclusion double, decodes boolean"
    names = [*[f"k{i}" for i in range(n_keys)], *[f.split()[0] for f in fields.split(", ")]]
    drawn = source.mapInArrow(draw, ", ".join([*[f"k{i} long" for i in range(n_keys)], fields]))
    renamed = drawn.withColumnsRenamed({f"k{i}": c for i, c in enumerate(key_columns)})
    return renamed if with_ids else renamed.drop("ids")
