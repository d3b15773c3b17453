"""BPE encoding and decoding by a queue of merges over a doubly linked list of symbols.

A text is normalized and cut into parts as the tokenizer file says; the merges of a part are
then made here. The symbols of a part form a doubly linked list, and a heap holds the rank
and the place of every neighbouring pair that can merge. The best merge is taken from the
heap and made in the list; entries whose pair has changed meanwhile are stale and skipped.
A part of n symbols takes O(n log n), whatever its length. Decoding puts the vocabulary's
strings one after another, as the file's decoder joins them.

Distinct parts of a batch are merged once, and those of earlier batches are remembered up
to a bound, so the work in Python follows the distinct parts and not the text.
"""

from __future__ import annotations

import heapq
import json
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarn.llm.common import coded_words, shared, slabs

#: Parts of a word as the word-level tokenizer defines them (a fixed value), and those of
#: them that are no letters: blanks around these leave the letters as parts of their own.
#: White space is written out, as Arrow's expressions do not count the vertical tab.
_NO_LETTERS = r"'s|'t|'re|'ve|'m|'ll|'d|\p{N}|[^\t-\r \p{L}\p{N}]+"
_FILE_PARTS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Texts with other characters than these are cut by the tokenizer's own normalizer and
#: cutter. For these the normalizer only lower-cases, one character into one.
_NOT_PLAIN = "[^\t-\r -~¡-¬®-įı-ɏ]"
#: How a byte-level tokenizer shows the bytes that are not printable (a fixed rule).
_PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
_SHOWN = {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}
_BYTES = {ord(c): b for b, c in _SHOWN.items()} | {b: b for b in _PRINTABLE}
#: Marks of parts that are given as shown, and of special tokens, in front of them.
_AS_SHOWN, _SPECIAL = "\x01", "\x02"
_CACHE_PARTS = 300_000
_CACHE_CHARS = 48


class Merges:
    """The vocabulary and the ranked merges of a byte-level BPE tokenizer file."""

    def __init__(self, definition: bytes):
        known = json.loads(definition)
        model = known["model"]
        if model["type"] != "BPE" or model.get("continuing_subword_prefix") or model.get("byte_fallback"):
            raise ValueError("only byte-level BPE tokenizers are supported")
        self.definition = definition
        self.vocabulary: dict[str, int] = model["vocab"]
        self.ending: str = model.get("end_of_word_suffix") or ""
        self.special = {t["content"]: t["id"] for t in known["added_tokens"]}
        self.size = 1 + max([*self.vocabulary.values(), *self.special.values()])
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        self.rank: dict[int, int] = {}
        self.made: list[int] = []
        for left, right in pairs:
            pair = self.vocabulary[left] * self.size + self.vocabulary[right]
            self.rank.setdefault(pair, len(self.made))
            self.made.append(self.vocabulary[left + right])
        decoder = known.get("decoder")
        if decoder and decoder["type"] != "ByteLevel":
            raise ValueError(f"decoder {decoder['type']} is not supported")
        self.joins_bytes = bool(decoder)
        cutters = (known["pre_tokenizer"] or {}).get("pretokenizers", [])
        self.cuts_words = (
            [n["type"] for n in (known["normalizer"] or {}).get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]
            and [c["type"] for c in cutters] == ["Split", "ByteLevel"]
            and cutters[0]["pattern"] == {"Regex": _FILE_PARTS}
            and not any(not t["special"] or t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"]
                        for t in known["added_tokens"])
        )

    def merge(self, shown: str) -> list[int]:
        """The ids of one part, given as the tokenizer shows its bytes."""
        vocabulary, rank, size = self.vocabulary, self.rank.get, self.size
        ids = [vocabulary[c] for c in shown[:-1]]
        ids.append(vocabulary[shown[-1] + self.ending])
        last = len(ids) - 1
        queue = []
        for at in range(last):
            found = rank(ids[at] * size + ids[at + 1])
            if found is not None:
                queue.append(found << 32 | at)
        if not queue:
            return ids
        heapq.heapify(queue)
        push, pop, made = heapq.heappush, heapq.heappop, self.made
        after, before = list(range(1, last + 2)), list(range(-1, last))
        while queue:
            entry = pop(queue)
            at, wanted = entry & 0xFFFFFFFF, entry >> 32
            right = after[at]
            if right > last or ids[at] < 0 or rank(ids[at] * size + ids[right]) != wanted:
                continue  # the pair has changed since
            ids[at], ids[right] = made[wanted], -1
            following = after[at] = after[right]
            if following <= last:
                before[following] = at
                found = rank(ids[at] * size + ids[following])
                if found is not None:
                    push(queue, found << 32 | at)
            previous = before[at]
            if previous >= 0:
                found = rank(ids[previous] * size + ids[at])
                if found is not None:
                    push(queue, found << 32 | previous)
        return [i for i in ids if i >= 0]

    def strings(self) -> list[str]:
        """The string of every id; an id that is not in the file has none."""
        names = [""] * self.size
        for known in (self.vocabulary, self.special):
            for name, i in known.items():
                names[i] = name
        return names


class Encoder:
    """Ids of whole texts, with a bounded memory of parts."""

    def __init__(self, merges: Merges):
        self.merges = merges
        self.known: dict[str, bytes] = {}
        self._tokenizer = None
        self._special = sorted(merges.special, key=len, reverse=True)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and where the ids of each text begin and end."""
        parts, code, starts = coded_words(self._cut(pc.fill_null(texts, "")), ascii=True)
        ids = self._ids(parts)
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        length = size[code]
        ends = np.concatenate(([0], np.cumsum(length)))
        places = np.repeat((np.cumsum(size) - size)[code] - ends[:-1], length) + np.arange(ends[-1])
        return np.frombuffer(b"".join(ids), "<i4")[places], ends[starts]

    def _cut(self, texts: pa.Array) -> pa.Array:
        """Texts as their parts with blanks between."""
        odd = pc.match_substring_regex(texts, _NOT_PLAIN) if self.merges.cuts_words else pa.array([True] * len(texts))
        for special in self._special:
            odd = pc.or_(odd, pc.match_substring(texts, special))
        places = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
        if len(places) == len(texts):
            return pa.array(map(self._cut_by_file, texts.to_pylist()), pa.string())
        lower = pc.utf8_lower(texts)
        if not len(places):
            return pc.replace_substring_regex(lower, _NO_LETTERS, r" \0 ")
        cut = pc.replace_substring_regex(pc.if_else(odd, "", lower), _NO_LETTERS, r" \0 ")
        by_file = pa.array([self._cut_by_file(texts[i].as_py()) for i in places.tolist()], pa.string())
        return pc.replace_with_mask(cut, odd, by_file)

    def _cut_by_file(self, text: str) -> str:
        """The parts as the file's own rules make them: special tokens first, then the rest
        normalized and cut; each part is marked and shown as bytes."""
        if self._tokenizer is None:
            from tokenizers import Tokenizer

            self._tokenizer = Tokenizer.from_buffer(self.merges.definition)
        normalizer, cutter = self._tokenizer.normalizer, self._tokenizer.pre_tokenizer
        parts = []
        for piece, is_special in _around(text, self._special):
            if is_special:
                parts.append(_SPECIAL + piece)
            elif piece:
                normal = normalizer.normalize_str(piece) if normalizer else piece
                parts += [_AS_SHOWN + shown for shown, _ in cutter.pre_tokenize_str(normal)]
        return " ".join(parts)

    def _ids(self, parts: list[str]) -> list[bytes]:
        if len(self.known) > _CACHE_PARTS:
            self.known = {}
        found = list(map(self.known.get, parts))
        fresh = [i for i, ids in enumerate(found) if ids is None]
        special, shown = self.merges.special, {}
        for i in fresh:
            part = parts[i]
            if part[0] == _SPECIAL:
                found[i] = array("i", [special[part[1:]]]).tobytes()
            elif part[0] == _AS_SHOWN:
                shown[i] = part[1:]
            else:
                shown[i] = part if part.isascii() else part.encode().decode("latin-1").translate(_SHOWN)
        for i, ids in zip(shown, self._merged(list(shown.values())), strict=True):
            found[i] = ids
        self.known.update((parts[i], found[i]) for i in fresh if len(parts[i]) <= _CACHE_CHARS)
        return found

    def _merged(self, shown: list[str]) -> list[bytes]:
        """The ids of parts, given as the tokenizer shows their bytes."""
        return [array("i", self.merges.merge(part)).tobytes() for part in shown]


def _around(text: str, special: list[str]) -> Iterator[tuple[str, bool]]:
    """A text cut at special tokens: at each place the first in the text, the longest there."""
    at = 0
    while True:
        places = [(p, -len(s), s) for s in special if (p := text.find(s, at)) >= 0]
        if not places:
            yield text[at:], False
            return
        place, _, token = min(places)
        yield text[at:place], False
        yield token, True
        at = place + len(token)


def encode_texts(
    docs: DataFrame, tokenizer_path: str, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """The id column and `ids`, the token ids of the whole text, for every row.

    Equal to the tokenizers library without added special tokens, truncation or padding. A
    null or empty text has no ids. Rows may share an id or have none; further columns are
    not read. A row's ids must fit in memory, nothing else grows with the input.
    """
    with open(tokenizer_path, "rb") as file:
        merges = shared(docs.sparkSession, Merges(file.read()))

    def encode(batches):
        encoder = Encoder(merges())
        for batch in slabs(batches, 1, size=2 << 20):
            ids, ends = encoder.encode(batch.column(1))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], ["id", "ids"])

    source = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`"))
    id_type = source.schema["id"].dataType.simpleString()
    encoded = source.mapInArrow(encode, f"id {id_type}, ids array<int>")
    return encoded.withColumnRenamed("id", id_column)


def _from_bytes(shown: str) -> str:
    return bytes(map(_BYTES.get, map(ord, shown))).decode("utf-8", "replace")


def decode_ids(
    rows: DataFrame, tokenizer_path: str, ids_column: str = "ids", text_column: str = "decoded"
) -> DataFrame:
    """`rows` with `text_column`, the decoded text, in the place of the column of ids.

    Special tokens are kept. A null list of ids gives a null text, a null id in a list or an
    id beyond the vocabulary adds nothing. A column that is already named as the text is an
    error.
    """
    if text_column in rows.columns:
        raise ValueError(f"there is a column {text_column} already")
    with open(tokenizer_path, "rb") as file:
        merges = shared(rows.sparkSession, Merges(file.read()))
    kept = [c for c in rows.columns if c != ids_column]
    source = rows.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{ids_column}`").cast("array<int>"))
    schema = T.StructType(source.schema.fields[:-1]).add(text_column, "string")

    def decode(batches):
        strings, by_bytes = pa.array(merges().strings()), merges().joins_bytes
        size, has = len(strings), np.array([bool(s) for s in merges().strings()])
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                lists = part.column(len(kept))
                ids = pc.fill_null(lists.flatten(), -1).to_numpy(zero_copy_only=False)
                known = (ids >= 0) & (ids < size)
                known[known] = has[ids[known]]
                counts = np.concatenate(([0], np.cumsum(known)))
                lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
                ends = counts[np.concatenate(([0], np.cumsum(lengths)))]
                named = pa.ListArray.from_arrays(
                    pa.array(ends, pa.int32()), strings.take(pa.array(ids[known], pa.int64()))
                )
                text = pc.binary_join(named, "" if by_bytes else " ")
                if by_bytes:
                    text = pa.array(map(_from_bytes, text.to_pylist()), pa.string())
                text = pc.if_else(lists.is_valid(), text, None)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], text], [*part.schema.names[:-1], text_column])

    return source.mapInArrow(decode, schema)
