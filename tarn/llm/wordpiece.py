"""Token counts of greedy word pieces, by a linear longest-match automaton.

The vocabulary is a trie of pieces that begin a word and of pieces that go on. Every node
has a failure link: if the next letter does not fit, the longest-match pieces of what has
been read are popped, and the link leads to the node of the rest. How many pieces a link
pops is computed once, so counting reads each letter of a word a bounded number of times
and never builds a piece.
"""

from __future__ import annotations

from collections import deque

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarn.llm.common import coded_words, shared, slabs

_CACHE_WORDS = 300_000
_CACHE_CHARS = 64


class Automaton:
    """Over pieces that begin a word and pieces that go on inside one."""

    def __init__(self, begin: list[str], inside: list[str]):
        # node 0 is where a word begins, node 1 where it goes on
        self.next: list[dict[str, int]] = [{}, {}]
        ends = [False, False]

        def add(root: int, piece: str) -> None:
            node = root
            for letter in piece:
                found = self.next[node].get(letter)
                if found is None:
                    found = self.next[node][letter] = len(self.next)
                    self.next.append({})
                    ends.append(False)
                node = found
            ends[node] = True

        for root, pieces in ((0, begin), (1, inside)):
            for piece in pieces:
                if piece:
                    add(root, piece)
        # link: where to go on, or -1; pops: pieces popped on the way, breadth first
        self.link, self.pops = [-1] * len(self.next), [0] * len(self.next)
        queue = deque((node, child, letter) for node in (0, 1) for letter, child in self.next[node].items())
        while queue:
            node, child, letter = queue.popleft()
            if ends[child]:
                self.link[child], self.pops[child] = 1, 1
            else:
                at, popped = self.link[node], self.pops[node]
                while at >= 0 and letter not in self.next[at]:
                    popped += self.pops[at]
                    at = self.link[at]
                if at >= 0:
                    self.link[child], self.pops[child] = self.next[at][letter], popped
            queue.extend((child, c, x) for x, c in self.next[child].items())

    def count(self, word: str) -> int:
        """Pieces of the greedy longest match, -1 if the vocabulary can not spell the word."""
        node, pieces = 0, 0
        following, link, pops = self.next, self.link, self.pops
        for letter in word:
            found = following[node].get(letter)
            while found is None:
                pieces += pops[node]
                node = link[node]
                if node < 0:
                    return -1
                found = following[node].get(letter)
            node = found
        while node > 1:  # what is left of the word
            pieces += pops[node]
            node = link[node]
        return pieces if node == 1 else -1


def sentencepiece_vocabulary(model_path: str) -> tuple[list[str], list[str]]:
    """Pieces that begin a word and pieces that go on, from a SentencePiece file: those with
    and without the mark of a word's beginning. Byte and control pieces are left out."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    size = range(model.get_piece_size())
    plain = [model.id_to_piece(i) for i in size if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
    begin = [p[1:] for p in plain if p.startswith("▁")]
    return begin, [p for p in plain if "▁" not in p]


def count_tokens(
    docs: DataFrame,
    begin: list[str],
    inside: list[str],
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """id, n_words, n_tokens and n_unknown of every row.

    Words are cut at white space. A word that the vocabulary can not spell is one token and
    counts as unknown. A null or empty text has none. Ids may be null or repeated; further
    columns are not read.
    """
    automaton = shared(docs.sparkSession, Automaton(begin, inside))

    def count(batches):
        known: dict[str, int] = {}
        spell = automaton().count
        for batch in slabs(batches, 1):
            words, codes, starts = coded_words(batch.column(1))
            if len(known) > _CACHE_WORDS:
                known.clear()
            found = list(map(known.get, words))
            for i, pieces in enumerate(found):
                if pieces is None:
                    found[i] = spell(words[i])
                    if len(words[i]) <= _CACHE_CHARS:
                        known[words[i]] = found[i]
            pieces = np.array(found, np.int64)[codes]
            text = np.repeat(np.arange(batch.num_rows), np.diff(starts))
            totals = [np.bincount(text, weights=w, minlength=batch.num_rows).astype(np.int64)
                      for w in (np.where(pieces < 0, 1, pieces), pieces < 0)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(starts)), pa.array(totals[0]), pa.array(totals[1])],
                ["id", "n_words", "n_tokens", "n_unknown"],
            )

    source = docs.select(F.col(f"`{id_column}`").cast("long"), F.col(f"`{text_column}`"))
    counted = source.mapInArrow(count, "id long, n_words long, n_tokens long, n_unknown long")
    return counted.withColumnRenamed("id", id_column)
