"""Language identification of mixed-language text.

Per language the counts of letter n-grams over all training words are kept in a table of
`SLOTS` hashed slots, so the model has a fixed size per language however large the corpus
is. A word is scored under the languages that write in its script; Viterbi over the words
of a text, with a penalty for every change of language, labels spans.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarn.llm.common import coded_words, mix64, shared, slabs

ORDERS = (1, 2, 3, 4)
SLOTS = 1 << 17
#: Cost in nats of a change of language between two words.
SWITCH_PENALTY = 6.0
#: A language is a candidate for a script that has at least this share of its letters.
SCRIPT_SHARE = 0.01
UNKNOWN = "und"
_BLOCK = 1 << 13
_HELD_LANGUAGES = 64
_CACHE_WORDS = 300_000
#: Words whose n-grams are in memory at a time, some 1,000 bytes each.
_RUN = 20_000
_IMPOSSIBLE = -1e6
SPANS = pa.list_(pa.struct([("first", pa.int32()), ("words", pa.int32()), ("lang", pa.string())]))
_SMOOTHING = 0.5

# First code points of Unicode script ranges, and the script that begins there.
SCRIPTS = (
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"),
    (0x0590, "hebrew"), (0x0600, "arabic"), (0x0700, "other"), (0x0900, "devanagari"),
    (0x0980, "bengali"), (0x0A00, "gurmukhi"), (0x0A80, "gujarati"), (0x0B00, "other"),
    (0x0B80, "tamil"), (0x0C00, "telugu"), (0x0C80, "kannada"), (0x0D00, "malayalam"),
    (0x0D80, "sinhala"), (0x0E00, "thai"), (0x0E80, "lao"), (0x0F00, "tibetan"),
    (0x1000, "myanmar"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "ethiopic"),
    (0x13A0, "other"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"),
    (0x2C60, "latin"), (0x2C80, "other"), (0x3040, "kana"), (0x3100, "han"),
    (0x3130, "hangul"), (0x3190, "han"), (0xA000, "other"), (0xAC00, "hangul"),
    (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "other"), (0xFB50, "arabic"),
    (0xFE00, "other"), (0xFF66, "kana"), (0xFFA0, "other"), (0x20000, "han"), (0x32000, "other"),
)
_STARTS = np.array([start for start, _ in SCRIPTS])
_NAMES = sorted({name for _, name in SCRIPTS})
_SCRIPT_OF = np.array([_NAMES.index(name) for _, name in SCRIPTS])


@dataclass
class Model:
    """languages: names; logp: (languages, SLOTS) log probabilities; writes: (languages,
    scripts) whether a language is a candidate; common: the language with most letters."""

    languages: list[str]
    logp: np.ndarray
    writes: np.ndarray
    common: int


def _codes(words: list[str]) -> np.ndarray:
    """The code points of the words between single blanks."""
    line = " " + " ".join(words) + " "
    return np.frombuffer(line.encode("utf-32-le", "surrogatepass"), "<u4")


def letter_table() -> np.ndarray:
    """Whether a code point is a letter; made once per task."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def _letters(words: list[str], is_letter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Letters and main script of each word."""
    code = _codes(words)
    owner = np.clip(np.cumsum(code == 32) - 1, 0, len(words) - 1)
    letter = is_letter[code]
    count = np.bincount(owner, weights=letter, minlength=len(words)).astype(np.int64)
    script = np.full(len(words), _NAMES.index("latin"))
    for i in np.unique(owner[letter & (code >= _STARTS[1])]).tolist():
        letters = [ord(c) for c in words[i] if c.isalpha()]
        scripts = _SCRIPT_OF[np.searchsorted(_STARTS, letters, side="right") - 1]
        script[i] = np.bincount(scripts).argmax()
    return count, script


def _grams(words: list[str], slots: int = SLOTS) -> tuple[np.ndarray, np.ndarray]:
    """Word number and slot of every n-gram of the words between two marks; n-grams of one
    mark alone are left out."""
    code = _codes(words).astype(np.uint64)
    gap = code == 32
    # a gap belongs to the word before it; the first one to the first word
    owner = np.maximum(np.cumsum(gap) - 1 - gap, 0)
    numbers, found = [], []
    for n in ORDERS:
        if len(code) < n:
            continue
        windows = np.lib.stride_tricks.sliding_window_view(code, n)
        value = np.full(len(windows), n, np.uint64)
        for k in range(n):
            value = value * np.uint64(0x100000001B3) + windows[:, k]
        inside = ~np.lib.stride_tricks.sliding_window_view(gap, n)[:, 1 : n - 1].any(axis=1)
        inside &= ~gap[: len(windows)] if n == 1 else inside
        if n == 2:
            inside &= ~(gap[:-1] & gap[1:])
        at = np.flatnonzero(inside)
        # the first character of a window that starts in a gap counts for the next word
        word = np.where(gap[at], np.minimum(owner[at] + (at > 0), len(words) - 1), owner[at])
        numbers.append(word)
        found.append(mix64(value[at]) % np.uint64(slots))
    return np.concatenate(numbers), np.concatenate(found).astype(np.int64)


def _gram_runs(words: list[str]):
    """First word, word numbers from there, and slots, for runs of the words."""
    for at in range(0, len(words), _RUN):
        yield at, *_grams(words[at : at + _RUN])


def train(rows: DataFrame, text_column: str, language_column: str) -> Model:
    """Count the n-grams of all rows whose text and language are not null.

    Every task adds up tables of a fixed size; the driver gets one table per language.
    """

    def count(batches):
        tables: dict[str, np.ndarray] = {}
        scripts: dict[str, np.ndarray] = {}
        is_letter = letter_table()
        for batch in slabs(batches, 0, size=2 << 20):
            words, codes, starts = coded_words(batch.column(0), lower=True)
            if not words:
                continue
            letters, script = _letters(words, is_letter)
            spoken = batch.column(1).dictionary_encode()
            of_word = np.repeat(spoken.indices.to_numpy(), np.diff(starts))
            names = spoken.dictionary.to_pylist()
            for i, language in enumerate(names):
                weight = np.bincount(codes[of_word == i], minlength=len(words))
                total = np.bincount(script, weights=letters * weight, minlength=len(_NAMES))
                scripts[language] = scripts.get(language, 0) + total
            for at, number, slot in _gram_runs(words):
                for i, language in enumerate(names):
                    weight = np.bincount(codes[of_word == i], minlength=len(words))[at:].astype(float)
                    table = np.bincount(slot, weights=weight[number], minlength=SLOTS)
                    tables[language] = tables.get(language, 0) + table
            if len(tables) > _HELD_LANGUAGES:
                yield blocks(tables, scripts)
                tables, scripts = {}, {}
        yield blocks(tables, scripts)

    def blocks(tables, scripts):
        rows = [(language, -1, total.tobytes()) for language, total in scripts.items()]
        for language, table in tables.items():
            parts = enumerate(table.reshape(-1, _BLOCK))
            rows += [(language, i, part.tobytes()) for i, part in parts if part.any()]
        columns = [[r[i] for r in rows] for i in range(3)]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
        )

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(c, "<f8") for c in frame["counts"])
        return frame.head(1).assign(counts=[total.tobytes()])

    schema = pa.schema([("language", pa.string()), ("block", pa.int32()), ("counts", pa.binary())])
    spark_schema = "language string, block int, counts binary"
    known = rows.select(F.col(f"`{text_column}`"), F.col(f"`{language_column}`").cast("string")).dropna()
    partial = known.mapInArrow(count, spark_schema)
    parts = partial.groupBy("language", "block").applyInPandas(add, spark_schema).collect()

    languages = sorted({p.language for p in parts})
    table = np.zeros((len(languages), SLOTS))
    letters = np.zeros((len(languages), len(_NAMES)))
    for p in parts:
        at, values = languages.index(p.language), np.frombuffer(p.counts, "<f8")
        if p.block < 0:
            letters[at] = values
        else:
            table[at, p.block * _BLOCK : (p.block + 1) * _BLOCK] = values
    used = max(1, int((table.sum(axis=0) > 0).sum()))
    logp = np.log(table + _SMOOTHING) - np.log(table.sum(axis=1, keepdims=True) + _SMOOTHING * used)
    share = letters / np.maximum(letters.sum(axis=1, keepdims=True), 1)
    common = int(letters.sum(axis=1).argmax()) if languages else 0
    return Model(languages, logp.astype(np.float32), share >= SCRIPT_SHARE, common)


def score_words(words: list[str], model: Model, is_letter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Letters of each word and its score under each language.

    Scores are sums of n-gram log probabilities, over the number of orders. A language that
    does not write in the word's script is no candidate; a word without letters, or in a
    script of no language, says nothing.
    """
    letters, script = _letters(words, is_letter)
    scores = np.zeros((len(words), len(model.languages)), np.float32)
    for at, number, slot in _gram_runs(words):
        run = scores[at : at + _RUN]
        for i, table in enumerate(model.logp):
            run[:, i] = np.bincount(number, weights=table[slot], minlength=len(run)) / len(ORDERS)
    candidate = model.writes[:, script].T
    silent = (letters == 0) | ~candidate.any(axis=1)
    scores[~candidate] = _IMPOSSIBLE
    scores[silent] = 0
    return letters, scores


def viterbi(scores: np.ndarray, starts: np.ndarray, penalty: float = SWITCH_PENALTY) -> np.ndarray:
    """The best language of every word; text i has the rows starts[i] to starts[i + 1].

    All texts advance together, one word at a time, the longest first, so that the texts
    still running are always the first rows of the working arrays.
    """
    sizes = np.diff(starts)
    order = np.argsort(-sizes, kind="stable")
    first, sizes = starts[:-1][order], sizes[order]
    path = np.zeros(len(scores), np.int16)
    if not len(scores):
        return path
    running = np.searchsorted(-sizes, -np.arange(sizes[0]), side="left")  # texts longer than t words
    value = scores[first[: running[0]]]
    came_from = np.zeros(scores.shape, np.int16)
    stay = np.arange(scores.shape[1], dtype=np.int16)
    ends = [value]
    for t in range(1, sizes[0]):
        n = running[t]
        if n < len(value):
            ends.append(value[n:])
            value = value[:n]
        best = value.argmax(axis=1)
        switched = value[np.arange(n), best][:, None] - penalty
        moves = switched > value
        came_from[first[:n] + t] = np.where(moves, best[:, None], stay)
        value = np.where(moves, switched, value) + scores[first[:n] + t]
    last = np.concatenate([value, *reversed(ends[1:])]) if len(ends) > 1 else value
    state = last.argmax(axis=1).astype(np.int16)
    for t in range(sizes[0] - 1, -1, -1):
        n = running[t]
        rows = first[:n] + t
        path[rows] = state[:n]
        state[:n] = came_from[rows, state[:n]] if t else state[:n]
    return path


class Labeller:
    """Labels texts under a model and keeps the scores of the words it has seen."""

    def __init__(self, model: Model, penalty: float = SWITCH_PENALTY):
        self.model, self.penalty, self.is_letter = model, penalty, letter_table()
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.letters = np.zeros(0, np.int64)
        self.scores = np.zeros((0, len(self.model.languages)), np.float32)

    def _rows(self, words: list[str]) -> np.ndarray:
        if len(self.known) > _CACHE_WORDS:
            self._forget()
        rows = list(map(self.known.get, words))
        fresh = [i for i, row in enumerate(rows) if row is None]
        if fresh:
            letters, scores = score_words([words[i] for i in fresh], self.model, self.is_letter)
            first = len(self.letters)
            self.letters = np.concatenate((self.letters, letters))
            self.scores = np.concatenate((self.scores, scores))
            for k, i in enumerate(fresh):
                rows[i] = self.known[words[i]] = first + k
        return np.array(rows, np.int64)

    def label(self, texts: pa.Array) -> tuple[list[str], np.ndarray, pa.Array]:
        """Language, score and spans of each text; spans are (first word, words, language).

        The language is the one with most letters in its spans, ties to the smaller name;
        the score is its share of all letters, counting words that say something. A text
        that is null or has no letter is `und`, score 0, and so is any text if nothing was
        learned; a text all in scripts of no language gets the commonest one, score 0.
        """
        n, names = len(texts), self.model.languages
        if not names:
            return [UNKNOWN] * n, np.zeros(n), pa.array([[]] * n, SPANS)
        words, codes, starts = coded_words(texts, lower=True)
        rows = self._rows(words)[codes]
        scores, letters = self.scores[rows], self.letters[rows]
        path = viterbi(scores, starts, self.penalty)
        text = np.repeat(np.arange(n), np.diff(starts))
        total = np.bincount(text, weights=letters, minlength=n)
        heard = letters * scores.any(axis=1)
        share = np.bincount(text * len(names) + path, weights=heard, minlength=n * len(names))
        share = share.reshape(n, -1) / np.maximum(total, 1)[:, None]
        best = np.where(share.any(axis=1), share.argmax(axis=1), self.model.common)
        language = [names[b] if t else UNKNOWN for b, t in zip(best.tolist(), total.tolist(), strict=True)]

        begins = np.flatnonzero(np.append(True, (text[1:] != text[:-1]) | (path[1:] != path[:-1]))[: len(path)])
        ends = np.append(begins[1:], len(path))
        spans = pa.StructArray.from_arrays(
            [pa.array((begins - starts[text[begins]]).astype(np.int32)), pa.array((ends - begins).astype(np.int32)),
             pa.DictionaryArray.from_arrays(path[begins], names).cast(pa.string())],
            ["first", "words", "lang"],
        )
        offsets = np.searchsorted(text[begins], np.arange(n + 1)).astype(np.int32)
        return language, share[np.arange(n), best], pa.ListArray.from_arrays(pa.array(offsets), spans)


def identify(
    docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """(id, lang_pred, score, spans) of every row; ids may be null or repeated, and further
    columns are not read. Spans are (first word, number of words, language)."""
    get = shared(docs.sparkSession, model)

    def label(batches):
        labeller = Labeller(get())
        size = (32 << 20) // max(4, len(get().languages))
        for batch in slabs(batches, 1, rows=8_000, size=size):
            language, score, spans = labeller.label(batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(language, pa.string()), pa.array(score), spans],
                ["id", "lang_pred", "score", "spans"],
            )

    source = docs.select(F.col(f"`{id_column}`").cast("long"), F.col(f"`{text_column}`"))
    labelled = source.mapInArrow(
        label, "id long, lang_pred string, score double, spans array<struct<first: int, words: int, lang: string>>"
    )
    return labelled.withColumnRenamed("id", id_column)


def accepts(language: str, score: float, at_least: float = 0.3) -> bool:
    """Whether a text is in a known language to a good part."""
    return language != UNKNOWN and score >= at_least
