"""Toxicity by weak supervision.

Voters are words and word beginnings that labelled toxic texts use far more often than
clean ones (a lexicon mined from all labelled rows), and a few patterns of writing. A
generative label model estimates how often each voter fires on toxic and on clean texts by
EM, labelled rows being known, and how far voters fire together for other reasons than the
label; voters that repeat each other share their weight. Its posteriors, for labelled and
unlabelled rows alike, are the targets of a linear classifier that scores every text.
"""

from __future__ import annotations

import string
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarn.llm.common import coded_words, shared, slabs
from tarn.session import broadcast_if_small, stage

#: Beginnings of words that may become voters, besides whole words.
BEGINNINGS = (3, 4, 5, 6)
#: The strongest voters stand alone; all further ones are pooled by strength in `POOLS` voters.
MAX_VOTERS = 400
POOLS = 10
MIN_PRECISION = 0.7
#: About so many labelled and as many unlabelled rows fit the label model and classifier.
FIT_ROWS = 20_000
#: Labels up to this number are broadcast after a count; beyond, they are joined by shuffle.
BROADCAST_LABELS = 2_000_000
#: Bytes of text whose words are in memory at a time, some 30 times as much.
SLAB = 1 << 20
#: Stems, some 200 bytes each, that a task counts before it hands them on.
HELD_STEMS = 150_000
TRUST = 0.97  # in a label, against the voters
#: Voters whose firing correlates at least so much within a class count as repeats.
REDUNDANT = 0.5
_EDGES = string.punctuation + "«»„“”‚‘’¡¿…–—"
PATTERNS = ("shouting", "exclaiming", "symbols", "short words")


# --- what a text shows


def stems(word: str) -> list[str]:
    """The word without marks at its edges, and its beginnings."""
    core = word.strip(_EDGES)
    if not core:
        return []
    return [f"={core}", *(f"^{core[:n]}" for n in BEGINNINGS if len(core) > n)]


def text_stems(texts: pa.Array, wanted: dict[str, int] | None = None, known: dict[str, int] | None = None):
    """(names, text, stem): the distinct stems of each text, as numbers into `names`.

    With `wanted`, only these stems, under their given numbers. With `known`, which takes in
    the new ones, stems seen before keep their numbers.
    """
    words, codes, starts = coded_words(texts, lower=True)
    numbers: dict[str, int] = wanted if wanted is not None else {} if known is None else known
    stem, owner = [], []
    for i, word in enumerate(words):
        for s in stems(word):
            n = numbers.setdefault(s, len(numbers)) if wanted is None else numbers.get(s)
            if n is not None:
                stem.append(n)
                owner.append(i)
    n_words, n_stems = len(words), max(1, len(numbers))
    text = np.repeat(np.arange(len(texts)), np.diff(starts))
    uses = np.bincount(np.array(owner, np.int64), minlength=n_words)
    first = np.cumsum(uses) - uses
    shown = uses[codes] > 0
    text, codes = text[shown], codes[shown]
    pairs = np.unique(text * max(1, n_words) + codes)
    text, codes = pairs // max(1, n_words), pairs % max(1, n_words)
    reps = uses[codes]
    place = np.arange(reps.sum()) - np.repeat(np.cumsum(reps) - reps, reps) + np.repeat(first[codes], reps)
    both = np.unique(np.repeat(text, reps) * n_stems + np.array(stem, np.int64)[place])
    return numbers, both // n_stems, both % n_stems


def text_patterns(text: str | None) -> list[float]:
    """How much of a text is shouted, exclaimed, made of symbols, and of very short words;
    from 0 to 1 each."""
    text = text or ""
    size = max(1, len(text))
    upper = sum(map(text.count, string.ascii_uppercase))
    letters = max(1, upper + sum(map(text.count, string.ascii_lowercase)))
    marks = text.count("!")
    symbols = sum(map(text.count, "#$%&*@^~|<>"))
    blanks = text.count(" ") + text.count("\n") + 1
    return [
        upper / letters if upper > 3 else 0.0,
        min(1.0, 20 * marks / size),
        min(1.0, 5 * symbols / size),
        1.0 if size / blanks < 4 else 0.0,
    ]


# --- the lexicon


def stem_counts(batches):
    """(stem, n): the number of texts with each stem, added up over the batches of a task as
    long as it holds no more than `HELD_STEMS` stems."""

    def counted():
        listed = np.array(list(names), dtype=object)
        return pa.RecordBatch.from_arrays([pa.array(listed, pa.string()), pa.array(times)], ["stem", "n"])

    names, times = {}, np.zeros(0, np.int64)
    for batch in slabs(batches, 0, size=SLAB):
        _, _, stem = text_stems(batch.column(0), known=names)
        more = np.bincount(stem, minlength=len(names))
        more[: len(times)] += times
        times = more
        if len(names) > HELD_STEMS:
            yield counted()
            names, times = {}, np.zeros(0, np.int64)
    yield counted()


def _count_stems(rows: DataFrame) -> DataFrame:
    """(stem, n) over all rows."""

    def count(batches):
        yield from stem_counts(batches)

    return rows.select("text").mapInArrow(count, "stem string, n long").groupBy("stem").agg(F.sum("n").alias("n"))


def mine_voters(labelled: DataFrame) -> tuple[list[str], dict[str, int]]:
    """Voters that tell toxic from clean texts, over all labelled rows (text, toxic), and the
    voter of every stem.

    The log-likelihood ratio of a stem has to pass a bound that grows with the number of
    stems tried, so that chance finds few. Stems that fire on the same texts are one voter.
    """
    sizes = {r.toxic: r.n for r in labelled.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not clean:
        return [], {}
    inside = _count_stems(labelled.filter("toxic = 1")).filter("n > 1")
    outside = _count_stems(labelled.filter("toxic = 0")).withColumnRenamed("n", "m")
    counted = stage(inside.join(outside, "stem", "left").fillna(0, ["m"]), "stems")
    tried = counted.count()
    if not tried:
        return [], {}
    n, m = F.col("n"), F.col("m")

    def likelihood(k, size, rate):
        p = F.greatest(F.lit(1e-12), F.least(F.lit(1 - 1e-12), rate))
        return k * F.log(p) + (size - k) * F.log(1 - p)

    both = (n + m) / (toxic + clean)
    gain = likelihood(n, toxic, n / toxic) + likelihood(m, clean, m / clean)
    gain = 2 * (gain - likelihood(n, toxic, both) - likelihood(m, clean, both))
    good = counted.filter(n >= MIN_PRECISION * (n + m)).withColumn("gain", gain)
    good = good.filter(F.col("gain") >= float(2 * np.log(tried) + 2)).collect()
    return voters_of([(r.stem, r.n, r.m, r.gain) for r in good])


def voters_of(good: list[tuple[str, int, int, float]]) -> tuple[list[str], dict[str, int]]:
    """The names of the voters of all accepted stems (stem, toxic and clean texts, gain), and
    the voter of every stem."""
    counts = {stem: (n, m) for stem, n, m, _ in good}
    members: dict[str, list[str]] = {}
    for stem, *_ in sorted(good, key=lambda g: (len(g[0]), g[0])):
        # a beginning is in every text that a longer stem is in; with equal counts, in no other
        above = (f"^{stem[1 : 1 + k]}" for k in BEGINNINGS if k < len(stem) - 1)
        head = next((b for b in above if counts.get(b) == counts[stem]), stem)
        members.setdefault(head, []).append(stem)
    gains = {stem: gain for stem, _, _, gain in good}
    heads = sorted(members, key=lambda h: (-gains[h], h))
    alone, rest = heads[:MAX_VOTERS], heads[MAX_VOTERS:]
    cuts = np.linspace(0, len(rest), min(POOLS, len(rest)) + 1).astype(int).tolist()
    pools = [[h] for h in alone] + [rest[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    return [p[0] for p in pools], {s: i for i, pool in enumerate(pools) for h in pool for s in members[h]}


# --- label model and classifier


@dataclass
class LabelModel:
    """Firing rates of each voter on clean and toxic texts, the share of toxic texts, and
    the weight that is left of each voter beside those it fires together with."""

    rates: np.ndarray
    prior: float
    weight: np.ndarray

    def log_odds(self, votes: np.ndarray) -> np.ndarray:
        fired = np.log(self.rates[1] / self.rates[0])
        silent = np.log((1 - self.rates[1]) / (1 - self.rates[0]))
        prior = np.log(self.prior / (1 - self.prior))
        return prior + votes @ (self.weight * (fired - silent)) + (self.weight * silent).sum()


def fit_label_model(votes: np.ndarray, label: np.ndarray, rounds: int = 20) -> tuple[LabelModel, np.ndarray]:
    """EM over rows of votes (0 or 1); `label` is 0, 1 or -1 for unknown. Returns the model
    and the posterior of each row, known labels taken in with `TRUST`."""
    known = label >= 0
    prior = float(np.clip(label[known].mean() if known.any() else 0.5, 0.001, 0.999))
    belief = np.where(known, np.where(label == 1, TRUST, 1 - TRUST), prior)
    if known.any():  # start from the labelled rows alone
        start, mass = votes[known].astype(float), belief[known]
    else:
        start, mass = votes.astype(float), belief
    told = np.log(TRUST / (1 - TRUST)) * np.where(known, np.where(label == 1, 1, -1), 0)
    model = None
    for _ in range(rounds):
        total = np.array([(1 - mass).sum(), mass.sum()])
        fires = np.stack([(1 - mass) @ start, mass @ start])
        rates = np.clip((fires + 0.05) / (total[:, None] + 1), 1e-5, 1 - 1e-5)
        expected = [rates[y] * total[y] for y in (0, 1)]
        # voters that fire together more often than their rates explain, within a class
        shared = np.zeros((votes.shape[1], votes.shape[1]))
        spread = np.zeros(votes.shape[1])
        for y, m in ((0, 1 - mass), (1, mass)):
            centred = start - rates[y]
            shared += (centred * m[:, None]).T @ centred
            spread += expected[y] * (1 - rates[y])
        scale = np.sqrt(np.maximum(spread, 1e-9))
        together = np.clip(shared / scale[:, None] / scale[None, :], 0, 1)
        np.fill_diagonal(together, 0)
        together[together < REDUNDANT] = 0
        fresh = LabelModel(rates, prior, 1 / (1 + together.sum(axis=1)))
        odds = np.clip(fresh.log_odds(votes) + told, -30, 30)
        after = 1 / (1 + np.exp(-odds))
        settled = model is not None and np.abs(after - belief).max() < 1e-4
        model, belief, start, mass = fresh, after, votes.astype(float), after
        if settled:
            break
    return model, belief


def fit_linear(features: np.ndarray, target: np.ndarray, l2: float = 0.05, rounds: int = 300) -> np.ndarray:
    """Weights, the last one the bias, of a logistic regression on soft targets, by
    accelerated gradient descent from the log-odds of the mean target."""
    n, d = features.shape
    x = np.concatenate((features, np.ones((n, 1))), axis=1)
    ridge = np.full(d + 1, l2 / max(1, n))
    ridge[-1] = 0
    top = np.linalg.norm(x, 2) ** 2 / (4 * max(1, n)) + ridge.max()
    mean = float(np.clip(target.mean(), 1e-4, 1 - 1e-4))
    weights = np.zeros(d + 1)
    weights[-1] = np.log(mean / (1 - mean))
    ahead, pace = weights.copy(), 1.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ ahead, -30, 30)))
        step = ahead - (x.T @ (p - target) / max(1, n) + ridge * ahead) / top
        quicker = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
        ahead = step + (pace - 1) / quicker * (step - weights)
        weights, pace = step, quicker
    return weights


@dataclass
class Model:
    """Voters by name, and the weights of the features: one per voter, whether any fires,
    how many do, one per pattern, and the bias."""

    voters: list[str]
    weights: np.ndarray
    label_model: LabelModel | None = field(default=None, repr=False)
    #: the voter of every stem
    numbers: dict[str, int] = field(default_factory=dict, repr=False)

    def score(self, texts: pa.Array) -> np.ndarray:
        """From 0 to 1; null texts count as empty, and without labels all scores are 0."""
        if not len(self.weights):
            return np.zeros(len(texts))
        return 1 / (1 + np.exp(-np.clip(self.features(texts) @ self.weights[:-1] + self.weights[-1], -40, 40)))

    def features(self, texts: pa.Array) -> np.ndarray:
        votes, patterns = votes_of(texts, self.numbers)
        return _features(votes, patterns)


def votes_of(texts: pa.Array, numbers: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    votes = np.zeros((len(texts), 1 + max(numbers.values(), default=-1)))
    if numbers:
        _, text, voter = text_stems(texts, numbers)
        votes[text, voter] = 1
    return votes, np.array([text_patterns(t) for t in texts.to_pylist()]).reshape(-1, len(PATTERNS))


def _features(votes: np.ndarray, patterns: np.ndarray) -> np.ndarray:
    fired = votes.sum(axis=1, keepdims=True)
    return np.concatenate((votes, fired > 0, np.log1p(fired), patterns), axis=1)


def train(rows: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> Model:
    """Learn from `rows` and the labels (doc_id, toxic) of some of them.

    The lexicon is counted over all labelled rows. The label model and the classifier are
    fitted on about `FIT_ROWS` labelled and as many unlabelled rows, taken by a hash of
    id and text. Of several labels of one id, one that says toxic wins; null labels are no labels.
    """
    spark = rows.sparkSession
    marks = labels.select(F.col("doc_id").cast("long").alias("id"), F.col("toxic").cast("int").alias("toxic"))
    marks = marks.dropna().groupBy("id").agg(F.max("toxic").alias("toxic"))
    marks = broadcast_if_small(marks, BROADCAST_LABELS)
    texts = rows.select(
        F.col(f"`{id_column}`").cast("long").alias("id"), F.coalesce(F.col(f"`{text_column}`"), F.lit("")).alias("text")
    )
    labelled = texts.join(marks, "id").select("id", "text", "toxic")
    voters, numbers = mine_voters(labelled)
    n_rows, n_marks = texts.select("id").count(), marks.count()
    if not n_rows or not n_marks:
        return Model([], np.zeros(0))

    def sampled(frame, n):
        return frame.filter(F.pmod(F.xxhash64("id", "text"), F.lit(max(1, -(-n // FIT_ROWS)))) == 0)

    get = shared(spark, numbers)

    def show(batches):
        for batch in slabs(batches, 1, size=SLAB):
            votes, patterns = votes_of(batch.column(1), get())
            fired = [np.flatnonzero(v) for v in votes]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(fired, pa.list_(pa.int64())),
                 pa.array(list(patterns), pa.list_(pa.float64()))],
                ["id", "toxic", "fired", "patterns"],
            )

    unknown = sampled(texts, n_rows).join(marks, "id", "left").filter("toxic IS NULL")
    fit = sampled(labelled, n_marks).union(unknown.select("id", "text", "toxic"))
    shape = "id long, toxic int, fired array<long>, patterns array<double>"
    found = fit.mapInArrow(show, shape).toArrow().to_pylist()
    if not any(f["toxic"] == 1 for f in found):
        return Model([], np.zeros(0))
    found.sort(key=lambda f: (f["id"] is None, f["id"] or 0, f["fired"]))
    votes = np.zeros((len(found), len(voters)))
    for i, f in enumerate(found):
        votes[i, f["fired"]] = 1
    patterns = np.array([f["patterns"] for f in found])
    label = np.array([-1 if f["toxic"] is None else f["toxic"] for f in found])
    model, belief = fit_label_model(np.concatenate((votes, patterns > 0.5), axis=1), label)
    return Model(voters, fit_linear(_features(votes, patterns), belief), model, numbers)


def score_texts(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, score, predicted) of every row; predicted is 1 from 0.5 on. Null and empty texts
    fire no voter. Ids may be null or repeated; further columns are not read."""
    get = shared(docs.sparkSession, model)

    def score(batches):
        for batch in slabs(batches, 1, size=SLAB):
            values = get().score(batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(values), pa.array((values >= 0.5).astype(np.int32))],
                ["id", "score", "predicted"],
            )

    source = docs.select(F.col(f"`{id_column}`").cast("long"), F.col(f"`{text_column}`"))
    return source.mapInArrow(score, "id long, score double, predicted int").withColumnRenamed("id", id_column)
