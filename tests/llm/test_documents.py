"""Operators over documents, against brute force and on odd tables."""

import math
import random
import tracemalloc
import re
import subprocess
import sys
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.models import WordPiece

import corpus_pipeline
from tarn.llm import bpe, langid, language_model, near_copies, packing, queries, segmentation, simhash, toxicity, wordpiece
from tarn.llm.common import checksum_rest, least_labels, mix64, read_table

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, id long, fp long, word binary, run long, item long, node string"
LONG = " ".join(f"w{i % 977}x{i}" for i in range(60_000))


def odd_documents(spark):
    """Null, empty, blank, very long and repeated texts, null and repeated ids, and columns
    with names that the operators use inside."""
    texts = [None, "", " \t\n", LONG, "the cat sat on the mat", "the cat sat on the mat", "The Cat sat on the mat.", "été à Zürich", "123 456", "x"]
    rows = [(i, t, "en" if i % 2 else None, 7, 8, b"w", 9, 10, "n") for i, t in enumerate(texts)]
    rows += [(4, "the cat sat on the mat", None, 1, 2, b"", 3, 4, None), (None, "the cat sat on the mat", "en", 1, 2, b"", 3, 4, None)]
    return spark.createDataFrame(rows, SCHEMA)


def brute_fingerprint(text):
    text = re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode())
    words = re.findall(rb"[^\x20\x09-\x0D]+", text)
    parts = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64(p, seed=42).intdigest() for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


# --- SimHash


def test_near_copies_of_odd_documents(spark):
    docs = odd_documents(spark)
    got = simhash.near_duplicates(docs).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, int(r.fingerprint, 16)) for r in got) == sorted(
        (r.doc_id is None, r.doc_id or 0, brute_fingerprint(r.text)) for r in docs.collect()
    )
    component = {r.doc_id: r.component_id for r in got}
    assert component[None] is None and component[0] == component[1] == component[2] == 0
    assert component[4] == component[5] == 4 and component[3] == 3
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


@pytest.mark.parametrize("slice_rows", [40, 8_192])
def test_links_equal_brute_force(spark, slice_rows):
    draw = np.random.default_rng(3)
    values = set()
    for base in draw.integers(0, 2**63, 12, dtype=np.uint64).tolist():
        for _ in range(60):
            values.add(base ^ sum(1 << int(b) for b in draw.choice(64, draw.integers(0, 4), replace=False)))
    values = np.array(sorted(values), np.uint64)
    far = np.bitwise_count(values[:, None] ^ values[None, :])
    want = least_labels(len(values), *np.nonzero(far <= 4))
    rows = [(i, int(v)) for i, v in enumerate(values.view(np.int64).tolist())]
    links = simhash.fingerprint_links(spark.createDataFrame(rows, "node long, fp long"), slice_rows=slice_rows).collect()
    got = least_labels(len(values), np.array([r.u for r in links], int), np.array([r.v for r in links], int))
    assert got.tolist() == want.tolist()
    assert simhash.bucket_labels(values).tolist() == want.tolist()


# --- near copies


def copied_documents():
    """Texts and copies of them with a word replaced here and there, and copies of copies."""
    draw, texts = random.Random(11), []
    words = ["".join(draw.choices("abcdefghij", k=4)) for _ in range(3_000)]
    for i in range(60):
        text = draw.choices(words, k=draw.choice([3, 12, 40, 100, 150, 400]))
        texts.append(text)
        for _ in range(i % 5):
            text = list(text)
            for _ in range(1 + len(text) * (i % 3) // 100):
                text[draw.randrange(len(text))] = draw.choice(words)
            texts.append(text)
    texts += [[*texts[0], "tail"]] + [texts[7]] * 3
    return [(i, " ".join(t)) for i, t in enumerate(texts)]


def brute_copies(rows):
    sets = []
    for _, text in rows:
        words = text.lower().split()
        sets.append({tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))})
    links = [(i, j) for i, a in enumerate(sets) for j, b in enumerate(sets[:i]) if 10 * len(a & b) >= 8 * len(a | b)]
    left, right = (np.array(x, np.int64) for x in zip(*links, strict=True))
    return least_labels(len(rows), left, right).tolist(), links


@pytest.mark.parametrize("slice_rows", [2, 1_000])
def test_near_copies_equal_brute_force(spark, monkeypatch, slice_rows):
    monkeypatch.setattr(near_copies, "SLICE", slice_rows)
    rows = copied_documents()
    want, links = brute_copies(rows)
    assert len(links) > 60
    got = near_copies.near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [r.component_id for r in sorted(got)] == want
    odd = near_copies.near_copies(odd_documents(spark)).collect()
    component = {r.doc_id: r.component_id for r in odd}
    assert len(odd) == 12 and component[None] is None and component[0] == component[2] == 0 and component[5] == 4


def test_pipeline_drops_near_copies(spark):
    rows = copied_documents()
    want, _ = brute_copies(rows)
    kept = corpus_pipeline.without_near_copies(spark, spark.createDataFrame(rows, "doc_id long, text string"), SF)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(want))


# --- packing


def test_packed_documents(spark):
    docs = odd_documents(spark).unionByName(read_table(spark, SF, "documents"), allowMissingColumns=True)
    path = packing.tokenizer_file()
    got = packing.pack_documents(docs.drop("n_chars", "source"), path).toPandas()
    tokenizer = Tokenizer.from_file(path)
    want = Counter()
    for r in docs.collect():
        ids = np.array([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 1], "<u4")
        for at in range(0, len(ids), 4096):
            part = ids[at : at + 4096]
            want[(r.doc_id if r.doc_id is not None else -1, at // 4096, at, len(part), zlib.crc32(part.tobytes()))] += 1
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert Counter(tuple(int(v) for v in r) for r in got[columns].fillna(-1).to_numpy()) == want
    got = got.sort_values(["sequence_id", "offset"])
    ends = got.groupby("sequence_id")["length"].cumsum()
    assert (ends - got["length"] == got["offset"]).all() and ends.max() <= 4096
    assert got["sequence_id"].nunique() <= math.ceil(got["length"].sum() / 4096) + 2
    assert packing.pack_documents(docs.limit(0), path).count() == 0


def test_packing_in_a_tree(spark):
    items = spark.range(3000).select(F.col("id").alias("item"), (1 + F.col("id") * 37 % 100).alias("length"))
    got = packing.pack(items, 100, group=100).join(items, "item").toPandas().sort_values(["sequence_id", "offset"])
    ends = got.groupby("sequence_id")["length"].cumsum()
    assert len(got) == 3000 and (ends - got["length"] == got["offset"]).all() and ends.max() <= 100
    assert got["sequence_id"].nunique() < 1.06 * got["length"].sum() / 100
    with pytest.raises(Exception, match="lengths must be"):
        packing.pack(spark.sql("SELECT 1L AS item, 0L AS length"), 100).collect()


def test_words_encode_like_their_text():
    path = packing.tokenizer_file()
    tokenizer, encoder = Tokenizer.from_file(path), packing.WordEncoder(bpe.Merges(open(path, "rb").read()))
    texts = ["<|endoftext|> A's don't", "İ ſ ﬁ ΑΣ Σ x\xady ²½", "日本語 😀 \x85 \x1c", "a" * 3000, "a_b-c'd.e '' 's", "", " \n"]
    draw = random.Random(1)
    texts += ["".join(chr(draw.choice([draw.randrange(32, 592), draw.randrange(0, 0x3000)])) for _ in range(40)) for _ in range(300)]
    for batch in (texts, [t for t in texts if "\x1c" not in t]):
        ids, ends = encoder.encode(pa.array(batch))
        for text, a, b in zip(batch, ends[:-1], ends[1:], strict=True):
            assert ids[a:b].tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


# --- language ID


def test_languages_of_held_out_documents(spark):
    docs = read_table(spark, "/root/testdata/sf0.01", "documents")
    held_out = checksum_rest("doc_id", 3) == 1
    model = langid.train(docs.filter(~held_out), "text", "lang")
    got = langid.identify(docs.filter(held_out), model).join(docs, "doc_id").toPandas()
    assert (got["lang_pred"] == got["lang"]).mean() > 0.98 and got["score"].between(0, 1).all()
    odd = [(r.doc_id, r.lang_pred, r.score) for r in langid.identify(odd_documents(spark), model).collect()]
    assert {(0, "und", 0.0), (1, "und", 0.0), (2, "und", 0.0), (8, "und", 0.0)} <= {*odd} and len(odd) == 12
    nothing = langid.train(docs.limit(0), "text", "lang")
    assert langid.identify(docs, nothing).filter("lang_pred <> 'und'").isEmpty()


def test_mixed_text_gets_spans(spark):
    rows = [("the quick brown house and the river", "en"), ("der schnelle braune hund und das haus", "de"), ("быстрая коричневая лиса", "ru")]
    model = langid.train(spark.createDataFrame(rows * 3, "text string, lang string"), "text", "lang")
    text = "the river and the house der hund und das haus лиса быстрая ελληνικά"
    (language, _, spans) = (x[0] for x in langid.Labeller(model, 1.0).label(pa.array([text])))
    assert [(s["first"], s["lang"]) for s in spans.as_py()] == [(0, "en"), (5, "de"), (10, "ru")] and language == "en"
    (language, score, _) = (x[0] for x in langid.Labeller(model).label(pa.array(["ελληνικά"])))
    assert language in model.languages and score == 0


def test_viterbi_equals_all_paths():
    draw = np.random.default_rng(5)
    for n in (1, 2, 5):
        scores = draw.normal(size=(n, 3)).astype(np.float32)
        paths = np.stack(np.meshgrid(*[range(3)] * n, indexing="ij"), axis=-1).reshape(-1, n)
        value = [scores[range(n), p].sum() - 0.7 * (np.diff(p) != 0).sum() for p in paths]
        got = langid.viterbi(np.concatenate((scores, scores)), np.array([0, n, 2 * n, 2 * n]), 0.7)
        assert got[:n].tolist() == got[n:].tolist() == paths[int(np.argmax(value))].tolist()


# --- toxicity


def test_a_task_hands_on_each_stem_once(monkeypatch):
    """However many slabs it reads; past the bound it hands on what it has and counts anew."""
    texts = [f"again w{i % 7}" for i in range(5_000)] + [None, ""]
    batches = [pa.RecordBatch.from_arrays([pa.array(texts[i : i + 1_500], pa.string())], ["text"]) for i in range(0, len(texts), 1_500)]
    plain = Counter(s for t in texts for s in {s for w in (t or "").split() for s in toxicity.stems(w)})
    for held, most in ((toxicity.HELD_STEMS, 1), (3, 10)):
        monkeypatch.setattr(toxicity, "HELD_STEMS", held)
        found = [(r["stem"], r["n"]) for b in toxicity.stem_counts(iter(batches)) for r in b.to_pylist()]
        added = Counter()
        for stem, n in found:
            added[stem] += n
        assert added == plain and len(plain) <= len(found) <= most * len(plain)


def test_toxic_words_are_learned(spark):
    draw = random.Random(4)
    words = ["".join(draw.choices("abcdefgh", k=5)) for _ in range(400)]
    rows, labels = [], []
    for i in range(600):
        toxic = int(i % 6 == 0)
        text = [*draw.choices(words, k=30), *(["zorgle" + draw.choice(["a", "ed", "ing"])] if toxic else [])]
        rows.append((i, " ".join(text)))
        if i % 2 == 0:
            labels.append((i, toxic))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame([*labels, *labels, (None, 1), (3, None)], "doc_id long, toxic int")
    model = toxicity.train(docs.filter("doc_id % 5 <> 0"), marks)
    assert model.voters and all(v.lstrip("^=").startswith("zor") for v in model.voters)
    got = {r.doc_id: r.predicted for r in toxicity.score_texts(docs, model).collect()}
    assert got == {i: int(i % 6 == 0) for i in range(600)}
    odd = toxicity.score_texts(odd_documents(spark), model)
    assert odd.count() == 12 and odd.filter("predicted = 1 OR score NOT BETWEEN 0 AND 1").isEmpty()
    untold = toxicity.train(docs, marks.limit(0))
    assert toxicity.score_texts(docs, untold).filter("score <> 0").isEmpty()
    assert toxicity.score_texts(docs.limit(0), model).count() == 0


def test_rare_and_many_voters_are_kept(spark, monkeypatch):
    """Words in a small share of many toxic texts, and more words than voters that stand alone."""
    monkeypatch.setattr(toxicity, "MAX_VOTERS", 3)
    rows = [(f"q{chr(97 + i // 20 % 26)}{chr(97 + i // 520)}zz" if i < 6_000 else "plain", int(i < 6_000)) for i in range(12_000)]
    voters, numbers = toxicity.mine_voters(spark.createDataFrame(rows, "text string, toxic int"))
    words = {f"={t}" for t, toxic in rows if toxic}
    assert len(words) == 300 and words <= set(numbers) and len(voters) == 3 + toxicity.POOLS
    same = numbers["=qaazz"]
    assert numbers["^qaa"] == numbers["^qaaz"] == same


def test_repeating_voters_share_their_weight():
    draw = np.random.default_rng(2)
    label = (draw.random(4000) < 0.3).astype(int)
    own = np.where(label == 1, draw.random(4000) < 0.6, draw.random(4000) < 0.05)
    other = np.where(label == 1, draw.random(4000) < 0.5, draw.random(4000) < 0.1)
    votes = np.stack([own, own, own, other], axis=1).astype(float)
    known = np.where(draw.random(4000) < 0.2, label, -1)
    model, belief = toxicity.fit_label_model(votes, known)
    assert np.allclose(model.weight, [1 / 3, 1 / 3, 1 / 3, 1], atol=0.01)
    assert abs(model.rates[1, 0] - 0.6) < 0.1 and abs(model.rates[0, 0] - 0.05) < 0.05
    assert ((belief > 0.5) == label).mean() > 0.8


# --- language model


def test_scores_of_odd_documents(spark, monkeypatch):
    monkeypatch.setattr(language_model, "SLOTS", 1 << 16)
    docs = odd_documents(spark)
    held_out = checksum_rest("doc_id", 10) == 0
    got = language_model.score_documents(docs, held_out).toPandas()
    rows = [(r.doc_id, re.findall(rb"[^\x20\x09-\x0D]+", (r.text or "").lower().encode())) for r in docs.collect()]
    counts, ends = Counter(), 0
    for i, words in rows:
        if zlib.crc32(b"" if i is None else str(i).encode()) % 10:
            counts.update(words)
            ends += 1
    total, kinds = sum(counts.values()) + ends, len(counts) + 1

    def base(n):
        return math.log10((n + 0.1) / (total + 0.1 * (kinds + 1)))

    want = sorted((-1 if i is None else i, len(w) + 1, sum(x in counts for x in w) + 1, round(sum(base(counts[x]) for x in w) + base(ends), 6)) for i, w in rows if w != [])
    found = got[got["n_tokens"] > 1]
    assert sorted(zip(found["doc_id"].fillna(-1), found["n_tokens"], found["n_known"], found["base_score"].round(6), strict=True)) == want
    assert (got["train_tokens"] == total).all() and (got["score"] < 0).all() and len(got) == 12
    assert language_model.score_documents(docs.limit(0), held_out).count() == 0
    untrained = language_model.score_documents(docs, F.lit(True)).toPandas()
    assert (untrained["train_tokens"] == 0).all() and (untrained["n_known"] == 0).all()


def test_scores_equal_brute_force(spark, monkeypatch):
    """The same tree, but counts of words and pairs taken one by one, over several runs and groups."""
    monkeypatch.setattr(language_model, "SLOTS", 1 << 16)
    monkeypatch.setattr(language_model, "GROUP_WORDS", 150)
    monkeypatch.setattr(language_model, "GROUP_PAIRS", 100)
    docs = read_table(spark, "/root/testdata/sf0.001", "documents").limit(60).repartition(3).cache()
    got = {r.doc_id: r.score for r in language_model.score_documents(docs, checksum_rest("doc_id", 10) == 0).collect()}
    texts = {r.doc_id: re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]+", lambda m: m[0].lower(), (r.text or "").encode())) for r in docs.collect()}
    learned = [words for i, words in texts.items() if zlib.crc32(str(i).encode()) % 10]
    counts, pairs = Counter(w for words in learned for w in words), Counter()
    counts[b"\n"] = len(learned)
    for words in learned:
        pairs.update(zip([b"\n", *words], [*words, b"\n"], strict=True))
    packed = language_model._deflated
    rows = [(bytearray(packed(b" ".join(w for w in counts if w != b"\n"))), bytearray(packed(np.ones(len(counts) - 1)))), (bytearray(packed(b"\n")), bytearray(packed([1])))]
    model = language_model.train(spark.createDataFrame(rows, "words binary, trained binary"))
    every = sorted({w for words in texts.values() for w in words} | {b"\n"})
    tree = dict(zip(every, model.word_log10(every), strict=True))
    total = sum(counts.values())

    def chance(before, word):
        alone = max(counts[word] - 0.75, 0) / total + 0.75 * len(counts) / total * 10 ** tree[word]
        return (pairs[before, word] + (counts[before] + 0.5) * alone) / (2 * counts[before] + 0.5)

    for i, words in texts.items():
        want = sum(math.log10(chance(a, b)) for a, b in zip([b"\n", *words], [*words, b"\n"], strict=True))
        assert abs(got[i] - want) < 1e-3 * max(1, len(words) / 100), i


def test_word_chances_sum_to_one():
    logs = np.log10([0.5, 0.2, 0.2, 0.1])
    counts, followers = np.array([5.0, 3.0, 1.0, 0.0]), np.array([2.0, 0.0, 1.0, 0.0])
    alone = language_model._word_mixture(counts, logs, 9, 3)
    assert abs((10**alone).sum() - 1) < 1e-9
    assert abs((10 ** language_model._pair_log10(followers, np.full(4, 3.0), alone)).sum() - 1) < 1e-9
    tiny = language_model._word_mixture(np.zeros(1), np.array([-5000.0]), 9, 3)
    assert np.isfinite(language_model._pair_log10(np.zeros(1), np.zeros(1), tiny)).all()


def test_held_out_scores_beat_the_base(spark):
    docs = read_table(spark, "/root/testdata/sf0.01", "documents")
    scores = language_model.score_documents(docs, checksum_rest("doc_id", 10) == 0).filter("held_out")
    found = scores.agg(F.sum("score").alias("score"), F.sum("base_score").alias("base")).head()
    assert found.score > 0.85 * found.base


def test_byte_predictions_sum_to_one(spark, monkeypatch):
    monkeypatch.setattr(language_model, "SLOTS", 1 << 16)
    words = [b"banana", b"bandana", b"bank", b"zz"]
    row = (bytearray(language_model._deflated(b" ".join(words))), bytearray(language_model._deflated([9, 3, 1, 2])))
    model = language_model.train(spark.createDataFrame([row], "words binary, trained binary"))
    _, data, contexts, depths = language_model._paths([b"bana"])
    for at in range(len(data)):
        each = np.arange(256, dtype=np.uint8)
        chance = 10 ** model.byte_log10(each, np.repeat(contexts[at : at + 1], 256, axis=0), np.repeat(depths[at], 256))
        assert abs(chance.sum() - 1) < 1e-4
    scores = model.word_log10([b"banana", b"bandana", b"quux"])
    assert scores[0] > scores[1] > scores[2]


def test_no_two_contexts_share_a_count(spark):
    """Counts of the tree against a dictionary of contexts, with many contexts at the last depth."""
    draw = random.Random(3)
    words = sorted({"".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=draw.randint(1, 12))).encode() for _ in range(30_000)})
    row = (bytearray(language_model._deflated(b" ".join(words))), bytearray(language_model._deflated(np.ones(len(words)))))
    model = language_model.train(spark.createDataFrame([row], "words binary, trained binary"))
    counts = Counter()
    for w in words:
        line = [1, *(b + 2 for b in w)]
        for at, byte in enumerate(w + b" "):
            context = sum(x << 9 * k for k, x in enumerate(reversed(line[max(0, at - 5) : at + 1])))
            if at >= 5:
                for k in range(8):
                    counts[context << 8 | (byte | 256) >> (8 - k), byte >> (7 - k) & 1] += 1
    nodes = {n for n, _ in counts}
    assert len(nodes) > 1 << 19 and sorted(nodes) == model.nodes[6].tolist()
    want = [(counts[n, 1] + 0.5) / (counts[n, 0] + counts[n, 1] + 1) for n in sorted(nodes)]
    assert np.allclose(model.kt[6], want)


# --- word pieces


def test_word_pieces(spark):
    draw = random.Random(6)
    for _ in range(400):
        begin, inside = (["".join(draw.choices("abc", k=draw.randint(1, 4))) for _ in range(7)] for _ in range(2))
        automaton = wordpiece.Automaton(begin, inside)
        vocabulary = {"[UNK]": 0} | {p: i + 1 for i, p in enumerate(dict.fromkeys([*begin, *(f"##{p}" for p in inside)]))}
        library = WordPiece(vocabulary, unk_token="[UNK]", max_input_chars_per_word=100)
        for _ in range(10):
            word = "".join(draw.choices("abc", k=draw.randint(1, 9)))
            pieces = [t.value for t in library.tokenize(word)]
            assert automaton.count(word) == (-1 if pieces == ["[UNK]"] else len(pieces))
    begin, inside = wordpiece.sentencepiece_vocabulary(packing.tokenizer_file("piece_bpe_32k.model"))
    got = wordpiece.count_tokens(odd_documents(spark), begin, inside).collect()
    counts = {(r.doc_id, r.n_words, r.n_unknown) for r in got}
    assert len(got) == 12 and {(0, 0, 0), (1, 0, 0), (2, 0, 0), (3, 60_000, 0), (4, 6, 0)} <= counts
    assert wordpiece.count_tokens(odd_documents(spark).limit(0), begin, inside).count() == 0


# --- segmentations


def test_segmentations(spark):
    model = packing.tokenizer_file("piece_bpe_32k.model")
    rows = [(1, 1, None), (1, 2, ""), (2, 1, "  two  blanks "), (2, 2, "▁ \x00 é 日本 😀"), (3, 1, "same"), (3, 1, "same"), (None, 4, LONG[:20_000])]
    frame = spark.createDataFrame([(*r, 5, [1]) for r in rows], "conv_id long, turn long, text string, sample long, ids array<int>")
    got = segmentation.sample_segmentations(frame, model, ["conv_id", "turn"]).collect()
    assert all(r.decodes and 0 < r.inclusion <= 1 and r.n_pieces == len(r.ids) for r in got)
    by_row = Counter((r.conv_id, r.turn) for r in got)
    assert by_row == {(1, 1): 1, (1, 2): 1, (2, 1): 4, (2, 2): 2, (3, 1): 8, (None, 4): 4}
    same = [tuple(r.ids) for r in got if r.conv_id == 3]
    assert len(set(same)) == 4
    assert segmentation.sample_segmentations(frame.limit(0), model, ["conv_id", "turn"]).count() == 0


def test_documents_and_turns_are_segmented(spark):
    for name, table, keys in (
        ("op5_sampled_segmentations", "documents", ["doc_id"]), ("op5_sampled_turns", "conversations", ["conv_id", "turn"])
    ):
        got = queries.QUERIES[name](spark, SF).select(*keys, "n_pieces", "decodes", F.size("ids").alias("ids")).collect()
        assert all(r.decodes and r.ids == r.n_pieces for r in got), name
        assert {tuple(r[k] for k in keys) for r in got} == {tuple(r) for r in read_table(spark, SF, table).select(*keys).collect()}


def test_samples_follow_the_lattice():
    vocabulary = segmentation.Vocabulary.load(packing.tokenizer_file("piece_bpe_32k.model"), sharpness=0.2)
    sampler, text = segmentation.Sampler(vocabulary), "the"

    def paths(arcs, at=0):
        if at == len(arcs):
            return [((), 0.0)]
        return [(ids + rest, logp + more) for end, ids, logp in arcs[at] for rest, more in paths(arcs, end)]

    (arcs,) = sampler.lattices(text)
    chances = {ids: math.exp(logp) for ids, logp in paths(arcs)}
    assert abs(sum(chances.values()) - 1) < 1e-9
    first, weight, n = Counter(), Counter(), 4000
    for seed in range(n):
        drawn = sampler.sample(text, 3, seed)
        assert len({tuple(d[0]) for d in drawn}) == 3
        assert all(abs(math.exp(logp) - chances[tuple(ids)]) < 1e-9 for ids, logp, _ in drawn)
        first[tuple(drawn[0][0])] += 1
        for ids, _, inclusion in drawn:
            weight[tuple(ids)] += 1 / inclusion
    assert all(abs(first[ids] / n - p) < 0.03 for ids, p in chances.items())
    # weighing each sampled path by 1 / inclusion estimates sums over all paths
    assert abs(sum(weight[ids] / n * p for ids, p in chances.items()) - 1) < 0.03


def test_samples_depend_on_the_text_and_its_seed_alone():
    """Not on the batch, the store or the order; a very long text is taken whole."""
    vocabulary = segmentation.Vocabulary.load(packing.tokenizer_file("piece_bpe_32k.model"))
    texts = ["the cat  sat", "", LONG, "▁ \x00 é 日本 😀", "the cat  sat", " ", "日本語" * 200, "x" * 300]
    seeds = [3, 1, 4, -1, 3, 9, 2, 6]
    sampler = segmentation.Sampler(vocabulary)
    owners, ids, ends, logps, inclusions = sampler.sample_all(texts, 4, seeds)
    found = list(zip(owners, [tuple(c.tolist()) for c in np.split(ids, ends[:-1])], logps, inclusions, strict=True))
    for number in reversed(range(len(texts))):
        alone = segmentation.Sampler(vocabulary).sample(texts[number], 4, seeds[number])
        assert [(number, tuple(i), lp, inc) for i, lp, inc in alone] == [f for f in found if f[0] == number]
    assert all(segmentation.decode(list(i), vocabulary) == texts[n] for n, i, _, _ in found)
    # no piece joins two of these letters, so there is one path
    assert [len({i for n, i, _, _ in found if n == number}) for number in (0, 2, 6, 7)] == [4, 4, 1, 4]


def test_lattices_equal_a_plain_recursion():
    vocabulary = segmentation.Vocabulary.load(packing.tokenizer_file("piece_bpe_32k.model"))
    sampler = segmentation.Sampler(vocabulary)
    for part in (" the", "  blanks", " ", " 日本é😀", " under▁line", " \x00", " internationalization", " " + "ab" * 40):
        pieces = {}
        for start in range(len(part)):
            for end in range(start + 1, len(part) + 1):
                shown = part[start:end].replace("▁", "\0").replace(" ", "▁")
                if shown in vocabulary.pieces:
                    number, weight = vocabulary.pieces[shown]
                    pieces[start, end] = (number,), weight
            if (start, start + 1) not in pieces:
                spelled = part[start].encode()
                pieces[start, start + 1] = tuple(vocabulary.bytes[b] for b in spelled), vocabulary.byte_cost * len(spelled)
        after = {len(part): 0.0}
        for start in reversed(range(len(part))):
            after[start] = np.logaddexp.reduce([w + after[e] for (s, e), (_, w) in pieces.items() if s == start])
        (arcs,) = sampler.lattices(part[1:])
        got = {(start, end): (ids, share) for start, some in enumerate(arcs) for end, ids, share in some}
        assert {k: ids for k, (ids, _) in got.items()} == {k: ids for k, (ids, _) in pieces.items()}
        assert all(abs(share - (pieces[s, e][1] + after[e] - after[s])) < 1e-9 for (s, e), (_, share) in got.items())


# --- pipeline


def test_pipeline_stages(spark):
    docs = read_table(spark, SF, "documents")
    odd = spark.createDataFrame([(9001, None), (9002, ""), (None, None), (9003, "123")], "doc_id long, text string")
    kept = docs.unionByName(odd, allowMissingColumns=True)
    before = kept
    for name, stage in corpus_pipeline.STAGES[:3]:
        after = stage(spark, before, SF)
        assert after.columns == docs.columns
        after = spark.createDataFrame(after.collect(), docs.schema)
        assert not after.exceptAll(before).head(1), name
        before = after
    ids = [r.doc_id for r in before.collect()]
    assert len(set(ids)) == len(ids) and not {9001, 9002, 9003, None} & set(ids)
    prints = [brute_fingerprint(r.text) for r in before.collect()]
    far = np.bitwise_count(np.array(prints, np.uint64)[:, None] ^ np.array(prints, np.uint64)[None, :])
    assert (far + 64 * np.eye(len(prints), dtype=int) > 4).all()
    assert len(ids) > 0.7 * docs.count()
    packed = corpus_pipeline.STAGES[3][1](spark, before, SF)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == set(ids)
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0


def test_executors_need_no_copy_of_the_repository(tmp_path):
    """Task functions and models travel by value."""
    code = f"""
import sys
sys.path.insert(0, {str(Path(corpus_pipeline.__file__).parent)!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").getOrCreate()
import __spark_entry__ as entry
for name, run in entry.queries().items():
    if name.startswith("op") and name[2].isdigit():
        assert run(spark, {SF!r}).count() > 0, name
"""
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=600)
    assert done.returncode == 0, done.stderr[-2000:]


def test_rows_that_share_an_id_keep_their_texts(spark):
    """Only near copies go, whatever their ids; columns named as those inside stay."""
    long = [" ".join(f"{w}{i}" for i in range(120)) for w in "abc"]
    rows = [(1, long[0]), (1, long[1]), (2, long[1] + " end"), (None, long[2]), (3, long[2]), (None, "alone here"), (1, long[0])]
    rows = [(i, t, f"g{n}", n) for n, (i, t) in enumerate(rows)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, grp string, __row long")
    kept = corpus_pipeline.without_near_copies(spark, docs, SF)
    assert kept.columns == docs.columns
    got = sorted((r.doc_id, r.text) for r in kept.collect() if r.doc_id is not None)
    assert got == [(1, long[0]), (1, long[1]), (3, long[2])]
    assert [r.text for r in kept.collect() if r.doc_id is None] == ["alone here"]


def test_few_words_are_in_memory_at_a_time(monkeypatch):
    """n-grams of two megabytes of distinct words, and scores that do not depend on runs."""
    words = [f"wörd{i}" for i in range(200_000)]
    tracemalloc.start()
    total = sum(len(slot) for _, _, slot in langid._gram_runs(words))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100 << 20 and total == len(langid._grams(words)[0])
    rnd = np.random.default_rng(1)
    logp = rnd.normal(size=(2, langid.SLOTS)).astype(np.float32)
    model = langid.Model(["de", "en"], logp, np.ones((2, len(langid._NAMES)), bool), 0)
    some, is_letter = ["a", "ab", "wörd", "12", "x" * 300, "ελ", "abc"] * 3, langid.letter_table()
    _, whole = langid.score_words(some, model, is_letter)
    monkeypatch.setattr(langid, "_RUN", 2)
    _, cut = langid.score_words(some, model, is_letter)
    assert np.allclose(whole, cut)
    for word, score in zip(some, cut, strict=True):  # every n-gram of the word between two blanks
        marked, slots = f" {word} ", []
        for n in langid.ORDERS:
            for i in range(len(marked) - n + 1):
                gram = marked[i : i + n]
                if gram.strip():
                    value = n
                    for c in gram:
                        value = (value * 0x100000001B3 + ord(c)) % 2**64
                    slots.append(int(mix64(np.array([value], np.uint64))[0] % langid.SLOTS))
        want = logp[:, slots].astype(float).sum(axis=1) / len(langid.ORDERS)
        assert np.allclose(score, want if any(map(str.isalpha, word)) else 0, rtol=1e-4, atol=1e-4), word
