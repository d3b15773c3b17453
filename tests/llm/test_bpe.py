"""BPE by a queue of merges against the tokenizers library and a plain merge loop."""

import hashlib
import random

import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tarn.llm import bpe
from tarn.llm.packing import tokenizer_file
from tarn.llm.queries import QUERIES

FILES = ["word_bpe_49k.json", "byte_bpe_50k.json"]
ODD = [
    "", " ", "a", "Hello, WORLD don't 12 café", "ÀÉ'S 'll'D it''s '", "a\x0bb\x85c\xa0d\x1de\x1ff",
    "<|endoftext|><|startoftext|>x<|end", "é 中文 😀😀 — “q”", "İΣ ﬁ Å", "x" * 3_000, "ab" * 5_000 + "!?" * 300,
    " ".join(f"word{i}." for i in range(60_000)), "\x01a \x02b \x00",
]


@pytest.fixture(scope="module", params=FILES)
def both(request):
    path = tokenizer_file(request.param)
    with open(path, "rb") as file:
        return bpe.Encoder(bpe.Merges(file.read())), Tokenizer.from_file(path)


def test_ids_equal_the_library(both):
    encoder, library = both
    rnd = random.Random(3)
    letters = "abcdeABC 's't1 2.,!?\n\té’—ßÆ"
    texts = ODD + ["".join(rnd.choice(letters) for _ in range(rnd.randrange(60))) for _ in range(2_000)]
    texts += [f"a{chr(i)}B {chr(i)}{chr(i)} {chr(i)}'s" for i in range(1, 0x500)]
    ids, ends = encoder.encode(pa.array(texts))
    for i, text in enumerate(texts):
        assert ids[ends[i] : ends[i + 1]].tolist() == library.encode(text, add_special_tokens=False).ids, repr(text[:80])


def test_merges_equal_the_plain_rule(both):
    """The best-ranked pair, leftmost first, merged until none is left."""
    merges = both[0].merges
    rnd = random.Random(5)
    for _ in range(500):
        part = "".join(rnd.choice("aeinorst") for _ in range(rnd.randrange(1, 30)))
        ids = [merges.vocabulary[c] for c in part[:-1]] + [merges.vocabulary[part[-1] + merges.ending]]
        while True:
            ranks = [merges.rank.get(a * merges.size + b, 1 << 40) for a, b in zip(ids, ids[1:], strict=False)]
            if not ranks or min(ranks) == 1 << 40:
                break
            at = ranks.index(min(ranks))
            ids[at : at + 2] = [merges.made[ranks[at]]]
        assert merges.merge(part) == ids


def test_forgetting_parts_changes_nothing(both, monkeypatch):
    encoder, library = both
    monkeypatch.setattr(bpe, "_CACHE_PARTS", 3)
    texts = pa.array(["some words here", "and some more words", None, "here"])
    for _ in range(3):
        ids, ends = encoder.encode(texts)
        for i, text in enumerate(texts.to_pylist()):
            want = library.encode(text or "", add_special_tokens=False).ids
            assert ids[ends[i] : ends[i + 1]].tolist() == want


@pytest.mark.parametrize("file", FILES)
def test_rows_in_and_out(spark, file):
    """Nulls, repeated rows and ids, empty tables, clashing extra columns; decoding as the library does."""
    path, library = tokenizer_file(file), Tokenizer.from_file(tokenizer_file(file))
    texts = [*ODD, None, "twice", "twice"]
    rows = [(None if i == 2 else i // 2, t, "x") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    coded = bpe.encode_texts(docs, path)
    assert coded.columns == ["doc_id", "ids"]
    got = bpe.decode_ids(coded.selectExpr("doc_id", "size(ids) AS n", "ids"), path).collect()
    want = []
    for key, text, _ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        want.append((key, len(ids), library.decode(ids, skip_special_tokens=False)))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    empty = bpe.decode_ids(bpe.encode_texts(docs.limit(0), path), path)
    assert empty.collect() == []
    lists = spark.createDataFrame([(1, None), (2, []), (3, [5, None, -4, 10**6])], "k int, ids array<int>")
    decoded = {r.k: r.decoded for r in bpe.decode_ids(lists, path).collect()}
    assert decoded == {1: None, 2: "", 3: library.decode([5], skip_special_tokens=False)}
    with pytest.raises(ValueError, match="already"):
        bpe.decode_ids(lists.selectExpr("k AS decoded", "ids"), path)


def test_query_equals_the_library(spark):
    sf_dir = "/root/testdata/sf0.001"
    library = Tokenizer.from_file(tokenizer_file())
    want = set()
    for row in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        ids = library.encode(row.text or "", add_special_tokens=False).ids
        texts = " ".join(map(str, ids)), library.decode(ids, skip_special_tokens=False)
        want.add((row.doc_id, len(ids), *(hashlib.sha256(t.encode()).hexdigest() for t in texts)))
    got = QUERIES["op11_merge_queue_bpe"](spark, sf_dir)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert {tuple(r) for r in got.collect()} == want
