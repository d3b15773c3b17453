"""Parts of texts, the trie of pieces and the store of lattices."""

import random

import numpy as np

from tarn.llm import packing, segmentation


def sampler():
    return segmentation.Sampler(segmentation.Vocabulary.load(packing.tokenizer_file("piece_bpe_32k.model")))


def test_parts_equal_the_pattern():
    draw, own = random.Random(4), sampler()
    texts = ["", " ", "  ", "a", " a", "a ", "日本 é  😀 ", "line\nnext\ttab"]
    texts += ["".join(draw.choices(["a", "bé", " ", "日"], k=draw.randrange(30))) for _ in range(300)]
    for text, bases, starts in zip(texts, *own._cut(texts), strict=True):
        parts = segmentation._PART.findall(" " + text) if text else []
        assert bases.tolist() == [own.known[p[1:]] for p in parts]
        assert starts.tolist() == np.cumsum([0, *map(len, parts)]).tolist()


def test_edges_that_meet_and_edges_that_are_none():
    v = sampler().vocabulary
    assert len(v.others)  # some edges share a place of the table
    draw = np.random.default_rng(2)
    none = np.setdiff1d(draw.integers(0, len(v.piece_at) << 21, 200_000), v.edges)
    asked = draw.permutation(np.concatenate((v.edges, none)))
    on, edges = v.edges_of(asked)
    assert np.array_equal(on, np.isin(asked, v.edges)) and np.array_equal(v.edges[edges], asked[on])


def test_draws_do_not_depend_on_what_is_kept(monkeypatch):
    """A store that grows, and one that is cleared between batches and written again."""
    texts = [f"word{i} and other{i * i} things" for i in range(60)]
    kept, cleared = sampler(), sampler()
    first = [kept.sample(t, 3, i) for i, t in enumerate(texts)]
    monkeypatch.setattr(segmentation, "_CACHE_ARCS", 100)
    assert [cleared.sample(t, 3, i) for i, t in enumerate(texts)] == first
    assert len(cleared.known) < len(kept.known) and cleared.n_arcs < kept.n_arcs <= len(kept.share)


def test_spelling_leaves_the_store_as_it_is():
    own = sampler()
    text = "\x00\x01 é😀\x02 \x00"
    before = [own.lattices(text), own.piece[: own.n_arcs].tolist(), own.sample(text, 2, 5)]
    assert [own.lattices(text), own.piece[: own.n_arcs].tolist(), own.sample(text, 2, 5)] == before
    assert segmentation.decode(before[2][0][0], own.vocabulary) == text


def test_parts_learnt_together_are_as_if_learnt_alone():
    """Also those of only blanks, which a piece of blanks could leave."""
    texts = [" ", "a  ", "   ", "▁ ", "the end", " \x00 😀 "]
    together = sampler()
    assert any(len(p) > 1 and not p.strip(segmentation.BLANK) for p in together.vocabulary.pieces)
    _, starts = together._cut(texts)
    for text, start in zip(texts, starts, strict=True):
        n_arcs, alone = together.n_arcs, sampler()
        assert together.lattices(text) == alone.lattices(text) and len(alone.lattices(text)) == len(start) - 1
        assert together.n_arcs == n_arcs  # nothing had to be learnt again
    bases = together._learn(["new", "", "newer"])
    assert bases.tolist() == [together.known[w] for w in ("new", "", "newer")]


def test_draws_do_not_depend_on_how_many_steps_are_weighed_first(monkeypatch):
    texts = ["a", "", "some words and others, " * 30, "日本 é  😀 " * 20]
    found = []
    for near in (1, 3, segmentation._NEAR, 10**6):
        monkeypatch.setattr(segmentation, "_NEAR", near)
        found.append([sampler().sample(t, 4, i) for i, t in enumerate(texts)])
    assert all(f == found[0] for f in found)
