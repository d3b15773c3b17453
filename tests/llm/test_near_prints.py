"""The fingerprints' part in the near-dedup stage."""

import random

import numpy as np

import corpus_pipeline
from tarn.llm import near_copies

SF = "/root/testdata/sf0.001"


def test_near_fingerprints_meet_without_shared_keys(spark, monkeypatch):
    """Near copies meet by their fingerprints alone, if they share no min-hash key."""
    monkeypatch.setattr(near_copies, "band_keys", lambda shingles: np.zeros(0, np.int64))
    draw = random.Random(2)
    texts = [[f"w{draw.randrange(9_000)}" for _ in range(500)] for _ in range(6)]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    rows += [(10 + i, " ".join([*t, "more"])) for i, t in enumerate(texts)]  # one shingle more
    kept = corpus_pipeline.without_near_copies(spark, spark.createDataFrame(rows, "doc_id long, text string"), SF)
    assert sorted(r.doc_id for r in kept.collect()) == list(range(6))
