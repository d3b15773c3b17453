"""Operators over vectors and pages, against brute force and on odd tables."""

import base64
import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarn.llm import exact_search, vector_dedup, warc
from tarn.llm.common import least_labels
from tarn.llm.components import with_component
from tarn.session import scratch_path


def vectors(spark):
    draw = np.random.default_rng(8)
    rows = []
    for center in draw.normal(size=(6, 8)):
        for _ in range(25):
            rows.append((center + 0.15 * draw.normal(size=8)).tolist())
    rows += [rows[0]] * 4 + [[0.0] * 8, [float("nan")] * 8, [float("inf"), *[1.0] * 7], None, [None, *[1.0] * 7], [], [1e200] * 8]
    labelled = [(i, v, None if i % 29 == 28 else i % 2, "l", 1) for i, v in enumerate(rows)]
    labelled += [(3, rows[9], 1, "l", 1), (3, rows[3], 1, "l", 1), (None, rows[0], 0, "l", 1)]
    return spark.createDataFrame(labelled, "vec_id long, embedding array<double>, label int, node string, links long")


def usable(v):
    return v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v)


@pytest.mark.parametrize(("slice_rows", "small"), [(7, 64), (2_048, 64), (2_048, 1), (7, 3)])
def test_links_equal_brute_force(spark, monkeypatch, slice_rows, small):
    monkeypatch.setattr(vector_dedup, "SLICE", slice_rows)
    monkeypatch.setattr(vector_dedup, "_SMALL", small)
    monkeypatch.setattr(vector_dedup, "_RUN_ROWS", 50)
    df = vectors(spark)
    rows = df.collect()
    unit = [np.array(r.embedding) / np.abs(r.embedding).max() if usable(r.embedding) and any(r.embedding) else None for r in rows]
    unit = [None if u is None else u / np.linalg.norm(u) for u in unit]
    n = len(rows)
    linked = np.zeros((n, n), bool)
    for i in range(n):
        for j in range(n):
            a, b = rows[i], rows[j]
            if i != j and unit[i] is not None and unit[j] is not None and None not in (a.label, a.vec_id, b.vec_id):
                linked[i, j] = a.label == b.label and unit[i] @ unit[j] >= 0.93
    same = np.array([[a.vec_id is not None and a.vec_id == b.vec_id for b in rows] for a in rows])
    order = sorted(range(n), key=lambda i: (rows[i].vec_id is None, rows[i].vec_id or 0))
    label = least_labels(n, *np.nonzero((linked | same)[np.ix_(order, order)]))
    want = sorted(
        (-1, 0, -1) if rows[i].vec_id is None else (rows[i].vec_id, int(linked[i].sum()), rows[order[label[at]]].vec_id)
        for at, i in enumerate(order)
    )
    got = vector_dedup.near_vectors(df).collect()
    as_number = lambda x: -1 if x is None else x
    assert sorted((as_number(r.vec_id), r.n_links, as_number(r.component_id)) for r in got) == want
    assert all(r.kept == (r.vec_id == r.component_id) for r in got if r.vec_id is not None)
    assert vector_dedup.near_vectors(df.limit(0)).count() == 0


def test_pairs_near_the_threshold_are_found_at_every_size_of_key():
    draw = np.random.default_rng(5)
    for rows in (100, 100_000, 10_000_000):
        bits, tables = vector_dedup.key_shape(rows)
        assert 2**bits >= 4 * rows
        a = draw.normal(size=(400, 64))
        a /= np.linalg.norm(a, axis=1, keepdims=True)
        aside = draw.normal(size=a.shape)
        aside -= (aside * a).sum(axis=1, keepdims=True) * a
        aside /= np.linalg.norm(aside, axis=1, keepdims=True)
        cosine = draw.uniform(0.93, 0.95, size=(400, 1))
        b = cosine * a + np.sqrt(1 - cosine**2) * aside
        together = vector_dedup.signatures(a, bits, tables) == vector_dedup.signatures(b, bits, tables)
        assert together.any(axis=1).mean() >= 0.99


def test_a_chain_is_one_component(spark):
    edges = spark.range(1, 300).select(F.col("id"), (F.col("id") - 1).alias("before")).orderBy(F.rand(3))
    found = with_component(spark.range(305).union(spark.range(1)), "id", edges)
    assert found.groupBy("component_id").count().count() == 6 and found.filter("component_id = 0").count() == 301


def test_search_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(exact_search, "BLOCK_ROWS", 16)
    monkeypatch.setattr(exact_search, "BATCH_ROWS", 4)
    draw = np.random.default_rng(9)
    rows = [(i, draw.integers(-40, 40, 6).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[7][1]) for i in range(20)]  # ties
    rows += [(2000, None), (2001, [1, None, 2]), (None, [1] * 6), (50, rows[51][1]), (2002, [3, 4]), (2003, [2**33] * 6)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, v array<long>, pivot string, score int")
    taken = [(i, [*v, *[0] * (6 - len(v))]) for i, v in rows if i is not None and v is not None and None not in v]
    want = []
    for q in range(0, 300, 50):
        vector = min(v for i, v in taken if i == q)
        scored = sorted((-sum(a * b for a, b in zip(vector, v, strict=True)), i) for i, v in taken if i != q)
        want += [(q, rank, i, -s) for rank, (s, i) in enumerate(scored[:5], 1)]
    asks = (F.col("vec_id") < 300) & (F.col("vec_id") % 50 == 0)
    got = exact_search.top_products(df, asks, "vec_id", "v")
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert exact_search.top_products(df.limit(0), asks, "vec_id", "v").count() == 0
    few = exact_search.top_products(df.filter("vec_id IN (0, 1, 2)"), asks, "vec_id", "v").collect()
    assert sorted((r.rank, r.vec_id) for r in few)[0][0] == 1 and len(few) == 2


def test_a_digest_is_made_without_a_lambda(spark):
    """A lambda over the 32 digits made the payload's SHA-1 anew for each of them."""
    df = spark.range(500).select(F.repeat("id", F.col("id").cast("int")).cast("binary").alias("p"))
    df = df.select("p", warc.base32_sha1(F.col("p")).alias("digest"))
    assert all(r.digest == base64.b32encode(hashlib.sha1(r.p).digest()).decode() for r in df.collect())
    assert "lambda" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_archive_round_trip(spark):
    big = "é" * 300_000
    payloads = [b"same", b"same", b"same", b"", None, big.encode(), b"\r\n\r\nWARC/1.1\r\n", bytes(range(256)), b"same"]
    uris = ["http://a", None, "http://c\r\nX: y", "", "http://e", "u", "v", "w", "x"]
    keys = [1, 2, 9, 4, 5, 6, 7, 8, None]
    rows = [(k, u, None if p is None else bytearray(p), "clash") for k, u, p in zip(keys, uris, payloads, strict=True)]
    df = spark.createDataFrame([*rows, rows[0]], "key long, uri string, payload binary, address string")
    path = scratch_path(spark, "archive")
    warc.write_archive(df, path)
    archive = warc.read_archive(spark, path)
    assert sorted(bytes(r.payload) for r in archive.collect()) == sorted(p or b"" for p in [*payloads, payloads[0]])
    assert spark.read.parquet(f"{path}/payloads").count() == 5
    got = {(r.key, r.record_type, r.refers_to) for r in warc.described(archive).collect()}
    assert got == {
        (1, "revisit", 9), (2, "revisit", 9), (9, "response", None), (None, "revisit", 9), (4, "revisit", 5),
        (5, "response", None), (6, "response", None), (7, "response", None), (8, "response", None),
    }
    for r in warc.whole_records(archive).collect():
        head, _, rest = bytes(r.record).partition(b"\r\n\r\n")
        fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])
        assert head.startswith(b"WARC/1.1\r\n") and len(rest) == int(fields[b"Content-Length"]) + 4 and rest.endswith(b"\r\n\r\n")
    stored = spark.read.parquet(f"{path}/payloads")
    other = scratch_path(spark, "archive")
    spark.read.parquet(f"{path}/headers").write.parquet(f"{other}/headers")
    wrong = F.lit(hashlib.sha256(b"else").hexdigest())
    stored.withColumn("address", wrong).limit(1).unionByName(stored).write.parquet(f"{other}/payloads")
    spark.read.parquet(f"{path}/headers").limit(1).withColumn("address", wrong).write.mode("append").parquet(f"{other}/headers")
    with pytest.raises(Exception, match="is damaged"):
        warc.read_archive(spark, other).collect()
    empty = scratch_path(spark, "archive")
    warc.write_archive(df.limit(0), empty)
    assert warc.read_archive(spark, empty).count() == 0
