"""Merkle manifests against a plain tree in Python."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tarn.llm import merkle
from tarn.llm.queries import QUERIES

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, text, lang, source, n_chars):
    values = (doc_id, source, lang, n_chars, text)
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(nodes):
    """The top of a list of digests, and for each the siblings (left, right) of every level."""
    steps, place = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i : i + 3] for i in range(0, len(nodes), 3)]
        for i, at in enumerate(place):
            run, own = runs[at // 3], at % 3
            steps[i].append(("".join(run[:own]), "".join(run[own + 1 :])))
            place[i] = at // 3
        nodes = [sha(*run) for run in runs]
    return nodes[0], steps


def expected(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[3], []).append(row)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for name in names:
        groups[name].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
        trees[name] = climb([leaf(*r) for r in groups[name]])
    root, above = climb([trees[n][0] for n in names])
    out = []
    for name, upper in zip(names, above, strict=True):
        subroot, steps = trees[name]
        for row, own in zip(groups[name], steps, strict=True):
            path = own + upper
            node = leaf(*row)
            if zlib.crc32(("" if row[0] is None else str(row[0])).encode()) % 2 == 0 and row[1] is not None:
                node = leaf(row[0], row[1].replace("\n", ""), *row[2:])
            for left, right in path:
                node = sha(left, node, right)
            out.append((row[0], leaf(*row), subroot, root, sha(*(a + b for a, b in path)), node, node == root))
    return sorted(out, key=repr)


def table(spark, tmp_path, rows):
    spark.createDataFrame(rows, DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    return str(tmp_path)


@pytest.mark.parametrize("size", [0, 1, 2, 3, 4, 28, 730])
def test_every_size_of_a_tree(spark, tmp_path, size):
    rows = [(i, f"text {i}\nmore", "en", "one", i) for i in range(size)]
    got = QUERIES["op13_merkle_manifest"](spark, table(spark, tmp_path, rows))
    assert sorted(map(tuple, got.collect()), key=repr) == (expected(rows) if rows else [])


def test_odd_rows_and_a_hot_source(spark, tmp_path):
    """Null fields, empty and very long texts, repeated ids and rows, null, empty and
    non-Latin sources, and a source with two passes of blocks."""
    rows = [(i, f"line {i}\n\nend", None, "hot", None) for i in range(2_500)]
    rows += [(7, "same\n", "en", "hot", 3)] * 400
    rows += [(None, None, None, None, None), (None, "x\n", "en", None, 1), (-5, "", "", "", 0)]
    rows += [(i, "word \n" * 60_000, "de", s, 9) for i, s in enumerate(["é", "z", "Z", "日本", "😀", "￿"])]
    rows += [(100 + i, "t", "en", f"s{i:03}", i) for i in range(40)]
    got = QUERIES["op13_merkle_manifest"](spark, table(spark, tmp_path, rows))
    assert sorted(map(tuple, got.collect()), key=repr) == expected(rows)


def test_many_groups(spark, tmp_path):
    """A tree over more groups than one block holds."""
    rows = [(i, "t\n", "en", f"s{i % 1_500}", i) for i in range(2_000)]
    got = QUERIES["op13_merkle_manifest"](spark, table(spark, tmp_path, rows))
    assert sorted(map(tuple, got.collect()), key=repr) == expected(rows)


def test_only_the_changed_leaf_fails(spark):
    """The operator's own interface: further columns stay, with names as used inside."""
    rows = [(i, i % 3, f"row {i}", "kept") for i in range(100)]
    frame = spark.createDataFrame(rows, "n long, g long, rank string, digest string")
    leaves = frame.withColumn("own leaf", merkle.leaf_digest(F.col("n"), F.col("rank")))
    proven = merkle.prove(leaves, "g", ["n"], "own leaf")
    assert proven.columns == ["n", "g", "rank", "digest", "own leaf", "subroot", "root", "steps"]
    other = F.when(F.col("n") == 40, merkle.leaf_digest(F.col("n"), F.lit("forged"))).otherwise(F.col("own leaf"))
    wrong = proven.filter(merkle.folded(other, F.col("steps")) != F.col("root")).collect()
    assert [r.n for r in wrong] == [40] and wrong[0].digest == "kept"
    with pytest.raises(ValueError, match="already"):
        merkle.prove(leaves.withColumn("root", F.lit(1)), "g", ["n"], "own leaf")


def test_one_exchange_per_pass(spark, tmp_path):
    """The digits of a block are grouped away without a further shuffle."""
    path = str(tmp_path / "nodes")
    spark.range(100).selectExpr("id % 2 AS g", "50L AS n", "id AS rank", "'x' AS digest", "struct(id) AS row").write.parquet(path)
    plan = merkle._rolled(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Window" not in plan
