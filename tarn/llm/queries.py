"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tarn.llm import (
    bpe,
    exact_search,
    langid,
    language_model,
    merkle,
    packing,
    prefix_trie,
    segmentation,
    simhash,
    toxicity,
    vector_dedup,
    warc,
    wordpiece,
)
from tarn.llm.common import checksum_rest, read_table
from tarn.session import scratch_path, stage

QUERIES: dict = {}
SQL: dict[str, str] = {}


def registered(run):
    QUERIES[run.__name__] = run
    return run


@registered
def op4_best_fit_packing(spark, sf_dir):
    return packing.pack_documents(read_table(spark, sf_dir, "documents"), packing.tokenizer_file())


@registered
def op7_simhash_near_dedup(spark, sf_dir):
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"))


@registered
def op6_language_id(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    held_out = checksum_rest("doc_id", 3) == 1
    model = langid.train(docs.filter(~held_out), "text", "lang")
    return langid.identify(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@registered
def op10_weak_supervision_toxicity(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    held_out = checksum_rest("doc_id", 5) == 0
    model = toxicity.train(docs.filter(~held_out), read_table(spark, sf_dir, "labels"))
    return toxicity.score_texts(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


@registered
def pipeline(spark, sf_dir):
    from corpus_pipeline import run

    return run(spark, sf_dir)


@registered
def op9_context_tree_scores(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    return language_model.score_documents(docs, checksum_rest("doc_id", 10) == 0, running=True)


@registered
def op1_exact_top_products(spark, sf_dir):
    rows = read_table(spark, sf_dir, "embeddings")
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * 256))
    vectors = rows.filter(F.col("embedding").isNotNull() & finite).select("vec_id", whole.alias("vector"))
    return exact_search.top_products(vectors, F.col("vec_id") % 50 == 0, "vec_id", "vector")


SQL["op1_exact_top_products"] = """
    WITH v AS (
        SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS z FROM embeddings
        WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), pairs AS (
        SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.z, c.z)::BIGINT AS score
        FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
    ), ranked AS (
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM pairs
    )
    SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5"""


@registered
def op2_content_addressed_warc(spark, sf_dir):
    pages = read_table(spark, sf_dir, "pages")
    records = pages.select(
        F.col("page_id").alias("key"), F.col("url").alias("uri"), F.encode("html", "UTF-8").alias("payload")
    )
    path = scratch_path(spark, "warc")
    warc.write_archive(records, path)
    return warc.described(warc.read_archive(spark, path)).withColumnRenamed("key", "page_id")


SQL["op2_content_addressed_warc"] = """
    WITH p AS (
        SELECT page_id, encode(coalesce(html, '')) AS payload, sha1(coalesce(html, '')) AS h,
               max(page_id) OVER (PARTITION BY coalesce(html, '')) AS newest
        FROM pages
    )
    SELECT page_id, octet_length(payload)::BIGINT AS payload_bytes,
           list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
               1 + ((('0x' || substr(h, 1 + 10 * (i // 8), 10))::BIGINT >> (35 - 5 * (i % 8))) & 31)::INT, 1)),
               'string_agg', '') AS payload_digest,
           CASE WHEN newest IS NULL OR page_id IS NOT DISTINCT FROM newest THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN newest IS NULL OR page_id IS NOT DISTINCT FROM newest THEN NULL ELSE newest END AS refers_to
    FROM p"""


@registered
def op3_vector_near_dedup(spark, sf_dir):
    return vector_dedup.near_vectors(read_table(spark, sf_dir, "embeddings"))


@registered
def op5_sampled_segmentations(spark, sf_dir):
    model = packing.tokenizer_file("piece_bpe_32k.model")
    return segmentation.sample_segmentations(read_table(spark, sf_dir, "documents"), model, ["doc_id"])


@registered
def op5_sampled_turns(spark, sf_dir):
    model = packing.tokenizer_file("piece_bpe_32k.model")
    return segmentation.sample_segmentations(read_table(spark, sf_dir, "conversations"), model, ["conv_id", "turn"])


@registered
def op8_word_piece_counts(spark, sf_dir):
    begin, inside = wordpiece.sentencepiece_vocabulary(packing.tokenizer_file("piece_bpe_32k.model"))
    return wordpiece.count_tokens(read_table(spark, sf_dir, "documents"), begin, inside)


@registered
def op11_merge_queue_bpe(spark, sf_dir):
    path = packing.tokenizer_file()
    ids = bpe.encode_texts(read_table(spark, sf_dir, "documents"), path)
    digest = F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256)
    counted = ids.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), digest.alias("ids_sha256"), "ids")
    return bpe.decode_ids(counted, path).withColumn("decoded_sha256", F.sha2("decoded", 256)).drop("decoded")


@registered
def op13_merkle_manifest(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    head = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    without_breaks = merkle.leaf_digest(*head, F.replace("text", F.lit("\n"), F.lit("")))
    leaves = docs.select(
        "doc_id", "source", merkle.leaf_digest(*head, F.col("text")).alias("leaf"),
        F.when(checksum_rest("doc_id", 2) == 0, without_breaks).alias("tampered"),
    )
    proven = merkle.prove(leaves, "source", ["doc_id"], "leaf")
    back = merkle.folded(F.coalesce("tampered", "leaf"), F.col("steps"))
    proven = proven.select(
        "doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("steps")).alias("proof_sha256"),
        back.alias("folded_root"),
    )
    return proven.withColumn("verified", F.col("folded_root") == F.col("root"))


#: crc32 of a key as decimal text, in SQL.
CRC32_SQL = """xor(4294967295, list_reduce(
    list_transform(range(1, 1 + len({key}::VARCHAR)), lambda j: ascii(substr({key}::VARCHAR, j::INT, 1))::BIGINT),
    lambda c, b: list_reduce(range(8), lambda x, k: xor(x >> 1, (x & 1) * 3988292384), xor(c, b)), 4294967295::BIGINT))"""


def _merkle_sql(levels: int = 14) -> str:
    """Level by level, for groups of up to 3^levels nodes."""

    def field(x):
        return f"CASE WHEN {x} IS NULL THEN '-' ELSE strlen({x}::VARCHAR) || ':' || {x}::VARCHAR END"

    def leaf(text):
        return "sha256(" + " || ".join(map(field, ["doc_id", "source", "lang", "n_chars", text])) + ")"

    def tree(name, first):
        """CTEs of nodes `{name}{k}` (g, n, i, h) and their siblings `{name}s{k}`."""
        parts = [f"{name}0 AS ({first})"]
        for k in range(levels):
            over = "OVER (PARTITION BY g, i // 3 ORDER BY i ROWS BETWEEN"
            parts.append(f"""{name}s{k} AS (SELECT *,
                coalesce(string_agg(h, '') {over} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
                coalesce(string_agg(h, '') {over} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {name}{k})""")
            parts.append(f"""{name}{k + 1} AS (SELECT g, n, i // 3 AS i, CASE WHEN n <= {3**k} THEN min(h)
                ELSE sha256(string_agg(h, '' ORDER BY i)) END AS h FROM {name}{k} GROUP BY g, n, i // 3)""")
        return parts

    def climb(name, first, nodes):
        """CTEs that take rows (g, i, f, p) up: f the folded digest, p the siblings so far."""
        parts = [f"{name}0 AS ({first})"]
        for k in range(levels):
            parts.append(f"""{name}{k + 1} AS (SELECT c.* REPLACE (
                CASE WHEN s.n <= {3**k} THEN f ELSE sha256(s.l || f || s.r) END AS f,
                CASE WHEN s.n <= {3**k} THEN p ELSE p || s.l || s.r END AS p)
                FROM {name}{k} c JOIN {nodes}s{k} s ON c.g IS NOT DISTINCT FROM s.g AND c.i // {3**k} = s.i)""")
        return parts

    even = CRC32_SQL.format(key="coalesce(doc_id::VARCHAR, '')") + " % 2 = 0"
    without_breaks = "replace(text, chr(10), '')"
    rows = f"""SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
        count(*) OVER (PARTITION BY g) AS n FROM (SELECT doc_id, source AS g, {leaf("text")} AS leaf,
        CASE WHEN {even} THEN {leaf(without_breaks)} ELSE {leaf("text")} END AS f FROM documents)"""
    parts = [
        f"docs AS MATERIALIZED ({rows})",
        *tree("a", "SELECT g, n, i, leaf AS h FROM docs"),
        *climb("u", "SELECT g, i, doc_id, leaf, f, '' AS p FROM docs", "a"),
        f"""tops AS MATERIALIZED (SELECT g AS own, 0 AS g, h, row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS i,
            count(*) OVER () AS n FROM a{levels})""",
        *tree("b", "SELECT g, n, i, h FROM tops"),
        *climb("v", f"""SELECT t.g, t.i, u.doc_id, u.leaf, t.h AS subroot, u.f, u.p
            FROM u{levels} u JOIN tops t ON u.g IS NOT DISTINCT FROM t.own""", "b"),
    ]
    return f"""WITH {", ".join(parts)}
        SELECT doc_id, leaf, subroot, h AS root, sha256(p) AS proof_sha256, f AS folded_root, f = h AS verified
        FROM v{levels}, (SELECT h FROM b{levels})"""


SQL["op13_merkle_manifest"] = _merkle_sql()


@registered
def op12_conversation_prefix_trie(spark, sf_dir):
    own = stage(prefix_trie.numbered_turns(read_table(spark, sf_dir, "conversations")), "own")
    taken = checksum_rest("conv_id", 4)
    lead = F.col("conv_id") - F.col("conv_id") % 20
    ids = own.filter("pos = 0").select("conv_id")
    openings = own.filter("pos < 3 AND conv_id % 20 = 0").withColumnRenamed("conv_id", "lead")
    first = ids.select("conv_id", lead.alias("lead"), taken.alias("taken")).join(openings, "lead").filter("pos < taken")
    rest = own.filter(F.col("pos") >= taken)
    columns = ["key", "words"]
    turns = first.select("conv_id", F.col("pos").alias("place"), *columns)
    turns = turns.unionByName(rest.select("conv_id", (F.col("pos") + 3).alias("place"), *columns))
    return prefix_trie.prefix_trie(turns, ids)


SQL["op12_conversation_prefix_trie"] = f"""
    WITH own AS (
        SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
                   sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos,
               coalesce(role, '') AS role, coalesce(text, '') AS text
        FROM conversations WHERE conv_id IS NOT NULL
    ), ids AS (
        SELECT conv_id, conv_id - conv_id % 20 AS lead, {CRC32_SQL.format(key="conv_id")} % 4 AS h
        FROM (SELECT DISTINCT conv_id FROM own)
    ), placed AS (
        SELECT i.conv_id, o.pos, role, text FROM ids i JOIN own o ON o.conv_id = i.lead AND o.pos <= i.h
        UNION ALL
        SELECT i.conv_id, o.pos + 3, role, text FROM ids i JOIN own o ON o.conv_id = i.conv_id AND o.pos > i.h
    ), turns AS (
        SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY pos) AS depth,
               sha256(strlen(role) || ':' || role || text) AS key,
               len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS words
        FROM placed
    ), prefixes AS (
        SELECT conv_id, 0 AS depth, '' AS path, NULL AS above, 0 AS words FROM ids
        UNION ALL
        SELECT conv_id, depth, string_agg(key, '/') OVER upto, coalesce(string_agg(key, '/') OVER before, ''), words
        FROM turns
        WINDOW upto AS (PARTITION BY conv_id ORDER BY depth),
               before AS (PARTITION BY conv_id ORDER BY depth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
    ), lengths AS (
        SELECT conv_id, max(depth) AS length FROM prefixes GROUP BY conv_id
    ), nodes AS (
        SELECT depth, path, any_value(above) AS above, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
               string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE depth = length) AS ends
        FROM prefixes JOIN lengths USING (conv_id) GROUP BY depth, path
    ), families AS (
        SELECT p.*, q.conv_id AS parent_conv_id, (SELECT count(*) FROM nodes c WHERE c.depth = p.depth + 1 AND c.above = p.path)
                   AS n_children
        FROM nodes p LEFT JOIN nodes q ON q.depth = p.depth - 1 AND q.path = p.above
    ), subtrees AS (
        SELECT a.depth, a.path, count(*) FILTER (WHERE f.n_children = 0) AS n_leaves,
               sum((f.n_convs - 1) * f.words)::BIGINT AS saved_tokens
        FROM (SELECT DISTINCT a.depth, a.path, b.depth AS low, b.path AS below
              FROM prefixes a JOIN prefixes b ON a.conv_id = b.conv_id AND a.depth <= b.depth) a
        JOIN families f ON f.depth = a.low AND f.path = a.below
        GROUP BY a.depth, a.path
    )
    SELECT f.conv_id, f.depth::BIGINT AS depth, f.parent_conv_id, f.n_convs, f.n_children, s.n_leaves, s.saved_tokens,
           sha256(coalesce(f.ends, '')) AS ends_sha256
    FROM families f JOIN subtrees s ON s.depth = f.depth AND s.path = f.path"""
