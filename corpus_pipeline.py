"""A training corpus from `documents`: known language, not toxic, no near copies, packed.

Each stage reads what the one before it has kept, as a table of its own, and rows leave it
by its decision. Models are learned from the given tables: the languages from `documents`,
the voices of toxicity from `documents` and `labels`.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarn.llm import langid, near_copies, packing, toxicity
from tarn.llm.common import read_table, shared, slabs
from tarn.session import scratch_path, stage


def _keep_by(docs: DataFrame, judge) -> DataFrame:
    """The rows whose text `judge` (made once per task: a function from an Arrow array of
    texts to one boolean each) accepts, with all their columns."""
    column = docs.columns.index("text")

    def keep(batches):
        decide = judge()
        for batch in slabs(batches, column, rows=4_000, size=1 << 20):
            yield batch.filter(pa.array(decide(batch.column(column)), pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a good part is in one of the languages learned from `documents`;
    a null text or one without letters goes."""
    learned = langid.train(read_table(spark, sf_dir, "documents"), "text", "lang")
    model = shared(spark, learned)
    make, accepts = langid.Labeller, langid.accepts

    def judge():
        labeller = make(model())

        def decide(texts):
            language, score, _ = labeller.label(texts)
            return [accepts(name, s) for name, s in zip(language, score, strict=True)]

        return decide

    return _keep_by(docs, judge)


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored under 0.5 by the classifier learned from `labels`."""
    learned = toxicity.train(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    model = shared(spark, learned)
    return _keep_by(docs, lambda: lambda texts: (model().score(texts) < 0.5).tolist())


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (near fingerprints or shared min-hash keys over five-word
    shingles, and a similarity of 0.8 or more) the row with the smallest id, one without an id only if no other has any. Rows are told apart by a
    number of their own, so rows that share an id but not a text are different documents."""
    number = next(n for n in ("__row", "__row_", "__row__") if n not in docs.columns)
    rows = stage(docs.withColumn(number, F.monotonically_increasing_id()), "numbered")
    groups = near_copies.near_copies(rows.select(number, "text"), number)
    place = F.struct(F.col("doc_id").isNull(), "doc_id", number)
    firsts = rows.select(number, "doc_id").join(groups, number).groupBy("component_id").agg(F.min(place).alias("first"))
    return rows.join(firsts.select(f"first.{number}"), number, "left_semi").select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its sequence and place."""
    return packing.pack_documents(docs, packing.tokenizer_file())


STAGES = [
    ("language ID", known_language),
    ("toxicity", not_toxic),
    ("near-dedup", without_near_copies),
    ("best-fit packing", packed),
]

#: SQL can express neither the models nor the tokens.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, decide in STAGES:
        path = scratch_path(spark, name.replace(" ", "-"))
        decide(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
