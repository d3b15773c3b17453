"""What one task holds does not grow with the table."""

from pyspark.sql import functions as F

from tarn.operators.maintain import compact
from tarn.streaming.ingest import dedupe_exact
from tests.conftest import rows


def test_compaction_gives_every_bin_a_task_of_its_own(spark, tmp_path):
    """No two bins meet in one task, and rows that are small when stored fill no larger bin."""
    path = str(tmp_path / "t")
    spark.range(0, 1_600_000, 1, 64).select((F.col("id") % 2).alias("x")).write.parquet(path)
    assert compact(spark, path, target_mb=1)
    files = spark.read.parquet(path).groupBy("_metadata.file_path").count().collect()
    assert len(files) == 13 and max(r["count"] for r in files) <= 150_000
    assert rows(spark.read.parquet(path).groupBy("x").count()) == [(0, 800_000), (1, 800_000)]
    assert not compact(spark, path, target_mb=1)


def test_copies_are_dealt_before_they_are_gathered(spark):
    """One shuffle, and no split of the input is held by a task as a whole."""
    values = [(1, 0.0, "a"), (1, -0.0, "a"), (2, float("nan"), None), (2, float("nan"), None), (None, None, ""), (None, None, ""), (1, 0.0, "b")]
    df = spark.createDataFrame(values, "k long, v double, `odd.name` string")
    once = dedupe_exact(df)
    assert once.columns == df.columns and once.count() == 4 and once.exceptAll(df.dropDuplicates()).isEmpty()
    plan = once._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Aggregate" not in plan.split("Exchange")[1]
