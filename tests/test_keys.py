"""Surrogate keys, row indexes and cumulative values: results, plans and skew."""

import math

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tarn.operators import keys
from tarn.operators.keys import (
    POSITION_BITS,
    STAMP,
    assign_surrogate_keys,
    cumulative,
    lay_out,
    range_number,
    with_row_index,
)
from tests.conftest import rows

slow = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


@slow
@given(st.lists(st.integers(-50, 50), min_size=1, max_size=60), st.integers(0, 10**9))
def test_surrogate_keys_are_dense_and_ordered(spark, ids, start):
    df = spark.createDataFrame([(i,) for i in ids], "id int").repartition(5)
    got = rows(assign_surrogate_keys(df, ["id"], start, "sk"))
    assert [sk for sk, _ in got] == list(range(start + 1, start + 1 + len(ids)))
    assert [i for _, i in got] == sorted(ids)


@slow
@given(
    st.lists(
        st.tuples(st.integers(0, 5), st.one_of(st.none(), st.floats(-9, 9), st.just(math.nan))),
        min_size=1,
        max_size=60,
    )
)
def test_cumulative_max_skips_missing(spark, pairs):
    data = [(i, t, v) for i, (t, v) in enumerate(pairs)]
    df = spark.createDataFrame(data, "id int, t int, v double").repartition(4)
    got = cumulative(df, ["t", "id"], "v", "max", "c", unique=True).toPandas().sort_values(["t", "id"])
    frame = pd.DataFrame(data, columns=["id", "t", "v"]).sort_values(["t", "id"])
    pd.testing.assert_series_equal(
        got["c"].astype(float), frame["v"].astype(float).cummax(), check_names=False, check_index=False
    )


@pytest.mark.parametrize("how", ["max", "min", "sum"])
def test_cumulative_kinds(spark, how):
    df = spark.range(1000).select("id", ((F.col("id") * 37) % 101).alias("v")).repartition(8)
    got = cumulative(df, ["id"], "v", how, "c", unique=True).orderBy("id").toPandas()
    assert got["c"].tolist() == getattr(got["v"], f"cum{how}")().tolist()


def test_empty_input(spark):
    df = spark.createDataFrame([], "id int, v double")
    assert with_row_index(df, ["id"]).count() == 0
    assert cumulative(df, ["id"], "v").count() == 0


def test_row_index_with_sort_expressions(spark):
    df = spark.createDataFrame([(1, 5.0), (2, None), (3, 1.0)], "id int, v double")
    got = with_row_index(df, [F.col("v").asc_nulls_last()])
    assert rows(got.select("row_index", "id")) == [(0, 3), (1, 1), (2, 2)]


def test_keys_survive_reading_twice(spark):
    df = spark.range(5000).select((F.col("id") % 7).alias("k"), "id").repartition(8)
    ranked = with_row_index(df, ["k"])
    assert rows(ranked) == rows(ranked)


def test_no_row_goes_through_one_partition(spark):
    df = spark.range(100_000).select((F.col("id") * 7 % 1000).alias("k"), "id")
    laid = lay_out(df, ["k", "id"], unique=True)
    plan = with_row_index(df, ["k", "id"], unique=True)._jdf.queryExecution().executedPlan().toString()
    single = [i for i, line in enumerate(plan.splitlines()) if "SinglePartition" in line]
    # the only single-partition exchange carries one row per range, right above an aggregate
    lines = plan.splitlines()
    assert all("HashAggregate" in lines[i + 1] for i in single)
    assert laid.select(range_number()).distinct().count() >= 1


@pytest.mark.parametrize("hot", ["ties", "copies"])
def test_hot_group_is_cut_into_ranges(spark, hot):
    """A third of all rows has one key (or is one row): no range gets more than its share."""
    is_hot = F.col("id") % 3 == 0
    df = spark.range(0, 300_000, 1, 8).select(
        F.when(is_hot, 5).otherwise(F.col("id") % 1000).alias("k"),
        (F.when(is_hot, 0) if hot == "copies" else F.when(is_hot, F.col("id")))
        .otherwise(F.col("id"))
        .alias("v"),
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        laid = lay_out(df, ["k"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    per_range = [r[1] for r in laid.groupBy(range_number()).count().collect()]
    assert len(per_range) == 8
    assert max(per_range) < 2 * 300_000 / 8
    ranked = with_row_index(df, ["k"])
    assert ranked.agg(F.count_distinct("row_index"), F.max("row_index")).head() == (300_000, 299_999)
    positions = laid.agg(F.max(F.col(STAMP).bitwiseAND((1 << POSITION_BITS) - 1))).head()[0]
    assert positions < 300_000


def test_no_wide_column_is_a_range_key(spark, tmp_path):
    spark.range(50).select((F.col("id") % 5).alias("k"), F.lit("long text").alias("text")).write.parquet(str(tmp_path / "t"))
    plans = []
    original = keys.stage
    keys.stage = lambda df, label: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or original(df, label)
    try:
        lay_out(spark.read.parquet(str(tmp_path / "t")), ["k"])
    finally:
        keys.stage = original
    (line,) = [x for x in plans[-1].splitlines() if "RepartitionByExpression" in x]
    assert "text" not in line.replace("xxhash64(text", "")
