"""The notebook examples with their worked-out results."""

import datetime
import decimal
import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from tarn.functions import columns as fc
from tarn.operators.joins import JOIN_TYPES, combine_all, split_outer_join
from tarn.operators.mutate import densify_missing, merge_insert, merge_update, renew_dimension
from tarn.operators.names import cleaned_names, sanitize_columns, sanitized, table_name_from_folder
from tarn.operators.profile import column_means, count_objects, describe_long, exact_quantiles, group_sums
from tarn.operators.reshape import (
    assign_between,
    concat_same_schema,
    drop_missing,
    fill_missing,
    reindex,
    transpose,
)
from tarn.operators.validate import check_fk, check_pk
from tarn.plans.loads import job_parameters
from tests.conftest import rows

DIM = "SurrKey int, ID int, Label string"


def dim(spark, *data):
    return spark.createDataFrame(list(data), DIM)


def test_dimension_first_round(spark):
    existing = dim(spark, (1, 1, "First"), (2, 5, "Second"))
    incoming = dim(spark, (1, 5, "NewFirst"), (2, 3, "TotallyNew"))
    inserted = renew_dimension(existing, incoming.filter("ID = 3"))
    assert rows(inserted) == [(1, 1, "First"), (2, 5, "Second"), (3, 3, "TotallyNew")]
    assert inserted.schema.simpleString() == existing.schema.simpleString()


def test_dimension_replayed_literally(spark):
    after_insert = dim(spark, (1, 1, "First"), (2, 5, "Second"), (3, 3, "TotallyNew"))
    second = dim(spark, (55, 5, "ThirdData"), (11, 11, "New"))
    prepared_in_round_one = dim(spark, (3, 3, "TotallyNew"))
    updated = merge_update(after_insert, second)
    final = merge_insert(updated, prepared_in_round_one)
    assert rows(final) == [(1, 1, "First"), (2, 5, "ThirdData"), (3, 3, "TotallyNew")]


def test_dimension_renewal_inserts_every_unmatched_row(spark):
    current = dim(spark, (1, 1, "First"), (2, 5, "Second"), (3, 3, "TotallyNew"))
    second = dim(spark, (55, 5, "ThirdData"), (11, 11, "New"))
    final = renew_dimension(current, second)
    expected = [(1, 1, "First"), (2, 5, "ThirdData"), (3, 3, "TotallyNew"), (4, 11, "New")]
    assert rows(final) == expected
    assert rows(renew_dimension(final, second)) == expected


def test_dimension_from_nothing_starts_at_one(spark):
    final = renew_dimension(dim(spark), dim(spark, (9, 7, "b"), (9, 4, "a")))
    assert rows(final) == [(1, 4, "a"), (2, 7, "b")]


@pytest.mark.parametrize("bad", [[(1, 5, "a"), (2, 5, "b")], [(1, None, "a")]])
def test_incoming_key_must_be_a_key(spark, bad):
    with pytest.raises(ValueError, match="not a key"):
        renew_dimension(dim(spark, (1, 1, "x")), dim(spark, *bad))


def test_merge_update_keeps_protected_column_and_row_count(spark):
    target = spark.range(500).select(F.col("id").alias("sk"), (F.col("id") * 3).alias("k"), F.lit("old").alias("v"))
    source = spark.range(0, 900, 2).select(F.lit(-1).cast("long").alias("sk"), F.col("id").alias("k"), F.lit("new").alias("v"))
    merged = merge_update(target, source)
    assert rows(merged.select("sk", "k")) == rows(target.select("sk", "k"))
    assert merged.filter("v = 'new'").count() == source.join(target, "k").count()


def test_update_sets_null_values_too(spark):
    merged = merge_update(dim(spark, (1, 5, "x")), dim(spark, (9, 5, None)))
    assert rows(merged) == [(1, 5, None)]


def test_countries_and_years(spark):
    country = spark.createDataFrame([(i, f"c{i}") for i in range(1, 11)], "country_key int, name string")
    economy = spark.createDataFrame([], "country_key int, year int")
    first = densify_missing(country, "country_key", 2010, 2020, "year", economy)
    gdp = first.withColumn("gdp", (F.lit(10000) * F.col("year")).cast("decimal(10,2)"))
    assert gdp.count() == 110
    low, high = gdp.agg(F.min("gdp"), F.max("gdp")).head()
    assert (low, high) == (decimal.Decimal("20100000.00"), decimal.Decimal("20200000.00"))
    assert densify_missing(country, "country_key", 2010, 2020, "year", first).count() == 0


def test_age_bands_join(spark):
    person = spark.createDataFrame([(1, "John", 25), (2, "Jane", 30), (3, "Mike", 35)], "ID int, Name string, Age int")
    ages = spark.range(1, 101).select(F.col("id").alias("Age"), fc.band_label("id").alias("Age Category"))
    joined = person.join(ages, person.Age == ages.Age, "left")
    assert rows(joined.select("Name", "Age Category")) == [("Jane", "30-30"), ("John", "20-30"), ("Mike", "30-40")]
    ends = ages.filter("Age in (1, 100)").select("Age", "Age Category")
    assert rows(ends) == [(1, "0-10"), (100, "100-100")]
    assert len(joined.columns) == 5


@pytest.fixture
def products(spark):
    left = [(i, "Toaster" if i < 4 else "Radio") for i in range(1, 7)]
    return (
        spark.createDataFrame(left, "CustomerId int, Product string"),
        spark.createDataFrame([(2, "Alabama"), (4, "Alabama"), (6, "Ohio")], "CustomerId int, State string"),
    )


def test_joins_by_name(products):
    left, right = products
    inner = [(2, "Toaster", "Alabama"), (4, "Radio", "Alabama"), (6, "Radio", "Ohio")]
    assert rows(left.join(right, "CustomerId")) == inner
    for how in ("left", "full"):
        got = split_outer_join(left, right, ["CustomerId"], how)
        assert got.count() == 6
        assert [r.CustomerId for r in got.filter("State is null").orderBy("CustomerId").collect()] == [1, 3, 5]
    assert rows(split_outer_join(left, right, ["CustomerId"], "right")) == inner


def test_split_outer_join_equals_plain_join(spark):
    left = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "k int, l string")
    right = spark.createDataFrame([(1, "x"), (1, "y"), (3, "z"), (None, "w")], "k int, r string")
    key = lambda r: tuple((v is None, v) for v in r)
    for how in ("left", "right", "full"):
        got = sorted(split_outer_join(left, right, ["k"], how).collect(), key=key)
        assert got == sorted(left.join(right, "k", how).collect(), key=key)


def test_hot_key_of_an_outer_join_is_split(spark):
    """The matches of a key with a third of the rows are cut by the skew join, either way."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "32",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k",
    }
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        key = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k")
        hot = spark.range(0, 300_000, 1, 8).select(key, F.xxhash64("id").alias("h"))
        even = spark.range(0, 300_000, 2, 8).select(F.col("id").alias("k"), F.xxhash64("id").alias("g"))
        for left, right, how in [(even, hot, "left"), (even, hot, "full"), (hot, even, "right")]:
            execution = split_outer_join(left, right, ["k"], how)._jdf.queryExecution()
            execution.toRdd().count()
            assert "skew=true" in execution.executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_all_combinations(products, spark):
    left, right = products
    pairs = combine_all(left, right)
    assert pairs.columns == ["CustomerId.x", "Product", "CustomerId.y", "State"]
    assert pairs.count() == 18
    assert combine_all(left, right.filter("false")).count() == 0
    assert combine_all(left, spark.range(1500)).count() == left.count() * 1500


@pytest.mark.parametrize("how", JOIN_TYPES)
def test_every_join_type_name(products, how):
    left, right = products
    counts = {"inner": 3, "cross": 3, "right": 3, "semi": 3, "anti": 3, "left": 6, "outer": 6, "full": 6}
    kind = how.replace("_", "").replace("outer", "") or "outer"
    kind = {"leftsemi": "semi", "leftanti": "anti"}.get(kind, kind)
    assert left.join(right, "CustomerId", how).count() == counts[kind]


def test_union_distinct(spark):
    dummy = spark.createDataFrame([("test", "12"), ("blob", "4")], ["koloma", "kolomb"])
    dummy.createOrReplaceTempView("dummy_words")
    got = spark.sql("SELECT * FROM dummy_words UNION SELECT 'drie' AS koloma, 45 AS kolomb")
    assert rows(got) == [("blob", 4), ("drie", 45), ("test", 12)]
    assert got.schema["kolomb"].dataType.simpleString() == "bigint"


def test_city(spark):
    schema = "rank LONG, city STRING, state STRING, code STRING, population LONG, price DOUBLE"
    city = spark.createDataFrame([[295, "South Bend", "Indiana", "IN", 101190, 112.9]], schema)
    assert city.filter(city["rank"] < 6).count() == 0
    assert city.selectExpr("`rank`", "upper(city) AS big_name").head() == (295, "SOUTH BEND")
    assert rows(city.select("City", "State")) == [("South Bend", "Indiana")]


def test_missing_data(spark):
    dates = [datetime.date(2013, 1, d) for d in range(1, 7)]
    df = spark.createDataFrame([(d, float(i)) for i, d in enumerate(dates)], "day date, A double")
    labels = spark.createDataFrame([(d,) for d in dates[:4]], "day date")
    holed = reindex(df, "day", labels, {"E": "double"})
    holed = assign_between(holed, "day", dates[0], dates[1], "E", 1.0)
    assert [r.E for r in holed.orderBy("day").collect()] == [1.0, 1.0, None, None]
    assert drop_missing(holed).count() == 2
    assert [r.E for r in fill_missing(holed, 5.0).orderBy("day").collect()] == [1.0, 1.0, 5.0, 5.0]


def test_reindex_adds_empty_rows(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    labels = spark.createDataFrame([(1,), (2,), (2,)], "k int")
    assert sorted(reindex(df, "k", labels).collect(), key=str) == [(1, "a"), (1, "b"), (2, None)]


def test_series_mean_and_profile(spark):
    df = spark.createDataFrame([(v,) for v in [1.0, 3.0, 5.0, float("nan"), 6.0, 8.0, None]], "s double")
    assert column_means(df).head()[0] == pytest.approx(23 / 5)
    for exact in (True, False):
        profile = {r.stat: r.value for r in describe_long(df, exact=exact).collect()}
        assert profile["count"] == 5 and profile["min"] == 1 and profile["max"] == 8
        assert (profile["25%"], profile["50%"], profile["75%"]) == (3, 5, 6)


def test_exact_quantiles_match_pandas(spark):
    df = spark.range(2000).select(
        (F.col("id") * 17 % 97).alias("a"), (F.col("id") * 1.5).alias("b"), F.lit(3).alias("c")
    )
    quantiles = [0.0, 0.1, 0.333, 0.5, 0.9, 1.0]
    expected = df.toPandas().quantile(quantiles)
    for r in exact_quantiles(df, ["a", "b", "c"], quantiles).collect():
        assert r.value == pytest.approx(expected.loc[r.quantile, r.column])


def test_exact_quantiles_of_nothing(spark):
    assert exact_quantiles(spark.createDataFrame([], "a double"), ["a"], [0.5]).count() == 0


def test_group_sums_leave_text_out(spark):
    df = spark.createDataFrame([("foo", "one", 1.0), ("foo", "two", 2.0), ("bar", "one", 4.0)], "A string, B string, C double")
    assert group_sums(df, ["A"]).columns == ["A", "C"]
    assert rows(group_sums(df, ["A"])) == [("bar", 4.0), ("foo", 3.0)]
    assert rows(group_sums(df, ["A", "B"])) == [("bar", "one", 4.0), ("foo", "one", 1.0), ("foo", "two", 2.0)]


def test_transpose(spark):
    df = spark.createDataFrame([("x", 1, 2.0), ("y", 3, 4.0)], "label string, a int, b double")
    got = transpose(df, "label", max_rows=100)
    assert got.columns == ["column", "x", "y"]
    assert rows(got) == [("a", 1.0, 3.0), ("b", 2.0, 4.0)]
    with pytest.raises(ValueError, match="more than 1 rows"):
        transpose(df, "label", max_rows=1)
    with pytest.raises(ValueError, match="unique"):
        transpose(df.union(df), "label", max_rows=100)


def test_transpose_keeps_types(spark):
    df = spark.sql("SELECT 'x' AS label, 9007199254740993 AS a, 1 AS b")
    assert rows(transpose(df, "label", max_rows=9)) == [("a", 9007199254740993), ("b", 1)]
    dated = spark.sql("SELECT 'x' AS label, DATE '2024-01-01' AS a, 1 AS b")
    assert rows(transpose(dated, "label", max_rows=9)) == [("a", "2024-01-01"), ("b", "1")]


def test_merge_finds_columns_of_another_case(spark):
    target = spark.createDataFrame([(1, 5, "old")], "SurrKey int, ID int, Label string")
    source = spark.createDataFrame([(5, "new")], "id int, label string")
    assert rows(merge_update(target, source)) == [(1, 5, "new")]
    assert rows(renew_dimension(target, source)) == [(1, 5, "new")]
    for change in (merge_update, renew_dimension):
        with pytest.raises(ValueError, match="no columns"):
            change(target, source.withColumn("more", F.lit(1)))


def test_concat_wants_equal_schemas(spark):
    a, b = spark.range(2), spark.range(2).select(F.col("id").cast("int"))
    assert concat_same_schema([a, a]).count() == 4
    with pytest.raises(ValueError, match="schemas differ"):
        concat_same_schema([a, b])


def test_object_counts_with_dummy(spark):
    assert rows(count_objects({"s.t": spark.range(3)})) == [(0, "dummy"), (3, "s.t")]
    assert rows(count_objects({"s.t": spark.range(3)}, dummy=False)) == [(3, "s.t")]


def test_key_checks(spark):
    child = spark.createDataFrame([(1, 1), (1, 2), (None, 1), (9, 9), (9, 9)], "a int, b int")
    assert sorted(check_pk(child, ["a", "b"]).collect(), key=str) == [(9, 9, 2), (None, 1, 1)]
    parent = spark.createDataFrame([(1,)], "p int")
    assert rows(check_fk(child, parent, ["a"], ["p"])) == [(9, 2)]


def test_names(spark):
    assert sanitized("a b") == "a_b"
    assert sanitized("a - b") == "a__b"
    runs = {n: len(sanitized("a" + "-" * n + "b")) - 2 for n in range(1, 10)}
    assert runs == {1: 1, 2: 1, 3: 2, 4: 2, 5: 1, 6: 1, 7: 2, 8: 2, 9: 3}
    assert table_name_from_folder("raw/car-parts/") == "carparts"
    assert table_name_from_folder("raw/dummy_csv/") == "dummy"
    dirty = ["firstName", "ábc@!*", "% successful (2009)", "REPEAT VALUE", "REPEAT VALUE", ""]
    clean = ["first_name", "abc", "percent_successful_2009", "repeat_value", "repeat_value_2", "x"]
    assert cleaned_names(dirty) == clean
    assert cleaned_names(["a", "a", "a_2"]) == ["a", "a_2", "a_2_2"]
    assert table_name_from_folder("raw/dummy_csv/part-0.csv") == "dummy"
    with pytest.raises(ValueError, match="collide"):
        sanitize_columns(spark.createDataFrame([(1, 2)], ["a b", "a-b"]))


def test_months_back(spark):
    days = spark.createDataFrame([("2024-03-31",), ("2024-02-29",)], "d string")
    got = days.select(fc.months_back(F.to_date("d")))
    assert rows(got) == [("20240129",), ("20240229",)]


def test_whitespace_table(spark):
    lines = spark.createDataFrame([("a   b,c  d  ",), (" x",), ("",)], "value string")
    got = fc.parse_whitespace_table(lines).collect()
    assert got == [("a", "b,c", "d", None), ("x", None, None, None), (None,) * 4]


def test_row_sum_and_cell_rule(spark):
    df = spark.createDataFrame([(101, 102), (201, 202), (None, 7)], "a int, b int")
    assert [r.row_sum for r in fc.row_sum(df, ["a", "b"]).collect()] == [203, 403, 7]
    cells = spark.createDataFrame([(50,), (5,), (None,)], "a int")
    assert [r.flag for r in fc.flag_cells(cells, "a", [("lessThan", 10, "red")]).collect()] == [None, "red", None]


def test_parameters_are_text():
    params = job_parameters({"a": 0, "b": 0}, {"a": 5, "b": "10"})
    assert params["a"] + params["b"] == "510"
    with pytest.raises(KeyError):
        job_parameters({"a": 1}, {"c": 1})


def archive(members):
    content = io.BytesIO()
    with zipfile.ZipFile(content, "w") as z:
        for name, text in members.items():
            z.writestr(name, text)
    return content.getvalue()


def test_people_json_fixture(spark, tmp_path):
    from tarn.sources.readers import read_folder

    people = [
        {
            "name": f"p{i}",
            "age": age,
            "address": {"street": "s", "city": "c"},
            "phoneNumbers": [{"type": t, "number": "1"} for t in kinds],
            "active": age != 45,
        }
        for i, (age, kinds) in enumerate(
            [(30, ["home", "work"]), (28, ["mobile"]), (45, ["home", "work"]), (35, ["mobile"]), (52, ["home", "work"])]
        )
    ]
    (tmp_path / "dummy.json").write_text(json.dumps(people, indent=2))
    (tmp_path / "other.csv").write_text("ignored")
    df = read_folder(spark, str(tmp_path), "json", multiline=True)
    assert df.count() == 5
    assert df.filter("NOT active").head().age == 45
    phones = df.select(F.explode("phoneNumbers").alias("p")).groupBy("p.type").count()
    assert rows(phones) == [("home", 3), ("mobile", 2), ("work", 3)]
    assert df.select("address.city").distinct().count() == 1
