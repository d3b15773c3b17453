"""Queries over aggregates, keys, order, set operations and missing data."""

from __future__ import annotations

from pyspark.sql import functions as F

from tarn.operators.keys import assign_surrogate_keys, cumulative, gappy_ids, with_row_index
from tarn.operators.profile import (
    append_profile,
    column_means,
    count_objects,
    count_tables,
    describe_long,
    group_sums,
    highest,
    stored_profile,
    summarize,
)
from tarn.operators.reshape import (
    assign_between,
    concat_same_schema,
    drop_missing,
    fill_missing,
    reindex,
    transpose,
)
from tarn.plans.registry import exact_sum, query, table
from tarn.session import scratch_path

# The names of the driver tables.
TABLES = """region nation customer supplier part orders lineitem events documents embeddings
pages benchmark labels conversations""".split()


@query("A1", sql="SELECT count(*) AS n FROM lineitem")
def row_count(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").agg(F.count("*").alias("n"))


@query(
    "A2",
    sql=" UNION ALL ".join(
        f"SELECT 'lake' AS DATABASE_NAME, 'raw' AS SCHEMA_NAME, '{t}' AS TABLE_NAME, count(*) AS COUNT FROM {t}"
        for t in TABLES
    ),
)
def all_table_counts(spark, sf_dir):
    return count_tables({("lake", "raw", t): table(spark, sf_dir, t) for t in TABLES})


@query(
    "A3 U2",
    sql="SELECT 0 AS Aantal, 'dummy' AS Object"
    + "".join(f" UNION SELECT count(*), 'raw.{t}' FROM {t}" for t in TABLES),
)
def all_object_counts(spark, sf_dir):
    return count_objects({f"raw.{t}": table(spark, sf_dir, t) for t in TABLES})


@query(
    "A4",
    sql="""
    SELECT 'orders' AS name, coalesce(max(o_orderkey), 0) AS highest FROM orders
    UNION ALL SELECT 'none', coalesce(max(o_orderkey), 0) FROM orders WHERE o_orderkey < 0""",
)
def highest_key(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    full = highest(orders, "o_orderkey").withColumn("name", F.lit("orders"))
    none = highest(orders.filter("o_orderkey < 0"), "o_orderkey").withColumn("name", F.lit("none"))
    return full.unionByName(none)


@query(
    "A5",
    sql="""
    SELECT event_type, sum(event_id)::BIGINT AS event_id, sum(user_id)::BIGINT AS user_id,
           sum(value::DECIMAL(18,4))::DOUBLE AS value
    FROM events GROUP BY event_type""",
)
def group_sum_one_key(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("value", F.col("value").cast("decimal(18,4)"))
    return group_sums(events, ["event_type"]).withColumn("value", F.col("value").cast("double"))


@query(
    "A6",
    sql="""
    SELECT l_returnflag, l_linestatus, sum(l_quantity::DECIMAL(18,4))::DOUBLE AS l_quantity,
           sum(l_extendedprice::DECIMAL(18,4))::DOUBLE AS l_extendedprice
    FROM lineitem GROUP BY l_returnflag, l_linestatus""",
)
def group_sum_two_keys(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        "l_returnflag",
        "l_linestatus",
        F.col("l_quantity").cast("decimal(18,4)").alias("l_quantity"),
        F.col("l_extendedprice").cast("decimal(18,4)").alias("l_extendedprice"),
    )
    sums = group_sums(lines, ["l_returnflag", "l_linestatus"])
    return sums.withColumns({c: F.col(c).cast("double") for c in ("l_quantity", "l_extendedprice")})


def _holed_events(spark, sf_dir):
    """Events with NaN values on clicks and NULL values on errors."""
    value = (
        F.when(F.col("event_type") == "click", F.lit(float("nan")))
        .when(F.col("event_type") != "error", F.col("value"))
        .alias("value")
    )
    return table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", value)


_WITHOUT_HOLES = "event_type NOT IN ('click', 'error')"


@query(
    "A7",
    sql=f"""
    SELECT round(avg(user_id), 6) AS user_id,
           round(avg(value) FILTER ({_WITHOUT_HOLES}), 6) AS value FROM events""",
)
def column_averages(spark, sf_dir):
    """Means that skip NULL and NaN alike."""
    means = column_means(_holed_events(spark, sf_dir), ["user_id", "value"])
    return means.select(F.round("user_id", 6).alias("user_id"), F.round("value", 6).alias("value"))


def _profile_sql(table_name, columns, digits=6):
    stats = {
        "count": "count({c})",
        "mean": "avg({c})",
        "std": "stddev_samp({c})",
        "min": "min({c})",
        "25%": "quantile_cont({c}, 0.25)",
        "50%": "quantile_cont({c}, 0.5)",
        "75%": "quantile_cont({c}, 0.75)",
        "max": "max({c})",
    }
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", '{s}' AS stat, round(({e.format(c=c)})::DOUBLE, {digits}) AS value
        FROM {table_name}"""
        for c in columns
        for s, e in stats.items()
    )


@query("A8", sql=_profile_sql("lineitem", ["l_quantity", "l_extendedprice", "l_discount"]))
def exact_profile(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    profile = describe_long(lines, ["l_quantity", "l_extendedprice", "l_discount"], exact=True)
    return profile.withColumn("value", F.round("value", 6))


_PROFILED = ["l_quantity", "l_extendedprice", "l_discount"]


def _near_sql(digits):
    return f"""SELECT "column", stat, CASE WHEN stat LIKE '%\\%' ESCAPE '\\' THEN NULL ELSE value END AS value,
        true AS near FROM ({_profile_sql("lineitem", _PROFILED, digits)})"""


def _nearness(rows, profile, digits=6):
    """Exact statistics, and whether each quartile has nearly its share of rows at or below it."""
    marks = profile.filter(F.col("stat").endswith("%")).collect()  # three quartiles per column
    shares = [
        (F.avg((F.col(r.column) <= r.value).cast("int")) >= float(r.stat[:-1]) / 100 - 0.01)
        & (F.avg((F.col(r.column) < r.value).cast("int")) <= float(r.stat[:-1]) / 100 + 0.01)
        for r in marks
    ]
    entries = [
        F.struct(F.lit(r.column).alias("column"), F.lit(r.stat).alias("stat"), F.lit(None).cast("double").alias("value"), s.alias("near"))
        for r, s in zip(marks, shares, strict=True)
    ]
    near = rows.agg(F.array(*entries).alias("__marks")).select(F.inline("__marks"))
    exact = profile.filter(~F.col("stat").endswith("%"))
    return exact.select("column", "stat", F.round("value", digits).alias("value"), F.lit(True).alias("near")).unionByName(near)


@query("A8", sql=_near_sql(6))
def approximate_profile(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(*_PROFILED)
    return _nearness(lines, describe_long(lines, _PROFILED))


@query("A8", sql=_near_sql(4))
def profile_of_loads(spark, sf_dir):
    """Line items come in three loads, the last one twice; their sketches are merged.

    A mean of means differs from a mean in its last bits; l_discount has one that lies just
    between two numbers of six digits, so four are compared.
    """
    lines, path = table(spark, sf_dir, "lineitem"), scratch_path(spark, "sketches")
    for load in (0, 1, 2, 2):
        append_profile(lines.filter(F.col("l_orderkey") % 3 == load), path, str(load), _PROFILED)
    return _nearness(lines, stored_profile(spark, path), 4)


@query(
    "A9",
    sql="""
    SELECT 'count' AS summary, count(c_name)::VARCHAR AS c_name, count(c_acctbal)::DOUBLE AS c_acctbal FROM customer
    UNION ALL SELECT 'mean', NULL, round(avg(c_acctbal), 6) FROM customer
    UNION ALL SELECT 'stddev', NULL, round(stddev_samp(c_acctbal), 6) FROM customer
    UNION ALL SELECT 'min', min(c_name), min(c_acctbal) FROM customer
    UNION ALL SELECT 'max', max(c_name), max(c_acctbal) FROM customer""",
)
def summary_with_strings(spark, sf_dir):
    """The exact part of a summary over text and numbers."""
    customer = table(spark, sf_dir, "customer").select("c_name", "c_acctbal")
    report = summarize(customer, ["count", "mean", "stddev", "min", "max"])
    return report.withColumn("c_acctbal", F.round(F.col("c_acctbal").cast("double"), 6))


@query(
    "A9",
    sql=" UNION ALL ".join(
        f"""SELECT '{f}' AS summary, {f}(c_name)::VARCHAR AS c_name, {f}(c_acctbal)::DOUBLE AS c_acctbal,
        {f}(c_mktsegment)::VARCHAR AS c_mktsegment FROM customer"""
        for f in ("count", "min", "max")
    ),
)
def summary_bounds(spark, sf_dir):
    """Counts and bounds of text and numbers in one report."""
    customer = table(spark, sf_dir, "customer").select("c_name", "c_acctbal", "c_mktsegment")
    report = summarize(customer, ["count", "min", "max"])
    return report.withColumn("c_acctbal", F.col("c_acctbal").cast("double"))


@query("A10", sql="SELECT DISTINCT l_partkey, l_suppkey FROM lineitem")
def distinct_rows(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey").distinct()


# ---- keys and order -----------------------------------------------------------------


@query(
    "W1 J10 A4",
    sql="""
    SELECT row_number() OVER (ORDER BY c_custkey)
             + (SELECT max(c_custkey) FROM customer WHERE c_mktsegment <> 'BUILDING') AS SurrKey,
           c_custkey, c_name
    FROM customer WHERE c_mktsegment = 'BUILDING'""",
)
def surrogate_keys(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    known = customer.filter("c_mktsegment <> 'BUILDING'")
    new = customer.join(known.select("c_custkey"), "c_custkey", "left_anti").select("c_custkey", "c_name")
    start = highest(known, "c_custkey").scalar()
    return assign_surrogate_keys(new, ["c_custkey"], start, "SurrKey", unique=True)


@query(
    "W1 W4",
    sql="""
    SELECT l_returnflag, l_partkey, n::BIGINT AS n, total::BIGINT AS total FROM (
      SELECT l_returnflag, l_partkey, count(*) AS n, sum(rn) AS total
      FROM (SELECT l_returnflag, l_partkey, row_number() OVER (ORDER BY l_returnflag, l_partkey, l_linenumber) AS rn
            FROM (SELECT l_returnflag, l_partkey, min(l_linenumber) AS l_linenumber FROM lineitem GROUP BY ALL))
      GROUP BY ALL)""",
)
def ranked_groups(spark, sf_dir):
    """Row numbers along a key with three values, ties by part: they spread over ranges."""
    groups = table(spark, sf_dir, "lineitem").groupBy("l_returnflag", "l_partkey")
    groups = groups.agg(F.min("l_linenumber").alias("l_linenumber"))
    ranked = with_row_index(groups, ["l_returnflag", "l_partkey"], "rn", start=1)
    return ranked.groupBy("l_returnflag", "l_partkey").agg(
        F.count("*").alias("n"), F.sum("rn").alias("total")
    )


@query("W2", sql="SELECT count(*) AS n_rows, count(*) AS n_ids FROM orders")
def gappy_row_ids(spark, sf_dir):
    ids = gappy_ids(table(spark, sf_dir, "orders").select("o_orderkey"), "id")
    return ids.agg(F.count("*").alias("n_rows"), F.count_distinct("id").alias("n_ids"))


@query(
    "W3",
    sql="""
    SELECT event_id, ts, value,
           max(value) OVER (ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS highest_so_far
    FROM events""",
)
def cumulative_max(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "ts", "value")
    return cumulative(events, ["ts", "event_id"], "value", "max", "highest_so_far", unique=True)


@query(
    "W3",
    sql="""
    SELECT o_orderkey, o_orderdate, o_totalprice,
           max(o_totalprice) OVER (ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING) AS highest_so_far
    FROM orders""",
)
def cumulative_max_with_ties(spark, sf_dir):
    """Many orders share a day; the order key breaks the tie."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    return cumulative(orders, ["o_orderdate", "o_orderkey"], "o_totalprice", "max", "highest_so_far")


@query(
    "W4 O1",
    sql="""
    SELECT "index", row_index, c_custkey, c_acctbal FROM (
      SELECT row_number() OVER (ORDER BY c_custkey) - 1 AS "index",
             row_number() OVER (ORDER BY nullif(c_acctbal, 0) NULLS LAST, c_custkey) - 1 AS row_index,
             c_custkey, c_acctbal
      FROM customer)""",
)
def reset_index(spark, sf_dir):
    """Sorted by value, with the new row number and the old label beside it."""
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    labelled = with_row_index(customer, ["c_custkey"], "index", unique=True)
    value = F.expr("nullif(c_acctbal, 0)").asc_nulls_last()
    return with_row_index(labelled, [value, "c_custkey"], "row_index", unique=True)


@query(
    "O1",
    sql="SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS value FROM events ORDER BY 2 NULLS LAST",
)
def sorted_by_value(spark, sf_dir):
    value = F.when(F.col("event_type") != "error", F.col("value")).alias("value")
    return table(spark, sf_dir, "events").select("event_id", value).orderBy(F.asc_nulls_last("value"))


@query("O2", sql="SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey DESC")
def sorted_by_label(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_orderkey"))


@query(
    "O3",
    sql="""
    SELECT l_orderkey, l_partkey, l_linenumber, l_extendedprice FROM lineitem
    ORDER BY l_extendedprice DESC, l_orderkey, l_partkey, l_linenumber LIMIT 10""",
)
def top_lines(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice")
    return lines.orderBy(F.desc("l_extendedprice"), "l_orderkey", "l_partkey", "l_linenumber").limit(10)


# ---- set operations and missing data ------------------------------------------------


@query(
    "U1",
    sql="SELECT c_custkey AS id, c_name AS name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier",
)
def positional_union(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    return customer.union(table(spark, sf_dir, "supplier").select("s_suppkey", "s_name"))


@query(
    "U2 A10",
    sql="SELECT c_nationkey AS nationkey FROM customer UNION SELECT s_nationkey FROM supplier",
)
def distinct_union(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nationkey"))
    return customer.union(table(spark, sf_dir, "supplier").select("s_nationkey")).distinct()


@query("U3", sql="SELECT * FROM events")
def checked_concat(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    types = ["click", "error"]
    named = [events.filter(F.col("event_type") == t) for t in types]
    return concat_same_schema([*named, events.filter(~F.col("event_type").isin(types))])


@query("M1", sql=f"SELECT event_id, user_id, event_type, value FROM events WHERE {_WITHOUT_HOLES}")
def rows_without_missing(spark, sf_dir):
    return drop_missing(_holed_events(spark, sf_dir))


@query(
    "M2",
    sql=f"""
    SELECT event_id, user_id, event_type, CASE WHEN {_WITHOUT_HOLES} THEN value ELSE 5.0 END AS value
    FROM events""",
)
def missing_filled(spark, sf_dir):
    return fill_missing(_holed_events(spark, sf_dir), 5.0)


@query(
    "M3",
    sql="""
    WITH labels AS (SELECT DISTINCT o_custkey + 5 AS c_custkey FROM orders WHERE o_orderstatus = 'P')
    SELECT c_custkey, c_name, c_acctbal, NULL::DOUBLE AS e FROM labels LEFT JOIN customer USING (c_custkey)""",
)
def reindexed_labels(spark, sf_dir):
    """Customers for a list of labels, some of which do not exist, and an empty column."""
    orders = table(spark, sf_dir, "orders").filter("o_orderstatus = 'P'")
    labels = orders.select((F.col("o_custkey") + 5).alias("c_custkey"))
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    return reindex(customer, "c_custkey", labels, {"e": "double"})


@query(
    "M4",
    sql="""
    SELECT o_orderkey, CASE WHEN o_orderdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1996-12-31'
                            THEN 1.0 ELSE o_totalprice END AS o_totalprice
    FROM orders""",
)
def assigned_label_range(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn("day", F.date_format("o_orderdate", "yyyy-MM-dd"))
    changed = assign_between(orders, "day", "1996-01-01", "1996-12-31", "o_totalprice", 1.0)
    return changed.select("o_orderkey", "o_totalprice")


def _transposed_sql():
    expressions = {
        "n": "count(*)::DOUBLE",
        "total": "sum(value::DECIMAL(18,4))::DOUBLE",
        "users": "max(user_id)::DOUBLE",
    }
    kinds = ["click", "error", "purchase", "signup", "view"]
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS "column", """
        + ", ".join(f"(SELECT {e} FROM events WHERE event_type = '{k}') AS \"{k}\"" for k in kinds)
        for name, e in expressions.items()
    )


@query("M5", sql=_transposed_sql())
def transposed_report(spark, sf_dir):
    """Per event type a row of figures, turned into a column per event type."""
    report = table(spark, sf_dir, "events").groupBy("event_type")
    report = report.agg(
        F.count("*").alias("n"), exact_sum("value").alias("total"), F.max("user_id").alias("users")
    )
    return transpose(report, "event_type", max_rows=100)
