"""Queries over names, projections, filters, functions and joins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarn.functions.columns import (
    band_label,
    content_hash,
    flag_cells,
    hashed_normal,
    months_back,
    parse_whitespace_table,
    row_sum,
    whitespace_fields,
)
from tarn.operators.joins import JOIN_TYPES, combine_all, split_outer_join
from tarn.operators.names import clean_names, sanitize_columns
from tarn.plans.loads import job_parameters, with_parameters
from tarn.plans.registry import exact_sum, query, table


@query(
    "P1",
    sql="""
    SELECT p_partkey AS part_key, p_name AS part__name, p_brand AS "part_brand_", p_type AS p_type,
           p_size AS size_cm_, p_retailprice AS retail_price
    FROM part""",
)
def sanitized_columns(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    messy = ["part key", "part - name", "part.brand!", "p_type", "size (cm)", "retail/price"]
    return sanitize_columns(part.toDF(*messy))


@query(
    "P2",
    sql="""
    SELECT o_orderkey AS first_name, o_custkey AS abc, o_orderstatus AS percent_successful_2009,
           o_totalprice AS repeat_value, o_orderdate AS repeat_value_2, o_orderpriority AS x
    FROM orders""",
)
def cleaned_columns(spark, sf_dir):
    names = ["firstName", "ábc@!*", "% successful (2009)", "REPEAT VALUE", "REPEAT VALUE", ""]
    return clean_names(table(spark, sf_dir, "orders").toDF(*names))


@query("P4", sql="SELECT c_name AS C_Name, c_mktsegment AS C_MKTSEGMENT FROM customer")
def projected_columns(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("C_Name", "C_MKTSEGMENT")


@query(
    "P5",
    sql="""
    SELECT c_mktsegment AS segment, c_custkey::INT AS id, c_acctbal::DECIMAL(10,2)::DOUBLE AS balance
    FROM customer""",
)
def renamed_dropped_cast(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").drop("c_name", "c_nationkey")
    customer = customer.withColumnRenamed("c_mktsegment", "segment")
    customer = customer.withColumn("id", F.col("c_custkey").cast("int")).drop("c_custkey")
    customer = customer.withColumn("balance", F.col("c_acctbal").cast("decimal(10,2)").cast("double"))
    return customer.select("segment", "id", "balance")


@query(
    "P6",
    sql="SELECT l_orderkey, l_extendedprice FROM lineitem WHERE l_quantity < 10 AND l_returnflag = 'R'",
)
def filtered_projection(spark, sf_dir):
    """Both predicates and the column list reach the Parquet scan."""
    lines = table(spark, sf_dir, "lineitem").filter(F.col("l_quantity") < 10)
    return lines.where(F.col("l_returnflag") == "R").select("l_orderkey", "l_extendedprice")


@query("P7", sql="SELECT doc_id, lang, n_chars FROM documents WHERE text LIKE '%,%'")
def like_filter(spark, sf_dir):
    return table(spark, sf_dir, "documents").filter("text LIKE '%,%'").select("doc_id", "lang", "n_chars")


@query(
    "P8 F1",
    sql="""
    SELECT p_partkey, upper(p_name) AS big_name, lower(p_type) AS little_type, p_size * 2 AS twice
    FROM part""",
)
def expression_projection(spark, sf_dir):
    part = table(spark, sf_dir, "part").withColumn("twice", F.expr("p_size * 2"))
    return part.selectExpr("p_partkey", "upper(p_name) AS big_name", "lower(p_type) AS little_type", "twice")


@query(
    "P9",
    sql="""
    SELECT l_orderkey, l_linenumber, 'line' AS kind, l_quantity * 10000 AS scaled,
           l_extendedprice * (1 - l_discount) AS net
    FROM lineitem""",
)
def computed_columns(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").withColumn("kind", F.lit("line"))
    lines = lines.withColumn("scaled", F.col("l_quantity") * F.lit(10000))
    lines = lines.withColumn("net", F.col("l_extendedprice") * (1 - F.col("l_discount")))
    return lines.select("l_orderkey", "l_linenumber", "kind", "scaled", "net")


@query(
    "P11",
    sql="""
    SELECT l_orderkey, l_partkey, l_linenumber,
           coalesce(nullif(l_quantity, 1), 0) + l_tax AS row_sum
    FROM lineitem""",
)
def row_sums(spark, sf_dir):
    """Quantity plus tax, where a quantity of 1 counts as a blank cell."""
    lines = table(spark, sf_dir, "lineitem").withColumn("l_quantity", F.expr("nullif(l_quantity, 1)"))
    return row_sum(lines, ["l_quantity", "l_tax"]).select("l_orderkey", "l_partkey", "l_linenumber", "row_sum")


@query(
    "P12",
    sql="""
    SELECT l_orderkey, l_partkey, l_quantity,
           CASE WHEN l_quantity < 10 THEN 'red' WHEN l_quantity >= 40 THEN 'green' END AS flag
    FROM lineitem""",
)
def flagged_cells(spark, sf_dir):
    rules = [("lessThan", 10, "red"), ("lessThan", 5, "never reached"), ("greaterThanOrEqual", 40, "green")]
    return flag_cells(table(spark, sf_dir, "lineitem"), "l_quantity", rules).select(
        "l_orderkey", "l_partkey", "l_quantity", "flag"
    )


@query("F2", sql="SELECT p_partkey, 'size ' || p_size || ' of ' || p_brand AS label FROM part")
def concatenated_label(spark, sf_dir):
    label = F.concat(F.lit("size "), F.col("p_size"), F.lit(" of "), "p_brand")
    return table(spark, sf_dir, "part").select("p_partkey", label.alias("label"))


@query(
    "F3",
    sql=r"""
    SELECT doc_id, regexp_replace(text, '[ \t\n\x0B\f\r]+', ' ', 'g') AS single_spaced,
           regexp_replace(source, '[^a-zA-Z0-9]', '_', 'g') AS safe_source
    FROM documents""",
)
def replaced_patterns(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.regexp_replace("text", r"\s+", " ").alias("single_spaced"),
        F.regexp_replace("source", "[^a-zA-Z0-9]", "_").alias("safe_source"),
    )


_FIELDS = r"list_filter(string_split(regexp_replace(text, '[ \t\n\x0B\f\r]+', ' ', 'g'), ' '), lambda x: x <> '')"


@query(
    "F4 F5",
    sql=rf"""
    SELECT doc_id, len({_FIELDS}) AS n_words, array_to_string({_FIELDS}, '|') AS words FROM documents""",
)
def split_words(spark, sf_dir):
    words = table(spark, sf_dir, "documents").select("doc_id", whitespace_fields("text").alias("w"))
    return words.select("doc_id", F.size("w").alias("n_words"), F.concat_ws("|", "w").alias("words"))


@query(
    "F6 F15 S10",
    sql=rf"""
    SELECT f[1] AS column1, f[2] AS column2, f[3] AS column3, f[4] AS column4
    FROM (SELECT {_FIELDS} AS f FROM documents)""",
)
def whitespace_table(spark, sf_dir):
    return parse_whitespace_table(table(spark, sf_dir, "documents"), 4, "text")


@query(
    "F7",
    sql="""
    SELECT (floor(l_quantity / 10) * 10)::BIGINT || '-' || (ceil(l_quantity / 10) * 10)::BIGINT AS band,
           count(*) AS n
    FROM lineitem GROUP BY band""",
)
def quantity_bands(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return lines.groupBy(band_label("l_quantity").alias("band")).agg(F.count("*").alias("n"))


@query(
    "F8",
    sql="""
    SELECT o_orderkey, strftime(o_orderdate::DATE - INTERVAL 1 MONTH, '%Y%m%d') AS month_before
    FROM orders""",
)
def month_before(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", months_back("o_orderdate").alias("month_before"))


def _noise(part):
    return f"(('0x' || substr(md5('42:noise/{part}:' || o_orderkey), 1, 8))::BIGINT / 4294967296.0::DOUBLE)"


@query(
    "F11",
    sql=f"""
    SELECT round(avg(x), 6) AS mean, round(stddev_samp(x), 6) AS spread
    FROM (SELECT sqrt(-2 * ln(1 - {_noise("r")})) * cos(2 * pi() * {_noise("a")}) AS x FROM orders)""",
)
def normal_noise(spark, sf_dir):
    """Mean and spread of one reproducible normal number per order."""
    noise = table(spark, sf_dir, "orders").select(hashed_normal(42, "noise", "o_orderkey").alias("x"))
    return noise.agg(F.round(F.avg("x"), 6).alias("mean"), F.round(F.stddev("x"), 6).alias("spread"))


@query(
    "F12",
    sql="""
    SELECT o_orderstatus, sum(o_totalprice::DECIMAL(10,2))::DOUBLE AS total FROM orders
    GROUP BY o_orderstatus""",
)
def decimal_totals(spark, sf_dir):
    price = F.col("o_totalprice").cast("decimal(10,2)")
    return table(spark, sf_dir, "orders").groupBy("o_orderstatus").agg(F.sum(price).cast("double").alias("total"))


@query("F13", sql="SELECT doc_id, sha256(text) AS sha256 FROM documents")
def content_hashes(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", content_hash("text").alias("sha256"))


# ---- joins --------------------------------------------------------------------------


@query(
    "J1",
    sql="""
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN -o_custkey ELSE o_custkey END AS custkey, c_custkey, c_name
    FROM orders LEFT JOIN customer ON (CASE WHEN o_orderstatus = 'P' THEN -o_custkey ELSE o_custkey END) = c_custkey""",
)
def left_join_expression(spark, sf_dir):
    """Orders, some under a customer key nobody has, with their customers."""
    customer, orders = table(spark, sf_dir, "customer"), _customers_and_orders(spark, sf_dir)[1]
    joined = orders.join(customer, orders.custkey == customer.c_custkey, "left")
    return joined.select("o_orderkey", "custkey", "c_custkey", "c_name")


@query(
    "J2 X1",
    sql="""
    SELECT l_orderkey, l_linenumber, l_partkey, p_name, p_size FROM lineitem
    LEFT JOIN part ON l_partkey = p_partkey AND p_size > 25""",
)
def left_join_sql(spark, sf_dir):
    return with_parameters(
        spark,
        """SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, p.p_name, p.p_size
           FROM {lines} l LEFT JOIN {parts} p ON l.l_partkey = p.p_partkey AND p.p_size > :size""",
        {"size": 25},
        lines=table(spark, sf_dir, "lineitem"),
        parts=table(spark, sf_dir, "part"),
    )


def _customers_and_orders(spark, sf_dir):
    """Customers, and orders, some under a customer key nobody has."""
    customer = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("custkey"), "c_mktsegment")
    orders = table(spark, sf_dir, "orders")
    shifted = F.when(F.col("o_orderstatus") == "P", -F.col("o_custkey")).otherwise(F.col("o_custkey"))
    return customer, orders.select(shifted.alias("custkey"), "o_orderkey")


_SIDES = """
    WITH l AS (SELECT c_custkey AS custkey, c_mktsegment FROM customer),
         r AS (SELECT CASE WHEN o_orderstatus = 'P' THEN -o_custkey ELSE o_custkey END AS custkey, o_orderkey
               FROM orders)
    """


def _by_name(kind):
    return f"{_SIDES} SELECT custkey, c_mktsegment, o_orderkey FROM l {kind} JOIN r USING (custkey)"


@query("J3", sql=_by_name("inner"))
def inner_join_by_name(spark, sf_dir):
    left, right = _customers_and_orders(spark, sf_dir)
    return left.join(right, "custkey", "inner")


@query("J4", sql=_by_name("full"))
def full_join_by_name(spark, sf_dir):
    return split_outer_join(*_customers_and_orders(spark, sf_dir), ["custkey"], "full")


@query("J5", sql=_by_name("left"))
def left_join_by_name(spark, sf_dir):
    return split_outer_join(*_customers_and_orders(spark, sf_dir), ["custkey"], "left")


@query("J6", sql=_by_name("right"))
def right_join_by_name(spark, sf_dir):
    return split_outer_join(*_customers_and_orders(spark, sf_dir), ["custkey"], "right")


@query(
    "J7",
    sql="""
    SELECT n_nationkey, n_name, n_regionkey, c_custkey, c_name FROM nation, customer""",
)
def all_combinations(spark, sf_dir):
    """Every nation with every customer."""
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return combine_all(table(spark, sf_dir, "nation"), customer)


@query(
    "J11",
    sql=f"""{_SIDES},
        i AS (SELECT count(*) AS n FROM l JOIN r USING (custkey)),
        a AS (SELECT count(*) AS n FROM l WHERE custkey NOT IN (SELECT custkey FROM r)),
        b AS (SELECT count(*) AS n FROM r WHERE custkey NOT IN (SELECT custkey FROM l)),
        counted AS (SELECT i.n AS i, a.n AS a, b.n AS b, (SELECT count(*) FROM l) AS l FROM i, a, b)
    SELECT how, CASE WHEN how = 'inner' THEN i WHEN how IN ('outer', 'full', 'fullouter', 'full_outer') THEN i + a + b
                     WHEN how IN ('leftouter', 'left', 'left_outer') THEN i + a
                     WHEN how IN ('rightouter', 'right', 'right_outer') THEN i + b
                     WHEN how IN ('leftsemi', 'left_semi', 'semi') THEN l - a ELSE a END AS n
    FROM counted, (SELECT unnest(['inner', 'outer', 'full', 'fullouter', 'full_outer', 'leftouter', 'left', 'left_outer',
        'rightouter', 'right', 'right_outer', 'leftsemi', 'left_semi', 'semi', 'leftanti', 'left_anti', 'anti']) AS how)""",
)
def join_type_counts(spark, sf_dir):
    """Rows of every join by name, under every spelling of its type."""
    left, right = _customers_and_orders(spark, sf_dir)
    counts = [
        left.join(right, "custkey", how).agg(F.count("*").alias("n")).select(F.lit(how).alias("how"), "n")
        for how in JOIN_TYPES
        if how != "cross"
    ]
    return reduce(DataFrame.unionByName, counts)


@query(
    "J8",
    sql=f"{_SIDES} SELECT custkey, c_mktsegment FROM l WHERE custkey IN (SELECT custkey FROM r)",
)
def semi_join(spark, sf_dir):
    left, right = _customers_and_orders(spark, sf_dir)
    return left.join(right, "custkey", "left_semi")


@query(
    "J9",
    sql=f"{_SIDES} SELECT custkey, o_orderkey FROM r WHERE custkey NOT IN (SELECT custkey FROM l)",
)
def anti_join(spark, sf_dir):
    left, right = _customers_and_orders(spark, sf_dir)
    return right.join(left, "custkey", "left_anti")


@query(
    "J10",
    sql=f"{_SIDES} SELECT r.custkey, r.o_orderkey FROM r LEFT JOIN l ON r.custkey = l.custkey WHERE l.custkey IS NULL",
)
def anti_join_sql(spark, sf_dir):
    left, right = _customers_and_orders(spark, sf_dir)
    return spark.sql(
        "SELECT n.* FROM {new} n LEFT ANTI JOIN {old} o ON n.custkey = o.custkey", new=right, old=left
    )


@query(
    "X1 X2",
    sql="""
    SELECT o_orderpriority, '12310' AS period, count(*) AS n, sum(o_totalprice::DECIMAL(18,4))::DOUBLE AS total
    FROM orders WHERE o_totalprice > 250000 GROUP BY o_orderpriority""",
)
def parameterised_query(spark, sf_dir):
    job = job_parameters({"period": "123", "suffix": 5}, {"suffix": 10})
    rows = with_parameters(
        spark,
        "SELECT *, :period || :suffix AS period FROM {orders} WHERE IDENTIFIER(:column) > :least",
        {**job, "column": "o_totalprice", "least": 250000},
        orders=table(spark, sf_dir, "orders"),
    )
    return rows.groupBy("o_orderpriority", "period").agg(
        F.count("*").alias("n"), exact_sum("o_totalprice").alias("total")
    )
