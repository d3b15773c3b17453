"""Queries over sinks, catalog tables and key checks."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarn.operators.maintain import compact
from tarn.operators.validate import append_checked, check_fk, check_new_keys, check_pk
from tarn.plans.loads import LoadSpec, load_distinct_per_file, load_folder, run_graph, run_loads, run_together
from tarn.plans.registry import exact_sum, query, table
from tarn.session import scratch_path, stage
from tarn.sources.catalog import (
    create_schema,
    describe_schema,
    drop_schema,
    insert_if_empty,
    insert_into,
    list_tables,
    read_table,
    register_external,
    replace_view,
)
from tarn.sources.readers import file_types, read_folder
from tarn.sources.writers import (
    append_or_create,
    export_rows,
    overwrite_table,
    replace_folder,
    truncate_and_load,
    write_csv,
    write_json,
    write_parquet,
    write_single_csv,
    write_sized,
)


def _name(label):
    return f"tarn_{label}_{uuid.uuid4().hex}"


def _read_and_unregister(spark, name):
    """The table's rows; its files stay, only the catalog entry goes."""
    rows = read_table(spark, name)
    rows.schema  # resolved against the catalog now
    spark.sql("DROP TABLE IDENTIFIER(:name)", {"name": name})
    return rows


@query(
    "K1",
    sql="""
    SELECT l_returnflag, l_linestatus, count(*) AS n_lines,
           sum(l_quantity::DECIMAL(18,4))::DOUBLE AS quantity
    FROM lineitem GROUP BY ALL""",
)
def single_csv_export(spark, sf_dir):
    """A summary report as one named CSV file."""
    report = table(spark, sf_dir, "lineitem").groupBy("l_returnflag", "l_linestatus")
    report = report.agg(F.count("*").alias("n_lines"), exact_sum("l_quantity").alias("quantity"))
    folder = scratch_path(spark, "report")
    path = write_single_csv(report, folder, "line_report")
    return read_folder(spark, path, "csv", sep=",", glob="line_report.csv")


@query("K4", sql="SELECT DISTINCT * FROM lineitem")
def distinct_per_file(spark, sf_dir):
    """Every line written twice to its file; one copy is left."""
    src, dst = scratch_path(spark, "doubled"), scratch_path(spark, "distinct")
    twice = F.explode(F.array(F.lit(1), F.lit(2)))
    lines = table(spark, sf_dir, "lineitem")
    write_csv(lines.withColumn("copy", twice).drop("copy"), src, sep=",")
    load_distinct_per_file(spark, src, dst, "csv", sep=",", schema=lines.schema)
    return spark.read.parquet(dst).drop("file_stem")


@query("K5", sql="SELECT * FROM orders")
def append_or_create_table(spark, sf_dir):
    path = scratch_path(spark, "appended")
    orders = table(spark, sf_dir, "orders")
    append_or_create(orders.filter("o_orderstatus = 'F'"), path)
    append_or_create(orders.filter("o_orderstatus <> 'F'"), path)
    return spark.read.parquet(path)


@query("K5", sql="SELECT * FROM events")
def rerun_safe_append(spark, sf_dir):
    """Each batch is loaded twice, as after a crash; its partition is replaced, not doubled."""
    path = scratch_path(spark, "batches")
    events = table(spark, sf_dir, "events")
    early = F.col("event_type").isin("click", "view")
    for _ in range(2):
        append_or_create(events.filter(early), path, batch="1")
        append_or_create(events.filter(~early), path, batch="2")
    return spark.read.parquet(path).drop("batch")


@query("K6 S15", sql="SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def overwritten_table_read(spark, sf_dir):
    name, path = _name("supplier"), scratch_path(spark, "table")
    supplier = table(spark, sf_dir, "supplier")
    overwrite_table(supplier.filter("s_acctbal < 0"), name, path)
    overwrite_table(supplier, name, path)
    return _read_and_unregister(spark, name)


@query("T4", sql="SELECT * FROM orders WHERE o_orderstatus <> 'P'")
def truncated_and_reloaded(spark, sf_dir):
    """The second load reads the very table it replaces."""
    path = scratch_path(spark, "reloaded")
    truncate_and_load(table(spark, sf_dir, "orders"), path)
    truncate_and_load(spark.read.parquet(path).filter("o_orderstatus <> 'P'"), path)
    return spark.read.parquet(path)


@query("K7", sql="SELECT * FROM lineitem")
def sized_write(spark, sf_dir):
    path = scratch_path(spark, "sized")
    write_sized(table(spark, sf_dir, "lineitem"), path)
    return spark.read.parquet(path)


@query(
    "K8 P5",
    sql="SELECT c_custkey AS id, c_name AS label, c_acctbal::DECIMAL(10,2)::DOUBLE AS balance FROM customer",
)
def positional_insert(spark, sf_dir):
    name, path = _name("insert"), scratch_path(spark, "inserted")
    customer = table(spark, sf_dir, "customer")
    spark.sql(
        "CREATE TABLE IDENTIFIER(:name) (id BIGINT, label STRING, balance DECIMAL(10,2)) "
        f"USING parquet LOCATION '{path}'",
        {"name": name},
    )
    insert_into(customer.select("c_custkey", "c_name", F.col("c_acctbal").cast("decimal(10,2)")), name)
    return _read_and_unregister(spark, name).withColumn("balance", F.col("balance").cast("double"))


@query("K9", sql="SELECT * FROM supplier")
def seeded_table(spark, sf_dir):
    """Seeding twice fills the table once."""
    name, path = _name("seed"), scratch_path(spark, "seeded")
    supplier = table(spark, sf_dir, "supplier")
    overwrite_table(supplier.filter("false"), name, path)
    insert_if_empty(supplier, name)
    insert_if_empty(supplier, name)
    return _read_and_unregister(spark, name)


@query(
    "K10 S12 O3",
    sql="SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 20",
)
def bounded_export(spark, sf_dir):
    """A top-20 report through a local frame."""
    best = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    best = best.orderBy(F.desc("c_acctbal"), "c_custkey").limit(20)
    return spark.createDataFrame(export_rows(best, 20))


@query("K11 S15", sql="SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus")
def external_table(spark, sf_dir):
    name, path = _name("external"), scratch_path(spark, "external")
    write_parquet(table(spark, sf_dir, "orders"), path)
    register_external(spark, name, path)
    register_external(spark, name, path)
    rows = spark.sql(
        "SELECT o_orderstatus, count(*) AS n FROM IDENTIFIER(:name) GROUP BY o_orderstatus",
        {"name": name},
    )
    spark.sql("DROP TABLE IDENTIFIER(:name)", {"name": name})
    return rows


@query("K13", sql="SELECT c_mktsegment, count(*) AS n FROM customer WHERE c_acctbal > 0 GROUP BY ALL")
def replaced_view(spark, sf_dir):
    name = _name("view")
    customer = table(spark, sf_dir, "customer")
    replace_view(customer, name)
    replace_view(customer.filter("c_acctbal > 0"), name)
    rows = spark.sql(f"SELECT c_mktsegment, count(*) AS n FROM {name} GROUP BY c_mktsegment")
    spark.catalog.dropTempView(name)
    return rows


@query(
    "K15",
    sql="""
    SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
    GROUP BY ALL HAVING count(*) > 1""",
)
def primary_key_violations(spark, sf_dir):
    return check_pk(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "K15",
    sql="""
    SELECT o_custkey, count(*) AS n_rows
    FROM (SELECT CASE WHEN o_orderstatus = 'P' THEN o_custkey + (SELECT max(c_custkey) + 1 FROM customer)
                      WHEN o_orderstatus = 'O' THEN NULL ELSE o_custkey END AS o_custkey FROM orders)
    WHERE o_custkey IS NOT NULL AND o_custkey NOT IN (SELECT c_custkey FROM customer)
    GROUP BY ALL""",
)
def foreign_key_violations(spark, sf_dir):
    """Orders whose customers were shifted out of range (`P`) or taken away (`O`)."""
    customer = table(spark, sf_dir, "customer")
    beyond = customer.agg(F.max("c_custkey") + 1).scalar()
    key = F.when(F.col("o_orderstatus") == "P", F.col("o_custkey") + beyond).when(
        F.col("o_orderstatus") != "O", F.col("o_custkey")
    )
    child = table(spark, sf_dir, "orders").withColumn("o_custkey", key)
    return check_fk(child, customer, ["o_custkey"], ["c_custkey"])


@query("T6", sql="SELECT * REPLACE (CASE WHEN o_orderstatus <> 'F' THEN o_totalprice END AS o_totalprice) FROM orders")
def compacted_table(spark, sf_dir):
    """Many small files, those of the first load without a column that came later."""
    path = scratch_path(spark, "small-files")
    orders = table(spark, sf_dir, "orders").repartition(32, "o_orderkey")
    orders.filter("o_orderstatus = 'F'").drop("o_totalprice").write.parquet(path)
    orders.filter("o_orderstatus <> 'F'").write.mode("append").parquet(path)
    compact(spark, path)
    return spark.read.parquet(path)


@query(
    "X3 K11",
    sql="""
    SELECT 'append' AS mode, count(*) AS n, sum(c_custkey)::BIGINT AS keys FROM customer
    UNION ALL SELECT 'replace', count(*), sum(c_custkey)::BIGINT FROM customer WHERE c_acctbal > 0
    UNION ALL SELECT 'batch', count(*), sum(c_custkey)::BIGINT FROM customer""",
)
def registered_after_two_loads(spark, sf_dir):
    """Tables that were registered at the first of two loads, read by name after the second."""
    raw, warehouse = scratch_path(spark, "raw"), scratch_path(spark, "warehouse")
    customer = table(spark, sf_dir, "customer")
    rich = F.col("c_acctbal") > 0
    names = {mode: _name(mode) for mode in ("append", "replace", "batch")}
    for i, rows in enumerate((customer.filter(~rich), customer.filter(rich))):
        write_parquet(rows, f"{raw}/{i}/part")
        for mode in ("append", "replace"):
            source, target = f"{raw}/{i}/part/", f"{warehouse}/{mode}"
            load_folder(spark, LoadSpec(source, target, "parquet", mode=mode, table=names[mode]))
        append_or_create(rows, f"{warehouse}/batch", batch=str(i))
        register_external(spark, names["batch"], f"{warehouse}/batch")
    counts = []
    for mode, name in names.items():
        totals = read_table(spark, name).agg(F.count("*").alias("n"), F.sum("c_custkey").alias("keys"))
        counts.append(stage(totals.withColumn("mode", F.lit(mode)), "totals"))
        spark.sql("DROP TABLE IDENTIFIER(:name)", {"name": name})
    return reduce(DataFrame.unionByName, counts)


@query(
    "K12 K14 K16",
    sql="""
    SELECT 'nation' AS "table", 0 AS position, 'n_nationkey' AS "column", true AS gone
    UNION ALL SELECT 'nation', 1, 'n_name', true UNION ALL SELECT 'nation', 2, 'n_regionkey', true""",
)
def schema_life(spark, sf_dir):
    """A schema with one table: its tables are listed and described, then it is dropped."""
    name, path = _name("schema"), scratch_path(spark, "schema-table")
    create_schema(spark, name)
    overwrite_table(table(spark, sf_dir, "nation"), f"{name}.nation", path)
    (listed,) = list_tables(spark).filter(F.col("namespace") == name).collect()
    columns = describe_schema(read_table(spark, f"{name}.nation")).select("position", "column")
    drop_schema(spark, name)
    gone = not spark.catalog.databaseExists(name)
    return columns.select(F.lit(listed.tableName).alias("table"), "*", F.lit(gone).alias("gone"))


@query(
    "X3 P1 P3 K5",
    sql="""
    SELECT 'orders' AS dataset, count(*) AS n, sum(o_totalprice::DECIMAL(18,4))::DOUBLE AS total FROM orders
    UNION ALL SELECT 'events', count(*), sum(value::DECIMAL(18,4))::DOUBLE FROM events
    UNION ALL SELECT 'part', count(*), sum(p_retailprice::DECIMAL(18,4))::DOUBLE FROM part""",
)
def load_list(spark, sf_dir):
    """Three datasets in three formats through one load list."""
    raw, warehouse = scratch_path(spark, "raw"), scratch_path(spark, "warehouse")
    write_csv(table(spark, sf_dir, "orders"), f"{raw}/orders_csv", sep=",")
    write_json(table(spark, sf_dir, "events"), f"{raw}/events")
    write_parquet(table(spark, sf_dir, "part"), f"{raw}/part")
    orders, events, part = (loaded.path for loaded in run_loads(
        spark,
        [
            LoadSpec(f"{raw}/orders_csv/", warehouse, "csv", ",", schema_from="first"),
            LoadSpec(f"{raw}/events/", warehouse, "json"),
            LoadSpec(f"{raw}/part/", warehouse, "parquet", mode="replace"),
        ],
    ))

    def total(path, dataset, column):
        return spark.read.parquet(path).agg(
            F.lit(dataset).alias("dataset"), F.count("*").alias("n"), exact_sum(column).alias("total")
        )

    return (
        total(orders, "orders", "o_totalprice")
        .unionByName(total(events, "events", "value"))
        .unionByName(total(part, "part", "p_retailprice"))
    )


@query(
    "X4",
    sql="""
    SELECT 'customer' AS name, count(*) AS n FROM customer
    UNION ALL SELECT 'supplier', count(*) FROM supplier""",
)
def writes_together(spark, sf_dir):
    """Two independent writes from two threads."""
    names = ["customer", "supplier"]
    paths = [scratch_path(spark, name) for name in names]

    def job(name, path):
        return lambda: replace_folder(table(spark, sf_dir, name), path)

    run_together([job(n, p) for n, p in zip(names, paths, strict=True)])
    first, second = [
        spark.read.parquet(p).agg(F.lit(n).alias("name"), F.count("*").alias("n"))
        for n, p in zip(names, paths, strict=True)
    ]
    return first.unionByName(second)


@query(
    "X3",
    sql="""
    SELECT 'customer' AS name, 'loaded before' AS state, (SELECT count(*) FROM customer) AS n
    UNION ALL SELECT 'supplier', 'loaded', (SELECT count(*) FROM supplier)
    UNION ALL SELECT 'nation', 'loaded', (SELECT count(*) FROM nation)
    UNION ALL SELECT 'part', 'loaded before', (SELECT count(*) FROM part)""",
)
def resumed_load_graph(spark, sf_dir):
    """A load list whose second dataset fails at first: what does not need it is loaded, and
    the repeated run loads the rest only."""
    raw, warehouse, status = (scratch_path(spark, label) for label in ("raw", "warehouse", "status"))
    names = ["customer", "supplier", "nation", "part"]
    after = {"nation": ("supplier",), "part": ("customer",)}
    specs = [LoadSpec(f"{raw}/{n}/", warehouse, "parquet", after=after.get(n, ())) for n in names]
    for name in ("customer", "nation", "part", "supplier"):
        if name == "supplier":
            run_graph(spark, specs, status, "2024-01-01")  # it is not there yet
        write_parquet(table(spark, sf_dir, name), f"{raw}/{name}")
    states = run_graph(spark, specs, status, "2024-01-01").drop("message")
    counts = [spark.read.parquet(f"{warehouse}/{n}").agg(F.lit(n).alias("name"), F.count("*").alias("n")) for n in names]
    return states.join(reduce(DataFrame.unionByName, counts), "name")


@query(
    "S8 S7 K4",
    sql="""
    WITH c AS (SELECT lower(c_mktsegment) AS stem, bool_or(c_acctbal < 0) AS debts FROM customer
               WHERE c_mktsegment IN ('AUTOMOBILE', 'BUILDING', 'MACHINERY') GROUP BY 1)
    SELECT stem, 0 AS position, 'c_custkey' AS name, 'int' AS type FROM c
    UNION ALL SELECT stem, 1, 'balance', CASE WHEN stem = 'machinery' THEN 'double'
        WHEN stem = 'building' AND debts THEN 'string' ELSE 'int' END FROM c
    UNION ALL SELECT stem, 2, 'c_name', 'string' FROM c""",
)
def types_of_every_file(spark, sf_dir):
    """Three files whose balances are whole numbers, numbers or a text, in one pass."""
    folder = scratch_path(spark, "files")
    balance = {
        "AUTOMOBILE": "string(int(c_acctbal))", "MACHINERY": "string(c_acctbal)",
        "BUILDING": "CASE WHEN c_acctbal < 0 THEN 'debts' ELSE string(int(c_acctbal)) END",
    }
    for segment, text in balance.items():
        rows = table(spark, sf_dir, "customer").filter(F.col("c_mktsegment") == segment)
        write_single_csv(rows.selectExpr("c_custkey", f"{text} AS balance", "c_name"), folder, segment.lower())
    types = file_types(spark, folder, "csv", ",")
    return types.select(F.regexp_extract("path", r"([a-z]+)\.csv$", 1).alias("stem"), "position", "name", "type")


@query(
    "K15 K5",
    sql="""
    SELECT stored, n_rows > 1 AS repeated, count(*) AS n_keys, sum(n_rows)::BIGINT AS n_rows,
           (SELECT count(*) FROM orders) AS n_target
    FROM (SELECT CASE WHEN o_orderstatus = 'F' THEN -1 - o_orderkey
                      WHEN o_orderstatus = 'P' THEN o_orderkey END AS key,
                 coalesce(o_orderstatus = 'P', false) AS stored,
                 CASE WHEN any_value(o_orderstatus) = 'F' THEN 2 * count(*) ELSE count(*) END AS n_rows
          FROM orders GROUP BY 1, 2)
    GROUP BY ALL""",
)
def checked_appends(spark, sf_dir):
    """Orders appended in two batches with their keys kept; then what a third batch would break:
    keys that are stored (`P`), keys twice in the batch (`F`), keys that are missing (`O`)."""
    path, keys = scratch_path(spark, "keyed"), f"keys_{uuid.uuid4().hex}"
    orders = table(spark, sf_dir, "orders")
    for batch, rest in (("even", 0), ("odd", 1), ("odd", 1)):  # a repeated batch changes nothing
        append_checked(orders.filter(F.pmod("o_orderkey", F.lit(2)) == rest), path, ["o_orderkey"], keys, batch, 8)
    status = F.col("o_orderstatus")
    key = F.when(status == "F", -1 - F.col("o_orderkey")).when(status == "P", F.col("o_orderkey"))
    third = orders.withColumn("o_orderkey", key)
    third = third.union(third.filter(status == "F"))
    bad = stage(check_new_keys(third, ["o_orderkey"], keys, "third"), "violations")
    spark.sql("DROP TABLE IDENTIFIER(:name)", {"name": keys})
    n_target = spark.read.parquet(path).count()
    grouped = bad.groupBy("stored", (F.col("n_rows") > 1).alias("repeated"))
    return grouped.agg(F.count("*").alias("n_keys"), F.sum("n_rows").alias("n_rows"), F.lit(n_target).alias("n_target"))
