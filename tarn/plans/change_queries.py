"""Queries over merges, dimension renewal, maintenance and incremental loading."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tarn.operators.maintain import discover_tables, expired_files
from tarn.operators.mutate import densify_missing, merge_insert, merge_partitions, merge_update, renew_dimension
from tarn.plans.registry import query, table
from tarn.session import scratch_path, stage
from tarn.sources.writers import write_csv, write_json
from tarn.streaming.ingest import (
    dedupe_exact,
    dedupe_latest,
    incremental_since,
    ingest_stream,
    land_attempt,
    land_pages,
    renew_schema,
    reset_stream,
    run_increment,
    start_attempt,
)


def _dimension(spark, sf_dir):
    """Customers outside BUILDING as a stored dimension: surrogate key, id, label, balance."""
    customer = table(spark, sf_dir, "customer").filter("c_mktsegment <> 'BUILDING'")
    return customer.select(
        (F.col("c_custkey") * 2 + 1).alias("SurrKey"),
        F.col("c_custkey").alias("ID"),
        F.col("c_name").alias("Label"),
        F.col("c_acctbal").alias("Balance"),
    )


def _incoming(spark, sf_dir):
    """Customers with money, relabelled, under surrogate keys that must not be used."""
    customer = table(spark, sf_dir, "customer").filter("c_acctbal > 0")
    return customer.select(
        F.lit(-1).cast("bigint").alias("SurrKey"),
        F.col("c_custkey").alias("ID"),
        F.concat(F.lit("New "), "c_name").alias("Label"),
        (F.col("c_acctbal") + 1).alias("Balance"),
    )


_DIM_SQL = """
    WITH dim AS (SELECT c_custkey * 2 + 1 AS SurrKey, c_custkey AS ID, c_name AS Label, c_acctbal AS Balance
                 FROM customer WHERE c_mktsegment <> 'BUILDING'),
         incoming AS (SELECT -1 AS SurrKey, c_custkey AS ID, 'New ' || c_name AS Label, c_acctbal + 1 AS Balance
                      FROM customer WHERE c_acctbal > 0),
         updated AS (SELECT d.SurrKey, d.ID, CASE WHEN i.ID IS NULL THEN d.Label ELSE i.Label END AS Label,
                            CASE WHEN i.ID IS NULL THEN d.Balance ELSE i.Balance END AS Balance
                     FROM dim d LEFT JOIN incoming i ON d.ID = i.ID),
         fresh AS (SELECT i.* FROM incoming i LEFT JOIN dim d ON d.ID = i.ID WHERE d.ID IS NULL)
    """


@query("T1", sql=f"{_DIM_SQL} SELECT * FROM updated")
def merged_updates(spark, sf_dir):
    return merge_update(_dimension(spark, sf_dir), _incoming(spark, sf_dir))


@query("T2", sql=f"{_DIM_SQL} SELECT * FROM dim UNION ALL SELECT * FROM fresh")
def merged_inserts(spark, sf_dir):
    return merge_insert(_dimension(spark, sf_dir), _incoming(spark, sf_dir))


@query(
    "T1 T2 T3",
    sql="""
    SELECT o_orderkey, o_custkey, CASE WHEN year(o_orderdate) = 1995 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
           CASE WHEN year(o_orderdate) = 1995 AND o_orderkey % 2 = 0 THEN '1996' ELSE year(o_orderdate)::VARCHAR END AS year
    FROM orders""",
)
def merged_partitions(spark, sf_dir):
    """Orders by year: those of 1995 change, half of them move to 1996, and 1998 is new; the
    other years are not written again."""
    path = scratch_path(spark, "by-year")
    year, even = F.year("o_orderdate"), F.col("o_orderkey") % 2 == 0
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", year.alias("year"))
    orders.filter("year <> 1998").write.partitionBy("year").parquet(path)
    changed = orders.filter("year IN (1995, 1998)").withColumns({
        "year": F.when((F.col("year") == 1995) & even, 1996).otherwise(F.col("year")),
        "o_totalprice": F.col("o_totalprice") + F.when(F.col("year") == 1995, 1).otherwise(0),
    })
    merge_partitions(spark, path, changed, ["o_orderkey"])
    return spark.read.parquet(path).withColumn("year", F.col("year").cast("string"))


@query(
    "T3 T1 J9 W1 T2",
    sql=f"""{_DIM_SQL}
    SELECT * FROM updated
    UNION ALL SELECT row_number() OVER (ORDER BY ID) + (SELECT max(SurrKey) FROM dim), ID, Label, Balance
    FROM fresh""",
)
def renewed_dimension(spark, sf_dir):
    return renew_dimension(_dimension(spark, sf_dir), _incoming(spark, sf_dir))


@query(
    "T5",
    sql="""
    SELECT o_custkey, y AS year, (10000 * y)::DOUBLE AS gdp
    FROM (SELECT DISTINCT o_custkey FROM orders
          WHERE o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')),
         (SELECT unnest(range(2010, 2021)) AS y)""",
)
def densified_years(spark, sf_dir):
    """Eleven years for each customer that has orders but no pending one."""
    orders = table(spark, sf_dir, "orders")
    years = densify_missing(orders, "o_custkey", 2010, 2020, "year", orders.filter("o_orderstatus = 'P'"))
    gdp = (F.lit(10000) * F.col("year")).cast("decimal(10,2)").cast("double")
    return years.withColumn("gdp", gdp)


@query(
    "T7",
    sql="""
    SELECT event_type || '/' || event_id || '.parquet' AS path, event_id AS size FROM events
    WHERE event_type <> 'view' AND ts < TIMESTAMP '2024-01-25 00:00:00' - INTERVAL 168 HOUR""",
)
def expired_file_plan(spark, sf_dir):
    """Events as a file inventory, of which the `view` files are still in use."""
    files = table(spark, sf_dir, "events").select(
        F.concat("event_type", F.lit("/"), F.col("event_id"), F.lit(".parquet")).alias("path"),
        F.col("event_id").alias("size"),
        F.col("ts").alias("modificationTime"),
    )
    now = F.lit("2024-01-25 00:00:00").cast("timestamp_ntz")
    live = files.filter(F.col("path").startswith("view/"))
    return expired_files(files, live, now=now).select("path", "size")


@query(
    "T9",
    sql="""
    SELECT DISTINCT split_part(url, '?', 1) AS table_path FROM pages
    WHERE html LIKE '%<table%' OR html LIKE '%<nav>%'""",
)
def discovered_tables(spark, sf_dir):
    """Page addresses as object keys; those of pages with a table or menu get a log folder."""
    pages = table(spark, sf_dir, "pages")
    base = F.substring_index("url", "?", 1)
    logs = pages.filter("html LIKE '%<table%' OR html LIKE '%<nav>%'")
    logs = logs.select(F.concat(base, F.lit("/_delta_log/0.json")).alias("path"))
    data = pages.select(F.concat(base, F.lit("/part-0.parquet")).alias("path"))
    return discover_tables(logs.unionByName(data))


# ---- incremental and streaming ------------------------------------------------------

_EVENT_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


@query("R1 R2", sql="SELECT * FROM events")
def streamed_ingest(spark, sf_dir):
    """JSON events in two drops, three runs: the third finds nothing new."""
    src, checkpoint = scratch_path(spark, "drops"), scratch_path(spark, "checkpoint")
    path = scratch_path(spark, "streamed")
    name = "tarn_" + path.rsplit("-", 1)[1]
    events = table(spark, sf_dir, "events")
    first = F.col("ts") < "2024-01-15"
    for drop in (events.filter(first), events.filter(~first), None):
        if drop is not None:
            write_json(drop, src, mode="append")
        ingest_stream(spark, src, name, checkpoint, path=path)
    rows = spark.table(name).drop("source_file", "processing_time")
    rows = rows.withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    spark.sql("DROP TABLE IDENTIFIER(:name)", {"name": name})
    return rows


@query("R5", sql="SELECT * FROM events")
def landed_pages(spark, sf_dir):
    """Events as page files, landed in batches; a second run continues with late pages."""
    pages, out = scratch_path(spark, "pages"), scratch_path(spark, "landed")
    checkpoint = scratch_path(spark, "checkpoint")
    events = table(spark, sf_dir, "events")
    schema = spark.createDataFrame([], _EVENT_SCHEMA).schema
    late = F.col("ts") >= "2024-01-20"
    for rows in (events.filter(~late).repartition(12, "event_id"), events.filter(late)):
        write_json(rows, pages, mode="append")
        land_pages(spark, pages, out, checkpoint, schema)
    return spark.read.parquet(out).drop("batch_id")


@query("R4 R5", sql="SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-15' - INTERVAL 1 MONTH OR ts < TIMESTAMP '2024-01-15'")
def finished_paged_runs(spark, sf_dir):
    """Two runs: the first lands what there was until its day, the second only the overlap
    and what is new; rows of both are in the table once."""
    pages, out, state = (scratch_path(spark, label) for label in ("pages", "increments", "state"))
    events, schema = table(spark, sf_dir, "events"), spark.createDataFrame([], _EVENT_SCHEMA).schema

    def fetch(last, folder):
        rows = events.filter(F.col("ts") < "2024-01-15") if last is None else events
        write_json(rows.repartition(12, "event_id"), folder)

    for day in ("2024-01-15", "2024-02-15"):
        run_increment(spark, fetch, pages, out, state, schema, "ts", day)
    return dedupe_exact(spark.read.parquet(out).drop("run", "batch_id"))


@query("R4 R5", sql="SELECT * FROM events WHERE ts < '2024-01-25'")
def repeated_paged_run(spark, sf_dir):
    """A run that was stopped after it had landed other versions of the same pages."""
    pages, out, state = (scratch_path(spark, label) for label in ("pages", "increments", "state"))
    events, schema = table(spark, sf_dir, "events"), spark.createDataFrame([], _EVENT_SCHEMA).schema

    def pages_of(rows):
        return lambda last, folder: write_json(rows.repartition(6, "event_id"), folder)

    changed = events.filter("event_id % 2 = 0").withColumn("value", F.col("value") + 1)
    land_attempt(spark, start_attempt(spark, pages, out, state, "2024-01-25"), pages_of(changed), schema, "ts")
    run_increment(spark, pages_of(events.filter("ts < '2024-01-25'")), pages, out, state, schema, "ts", "2024-01-25")
    return spark.read.parquet(out).drop("run", "batch_id")


@query(
    "R1 R2",
    sql="""
    SELECT event_id, user_id, event_type, value, list_value(event_type, user_id::VARCHAR) AS tags,
           CASE WHEN ts >= '2024-01-15' THEN props END AS props
    FROM events""",
)
def nested_stream_change(spark, sf_dir):
    """The second drop has a new field in a struct in an array of structs: the stream stops,
    takes the field in, and goes on with the drop."""
    src, checkpoint, path = (scratch_path(spark, label) for label in ("drops", "checkpoint", "streamed"))
    name = "tarn_" + path.rsplit("-", 1)[1]
    events, early = table(spark, sf_dir, "events"), F.col("ts") < "2024-01-15"
    tags = F.array(*[F.struct(F.col(c).cast("string").alias("tag")) for c in ("event_type", "user_id")]).alias("tags")
    for rows, inner in ((events.filter(early), ["value"]), (events.filter(~early), ["value", "props"])):
        detail = F.array(F.struct("event_type", F.struct(*inner).alias("more"))).alias("details")
        write_json(rows.select("event_id", F.struct("user_id").alias("who"), detail, tags), src, mode="append")
        try:
            ingest_stream(spark, src, name, checkpoint, path=path)
        except StreamingQueryException:
            renew_schema(spark, src, checkpoint + "_schema")
            spark.sql("DROP TABLE IDENTIFIER(:name)", {"name": name})
            ingest_stream(spark, src, name, checkpoint, path=path)
    loaded = spark.read.schema(spark.table(name).schema).parquet(path)
    spark.sql("DROP TABLE IDENTIFIER(:name)", {"name": name})
    detail = F.col("details")[0]
    return loaded.select(
        "event_id", F.col("who.user_id").alias("user_id"), detail["event_type"].alias("event_type"),
        detail["more"]["value"].alias("value"), F.col("tags.tag").alias("tags"), detail["more"]["props"].alias("props"),
    )


@query("R3 R1", sql="SELECT event_id, value FROM events")
def reset_and_loaded_again(spark, sf_dir):
    """A stream that is forgotten loads all files once more."""
    src, checkpoint, path = (scratch_path(spark, label) for label in ("drops", "checkpoint", "streamed"))
    name = "tarn_" + path.rsplit("-", 1)[1]
    write_csv(table(spark, sf_dir, "events").select("event_id", "value"), src, sep=",")
    schema = spark.createDataFrame([], "event_id bigint, value double").schema
    for run in range(2):
        ingest_stream(spark, src, name, checkpoint, fmt="csv", schema=schema, path=f"{path}/{run}")
        rows = stage(spark.table(name).select("event_id", "value"), "loaded")
        reset_stream(spark, name, checkpoint)
    return rows


@query(
    "R4 F8",
    sql="""
    SELECT o_orderkey, o_totalprice FROM orders
    WHERE o_orderdate >= TIMESTAMP '1998-03-31' - INTERVAL 1 MONTH""",
)
def incremental_orders(spark, sf_dir):
    orders = incremental_since(table(spark, sf_dir, "orders"), "o_orderdate", "1998-03-31")
    return orders.select("o_orderkey", "o_totalprice")


@query(
    "R4",
    sql="""
    SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS day FROM orders
    WHERE strftime(o_orderdate, '%Y%m%d') >= '19980228'""",
)
def incremental_text_days(spark, sf_dir):
    day = F.date_format("o_orderdate", "yyyyMMdd").alias("day")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", day)
    return incremental_since(orders, "day", "1998-03-31")


@query("R6 A10", sql="SELECT * FROM events")
def overlap_removed(spark, sf_dir):
    """A reload of the last days brings exact copies; one of each stays."""
    events = table(spark, sf_dir, "events")
    return dedupe_exact(events.unionByName(events.filter(F.col("ts") >= "2024-01-20")))


@query(
    "R6",
    sql="""
    SELECT user_id, ts, event_id, event_type, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
)
def latest_per_user(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type", "value")
    return dedupe_latest(events, ["user_id"], ["ts", "event_id"])
