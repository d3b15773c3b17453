"""Queries over the readers: each writes a table in some format and reads it back."""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import functions as F

from tarn.operators.maintain import checksum_manifest, table_stats
from tarn.plans.registry import query, table
from tarn.session import scratch_path
from tarn.sources.generated import add_person_columns, date_range, literal_table, number_range
from tarn.sources.ranges import file_systems, read_zip_members, tree_manifest
from tarn.sources.readers import (
    file_inventory,
    infer_schema_first_file,
    read_columnar_json,
    read_folder,
    read_folder_tolerant,
    read_text,
    unpack_archives,
    widen_ints,
)
from tarn.sources.writers import write_csv, write_json, write_parquet, write_text

ORDERS_WITH_DAY = """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
           strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority
    FROM orders"""


def _with_day(orders):
    return orders.withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))


@query("S1 K2", sql=ORDERS_WITH_DAY)
def csv_folder_read(spark, sf_dir):
    folder = scratch_path(spark, "csv")
    write_csv(table(spark, sf_dir, "orders"), folder, sep=";")
    return _with_day(read_folder(spark, folder, "csv", sep=";"))


@query("S2 K3", sql="SELECT event_id, ts, user_id, event_type, value, props FROM events")
def json_folder_read(spark, sf_dir):
    folder = scratch_path(spark, "json")
    write_json(table(spark, sf_dir, "events"), folder)
    rows = read_folder(spark, folder, "json").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    return rows.select("event_id", "ts", "user_id", "event_type", "value", "props")


@query(
    "S4",
    sql="""
    SELECT word, count(*) AS n, sum(position)::BIGINT AS positions
    FROM (SELECT unnest(words) AS word, unnest(range(len(words))) AS position
          FROM (SELECT string_split(text, ' ') AS words FROM documents))
    GROUP BY word""",
)
def columnar_json_words(spark, sf_dir):
    """Each document as a JSON object of parallel arrays, unpacked to one row per word."""
    words = F.split("text", " ")
    document = F.to_json(
        F.struct(F.sequence(F.lit(0), F.size(words) - 1).alias("position"), words.alias("word"))
    )
    packed = table(spark, sf_dir, "documents").select(document.alias("value"))
    rows = read_columnar_json(packed, "position int, word string")
    return rows.groupBy("word").agg(F.count("*").alias("n"), F.sum("position").alias("positions"))


@query("S3", sql="SELECT * EXCLUDE (ts) FROM events")
def json_array_read(spark, sf_dir):
    """Every file is one JSON array over many lines."""

    def array_documents(frames):
        opened = False
        for frame in frames:
            if len(frame):
                lines = ["," + v if opened or i else "[" + v for i, v in enumerate(frame["value"])]
                opened = True
                yield pd.DataFrame({"value": lines})
        yield pd.DataFrame({"value": ["]" if opened else "[]"]})

    folder = scratch_path(spark, "arrays")
    events = table(spark, sf_dir, "events").drop("ts")
    texts = events.select(F.to_json(F.struct("*")).alias("value"))
    write_text(texts.mapInPandas(array_documents, "value string"), folder)
    return read_folder(spark, folder, "json", schema=events.schema, glob="*.txt", multiline=True)


@query("S16", sql="SELECT p_partkey, p_name, p_brand, p_size FROM part")
def zipped_csv_read(spark, sf_dir):
    """Each batch of lines as a zip archive with one CSV member and one to be ignored."""

    def zipped(frames):
        for i, frame in enumerate(frames):
            content = io.BytesIO()
            with zipfile.ZipFile(content, "w", zipfile.ZIP_DEFLATED) as archive:
                archive.writestr("rows.csv", "\n".join(frame["value"]) + "\n")
                archive.writestr("notes.txt", "not read")
            yield pd.DataFrame({"path": [f"{i}.zip"], "content": [content.getvalue()]})

    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_size")
    lines = part.select(F.to_csv(F.struct("*")).alias("value"))
    archives = lines.mapInPandas(zipped, "path string, content binary")
    parsed = F.from_csv("value", "p_partkey bigint, p_name string, p_brand string, p_size int")
    return unpack_archives(archives).select(parsed.alias("row")).select("row.*")


@query("S16", sql="SELECT p_partkey, p_name, p_brand, p_size FROM part")
def archived_members_read(spark, sf_dir):
    """Archives in a folder, ten members each, that many tasks read member by member."""
    folder, locate = scratch_path(spark, "archives"), file_systems()

    def zipped(frames):
        for i, frame in enumerate(frames):
            task = TaskContext.get().partitionId()
            store, inside = locate(folder)
            store.create_dir(inside)
            with (
                store.open_output_stream(f"{inside}/{task}-{i}.zip") as stream,
                zipfile.ZipFile(stream, "w", zipfile.ZIP_DEFLATED) as archive,
            ):
                for n, member in frame.groupby(frame.index % 10):
                    archive.writestr(f"rows-{n}.csv", "\n".join(member["value"]) + "\n")
                archive.writestr("notes.txt", "not read")
            yield pd.DataFrame({"path": [f"{task}-{i}.zip"]})

    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_size")
    part.select(F.to_csv(F.struct("*")).alias("value")).mapInPandas(zipped, "path string").count()
    parsed = F.from_csv("value", "p_partkey bigint, p_name string, p_brand string, p_size int")
    return read_zip_members(spark, folder).select(parsed.alias("row")).select("row.*")


@query(
    "S11",
    sql="""
    SELECT label, count(*) AS n FROM events
    JOIN (VALUES ('click', 'look'), ('view', 'look'), ('purchase', 'buy')) AS t(event_type, label)
    USING (event_type) GROUP BY label""",
)
def literal_labels(spark, sf_dir):
    """Events labelled by a literal table; counted per type first, so no hot join key."""
    labels = literal_table(
        spark,
        [("click", "look"), ("view", "look"), ("purchase", "buy")],
        "event_type string, label string",
    )
    per_type = table(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("n"))
    return per_type.join(labels, "event_type").groupBy("label").agg(F.sum("n").alias("n"))


@query("F9 F14", sql="SELECT 'orders' AS source, count(*) AS n, true AS stamped, true AS by_user FROM orders")
def source_file_rows(spark, sf_dir):
    """Rows per source file name, with a load time on every row."""
    orders = table(spark, sf_dir, "orders").select(
        F.regexp_extract("_metadata.file_path", r"/(\w+)\.parquet", 1).alias("source"),
        F.current_timestamp().alias("loaded_at"),
        F.current_user().alias("loaded_by"),
    )
    stamped = F.min(F.col("loaded_at").between("2020-01-01", F.current_timestamp()))
    by_user = F.min(F.length("loaded_by") > 0)
    return orders.groupBy("source").agg(F.count("*").alias("n"), stamped.alias("stamped"), by_user.alias("by_user"))


@query("S5 K18", sql="SELECT * FROM lineitem")
def parquet_folder_read(spark, sf_dir):
    folder = scratch_path(spark, "parquet")
    write_parquet(table(spark, sf_dir, "lineitem"), folder)
    return read_folder(spark, folder, "parquet")


@query("S6", sql="SELECT * FROM customer")
def mixed_folder_glob(spark, sf_dir):
    """A folder with CSV, JSON and text files; only the CSV files count."""
    folder = scratch_path(spark, "mixed")
    customer = table(spark, sf_dir, "customer")
    write_csv(customer, folder, sep=",")
    write_json(customer.select("c_custkey"), folder, mode="append")
    write_text(customer, folder, "c_name", mode="append")
    return read_folder(spark, folder, "csv", sep=",", glob="*.csv")


@query("S7", sql=ORDERS_WITH_DAY)
def first_file_schema_read(spark, sf_dir):
    folder = scratch_path(spark, "many-files")
    orders = table(spark, sf_dir, "orders")
    for status in ("F", "O", "P"):
        write_csv(orders.filter(F.col("o_orderstatus") == status), folder, sep=",", mode="append")
    schema = infer_schema_first_file(spark, folder, "csv", sep=",")
    return _with_day(read_folder(spark, folder, "csv", sep=",", schema=schema))


def _events_with_bad_files(spark, sf_dir):
    """CSV files of all events; those with `error` events hold text in a number column."""
    folder = scratch_path(spark, "some-bad")
    events = table(spark, sf_dir, "events").drop("ts")
    good, bad = F.col("event_type") != "error", F.col("event_type") == "error"
    write_csv(events.filter(good), folder, sep=",")
    spoiled = events.filter(bad).withColumn("value", F.concat(F.lit("?"), "value"))
    write_csv(spoiled, folder, sep=",", mode="append")
    return read_folder_tolerant(spark, folder, "csv", schema=events.schema, sep=",")


@query(
    "S8",
    sql="SELECT * EXCLUDE (ts) FROM events WHERE event_type <> 'error'",
)
def tolerant_folder_read(spark, sf_dir):
    return _events_with_bad_files(spark, sf_dir)[0]


@query(
    "S8",
    sql="SELECT event_type <> 'error' AS ok, count(*) AS n_rows FROM events GROUP BY 1",
)
def tolerant_folder_report(spark, sf_dir):
    report = _events_with_bad_files(spark, sf_dir)[1]
    return report.groupBy("ok").agg(F.sum("n_rows").alias("n_rows"))


@query(
    "S9",
    sql="""
    SELECT p_partkey::DOUBLE AS p_partkey, p_name, p_brand, p_type, p_size::DOUBLE AS p_size,
           p_retailprice
    FROM part""",
)
def widened_integers(spark, sf_dir):
    return widen_ints(table(spark, sf_dir, "part"))


@query(
    "S10 K17",
    sql=r"""
    SELECT line, count(*) AS n
    FROM (SELECT unnest(regexp_split_to_array(text, '\r\n|\n|\r')) AS line FROM documents)
    GROUP BY line""",
)
def text_lines_read(spark, sf_dir):
    folder = scratch_path(spark, "text")
    write_text(table(spark, sf_dir, "documents"), folder, "text")
    return read_text(spark, folder).groupBy(F.col("value").alias("line")).agg(F.count("*").alias("n"))


@query(
    "S13",
    sql="""
    SELECT id, count(o_orderkey) AS n_orders
    FROM (SELECT unnest(range((SELECT min(o_orderkey) FROM orders),
                              (SELECT max(o_orderkey) + 100 FROM orders))) AS id)
    LEFT JOIN orders ON o_orderkey = id GROUP BY id""",
)
def number_range_rows(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    first, last = orders.agg(F.min("o_orderkey"), F.max("o_orderkey")).head()
    numbers = number_range(spark, first, last + 100)
    per_key = orders.groupBy(F.col("o_orderkey").alias("id")).agg(F.count("*").alias("n"))
    found = numbers.join(per_key, "id", "left")
    return found.select("id", F.coalesce("n", F.lit(0)).alias("n_orders"))


@query(
    "S17",
    sql="""
    SELECT strftime(day, '%Y-%m-%d') AS day, count(o_orderkey) AS n_orders
    FROM (SELECT unnest(generate_series((SELECT min(o_orderdate) FROM orders),
                                        (SELECT max(o_orderdate) FROM orders),
                                        INTERVAL 1 DAY)) AS day)
    LEFT JOIN orders ON o_orderdate = day GROUP BY day""",
)
def date_range_rows(spark, sf_dir):
    """Orders per day, counted before the join, so that a busy day is no skewed key."""
    orders = table(spark, sf_dir, "orders")
    per_day = orders.groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count("*").alias("n"))
    first, n = per_day.agg(F.min("day"), F.datediff(F.max("day"), F.min("day")) + 1).head()
    days = date_range(spark, first, n).join(per_day, "day", "left")
    return days.select(
        F.date_format("day", "yyyy-MM-dd").alias("day"), F.coalesce("n", F.lit(0)).alias("n_orders")
    )


def _uniform(label):
    return f"('0x' || substr(md5('42:{label}:' || id), 1, 8))::BIGINT / 4294967296.0::DOUBLE"


@query(
    "S14 F10 F11",
    sql=f"""
    SELECT id, 'Person_' || (id - 1) AS name,
           (18 + floor({_uniform("age")} * 62))::INT AS age,
           round(30000 + ({_uniform("salary")}) * 90000, 2) AS salary,
           ['HR', 'IT', 'Sales', 'Marketing', 'Engineering'][
               (1 + floor({_uniform("department")} * 5))::INT] AS department,
           strftime(TIMESTAMP '2025-01-01' - to_days(floor({_uniform("hire_date")} * 1825)::INT),
                    '%Y-%m-%d') AS hire_date,
           {_uniform("active")} < 0.9 AS active
    FROM (SELECT c_custkey + 1 AS id FROM customer)""",
)
def synthetic_people(spark, sf_dir):
    """A synthetic person for every customer."""
    ids = table(spark, sf_dir, "customer").select((F.col("c_custkey") + 1).alias("id"))
    people = add_person_columns(ids, "id", as_of="2025-01-01 00:00:00")
    return people.withColumn("hire_date", F.date_format("hire_date", "yyyy-MM-dd"))


@query(
    "S18",
    sql="SELECT (sum(strlen(c_name) + 1))::BIGINT AS n_bytes, true AS sizes_known FROM customer",
)
def file_inventory_bytes(spark, sf_dir):
    """Sizes in the listing add up to the bytes written."""
    folder = scratch_path(spark, "listed")
    write_text(table(spark, sf_dir, "customer"), folder, "c_name")
    files = file_inventory(spark, folder, glob="*.txt")
    return files.agg(
        F.sum("size").alias("n_bytes"), F.min(F.col("modificationTime").isNotNull()).alias("sizes_known")
    )


@query("T8", sql="SELECT count(*) AS n_rows, 6 AS n_columns, true AS has_files FROM orders")
def stored_table_stats(spark, sf_dir):
    folder = scratch_path(spark, "stats")
    write_parquet(table(spark, sf_dir, "orders"), folder)
    stats = table_stats(spark, folder)
    sized = (F.col("n_files") > 0) & (F.col("n_bytes") > 0)
    return stats.select("n_rows", "n_columns", sized.alias("has_files"))


@query(
    "T10 F13",
    sql="SELECT (sum(strlen(text) + 1))::BIGINT AS n_bytes, true AS all_hashed FROM conversations",
)
def checksum_manifest_bytes(spark, sf_dir):
    folder = scratch_path(spark, "hashed")
    write_text(table(spark, sf_dir, "conversations"), folder, "text")
    manifest = checksum_manifest(spark, folder, glob="*.txt")
    hashed = F.min(F.col("sha256").rlike("^[0-9a-f]{64}$"))
    return manifest.agg(F.sum("size").alias("n_bytes"), hashed.alias("all_hashed"))


@query(
    "T10 F13",
    sql="""
    SELECT (sum(strlen(text) + 1))::BIGINT AS n_bytes, true AS streamed_alike, true AS one_range_alike
    FROM conversations""",
)
def ranged_checksums(spark, sf_dir):
    """Files hashed as streams, in one range and in ranges of 16 kB, beside Spark's own reader."""
    folder = scratch_path(spark, "ranged")
    write_text(table(spark, sf_dir, "conversations"), folder, "text")
    whole = checksum_manifest(spark, folder, "*.txt")
    streamed = checksum_manifest(spark, folder, "*.txt", whole=0).select("path", F.col("sha256").alias("streamed"))
    single = tree_manifest(spark, folder, "*.txt").select("path", F.col("sha256").alias("single"))
    ranged = tree_manifest(spark, folder, "*.txt", size=16 << 10).select("path", F.col("sha256").alias("ranged"))
    joined = whole.join(streamed, "path").join(single, "path").join(ranged, "path")
    small = (F.col("size") <= 16 << 10) == (F.col("ranged") == F.col("sha256"))
    return joined.agg(
        F.sum("size").alias("n_bytes"),
        F.min(F.col("sha256") == F.col("streamed")).alias("streamed_alike"),
        F.min((F.col("sha256") == F.col("single")) & small).alias("one_range_alike"),
    )
