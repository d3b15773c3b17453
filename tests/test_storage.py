"""Readers, writers, catalog, maintenance and loads on real files."""

import gzip
import hashlib
import math
import os
import zipfile
from pathlib import Path
from types import SimpleNamespace
from urllib.parse import unquote

import duckdb
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarn.operators import profile
from tarn.operators.keys import gappy_ids
from tarn.operators.maintain import checksum_manifest, compact, discover_tables, expired_files, table_stats
from tarn.operators.mutate import merge_partitions
from tarn.operators.validate import append_checked, check_new_keys
from tarn.plans import loads
from tarn.plans.loads import LoadSpec, load_distinct_per_file, load_folder, run_graph, run_loads, run_together
from tarn.session import broadcast_if_small, comes_in_file_order, scratch_path, settings
from tarn.sources import catalog, generated, ranges, readers, writers
from tests.conftest import rows


def put(folder, **files):
    Path(folder).mkdir(parents=True, exist_ok=True)
    for name, text in files.items():
        (Path(folder) / name.replace("__", ".")).write_text(text)
    return str(folder)


# ---- readers ------------------------------------------------------------------------


def test_csv_fixture(spark, tmp_path):
    folder = put(tmp_path / "raw", dummy__csv="naam,waarde\na,1\nb,2\nc,3\n", notes__txt="no")
    df = readers.read_folder(spark, folder, "csv", sep=",")
    assert rows(df) == [("a", 1), ("b", 2), ("c", 3)]
    assert df.schema["waarde"].dataType.simpleString() == "int"
    wrong = readers.read_folder(spark, folder, "csv")
    assert wrong.columns == ["naam,waarde"]
    with pytest.raises(ValueError, match="unsupported"):
        readers.read_folder(spark, folder, "xml")


def test_csv_round_trip_keeps_quotes_newlines_and_microseconds(spark, tmp_path):
    df = spark.sql(
        """SELECT 'a "quoted", text' AS t, TIMESTAMP_NTZ '2024-01-01 00:00:07.179575' AS ts
           UNION ALL SELECT 'two\nlines', TIMESTAMP_NTZ '2024-01-01 00:00:00.000001'"""
    )
    writers.write_csv(df, str(tmp_path / "c"))
    back = readers.read_folder(spark, str(tmp_path / "c"), "csv", schema=df.schema, multiline=True)
    assert rows(back) == rows(df)
    writers.write_json(df, str(tmp_path / "j"))
    assert rows(readers.read_folder(spark, str(tmp_path / "j"), "json", schema=df.schema)) == rows(df)


def test_schema_of_first_file_is_imposed(spark, tmp_path):
    folder = put(tmp_path, a__csv="x;y\n1;2.5\n", b__csv="x;y\n2;3\n")
    schema = readers.infer_schema_first_file(spark, folder, "csv")
    assert schema.simpleString() == "struct<x:int,y:double>"
    assert rows(readers.read_folder(spark, folder, "csv", schema=schema)) == [(1, 2.5), (2, 3.0)]


def test_schema_sample_is_limited(spark, tmp_path):
    folder = put(tmp_path, a__csv="x\n1\n2\n2.5\n", b__json='{"x": 1}\n{"x": "late"}\n')
    assert readers.infer_schema_first_file(spark, folder, "csv", n=2).simpleString() == "struct<x:int>"
    assert readers.infer_schema_first_file(spark, folder, "csv", n=3).simpleString() == "struct<x:double>"
    assert readers.infer_schema_first_file(spark, folder, "json", n=1).simpleString() == "struct<x:bigint>"
    put(tmp_path / "empty", a__csv="x\n", b__csv="x\n7\n")
    assert readers.infer_schema_first_file(spark, f"{folder}/empty", "csv").simpleString() == "struct<x:int>"
    with pytest.raises(Exception, match="(?i)malformed"):
        readers.read_folder(spark, folder, "csv", schema="x int").collect()
    with pytest.raises(FileNotFoundError):
        readers.infer_schema_first_file(spark, folder, "parquet")


def test_large_sample_keeps_its_header_first(spark, tmp_path):
    writers.write_csv(spark.range(120_000).withColumn("v", F.col("id") / 2).coalesce(1), str(tmp_path / "c"))
    schema = readers.infer_schema_first_file(spark, str(tmp_path / "c"), "csv")
    assert schema.simpleString() == "struct<id:int,v:double>"


def names(report, ok):
    return sorted(os.path.basename(r.path) for r in report.filter(F.col("ok") == ok).collect())


def test_bad_csv_files_are_left_out_whole(spark, tmp_path):
    folder = put(
        tmp_path,
        a__csv="x,y\n1,one\n2,two\n",
        b__csv="x,y\n3,three\nfour,4\n",
        c__csv="x;y\n5;five\n",
        d__csv="x,y\n6,six\n",
        e__csv="x,y\n",
    )
    good, report = readers.read_folder_tolerant(spark, folder, "csv", sep=",")
    assert rows(good) == [(1, "one"), (2, "two"), (6, "six")]
    assert rows(good.select("y")) == [("one",), ("six",), ("two",)]
    assert names(report, False) == ["b.csv", "c.csv"]
    schema = good.schema
    readers.read_folder_tolerant(spark, folder, "csv", schema=schema, sep=",")
    assert schema.names == ["x", "y"]
    assert names(report, True) == ["a.csv", "d.csv", "e.csv"]


def test_bad_json_files(spark, tmp_path):
    folder = put(tmp_path, a__json='{"x": 1}\n{"x": 2}\n', b__json='{"x": 3}\n{"x": oops\n')
    good, report = readers.read_folder_tolerant(spark, folder, "json")
    assert rows(good) == [(1,), (2,)] and names(report, False) == ["b.json"]


def test_bad_parquet_files(spark, tmp_path):
    folder = str(tmp_path / "p")
    spark.range(0, 100, 1, 2).write.parquet(folder)
    parts = sorted(Path(folder).glob("*.parquet"))
    damaged = tmp_path / "p" / "zz.parquet"
    damaged.write_bytes(parts[0].read_bytes()[:-40])
    good, report = readers.read_folder_tolerant(spark, folder, "parquet")
    assert good.count() == 100 and names(report, False) == ["zz.parquet"]


def test_no_readable_file_is_an_error(spark, tmp_path):
    folder = put(tmp_path, a__csv="x\nword\n")
    with pytest.raises(ValueError, match="no readable"):
        readers.read_folder_tolerant(spark, folder, "csv", schema=spark.range(1).schema)


def test_columnar_json(spark):
    text = '{"Name":["John","Jane","Alice","Bob"],"Age":[25,30,35,40],"City":["New York","Paris","London","Tokyo"]}'
    df = spark.createDataFrame([(text,)], "value string")
    got = readers.read_columnar_json(df, "Name string, Age int, City string")
    assert got.columns == ["Name", "Age", "City"]
    assert [tuple(r) for r in got.collect()][3] == ("Bob", 40, "Tokyo")


def test_text_has_no_header(spark, tmp_path):
    folder = put(tmp_path, r__txt="This is some dummy content for the text file.\n")
    assert rows(readers.read_text(spark, folder)) == [("This is some dummy content for the text file.",)]


def test_zip_members(spark, tmp_path):
    for i in range(3):
        with zipfile.ZipFile(tmp_path / f"z{i}.zip", "w") as z:
            z.writestr("b.csv", "\n".join(f"{i},{n}" for n in range(25)))
            z.writestr("a.csv", "é,1\r\n")
            z.writestr("skip.txt", "no")
    got = ranges.read_zip_members(spark, str(tmp_path))
    assert got.count() == 3 * 26
    first = got.filter("archive LIKE '%z1.zip'").orderBy("member", "line_number").head(3)
    assert [(r.member, r.line_number, r.value) for r in first] == [
        ("a.csv", 1, "é,1"), ("b.csv", 1, "1,0"), ("b.csv", 2, "1,1"),
    ]
    small = readers.unpack_archives(
        spark.read.format("binaryFile").load(str(tmp_path)).select("path", "content"), batch_lines=10
    )
    assert rows(small.select("member", "line_number", "value")) == rows(
        got.select("member", "line_number", "value")
    )


def test_file_inventory_and_manifest(spark, tmp_path):
    folder = put(tmp_path / "d", a__txt="hello", b__txt="worlds!")
    files = readers.file_inventory(spark, folder)
    assert sorted((os.path.basename(r.path), r.size) for r in files.collect()) == [("a.txt", 5), ("b.txt", 7)]
    assert "content" not in files._jdf.queryExecution().executedPlan().toString()
    manifest = {os.path.basename(r.path): r.sha256 for r in checksum_manifest(spark, folder).collect()}
    assert manifest["a.txt"] == hashlib.sha256(b"hello").hexdigest()


def test_one_archive_is_read_by_many_tasks(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "all in one.zip", "w", zipfile.ZIP_DEFLATED) as z:
        for i in range(100):
            z.writestr(f"{i}.csv", "".join(f"{i},{n}\n" for n in range(i)))
        with pytest.warns(UserWarning):
            z.writestr("7.csv", "same name\n")
    got = ranges.read_zip_members(spark, str(tmp_path), batch_lines=16)
    tasks = got.select("member", F.spark_partition_id().alias("task")).distinct()
    assert tasks.select("task").distinct().count() > 8
    expected = [(f"{i}.csv", n + 1, f"{i},{n}") for i in range(100) for n in range(i)] + [("7.csv", 1, "same name")]
    assert rows(got.select("member", "line_number", "value")) == sorted(expected)
    empty = tmp_path / "none"
    empty.mkdir()
    assert ranges.read_zip_members(spark, str(empty)).count() == 0


def test_hashes_of_ranges(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ranges, "FAN", 4)
    contents = {"a.bin": bytes(range(256)) * 40, "b.bin": b"z", "c.bin": b"x" * 100, "d.bin": b"y" * 401}
    for name, data in contents.items():
        (tmp_path / name).write_bytes(data)

    def tree(data):
        level = [hashlib.sha256(data[i : i + 100]).hexdigest() for i in range(0, max(len(data), 1), 100)]
        while len(level) > 1:
            level = [hashlib.sha256("".join(level[i : i + 4]).encode()).hexdigest() for i in range(0, len(level), 4)]
        return level[0]

    got = {os.path.basename(r.path): r.sha256 for r in ranges.tree_manifest(spark, str(tmp_path), size=100).collect()}
    assert got == {name: tree(data) for name, data in contents.items()}
    streamed = {os.path.basename(r.path): r.sha256 for r in checksum_manifest(spark, str(tmp_path), whole=99).collect()}
    assert streamed == {name: hashlib.sha256(data).hexdigest() for name, data in contents.items()}
    longer = ranges.file_ranges(spark.createDataFrame([(f"{tmp_path}/c.bin", 150)], "path string, size long"), 100)
    with pytest.raises(Exception, match="ends before"):
        ranges.range_digests(longer).collect()


def test_a_file_above_two_gigabytes(spark, tmp_path):
    with open(tmp_path / "large.bin", "wb") as f:  # a hole: it takes no room on the disk
        f.truncate((2 << 30) + 5)
    row = checksum_manifest(spark, str(tmp_path)).first()
    state = hashlib.sha256()
    for _ in range(2 << 10):
        state.update(bytes(1 << 20))
    state.update(bytes(5))
    assert (row.size, row.sha256) == ((2 << 30) + 5, state.hexdigest())


def test_gzip_text(spark, tmp_path):
    with gzip.open(tmp_path / "a.csv.gz", "wt") as f:
        f.write("x;y\n1;2\n")
    assert rows(readers.read_folder(spark, str(tmp_path), "csv", glob="*.csv.gz")) == [(1, 2)]


# ---- generated ----------------------------------------------------------------------


def test_people_do_not_depend_on_partitioning(spark):
    one = generated.synth_people(spark, 1000, as_of="2025-01-01")
    other = generated.add_person_columns(spark.range(1, 1001).repartition(13), "id", as_of="2025-01-01")
    assert rows(one) == rows(other)
    low, high, cheap, dear, active, departments = one.agg(
        F.min("age"), F.max("age"), F.min("salary"), F.max("salary"),
        F.avg(F.col("active").cast("int")), F.count_distinct("department"),
    ).head()
    assert 18 <= low and high <= 79 and 30_000 <= cheap and dear <= 120_000
    assert 0.85 < active < 0.95 and departments == 5
    assert one.filter("hire_date > '2025-01-01' OR hire_date < '2020-01-03'").count() == 0
    assert one.filter("id = 1").head().name == "Person_0"
    assert rows(generated.synth_people(spark, 50, seed=1).drop("hire_date")) != rows(
        generated.synth_people(spark, 50, seed=2).drop("hire_date")
    )


def test_ranges(spark):
    assert [r[0] for r in generated.number_range(spark, 2010, 2021, "year").collect()] == list(range(2010, 2021))
    days = generated.date_range(spark, "2013-01-01", 6).collect()
    assert str(days[0][0]) == "2013-01-01" and str(days[-1][0]) == "2013-01-06"


# ---- writers ------------------------------------------------------------------------


def test_single_csv(spark, tmp_path):
    df = spark.createDataFrame([("rij1", "a"), ("rij2", "b")], ["koloma", "kolomb"])
    for _ in range(2):
        path = writers.write_single_csv(df.repartition(2, "koloma"), str(tmp_path), "part_file")
    assert [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["part_file.csv"]
    lines = Path(path.removeprefix("file:")).read_text().splitlines()
    assert lines[0] == "koloma,kolomb" and sorted(lines[1:]) == ["rij1,a", "rij2,b"]
    with pytest.raises(Exception, match="more than 1 rows"):
        writers.write_single_csv(df, str(tmp_path), "x", max_rows=1)
    with pytest.raises(ValueError, match="more than 1 rows"):
        writers.export_rows(df, 1)


def test_replace_keeps_the_old_table_when_the_job_fails(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.replace_folder(spark.range(5), path)
    with pytest.raises(Exception, match="boom"):
        writers.replace_folder(spark.range(3).select(F.raise_error(F.lit("boom")).cast("long").alias("id")), path)
    assert spark.read.parquet(path).count() == 5
    writers.replace_folder(spark.read.parquet(path).filter("id > 1"), path)
    assert spark.read.parquet(path).count() == 3


def test_append_again_doubles_but_batches_do_not(spark, tmp_path):
    for _ in range(2):
        writers.append_or_create(spark.range(4), str(tmp_path / "plain"))
        writers.append_or_create(spark.range(4), str(tmp_path / "batched"), batch="2024-01-01")
    writers.append_or_create(spark.range(4), str(tmp_path / "batched"), batch="2024-01-02")
    assert spark.read.parquet(str(tmp_path / "plain")).count() == 8
    assert spark.read.parquet(str(tmp_path / "batched")).count() == 8


def test_distinct_per_file(spark, tmp_path):
    src = put(tmp_path / "src", a__csv="x,y\n1,a\n1,a\n2,b\n", b__csv="x,y\n1,a\n3,c\n3,c\n")
    load_distinct_per_file(spark, src, str(tmp_path / "dst"))
    got = spark.read.parquet(str(tmp_path / "dst"))
    assert rows(got.select("file_stem", "x")) == [("a", 1), ("a", 2), ("b", 1), ("b", 3)]
    put(src, c__csv="x,y\nbad,z\n")
    load_distinct_per_file(spark, src, str(tmp_path / "good"), on_error="skip")
    assert rows(spark.read.parquet(str(tmp_path / "good")).select("file_stem", "x")) == rows(
        got.select("file_stem", "x")
    )
    os.remove(f"{src}/c.csv")
    load_distinct_per_file(spark, src, str(tmp_path / "all"), scope="all")
    assert rows(spark.read.parquet(str(tmp_path / "all")).select("file_stem", "x")) == [("a", 1), ("a", 2), ("b", 3)]


def test_distinct_per_file_layout(spark, tmp_path):
    src = tmp_path / "src"
    writers.write_csv(spark.range(250_000).coalesce(1), str(src), sep=",")
    load_distinct_per_file(spark, str(src), str(tmp_path / "dst"))
    files = f"{tmp_path}/dst/*/*.parquet"
    con = duckdb.connect()
    codecs = con.execute(f"SELECT DISTINCT compression FROM parquet_metadata('{files}')").fetchall()
    largest = con.execute(f"SELECT max(row_group_num_rows) FROM parquet_metadata('{files}')").fetchall()
    assert codecs == [("ZSTD",)] and largest[0][0] <= 100_000
    assert spark.read.parquet(str(tmp_path / "dst")).count() == 250_000


def test_sized_write_and_compaction(spark, tmp_path):
    path = str(tmp_path / "many")
    spark.range(0, 20_000, 1, 40).write.parquet(path)
    assert compact(spark, path)
    assert not compact(spark, path)
    stats = table_stats(spark, path).head()
    assert (stats.n_files, stats.n_rows, stats.n_columns) == (1, 20_000, 1)
    assert rows(spark.read.parquet(path)) == [(i,) for i in range(20_000)]
    writers.write_sized(spark.range(0, 20_000, 1, 40), str(tmp_path / "sized"))
    assert table_stats(spark, str(tmp_path / "sized")).head().n_files < 8
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    with pytest.raises(RuntimeError), settings(spark, spark__sql__files__maxPartitionBytes="1m"):
        raise RuntimeError
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before


def test_compaction_keeps_partition_folders(spark, tmp_path):
    path = str(tmp_path / "batches")
    for batch in ("2024-01-01", "007"):
        writers.append_or_create(spark.range(0, 1000, 1, 10), path, batch=batch)
    assert compact(spark, path) and not compact(spark, path)
    assert sorted(p.name for p in Path(path).glob("batch=*")) == ["batch=007", "batch=2024-01-01"]
    assert len(list(Path(path).glob("batch=*/*.parquet"))) == 2
    assert spark.read.parquet(path).count() == 2000


def test_broadcast_only_below_the_bound(spark):
    assert "hint" in broadcast_if_small(spark.range(5), 5)._jdf.queryExecution().logical().toString().lower()
    assert "hint" not in broadcast_if_small(spark.range(6), 5)._jdf.queryExecution().logical().toString().lower()


def test_scratch_is_where_the_session_says(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    path = scratch_path(spark, "x")
    assert path != scratch_path(spark, "x")
    assert base is None or path.startswith(base)


def test_scratch_without_a_setting():
    def session(master):
        conf = {"spark.sql.warehouse.dir": "hdfs://shared/warehouse"}
        return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))

    assert Path(scratch_path(session("local[2]"), "x")).parent.is_dir()
    assert scratch_path(session("yarn"), "x").startswith("hdfs://shared/warehouse/")


# ---- catalog ------------------------------------------------------------------------


@pytest.fixture
def schema(spark):
    catalog.create_schema(spark, "tarn_test")
    yield "tarn_test"
    catalog.drop_schema(spark, "tarn_test")


def test_schema_life(spark, schema, tmp_path):
    writers.overwrite_table(spark.range(3), f"{schema}.t", str(tmp_path / "t"))
    spark.range(4).write.parquet(str(tmp_path / "e"))
    for _ in range(2):
        catalog.register_external(spark, f"{schema}.e", str(tmp_path / "e"))
    assert rows(catalog.list_tables(spark, ("default",))) == [(schema, "e"), (schema, "t")]
    assert catalog.read_table(spark, f"{schema}.e").count() == 4
    assert rows(catalog.list_tables(spark, (schema, "default"))) == []
    catalog.create_schema(spark, schema, use=True)
    assert spark.table("t").count() == 3
    spark.catalog.setCurrentDatabase("default")


def test_save_as_table_refuses_an_existing_one(spark, schema, tmp_path):
    writers.overwrite_table(spark.range(3), f"{schema}.t", str(tmp_path / "t"))
    with pytest.raises(PySparkException, match="ALREADY_EXISTS"):
        spark.range(1).write.saveAsTable(f"{schema}.t")


def test_seed_only_an_empty_table(spark, schema, tmp_path):
    spark.sql(f"CREATE TABLE {schema}.c (country_key INT, name STRING) USING parquet LOCATION '{tmp_path}/c'")
    seed = spark.createDataFrame([(1, "a"), (2, "b")], "country_key int, name string")
    assert catalog.insert_if_empty(seed, f"{schema}.c")
    assert not catalog.insert_if_empty(seed, f"{schema}.c")
    assert spark.table(f"{schema}.c").count() == 2


def test_gappy_ids_do_not_fit_an_int_key(spark, schema, tmp_path):
    spark.sql(f"CREATE TABLE {schema}.k (id INT) USING parquet LOCATION '{tmp_path}/k'")
    ids = gappy_ids(spark.range(0, 10, 1, 4).drop("id").select(F.lit(1).alias("x"))).select("id")
    assert ids.distinct().count() == 10
    with pytest.raises(Exception, match="(?i)overflow"):
        catalog.insert_into(ids, f"{schema}.k")


def test_describe_schema_and_views(spark):
    df = spark.createDataFrame([(1, "a")], "a int, b string")
    assert rows(catalog.describe_schema(df)) == [(0, "a", "int", True), (1, "b", "string", True)]
    catalog.replace_view(df, "tarn_view")
    catalog.replace_view(df.filter("false"), "tarn_view")
    assert spark.table("tarn_view").count() == 0
    spark.catalog.dropTempView("tarn_view")


# ---- maintenance and loads ----------------------------------------------------------


def test_discovery(spark):
    keys = ["warehouse/b/_delta_log/0.json", "warehouse/a/_delta_log/0.json", "warehouse/a/p.parquet",
            "warehouse/a/_delta_log/1.json", "x_delta_log_notes.txt"]
    got = discover_tables(spark.createDataFrame([(k,) for k in keys], "path string"))
    assert [r[0] for r in got.collect()] == ["warehouse/a", "warehouse/b"]


def test_retention(spark):
    files = spark.sql(
        """SELECT * FROM VALUES ('old', TIMESTAMP '2024-01-01'), ('live', TIMESTAMP '2024-01-01'),
           ('young', TIMESTAMP '2024-01-09') AS t(path, modificationTime)"""
    )
    live = spark.createDataFrame([("live",)], "path string")
    now = F.lit("2024-01-10 00:00:00").cast("timestamp")
    assert [r.path for r in expired_files(files, live, now=now).collect()] == ["old"]


def test_load_list(spark, tmp_path, schema):
    put(tmp_path / "raw/people_csv", a__csv="first name;the-age\nann;3\n")
    put(tmp_path / "raw/bad", a__csv="x;y\n1;2\n", b__csv="x;y\nq;2\n")
    loads = run_loads(
        spark,
        [
            LoadSpec(f"{tmp_path}/raw/people_csv/", f"{tmp_path}/wh", table=f"{schema}.people"),
            LoadSpec(f"{tmp_path}/raw/bad/", f"{tmp_path}/wh", on_error="skip", mode="replace"),
        ],
    )
    paths = [load.path for load in loads]
    assert [os.path.basename(p) for p in paths] == ["people", "bad"]
    assert loads[0].report is None and names(loads[1].report, False) == ["b.csv"]
    assert spark.table(f"{schema}.people").columns == ["first_name", "the_age"]
    assert rows(spark.read.parquet(paths[1])) == [(1, 2)]
    load_folder(spark, LoadSpec(f"{tmp_path}/raw/people_csv/", f"{tmp_path}/wh"))
    assert spark.read.parquet(paths[0]).count() == 2


def test_jobs_together(spark):
    assert run_together([lambda i=i: spark.range(i).count() for i in (1, 2, 3)]) == [1, 2, 3]
    with pytest.raises(ZeroDivisionError):
        run_together([lambda: 1 // 0])


# ---- nothing is lost silently -------------------------------------------------------


def test_compaction_keeps_columns_and_cuts_large_files(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).select(F.col("id").alias("x")).coalesce(1).write.parquet(path)
    more = spark.range(10, 20).select(F.col("id").alias("x"), F.lit("e").alias("extra"))
    more.coalesce(1).write.mode("append").parquet(path)
    noise = spark.range(200_000).select(F.col("id").alias("x"), F.sha2(F.col("id").cast("string"), 512).alias("extra"))
    noise.coalesce(1).write.mode("append").parquet(path)
    large = max(p.stat().st_size for p in Path(path).glob("*.parquet"))
    assert large > 12 << 20
    assert compact(spark, path, target_mb=4) and not compact(spark, path, target_mb=4)
    sizes = [p.stat().st_size for p in Path(path).glob("*.parquet")]
    assert max(sizes) < large / 2 and sum(s < 2 << 20 for s in sizes) <= 1
    got = spark.read.option("mergeSchema", "true").parquet(path)
    assert got.count() == 200_020 and got.filter("extra = 'e'").count() == 10


def test_compaction_is_one_write_for_all_folders(spark, tmp_path):
    """Two hundred folders, whose values look like numbers, are null or hold blanks and
    signs; the number of jobs does not grow with them, and no session setting changes."""
    path = str(tmp_path / "t")
    name = F.when(F.col("id") % 200 == 7, None).when(F.col("id") % 200 == 8, "a b/%=é").otherwise(
        F.format_string("%05d", F.col("id") % 200)
    )
    data = spark.range(4_000).select("id", name.alias("k"), (F.col("id") % 2).alias("j"))
    data.repartition(2, "j").write.partitionBy("k").parquet(path)
    data.repartition(2, "j").write.mode("append").partitionBy("k").parquet(path)
    folders = sorted(p.name for p in Path(path).glob("k=*"))
    before, conf = rows(spark.read.schema("id long, j long, k string").parquet(path)), dict(spark.conf.getAll)
    spark.sparkContext.setJobGroup("compact-test", "compaction")
    assert compact(spark, path)
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("compact-test"))
    spark.sparkContext.setJobGroup("other", "")
    assert jobs < 20 and dict(spark.conf.getAll) == conf
    assert not compact(spark, path)
    assert sorted(p.name for p in Path(path).glob("k=*")) == folders
    assert len(list(Path(path).glob("k=*/*.parquet"))) == 200
    assert rows(spark.read.schema("id long, j long, k string").parquet(path)) == before


def test_failed_compaction_leaves_the_table(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    spark.range(0, 1000, 1, 10).write.parquet(path)
    files = sorted(p.name for p in Path(path).iterdir())
    monkeypatch.setattr(writers, "move_into_place", lambda *a: (_ for _ in ()).throw(RuntimeError("stopped")))
    with pytest.raises(RuntimeError, match="stopped"):
        compact(spark, path)
    assert sorted(p.name for p in Path(path).iterdir()) == files
    monkeypatch.undo()
    assert compact(spark, path) and spark.read.parquet(path).count() == 1000
    part = str(tmp_path / "p")
    spark.range(100).select("id", (F.col("id") % 2).alias("k")).repartition(4).write.partitionBy("k").parquet(part)
    untouched = sorted(p.name for p in Path(part, "k=1").iterdir())
    assert compact(spark, f"{part}/k=0") and spark.read.parquet(part).count() == 100
    assert sorted(p.name for p in Path(part, "k=1").iterdir()) == untouched
    assert len(list(Path(part, "k=0").glob("*.parquet"))) == 1


def test_append_refuses_another_schema(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.append_or_create(spark.createDataFrame([(1, "a")], "x int, y string"), path)
    writers.append_or_create(spark.createDataFrame([("b", 2)], "y string, x int"), path)
    assert rows(spark.read.parquet(path)) == [(1, "a"), (2, "b")]
    for bad in ("x double, y string", "x int, z string", "x int"):
        with pytest.raises(ValueError, match="the new rows have"):
            writers.append_or_create(spark.createDataFrame([], bad), path)


def test_batches_from_threads_keep_each_other(spark, tmp_path):
    path = str(tmp_path / "t")
    jobs = [lambda b=b: writers.append_or_create(spark.range(50), path, batch=str(b)) for b in range(4)]
    jobs[0]()
    run_together(jobs, threads=4)
    assert spark.read.parquet(path).count() == 200
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_swapped_header_is_refused(spark, tmp_path):
    folder = put(tmp_path / "src", a__csv="x,y\n1,2\n", b__csv="y,x\n30,40\n")
    with pytest.raises(Exception, match="(?i)header"):
        readers.read_folder(spark, folder, "csv", sep=",", schema="x int, y int").collect()
    good, report = readers.read_folder_tolerant(spark, folder, "csv", sep=",", schema=spark.createDataFrame([], "x int, y int").schema)
    assert rows(good) == [(1, 2)] and names(report, False) == ["b.csv"]


def test_types_of_the_first_file_come_from_all_its_rows(spark, tmp_path):
    lines = "x\n" + "\n".join(map(str, range(100_001))) + "\n2.5\n"
    folder = put(tmp_path / "src", a__csv=lines, b__csv="x\n7\n")
    good, report = readers.read_folder_tolerant(spark, folder, "csv", sep=",")
    assert good.count() == 100_003 and report.filter("NOT ok").isEmpty()


@pytest.mark.parametrize("bad", ["{oops", '{"a": ["x"], "b": ["y"]}', '{"a": [1, 2], "b": ["y"]}'])
def test_columnar_json_refuses_misfits(spark, bad):
    df = spark.createDataFrame([('{"a": [1], "b": ["z"]}',), (bad,)], "value string")
    with pytest.raises(Exception):  # noqa: B017
        readers.read_columnar_json(df, "a int, b string").collect()


def test_files_with_types_of_their_own(spark, tmp_path):
    src = put(tmp_path / "src", a__csv="x\n1\n1\n", b__csv="x\nword\n")
    load_distinct_per_file(spark, src, str(tmp_path / "dst"), own_schemas=True)
    kinds = [spark.read.parquet(f"{tmp_path}/dst/file_stem={s}").dtypes for s in "ab"]
    assert kinds == [[("x", "int")], [("x", "string")]]


def test_file_order_is_known_from_the_leaves(spark, tmp_path):
    spark.range(10).write.parquet(str(tmp_path / "t"))
    assert comes_in_file_order(spark.read.parquet(str(tmp_path / "t")).filter("id > 1"))
    shuffled = spark.range(10).repartition(3)
    assert not comes_in_file_order(shuffled)
    assert not comes_in_file_order(spark.createDataFrame(shuffled.rdd, "id bigint"))


def test_registration_touches_no_other_data(spark, tmp_path):
    """A managed table, a view and a table over another path are errors, and all stay."""
    path, other = str(tmp_path / "t"), str(tmp_path / "other")
    spark.range(5).write.parquet(path)
    spark.range(3).select(F.col("id").alias("x")).write.parquet(other)
    spark.range(7).select(F.col("id").alias("mine")).write.mode("overwrite").saveAsTable("tarn_managed")
    with pytest.raises(ValueError, match="managed"):
        catalog.register_external(spark, "tarn_managed", path)
    assert spark.table("tarn_managed").count() == 7
    spark.sql("DROP TABLE tarn_managed")
    spark.range(2).createOrReplaceTempView("tarn_view")
    with pytest.raises(ValueError, match="temporary"):
        catalog.register_external(spark, "tarn_view", path)
    spark.catalog.dropTempView("tarn_view")
    catalog.register_external(spark, "tarn_ext", other)
    with pytest.raises(ValueError, match="external, at"):
        catalog.register_external(spark, "tarn_ext", path)
    assert spark.table("tarn_ext").columns == ["x"]
    spark.range(3).select("id", F.lit("a").alias("y")).write.mode("overwrite").parquet(other)
    catalog.register_external(spark, "tarn_ext", other)
    assert spark.table("tarn_ext").columns == ["id", "y"] and spark.table("tarn_ext").count() == 3
    spark.sql("DROP TABLE tarn_ext")


# ---- types of every file --------------------------------------------------------------


def test_types_of_every_file_in_one_pass(spark, tmp_path):
    """The least type of each column of each file; what they infer reads back as Spark's own
    inference reads each file by itself."""
    src = tmp_path / "src"
    src.mkdir()
    (src / "a b.csv").write_text('id,v,"w",n,d,t,f\n1,1.5,x,,2024-01-01,2024-01-01 10:00:00,true\n-2,3,"y,z",,2024-02-30x,2024-01-02,False\n')
    (src / "b.csv").write_text("id,v\n99999999999,0x1\n7,\n")
    (src / "c.csv").write_text("v\n 5\n")
    (src / "d.csv").write_text("x,y\n")
    (src / "e.csv").write_text("big\n123456789012345678901234\n1\n")
    types = readers.file_types(spark, str(src), "csv", ",")
    got = {}
    for row in types.orderBy("path", "position").collect():
        got.setdefault(unquote(row.path).rsplit("/", 1)[1], []).append((row.name, row.type))
    assert got == {
        "a b.csv": [("id", "int"), ("v", "double"), ("w", "string"), ("n", "string"), ("d", "string"), ("t", "timestamp"), ("f", "boolean")],
        "b.csv": [("id", "bigint"), ("v", "string")], "c.csv": [("v", "string")],
        "d.csv": [("x", "string"), ("y", "string")], "e.csv": [("big", "decimal(38,0)")],
    }
    report = readers.misfit_report(types, T.StructType.fromDDL("id bigint, v double"))
    found = {(unquote(r.path).rsplit("/", 1)[1], r.position, r.name, r.type, r.expected) for r in report.collect()}
    assert {f for f in found if f[0] == "b.csv"} == {("b.csv", 1, "v", "string", "double")}
    assert {f for f in found if f[0] == "c.csv"} == {("c.csv", 0, "v", "string", "bigint"), ("c.csv", 1, "v", None, "double")}
    assert len({f for f in found if f[0] == "a b.csv"}) == 5

    load_distinct_per_file(spark, str(src), str(tmp_path / "dst"), own_schemas=True)
    first = spark.read.parquet(f"{tmp_path}/dst/file_stem=a b")
    assert [f.dataType.simpleString() for f in first.schema.fields] == [t for _, t in got["a b.csv"]]
    assert sorted(r.w for r in first.collect()) == ["x", "y,z"]
    assert rows(spark.read.parquet(f"{tmp_path}/dst/file_stem=b")) == [(7, None), (99999999999, "0x1")]
    assert sorted(p.name for p in Path(tmp_path / "dst").glob("file_stem=*")) == [
        "file_stem=a b", "file_stem=b", "file_stem=c", "file_stem=e"]


def test_many_files_cost_one_inference(spark, tmp_path):
    for fmt, lines in (("csv", "a,b\n{i},x\n"), ("json", '{{"a": {i}, "b": "x", "c": {{"d": [1.5, null]}}}}\n')):
        src, dst = tmp_path / fmt, str(tmp_path / f"{fmt}-out")
        src.mkdir()
        for i in range(60):
            (src / f"f{i}.{fmt}").write_text(lines.format(i=i))
        spark.sparkContext.setJobGroup(f"types-{fmt}", "")
        load_distinct_per_file(spark, str(src), dst, fmt=fmt, own_schemas=True)
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"types-{fmt}"))
        spark.sparkContext.setJobGroup("other", "")
        assert jobs < 20
        whole = spark.read.parquet(dst)
        assert sorted(r.a for r in whole.collect()) == list(range(60))
        if fmt == "json":
            assert whole.schema["c"].dataType.simpleString() == "struct<d:array<double>>"


def test_columnar_json_is_parsed_once(spark, tmp_path):
    (tmp_path / "c.txt").write_text('{"a": [1, 2], "b": ["x", "y"]}\n')
    parsed = readers.read_columnar_json(spark.read.text(str(tmp_path)), "a int, b string")
    assert parsed._jdf.queryExecution().executedPlan().toString().count("from_json(") == 1
    assert rows(parsed) == [(1, "x"), (2, "y")]


# ---- load graphs ----------------------------------------------------------------------


def test_a_failing_dataset_stops_only_what_needs_it(spark, tmp_path):
    raw, target, status = tmp_path / "raw", str(tmp_path / "w"), str(tmp_path / "status")
    for name in ("a", "b", "c", "d", "e"):
        put(raw / name, x__csv="k,v\n1,2\n")
    (raw / "b" / "x.csv").unlink()
    after = {"c": ("b",), "d": ("a",), "e": ("c", "d")}
    specs = [LoadSpec(f"{raw}/{n}/", target, "csv", ",", after=after.get(n, ())) for n in "edcba"]
    got = {r.name: (r.state, r.message) for r in run_graph(spark, specs, status, "r1").collect()}
    assert {n: s for n, (s, _) in got.items()} == {"a": "loaded", "b": "failed", "c": "waiting", "d": "loaded", "e": "waiting"}
    assert "b" in got["c"][1] and got["e"][1] == "c" and got["b"][1]
    put(raw / "b", x__csv="k,v\n3,4\n")
    again = {r.name: r.state for r in run_graph(spark, specs, status, "r1").collect()}
    assert again == {"a": "loaded before", "b": "loaded", "c": "loaded", "d": "loaded before", "e": "loaded"}
    assert all(spark.read.parquet(f"{target}/{n}").count() == 1 for n in "abcde")
    run_graph(spark, specs, status, "r2")
    assert all(spark.read.parquet(f"{target}/{n}").count() == 2 for n in "abcde")


def test_an_interrupted_load_is_not_doubled(spark, tmp_path, monkeypatch):
    put(tmp_path / "raw" / "a", x__csv="k,v\n1,2\n")
    specs = [LoadSpec(f"{tmp_path}/raw/a/", str(tmp_path / "w"), "csv", ",")]
    with monkeypatch.context() as patched:
        patched.setattr(loads, "register_external", lambda *a: 1 / 0)
        failing = [LoadSpec(f"{tmp_path}/raw/a/", str(tmp_path / "w"), "csv", ",", table="tarn_late")]
        assert run_graph(spark, failing, str(tmp_path / "s"), "r").head().state == "failed"
    assert run_graph(spark, specs, str(tmp_path / "s"), "r").head().state == "loaded"
    assert spark.read.parquet(f"{tmp_path}/w/a").count() == 1


def test_graphs_without_an_order_are_refused(spark, tmp_path):
    def spec(name, *after):
        return LoadSpec(f"{tmp_path}/{name}/", str(tmp_path / "w"), after=after)

    for specs in ([spec("a", "b"), spec("b", "a")], [spec("a", "z")], [spec("a"), spec("a")]):
        with pytest.raises(ValueError, match="datasets that"):
            run_graph(spark, specs, str(tmp_path / "s"), "r")


def test_jobs_side_by_side_have_pools_of_their_own(spark):
    def pool():
        return spark.sparkContext.getLocalProperty("spark.scheduler.pool")

    assert run_together([pool, pool, pool]) == ["together-0", "together-1", "together-2"]
    assert pool() is None


# ---- merges by partition --------------------------------------------------------------


def test_only_concerned_partitions_are_written(spark, tmp_path):
    """Updates, moves, an emptied partition, a null one, new ones; spelling of values stays."""
    path = str(tmp_path / "t")
    data = [(i, f"v{i}", ["007", "a b/%", None, "x", "gone"][i % 5]) for i in range(50)]
    spark.createDataFrame(data, "id long, v string, p string").repartition(2).write.partitionBy("p").parquet(path)
    before = {f.relative_to(path): f.stat().st_mtime_ns for f in Path(path).glob("p=*/*.parquet")}
    gone = [(i, "moved", "x") for i in range(50) if i % 5 == 4]
    source = spark.createDataFrame([*gone, (2, "null one", None), (100, "new", "late"), (101, "new", None)], "ID long, V string, P string")
    assert merge_partitions(spark, path, source, ["id"]) == 4
    want = {i: (v, p) for i, v, p in data} | {i: (v, p) for i, v, p in map(tuple, source.collect())}
    got = spark.read.schema("id long, v string, p string").parquet(path).collect()
    assert len(got) == len(want) and {r.id: (r.v, r.p) for r in got} == want
    after = {f.relative_to(path): f.stat().st_mtime_ns for f in Path(path).glob("p=*/*.parquet")}
    kept = {f for f in before if f.parts[0] in ("p=007", "p=a b%2F%25")}
    assert kept and all(after.get(f) == before[f] for f in kept)
    assert sorted({f.parts[0] for f in after}) == [
        "p=007", "p=__HIVE_DEFAULT_PARTITION__", "p=a b%2F%25", "p=late", "p=x"]
    update = spark.createDataFrame([(5, "by key"), (999, "nowhere")], "id long, v string")
    assert merge_partitions(spark, path, update, ["id"], insert=False) == 1
    assert {r.v for r in spark.read.parquet(path).filter("id IN (5, 999)").collect()} == {"by key"}
    with pytest.raises(ValueError, match="partition columns"):
        merge_partitions(spark, path, update, ["id"])
    with pytest.raises(ValueError, match="merge source"):
        merge_partitions(spark, path, update.unionByName(update), ["id"], insert=False)
    assert spark.read.parquet(path).count() == 52
    assert merge_partitions(spark, path, update.filter("id = 0"), ["id"], insert=False) == 0


def test_profiles_of_loads_are_merged(spark, tmp_path):
    """Like one profile of all rows; a repeated load counts once; columns without values stay."""
    path = str(tmp_path / "sketches")
    schema = "a double, b int, c double, t string"
    loads = {
        "one": [(float(i), i % 7, None, "x") for i in range(3_000)],
        "two": [(float("nan"), None, None, None)] * 5,
        "three": [(float(i), 10**6 + i, None, "y") for i in range(3_000, 10_000)],
        "none": [],
    }
    for load in ("one", "two", "three", "none", "three"):
        profile.append_profile(spark.createDataFrame(loads[load], schema), path, load)
    assert spark.read.parquet(path).count() == 4 * 3
    got = {(r.column, r.stat): r.value for r in profile.stored_profile(spark, path).collect()}
    every = spark.createDataFrame([r for rows in loads.values() for r in rows], schema)
    want = {(r.column, r.stat): r.value for r in profile.describe_long(every, exact=True).collect()}
    for c in "ab":
        for stat in ("count", "mean", "std", "min", "max"):
            assert math.isclose(got[c, stat], want[c, stat], rel_tol=1e-12), (c, stat)
    assert all(abs(got["a", stat] - want["a", stat]) < 100 for stat in profile.QUARTILES)
    assert got["c", "count"] == 0 and all(got["c", stat] is None for stat in ("mean", "std", "min", "max", *profile.QUARTILES))


def test_appended_keys_are_checked_without_moving_the_stored_ones(spark, tmp_path):
    path, keys = str(tmp_path / "t"), "keys_of_t"
    frame = lambda *ids: spark.createDataFrame([(i, s) for i, s in ids], "id long, part string")
    try:
        append_checked(frame((1, "a"), (1, "b")), path, ["id", "part"], keys, "one", 8)
        append_checked(frame((2, "a")), path, ["id", "part"], keys, "two", 8)
        for bad in [((1, "b"),), ((3, "c"), (3, "c")), ((4, None),)]:
            with pytest.raises(ValueError, match="would be no key"):
                append_checked(frame((9, "z"), *bad), path, ["id", "part"], keys, "three", 8)
        # a repeated batch replaces its own keys and rows, also with others
        append_checked(frame((5, "e")), path, ["id", "part"], keys, "two", 8)
        append_checked(frame((2, "a")), path, ["id", "part"], keys, "three", 8)
        append_checked(frame().limit(0), path, ["id", "part"], keys, "four", 8)
        assert rows(spark.read.parquet(path).select("id", "part")) == [(1, "a"), (1, "b"), (2, "a"), (5, "e")]
        assert rows(spark.table(keys).select("id", "part")) == [(1, "a"), (1, "b"), (2, "a"), (5, "e")]
        with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__shuffle__partitions="200"):
            bad = check_new_keys(frame((1, "a"), (7, "g")), ["id", "part"], keys, "five")
            plan = bad._jdf.queryExecution().executedPlan().toString()
            assert rows(bad) == [(1, "a", 1, True)]
        stored = plan[plan.rindex("+- Sort") :]  # the right side of the join comes last
        assert "__known" in stored and "Exchange" not in stored, plan
        assert "Bucketed: true" in plan
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {keys}")


def test_a_single_csv_is_computed_by_many_tasks_in_order(spark, tmp_path):
    group = "single-csv"
    spark.sparkContext.setJobGroup(group, group)
    try:
        df = spark.range(0, 5_000, numPartitions=7).select((F.lit(5_000) - F.col("id")).alias("n"), F.rand(3).alias("r")).orderBy("r")
        path = writers.write_single_csv(df, str(tmp_path), "sorted")
        tracker = spark.sparkContext.statusTracker()
        stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds]
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    values = [float(line.split(",")[1]) for line in Path(path).read_text().splitlines()[1:]]
    assert len(values) == 5_000 and values == sorted(values)
    assert max(s.numTasks for s in stages if s) >= 7
