"""Streaming ingest, page landing and incremental filters, with restarts."""

import json
import re
import shutil
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarn.streaming import ingest
from tarn.streaming.ingest import (
    dedupe_exact,
    dedupe_latest,
    incremental_since,
    ingest_stream,
    land_pages,
    last_run,
    mark_run,
    renew_schema,
    reset_stream,
    run_increment,
    stream_schema,
)
from tests.conftest import rows


def page(folder, number, size=10):
    folder.mkdir(exist_ok=True)
    lines = [json.dumps({"id": number * size + i, "v": f"p{number}"}) for i in range(size)]
    (folder / f"page-{number:05d}.json").write_text("\n".join(lines) + "\n")


def test_each_file_is_loaded_once(spark, tmp_path):
    src, checkpoint = tmp_path / "src", str(tmp_path / "cp")

    def run():
        ingest_stream(spark, str(src), "tarn_stream", checkpoint, path=str(tmp_path / "t"))
        return spark.table("tarn_stream")

    page(src, 0)
    assert run().count() == 10
    page(src, 1)
    assert run().count() == 20
    table = run()
    assert table.count() == 20
    assert table.columns == ["id", "v", "source_file", "processing_time"]
    assert table.select("source_file").distinct().count() == 2
    assert table.filter("processing_time IS NULL").count() == 0

    reset_stream(spark, "tarn_stream", checkpoint)
    shutil.rmtree(tmp_path / "t")
    assert run().count() == 20
    reset_stream(spark, "tarn_stream", checkpoint)
    assert not spark.catalog.tableExists("tarn_stream")


def test_schema_is_kept(spark, tmp_path):
    src, location = tmp_path / "src", str(tmp_path / "schema")
    page(src, 0)
    first = stream_schema(spark, str(src), location)
    (src / "z.json").write_text('{"id": "text", "more": 1}\n')
    assert stream_schema(spark, str(src), location) == first
    assert first.simpleString() == "struct<id:bigint,v:string>"


def test_pages_land_in_batches(spark, tmp_path):
    src, out, checkpoint = tmp_path / "src", str(tmp_path / "out"), str(tmp_path / "cp")
    schema = spark.createDataFrame([], "id bigint, v string").schema
    for i in range(25):
        page(src, i)
    land_pages(spark, str(src), out, checkpoint, schema, files_per_batch=1)
    landed = spark.read.parquet(out)
    assert landed.count() == 250 and landed.select("batch_id").distinct().count() == 3
    for i in range(25, 28):
        page(src, i)
    land_pages(spark, str(src), out, checkpoint, schema, files_per_batch=1)
    land_pages(spark, str(src), out, checkpoint, schema, files_per_batch=1)
    landed = spark.read.parquet(out)
    assert landed.count() == 280 == landed.select("id").distinct().count()
    assert landed.select("batch_id").distinct().count() == 4


def test_killed_between_write_and_checkpoint(spark, tmp_path):
    """The commit of the last batch is lost: the rerun writes the same batch again."""
    src, out, checkpoint = tmp_path / "src", str(tmp_path / "out"), tmp_path / "cp"
    schema = spark.createDataFrame([], "id bigint, v string").schema
    for i in range(15):
        page(src, i)
    land_pages(spark, str(src), out, str(checkpoint), schema, files_per_batch=1)
    for f in (checkpoint / "commits").iterdir():
        if f.name in ("1", ".1.crc"):
            f.unlink()
    page(src, 15)
    land_pages(spark, str(src), out, str(checkpoint), schema, files_per_batch=1)
    landed = spark.read.parquet(out)
    assert landed.count() == 160 == landed.select("id").distinct().count()


def test_failing_batch_is_tried_again(spark, tmp_path):
    src, out, checkpoint = tmp_path / "src", str(tmp_path / "out"), str(tmp_path / "cp")
    schema = spark.createDataFrame([], "id bigint, v string").schema
    page(src, 0)
    (tmp_path / "out").write_text("in the way")
    with pytest.raises(Exception):  # noqa: B017
        land_pages(spark, str(src), out, checkpoint, schema, files_per_batch=1)
    (tmp_path / "out").unlink()
    land_pages(spark, str(src), out, checkpoint, schema, files_per_batch=1)
    assert spark.read.parquet(out).count() == 10


def test_date_filter(spark):
    days = spark.createDataFrame([("20240228",), ("20240229",), ("20240401",)], "day string")
    assert rows(incremental_since(days, "day", "2024-03-31")) == [("20240229",), ("20240401",)]
    assert incremental_since(days, "day", None).count() == 3
    stamps = days.select(F.to_timestamp("day", "yyyyMMdd").alias("ts"))
    assert incremental_since(stamps, "ts", "2024-03-31").count() == 2
    assert incremental_since(stamps, "ts", "2024-03-31", months=2).count() == 3


def test_last_run_stamp(spark, tmp_path):
    path = str(tmp_path / "stamp")
    assert last_run(spark, path) is None
    for day in ("2024-01-31", "2024-03-31"):
        mark_run(spark, path, day)
        assert last_run(spark, path) == day


def test_dedupe(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (1, 2, "b"), (2, 1, None)], "k int, t int, v string")
    assert dedupe_exact(df).count() == 3
    assert rows(dedupe_latest(df, ["k"], ["t"])) == [(1, 2, "b"), (2, 1, None)]
    assert dedupe_latest(df, ["k"], ["t"]).columns == df.columns


@pytest.mark.parametrize("bad", ['{"id": "text", "v": "x"}', '{"id": 1', '{"id": 1, "v": "x", "more": 2}'])
def test_misfits_stop_a_stream(spark, tmp_path, bad):
    src, schema = tmp_path / "src", spark.createDataFrame([], "id bigint, v string").schema
    page(src, 0)
    (src / "z.json").write_text(bad + "\n")
    with pytest.raises(Exception):  # noqa: B017
        land_pages(spark, str(src), str(tmp_path / "out"), str(tmp_path / "cp"), schema)


def test_renewed_schema_takes_new_fields(spark, tmp_path):
    src, location = tmp_path / "src", str(tmp_path / "schema")
    page(src, 0)
    stream_schema(spark, str(src), location)
    (src / "z.json").write_text('{"id": 1, "v": "x", "more": 2}\n')
    renewed = renew_schema(spark, str(src), location)
    assert renewed == stream_schema(spark, str(src), location)
    assert renewed.simpleString() == "struct<id:bigint,v:string,more:bigint>"


def test_csv_stream_reads_its_header(spark, tmp_path):
    src, out = tmp_path / "src", str(tmp_path / "out")
    schema = spark.createDataFrame([], "id bigint, v string").schema
    src.mkdir()
    (src / "a.csv").write_text("id;v\n1;x\n2;y\n")
    land_pages(spark, str(src), out, str(tmp_path / "cp"), schema, fmt="csv", sep=";")
    assert rows(spark.read.parquet(out).select("id", "v")) == [(1, "x"), (2, "y")]
    (src / "b.csv").write_text("v;id\nz;3\n")
    with pytest.raises(Exception):  # noqa: B017
        land_pages(spark, str(src), out, str(tmp_path / "cp"), schema, fmt="csv", sep=";")


# ---- repeated runs --------------------------------------------------------------------

RUN_SCHEMA = "id bigint, day string"


def fetched(pages):
    """A `fetch` that puts the given pages (lists of ids) into files of always the same names."""

    def fetch(last, folder):
        Path(folder).mkdir(parents=True)
        for i, ids in enumerate(pages):
            lines = [json.dumps({"id": n, "day": f"202403{n % 28 + 1:02}"}) for n in ids]
            (Path(folder) / f"page-{i:05d}.json").write_text("\n".join(lines) + "\n")

    return fetch


def increment(spark, base, pages, day):
    schema = spark.createDataFrame([], RUN_SCHEMA).schema
    return run_increment(spark, fetched(pages), f"{base}/pages", f"{base}/out", f"{base}/state", schema, "day", day)


def landed_ids(spark, base):
    return sorted(r.id for r in spark.read.schema(RUN_SCHEMA).parquet(f"{base}/out").collect())


@pytest.mark.parametrize("stopped", ["fetch", "between batches", "before the move", "before the stamp"])
def test_a_stopped_run_leaves_nothing_behind(spark, tmp_path, monkeypatch, stopped):
    """The pages have changed when the run is repeated; the result is that of one clean run."""

    def stop(*a, **k):
        raise RuntimeError(stopped)

    before = [[100, 101]]
    assert increment(spark, tmp_path, before, "2024-03-15") is None
    first, second = [[n] for n in range(25)], [[0, 7], [1], [30]]
    with monkeypatch.context() as patched:
        if stopped == "fetch":
            patched.setattr(ingest, "land_pages", stop)
        if stopped == "between batches":
            whole = ingest.land_pages

            def two_batches(*args, **options):
                whole(*args, **options, pages_per_file=5, files_per_batch=1)
                stop()

            patched.setattr(ingest, "land_pages", two_batches)
        if stopped == "before the move":
            patched.setattr(ingest, "move_into_place", stop)
        if stopped == "before the stamp":
            patched.setattr(ingest, "mark_run", stop)
        with pytest.raises(RuntimeError, match=stopped):
            increment(spark, tmp_path, first, "2024-03-20")
    assert last_run(spark, f"{tmp_path}/state/last_run") == "2024-03-15"
    seen = [100, 101] + (list(range(25)) if stopped == "before the stamp" else [])
    assert landed_ids(spark, tmp_path) == sorted(seen)
    assert increment(spark, tmp_path, second, "2024-03-20") == "2024-03-15"
    assert landed_ids(spark, tmp_path) == [0, 1, 7, 30, 100, 101]
    assert last_run(spark, f"{tmp_path}/state/last_run") == "2024-03-20"
    assert not list((tmp_path / "out" / "_attempts").iterdir())
    assert len(list((tmp_path / "pages" / "run=2024-03-20").iterdir())) == 1


def test_a_second_run_of_a_day_adds_to_it(spark, tmp_path):
    assert increment(spark, tmp_path, [[1, 2]], "2024-06-15") is None
    assert increment(spark, tmp_path, [], "2024-06-15") == "2024-06-15"
    assert landed_ids(spark, tmp_path) == [1, 2]
    increment(spark, tmp_path, [[3]], "2024-03-15")
    increment(spark, tmp_path, [[4]], "2024-03-15")
    increment(spark, tmp_path, [[5]], "2024-03-15")
    assert landed_ids(spark, tmp_path) == [1, 2, 4, 5]  # the third run looked back from June


# ---- nested fields ----------------------------------------------------------------------

NESTED = {"id": 1, "p": {"x": 1, "q": {"y": 2}}, "rows": [{"a": 1}], "grid": [[{"b": 1}]]}


@pytest.mark.parametrize(
    ("change", "path"),
    [
        ({"p": {"x": 2, "fresh": 1}}, "p.fresh"),
        ({"p": {"x": 2, "q": {"y": 1, "z": {"deep": 1}}}}, "p.q.z"),
        ({"rows": [{"a": 1}, None, {"a": 2, "late": True}]}, "rows[].late"),
        ({"grid": [[], [{"b": 1}, {"c": 2}]]}, "grid[][].c"),
        ({"top": None}, "top"),
    ],
)
def test_a_new_field_at_any_depth_stops_the_stream(spark, tmp_path, change, path):
    src, out, cp = tmp_path / "src", str(tmp_path / "t"), str(tmp_path / "cp")
    src.mkdir()
    (src / "a.json").write_text(json.dumps(NESTED) + "\n")
    name = f"tarn_nested_{abs(hash(path)) % 10**9}"
    ingest_stream(spark, str(src), name, cp, path=out)
    (src / "b.json").write_text(json.dumps(NESTED | change | {"id": 2}) + "\n" + json.dumps({"id": 3, "p": None}) + "\n")
    with pytest.raises(Exception, match=re.escape(path)):
        ingest_stream(spark, str(src), name, cp, path=out)
    assert spark.read.parquet(out).count() == 1
    renewed = renew_schema(spark, str(src), f"{cp}_schema")
    assert renewed.names[:4] == spark.read.json(str(src / "a.json")).schema.names
    spark.sql(f"DROP TABLE {name}")
    ingest_stream(spark, str(src), name, cp, path=out)
    got = spark.read.option("mergeSchema", "true").parquet(out).orderBy("id").collect()
    assert [r.id for r in got] == [1, 2, 3]
    whole = spark.read.schema(renewed).json(str(src)).orderBy("id").collect()
    assert [r.asDict(recursive=True) for r in whole] == [
        {k: v for k, v in r.asDict(recursive=True).items() if k in renewed.names} for r in got
    ]
    spark.sql(f"DROP TABLE {name}")


def test_merged_types():
    def of(text):
        return T.StructType.fromDDL(text)

    kept = of("a int, s struct<x: int, m: map<string, struct<u: int>>>, l array<struct<v: string>>")
    found = of("b int, a string, l array<struct<w: int, v: int>>, s struct<y: int, m: map<string, struct<n: int, u: int>>>")
    want = of("a int, s struct<x: int, m: map<string, struct<u: int, n: int>>, y: int>, l array<struct<v: string, w: int>>, b int")
    assert ingest.merged_type(kept, found) == want
    assert ingest.merged_type(T.LongType(), found) == T.LongType()
