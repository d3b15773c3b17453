"""Every registered query against its SQL twin on the smallest tables."""

import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry
from tests.oracle import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    ok, message = compare(spark, con, SF, name, entry.queries()[name], entry.oracle_sql().get(name))
    assert ok, message


def test_entry_has_stable_columns(spark):
    df = entry.entry(spark)
    assert df.columns == ["SurrKey", "ID", "Label", "Balance"]
    assert df.count() > 0


def test_python_tasks_need_no_package_on_the_workers(tmp_path):
    """Task functions travel by value: workers started elsewhere can not import this package."""
    code = f"""
import sys
sys.path.insert(0, {str(Path(__file__).resolve().parents[1])!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
import __spark_entry__ as entry
for name in ("json_array_read", "zipped_csv_read", "archived_members_read", "ranged_checksums"):
    assert entry.queries()[name](spark, {SF!r}).count() > 0
"""
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
