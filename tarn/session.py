"""Session helper, shared scratch folder and the few execution tools every module uses."""

from __future__ import annotations

import contextlib
import tempfile
import threading
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_own_scratch: tempfile.TemporaryDirectory | None = None
_settings_lock = threading.RLock()


def get_session(app: str = "tarn", **conf: str) -> SparkSession:
    """A session with the settings the operators are tuned for; `conf` keys use `__` for dots."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.scheduler.mode", "FAIR")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder named by `spark.checkpoint.dir`.

    Only a local session without that setting gets a temporary folder of its own, removed
    when Python exits. A cluster without it falls back to the warehouse folder. A folder on
    the machine's own disk is refused there, as executors could not see each other's files.
    """
    global _own_scratch
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if spark.sparkContext.master.startswith("local"):
            _own_scratch = _own_scratch or tempfile.TemporaryDirectory(prefix="tarn-")
            base = _own_scratch.name
        else:
            base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_tarn_scratch"
    if base.startswith("file:") and not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"{base} is no shared folder; set spark.checkpoint.dir to one")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write `df` to the shared scratch folder and read it back.

    Cuts the lineage with a table that outlives its executors, and pins values that a
    recomputation could change (generated ids, range bounds).
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_STEADY_LEAVES = ("Scan parquet", "Scan csv", "Scan json", "Scan text", "Scan orc", "Scan binaryFile", "Range", "LocalTableScan")


def comes_in_file_order(df: DataFrame) -> bool:
    """Whether a rerun task sees its rows in the same order again.

    True if all leaves of the plan are files, ranges or literal rows and there is no exchange
    above them: splits of files are read from start to end, while shuffled blocks arrive in
    any order, and an RDD or a cached table may have been shuffled before.
    """
    execution = df._jdf.queryExecution()
    leaves = execution.sparkPlan().collectLeaves().iterator()
    while leaves.hasNext():
        if not leaves.next().nodeName().startswith(_STEADY_LEAVES):
            return False
    return "Exchange" not in execution.executedPlan().toString()


def broadcast_if_small(df: DataFrame, max_rows: int) -> DataFrame:
    """Hint a broadcast only after counting that `df` has at most `max_rows` rows.

    Beyond the bound the frame comes back unhinted and the join shuffles as usual.
    """
    if df.limit(max_rows + 1).count() <= max_rows:
        return F.broadcast(df)
    return df


@contextlib.contextmanager
def settings(spark: SparkSession, **conf: str):
    """Session settings for the duration of one write; `conf` keys use `__` for dots.

    The settings are shared by all threads of a session, so one block runs at a time; they
    only ever tune file sizes, never what is written.
    """
    with _settings_lock:
        yield from _changed(spark, conf)


def _changed(spark: SparkSession, conf: dict[str, str]):
    names = {key.replace("__", "."): value for key, value in conf.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def as_columns(columns: list[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in columns]
