"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs whole: its result goes to Spark's `noop` sink. The first run of the flagship
warms the JVM up and is not counted.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tarn.plans import all_queries  # noqa: E402
from tarn.session import get_session  # noqa: E402

HEADLINE = [
    "renewed_dimension",
    "merged_updates",
    "surrogate_keys",
    "cumulative_max",
    "cumulative_max_with_ties",
    "reset_index",
    "exact_profile",
    "group_sum_two_keys",
    "distinct_rows",
    "primary_key_violations",
    "foreign_key_violations",
    "left_join_sql",
    "full_join_by_name",
    "csv_folder_read",
    "json_folder_read",
    "tolerant_folder_read",
    "distinct_per_file",
    "sized_write",
    "compacted_table",
    "load_list",
    "streamed_ingest",
    "landed_pages",
    "overlap_removed",
    "latest_per_user",
    "split_words",
    "columnar_json_words",
    "content_hashes",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = get_session(
        "bench",
        spark__master=f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "8g"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()

    def seconds(name: str) -> float:
        start = time.perf_counter()
        queries[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds(HEADLINE[0])
    times = {name: round(seconds(name), 3) for name in HEADLINE}
    result = {
        "metric": "headline_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": Path(sf_dir).name.removeprefix("sf"),
        "cpus": int(cpus),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
