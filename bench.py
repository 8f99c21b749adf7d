"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR is the data folder, BENCH_CPUS the number of local cores. Every query is run whole, into a
sink that discards the rows, so nothing is saved by not producing them. A first unmeasured run loads
and compiles the classes, then the best of BENCH_RUNS runs counts.

Each given table is a single row group, so a scan with all text work on it is one task. A second set of figures
is taken over the same rows in BENCH_FILES files, written outside the measured part.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks import fixtures  # noqa: E402
from checks.registry import QUERIES  # noqa: E402
from kerbside.session import build_session, remove, scratch_dir  # noqa: E402

HEADLINE = [
    "hotspots",
    "hotspots_from_text",
    "match_spots",
    "suggestions",
    "stream_suggestions",
    "arrivals",
    "amplify",
    "amplify_lines",
    "fleet_at",
    "playback",
    "resolve_ids",
    "decode_positions",
]


SPREAD = ["hotspots", "match_spots", "suggestions", "amplify"]
TABLES = ["lineitem", "events"]


def in_files(spark, sf_dir: str, files: int) -> str:
    """A copy of the tables that the queries above read, each in several files."""
    target = scratch_dir(spark, "bench")
    for name in TABLES:
        fixtures.table(spark, sf_dir, name).repartition(files).write.parquet(f"{target}/{name}.parquet")
    return target


def timed(spark, name: str, sf_dir: str) -> float:
    began = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = sys.argv[1:] or HEADLINE
    conf = {
        "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
        "spark.driver.memory": "8g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    spark = build_session("bench", f"local[{cpus}]", conf)
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        timed(spark, name, sf_dir)
        seconds[name] = round(min(timed(spark, name, sf_dir) for _ in range(runs)), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    spread = {}
    if files := int(os.environ.get("BENCH_FILES", "8")):
        copy = in_files(spark, sf_dir, files)
        for name in [name for name in SPREAD if name in names]:
            timed(spark, name, copy)
            spread[name] = round(min(timed(spark, name, copy) for _ in range(runs)), 3)
            print(name, f"in {files} files", spread[name], file=sys.stderr, flush=True)
        remove(spark, copy)
    trips = fixtures.table(spark, sf_dir, "lineitem").count()
    positions = fixtures.table(spark, sf_dir, "events").count()
    rows = {"hotspots": trips, "hotspots_from_text": trips, "suggestions": positions, "stream_suggestions": positions}
    rows.update({"amplify": 2 * trips, "amplify_lines": 2 * trips})
    result = {
        "metric": "headline queries, total of best runs",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "in_files": spread,
        "rows_per_second": {name: round(rows[name] / seconds[name]) for name in rows if name in seconds},
        "sf": Path(sf_dir).name.removeprefix("sf"),
        "cpus": cpus,
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
