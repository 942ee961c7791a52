"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

Each query runs once to warm up and then ``$BENCH_RUNS`` times (default 1); the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks.catalog import QUERIES  # noqa: E402
from readframe.session import session  # noqa: E402

HEADLINE = (
    "sum_counts",
    "count_matrix",
    "cpm",
    "mate_zip",
    "repair_pairs",
    "part_numbers",
    "record_frames",
    "block_frames",
    "trim_sliding",
    "trim_adapter",
    "standard_cleaning",
    "read_bins_tiled",
    "overlap_hits",
    "feature_counts",
    "htseq_nonempty",
    "star_counts",
    "coverage_segments",
    "read_islands",
    "base_classes",
    "known_splices",
    "sam_scan",
    "maximal_chains",
    "merged_transcripts",
    "accuracy_levels",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    spark = session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        times = []
        for run in range(runs + 1):
            began = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - began
            if run:
                times.append(took)
        seconds[name] = round(statistics.median(times), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    spark.stop()
    line = {
        "metric": "total_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": sf_dir.rstrip("/").rsplit("/sf", 1)[-1],
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
