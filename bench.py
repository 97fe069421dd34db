"""Headline queries, timed one by one; prints one JSON line.

BENCH_SF_DIR   folder with the tables (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_QUERIES  names, comma-separated (default: the list below)
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from dugout.plans.catalog import QUERIES  # noqa: E402
from dugout.session import build_session  # noqa: E402

HEADLINE = (
    "pitch_mix",
    "partition_scan",
    "range_query",
    "player_query",
    "pitch_sort",
    "in_season",
    "stat_filters",
    "clip_search",
    "season_stats_split",
    "canonical_normalize",
    "diagonal_union",
    "source_fallback",
    "dim_join",
    "id_map",
    "reverse_lookup",
    "accent_lookup",
    "fuzzy_names",
    "board_exit_velo",
    "board_arsenal_pivot",
    "percentile",
    "archive_table",
    "leaders_topn",
    "latest_payload",
    "standings",
    "strict_audit",
    "feed_schedule",
    "feed_live",
    "html_stat_table",
    "page_leaders",
)


def run(spark, folder: str, name: str) -> float:
    """Seconds to plan and fully compute a query; results are not collected."""
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    settings = {
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
        "spark.sql.shuffle.partitions": cpus,
        "spark.sql.files.maxPartitionBytes": "1m",
        "spark.sql.files.openCostInBytes": "256k",
    }
    spark = build_session("bench", f"local[{cpus}]", **settings)
    spark.sparkContext.setLogLevel("ERROR")
    run(spark, folder, "pitch_mix")
    seconds = {name: round(run(spark, folder, name), 3) for name in names}
    scale = re.search(r"sf([\d.]+)", folder)
    report = {
        "metric": "total seconds of headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(scale.group(1)) if scale else None,
    }
    print(json.dumps(report))
    spark.stop()


if __name__ == "__main__":
    main()
