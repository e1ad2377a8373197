"""Time the headline queries and print one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose the data and the cores; BENCH_QUERIES=all
times every registered query.  Each query is run once to warm up and then
BENCH_RUNS times (3 by default); its median is reported.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from caselabel.catalog import REGISTRY  # noqa: E402
from caselabel.session import local_session  # noqa: E402

HEADLINE = [
    "label_distribution",
    "weekly_run",
    "update_from",
    "merge_snapshots",
    "incremental_run",
    "scan_cases",
    "normalize_text",
    "lexicon_score",
    "stateful_score",
    "map_category",
    "commission_override",
    "classification_report",
    "confusion_matrix",
    "count_diff_total",
    "word_count_describe",
    "histogram",
    "pivot_margins",
    "category_share",
    "overlap_matrix",
    "dataframe_difference",
    "dedupe_last",
    "duplicate_stats",
    "case_detail",
    "proceeding_detail",
    "case_activity",
    "split_exact",
    "split_hash",
    "mask_dictionary",
    "id_card_quality",
    "strip_markup",
    "plug_in_score",
]


def timed(run, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    run(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = list(REGISTRY) if os.environ.get("BENCH_QUERIES") == "all" else HEADLINE
    spark = local_session(cores)
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        run = REGISTRY[name].run
        timed(run, spark, sf_dir)
        seconds[name] = round(statistics.median(timed(run, spark, sf_dir) for _ in range(runs)), 3)
    result = {
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
