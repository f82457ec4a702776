"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

`python bench.py --sweep` also runs the smaller scale factors next to it and prints one line each.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

HEADLINE = (
    "a05_write_fact", "b01_select_incremental", "b04_job_key", "c01_flatten_payload", "c02_html_to_text",
    "c06_normalize_locations", "c09_work_mode_corpus", "c11_tag_skills", "c11_tag_terms", "d01_dedup_batch",
    "d02_upsert_history", "d03_quality_report", "e03_skill_demand", "e06_company_hiring", "f05_kpi_slice",
    "f10_top_n_other_employers", "f11_employer_pareto", "f12_classify_roles", "f14_employers_top_run", "f19_geo_states",
    "f21_heatmap", "f23_flow_location_employer", "f25_skill_mix", "f27_radar_profile", "f30_skill_mix_aligned",
    "f33_reconcile", "f36_profile_payloads", "d02_upsert_snapshot", "e03_distinct_over_months", "f16_box_plot_prices")
#: The first view of a folder publishes the facts that all views read; that is timed as a query of its own.
PUBLISHES = "f06_hhi"


def run(spark, sf_dir: str, names) -> dict[str, float]:
    from suite.base import QUERIES

    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    return seconds


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    sys.path.insert(0, str(Path(__file__).resolve().parent))
    from pyspark.sql import SparkSession

    from suite import ORDERED

    ORDERED()
    spark = (SparkSession.builder.master(f"local[{cores}]").appName("bench").config("spark.ui.enabled", "false")
             .config("spark.driver.memory", "16g").config("spark.sql.shuffle.partitions", cores)
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    folders = [sf_dir]
    if "--sweep" in sys.argv:
        folders = [str(Path(sf_dir).parent / s) for s in ("sf0.001", "sf0.01")] + folders
    run(spark, folders[0], ["b04_job_key"])  # start the JVM and its compilers
    for folder in folders:
        seconds = {"publish_facts": run(spark, folder, [PUBLISHES])[PUBLISHES], **run(spark, folder, HEADLINE)}
        print(json.dumps({"metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
                          "queries": seconds, "sf": Path(folder).name.removeprefix("sf")}), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
