"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the folder of test tables, BENCH_CPUS the number of local cores.
Every query is run in full into a sink that keeps nothing; the best of two runs counts,
so that the figures do not include the start of the session.
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lamina.plans.queries import QUERIES  # noqa: E402
from lamina.session import build_session  # noqa: E402

HEADLINE = [
    "clean_full", "clean_vaccinations", "dedup_keys", "dedup_rows", "offset_pages", "manifest_best_format",
    "kpi_incidence", "kpi_cases_per_day", "kpi_vaccination_vs_cases", "kpi_temporal_evolution",
    "v_kpi_dashboard", "v_temporal_trends", "summary", "top_states", "dashboard_latest", "weekly_deaths",
    "doc_text", "doc_text_long", "quality_cases", "quality_vaccinations", "run_duration_hist", "run_freshness",
    "warehouse_cast", "warehouse_load", "end_to_end",
]


def run(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = build_session(
        "lamina-bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory="8g",
        spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {name: round(min(run(spark, name, folder) for _ in range(2)), 3) for name in HEADLINE}
    spark.stop()
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
