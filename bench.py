"""Time the headline queries and print one JSON line.

Every query runs to its end into a sink that throws rows away, so no result passes the driver.
``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose data and cores; ``BENCH_QUERIES`` a list of names or
``all``.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from croplake.queries import QUERIES  # noqa: E402
from croplake.session import builder  # noqa: E402

HEADLINE = [
    "plot_application_summary", "plot_nutrient_totals", "season_length",
    "apps_outside_field_window", "natural_key_lookup", "insert_or_get", "group_rollup",
    "latest_daily", "last_requested", "update_inventory", "fill_inventory", "fill_plan",
    "chunk_plan", "response_clean", "response_filter_exact", "type_summary", "time_ordinal",
    "tolerance_dedupe", "feature_columns", "key_observations", "duplicate_executions",
    "execution_summary", "point_to_cell", "need_of_fields", "grid_cells", "polygon_join",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else chosen.split(",") if chosen else HEADLINE
    spark = (
        builder("croplake-bench")
        .master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # start the engine before the clock runs
    QUERIES["populated_cells"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in names:
        begin = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - begin, 3)
    print(json.dumps({
        "metric": "total seconds over the headline queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
