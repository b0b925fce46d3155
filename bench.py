"""Times registered queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8). BENCH_QUERIES may
name a subset; BENCH_ALL=1 runs everything that is registered.
"""

from __future__ import annotations

import json
import os
import time

from checks.queries import QUERIES
from ledgerlake import MODELS, build_session

HEADLINE = [
    *[name for name, (layer, _) in MODELS.items() if layer != "silver"],
    "latest_order_by_customer",
    "asof_change_by_customer",
    "percentile_global",
    "percentile_by_type",
    "rank_quantiles_global",
    "running_quantity",
    "local_minima_daily",
    "effective_dated_rates",
    "scd2_status_history",
    "incremental_append",
    "dq_unique",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.ui.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = list(QUERIES) if os.environ.get("BENCH_ALL") else HEADLINE
    if os.environ.get("BENCH_QUERIES"):
        names = os.environ["BENCH_QUERIES"].split(",")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    for name in ("mart_runway", "mart_macro_indicators"):  # start the JVM's engines
        run(name)
    cold = {name: round(run(name), 3) for name in names}
    warm = {name: round(run(name), 3) for name in names}
    print(
        json.dumps(
            {
                "metric": "total warm seconds over all benched queries",
                "value": round(sum(warm.values()), 3),
                "unit": "sec",
                "queries": warm,
                "cold": cold,
                "cold_total": round(sum(cold.values()), 3),
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
