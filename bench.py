"""Times the registered queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is run into the no-op sink, so that every row and column is computed. With names as
arguments only those run.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from mediabatch.plans.queries import QUERIES  # noqa: E402
from mediabatch.session import build_session  # noqa: E402


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or list(QUERIES)
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "12g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Start the JVM paths and the Python workers once, outside the timings.
    QUERIES["valid_items"](spark, folder).write.format("noop").mode("overwrite").save()
    QUERIES["explode_links"](spark, folder).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    extra = {}
    if "compose_collage" in times:
        # Images placed per second, the reference workload's own unit.
        placed = QUERIES["compose_collage"](spark, folder).groupBy().sum("placed").first()[0]
        extra["images_per_second"] = round(placed / times["compose_collage"], 1)
    spark.stop()
    sf = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    line = {"metric": "total_query_time", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
            "sf": float(sf) if sf.replace(".", "").isdigit() else sf, **extra}
    print(json.dumps(line))


if __name__ == "__main__":
    main()
