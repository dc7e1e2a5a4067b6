"""Benchmark: wall time of every registered query plus the silver and gold jobs.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPEATS (timed runs per query after one warm-up, default 3),
BENCH_QUERIES (comma-separated subset). Each query's action writes to the
``noop`` sink, so the whole plan runs without collecting to the driver.
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from mercato.plans.jobs import build_gold  # noqa: E402
from mercato.plans.silver import build_silver  # noqa: E402
from mercato.sources.testdata import write_bronze_csv  # noqa: E402
from mercato.plans.model import Model  # noqa: E402
from mercato.registry import QUERIES  # noqa: E402
from mercato.session import build_session, ensure_checkpoint_dir  # noqa: E402


def run_noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(fn, repeats: int) -> float:
    fn()  # warm-up
    times = []
    for _ in range(repeats):
        t0 = time.perf_counter()
        fn()
        times.append(time.perf_counter() - t0)
    return statistics.median(times)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    subset = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = build_session(
        f"local[{cpus}]", app_name="mercato-bench", shuffle_partitions=cpus * 2,
        extra={"spark.driver.memory": "16g"},
    )
    # outputs of the job benchmarks go under the session's (shared) checkpoint folder
    scratch = f"{ensure_checkpoint_dir(spark).rstrip('/')}/bench-{os.getpid()}"
    results: dict[str, float] = {}
    errors: dict[str, str] = {}

    def measure(name: str, fn) -> None:
        try:
            results[name] = round(timed(fn, repeats), 3)
        except Exception as err:  # noqa: BLE001 - keep measuring the other queries
            errors[name] = f"{type(err).__name__}: {str(err)[:200]}"

    for name in [q for q in subset if q in QUERIES] if subset else [q for q in QUERIES if not q.startswith("dirty_")]:
        measure(name, lambda n=name: run_noop(QUERIES[n](spark, sf_dir)))
    if not subset or "gold_build" in subset:
        counter = iter(range(10**6))

        def gold_job():
            out = f"{scratch}/gold-{next(counter)}"
            m = Model(spark, sf_dir)
            build_gold(spark, "", out, silver=m.silver())

        measure("gold_build", gold_job)
    if not subset or "silver_build" in subset:
        bronze = f"{scratch}/bronze"
        write_bronze_csv(spark, sf_dir, bronze)  # derived raw files; not timed
        silver_runs = iter(range(10**6))
        measure("silver_build", lambda: build_silver(spark, bronze, f"{scratch}/silver-{next(silver_runs)}"))
    sf = Path(sf_dir).name.removeprefix("sf")
    print(json.dumps({
        "metric": "total_query_time",
        "value": round(sum(results.values()), 3),
        "unit": "sec",
        "queries": results,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "repeats": repeats,
        "shuffle_partitions": cpus * 2,
        "spark": spark.version,
        **({"errors": errors} if errors else {}),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
