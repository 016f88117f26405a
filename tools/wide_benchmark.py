"""Q13 end to end at the reference's sizes: seed the four wide tables
(10/50 columns × 100k/200k rows) into a scratch warehouse, time ``SELECT *``
in SQL and DataFrame form through the ``noop`` sink (best of 3 after
warm-up passes), and print the pivot
(Q10), the fastest/slowest summary (Q11) and the run log as JSON.

Usage: python tools/wide_benchmark.py [scratch_dir]
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerline.plans import reports, seed, timing  # noqa: E402
from ledgerline.session import build_session  # noqa: E402
from ledgerline.sources import generate as G  # noqa: E402


def main() -> None:
    scratch = sys.argv[1] if len(sys.argv) > 1 else tempfile.mkdtemp(prefix="ledgerline-wide-")
    spark = build_session(
        app_name="ledgerline-wide-bench", shuffle_partitions=16,
        extra={"spark.sql.warehouse.dir": os.path.join(scratch, "warehouse")},
    )
    steps = {}
    t0 = time.perf_counter()
    counts = seed.seed_wide(spark, "benchmark").collect()
    steps["seed wide tables"] = time.perf_counter() - t0
    tables = {name: spark.read.table(f"benchmark.{name}") for name, _, _ in G.WIDE_TABLES}
    # warm-up passes (JIT settles after a few runs), then the timed run log
    timing.run_benchmark(spark, tables, repeat=2)
    t0 = time.perf_counter()
    log = timing.run_benchmark(spark, tables, repeat=3).cache()
    log.count()
    steps["timed SELECT *"] = time.perf_counter() - t0
    engines = list(timing.FORMS)
    reports.run_log_pivot(log, engines).show(truncate=False)
    reports.run_log_summary(log, engines).show(truncate=False)
    reports.step_summary(timing.step_log(spark, steps)).show(truncate=False)
    print(json.dumps({
        "seeded": {r.table: r.rows for r in counts},
        "runs": [r.asDict() for r in log.collect()],
    }))
    spark.stop()


if __name__ == "__main__":
    main()
