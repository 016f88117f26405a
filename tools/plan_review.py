"""Plan review in the large-scale regime: every registered query is planned
with broadcasting disabled (as when no dimension fits in memory) and the
shuffles, broadcasts and sort-merge joins of its physical plan are listed.

Usage: python tools/plan_review.py [sf_dir]
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerline.plans.registry import QUERIES  # noqa: E402
from ledgerline.session import build_session  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(
        app_name="ledgerline-plan-review", shuffle_partitions=200,
        extra={"spark.sql.autoBroadcastJoinThreshold": "-1",
               "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"},
    )
    for name, fn in QUERIES.items():
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            fn(spark, sf_dir).explain()
        lines = buf.getvalue().splitlines()
        shuffles = [re.sub(r"#\d+L?", "", m.group(1)) for line in lines
                    if (m := re.search(r"Exchange (\w+partitioning\([^,)]*|SinglePartition)", line))]
        broadcasts = sum("BroadcastExchange" in line for line in lines)
        smj = sum("SortMergeJoin" in line for line in lines)
        print(f"{name:30s} shuffles={len(shuffles)} broadcasts={broadcasts} smj={smj}  {'; '.join(shuffles)}")
    spark.stop()


if __name__ == "__main__":
    main()
