"""Measure shuffle volume per query from Spark's event log.

Runs the named registered queries (default: the flagship forms) in one
session with broadcasting disabled — the regime where no dimension fits in
memory — and the event log written to a scratch folder, then reads the log
and reports, per query, the shuffle bytes and records written and the
number of stages.

Usage: python tools/shuffle_volume.py [sf_dir] [query ...]
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerline.plans.registry import QUERIES  # noqa: E402
from ledgerline.session import build_session  # noqa: E402

DEFAULT = ["order_enrichment", "order_enrichment_flat", "category_revenue", "product_units"]


def main() -> None:
    args = sys.argv[1:]
    sf_dir = args[0] if args and os.path.isdir(args[0]) else "/root/testdata/sf0.1"
    names = [a for a in args if a in QUERIES] or DEFAULT
    log_dir = tempfile.mkdtemp(prefix="ledgerline-eventlog-")
    spark = build_session(
        app_name="ledgerline-shuffle-volume", shuffle_partitions=16,
        extra={
            "spark.eventLog.enabled": "true",
            "spark.eventLog.dir": log_dir,
            # one plain JSON-lines file (Spark 4 otherwise rolls and compresses)
            "spark.eventLog.rolling.enabled": "false",
            "spark.eventLog.compress": "false",
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        },
    )
    sc = spark.sparkContext
    for name in names:
        sc.setJobGroup(name, name)
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    sc.setJobGroup("", "")
    spark.stop()

    stage_group: dict[int, str] = {}
    written = defaultdict(int)
    records = defaultdict(int)
    stages = defaultdict(set)
    paths = [p for p in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True) if os.path.isfile(p)]
    for path in sorted(paths):
        with open(path) as f:
            for line in f:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in ev.get("Stage IDs", []):
                        stage_group[sid] = group
                elif kind == "SparkListenerTaskEnd":
                    group = stage_group.get(ev.get("Stage ID"))
                    metrics = ev.get("Task Metrics") or {}
                    sw = metrics.get("Shuffle Write Metrics") or {}
                    if group:
                        written[group] += sw.get("Shuffle Bytes Written", 0)
                        records[group] += sw.get("Shuffle Records Written", 0)
                        stages[group].add(ev.get("Stage ID"))
    print(f"{'query':28s} {'shuffle MB':>11s} {'shuffle rows':>13s} {'stages':>7s}")
    for name in names:
        print(f"{name:28s} {written[name] / 2**20:11.2f} {records[name]:13d} {len(stages[name]):7d}")


if __name__ == "__main__":
    main()
