"""The retail queries as timed steps (Q12): every pipeline runs in full on
one scale-factor folder, and the step times are reported with a TOTAL row.

Usage: python tools/retail_steps.py [sf_dir]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerline.plans import reports, retail, timing  # noqa: E402
from ledgerline.session import build_session  # noqa: E402
from ledgerline.sources.bindings import driver_roles  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session(app_name="ledgerline-retail-steps", shuffle_partitions=16)
    r = driver_roles(spark, sf_dir)
    done = r.lit("completed")
    steps = {
        "1. product margin": lambda: retail.product_margin(r.products),
        "2. customer segmentation": lambda: retail.segmentation(
            r.customers_geo, measure="acctbal", low_name="lowest_balance", high_name="highest_balance"),
        "3. order enrichment": lambda: retail.order_enrichment_by_header(
            r.order_lines, r.order_headers, r.customers, r.products, done),
        "4. session summary": lambda: retail.session_summary(
            r.clickstream, ("session_id", "customer_id"), r.lit("purchase"), r.lit("add_to_cart")),
        "5. top recommendations": lambda: retail.top_recommendations(r.recommendations, r.products, 0.07, 20),
        "6. product units": lambda: retail.product_units(r.orders, done),
        "7. margin tier transform": lambda: retail.margin_tier_transform(r.products),
        "8. category revenue": lambda: retail.category_revenue(r.orders, r.products, done),
    }
    log, errors = timing.timed_steps(spark, steps)
    reports.step_summary(log).show(truncate=False)
    if errors:
        print("failed steps:", errors)
    spark.stop()


if __name__ == "__main__":
    main()
