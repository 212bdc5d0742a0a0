"""Headline queries, each run to the end once; prints one JSON line."""

import json
import os
import time

from tidemark.plans.registry import QUERIES
from tidemark.session import clear_settled, local_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
NAMES = [
    "i2_infer_types", "i4_full_refresh",
    "e4_describe", "e7_iqr_outliers", "e8_duplicate_rows", "e10_null_profile",
    "c1_customer_sales", "c2_customer_diversity", "c4_elite_customers", "c5_elite_top_category",
    "k3_weekday_mean", "f2_monthly_demand", "f3_filled_months", "f4_forecast", "f6_forecast_error",
    "r1_interactions", "r3_item_similarity", "r3_item_similarity_blocks", "r4_similar_products", "r4b_top_similar",
    "b2b_state_orders_customers", "b3_anchor_customers", "b4b_top_products_revenue",
    "b6_multi_state_customers", "b7_state_products", "b8_ticket_by_state",
    "m1_merge_upsert", "t1_asof_hot_key", "t2_overlapping_lines", "t3_rfm_quintiles", "g1_revenue_cube",
]


def main() -> None:
    spark = local_session(CPUS, "tidemark-bench")
    spark.range(1000).selectExpr("sum(id)").collect()
    seconds = {}
    names = os.environ["BENCH_ONLY"].split(",") if os.environ.get("BENCH_ONLY") else NAMES
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        clear_settled(spark)
    print(json.dumps({
        "metric": "total wall time of the headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
        "cpus": CPUS,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
