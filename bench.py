"""Time the headline queries; prints one JSON line.

The given tables are first stored once in chain shape (`land_tables` below), since
the queries are meant for stored blocks, transactions and logs. Every query then
runs once to warm up and `BENCH_RUNS` times (default 2) measured, writing all
columns of all rows to the no-op sink. The median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import time
import uuid

from chainlake.registry import QUERIES
from chainlake.registry.adapters import land
from chainlake.session import local_session, shared_dir

HEADLINE = [
    "v01_pre_tx", "v03_pre_tx_daily", "v04_tx_volume", "v05_uaw", "v06_missing_tokens",
    "j01_enrich_transactions", "j09_native_interval_price", "j16_tokens_without_metadata",
    "x01_transfers_decimal", "x10_trace_status", "w01_last_transaction", "d01_latest_by",
    "a21_cumulative_stats", "g01_prepare_edges", "g05_pagerank_personalised", "w06_global_ranking",
    "b01_overview_var", "b03_key_metrics", "b10_contract_categories", "b13_top10_contract_uaw",
    "b27_uaw_daily_defi", "j20_category_activity", "r06_sorting_table", "r07_project_table",
]


VIEWS = ["transactions", "receipts", "token_transfers", "logs", "tokens", "price_history",
         "price_ids", "contracts", "trace_rows", "scores", "label_contract", "label_eoa", "reputations",
         "top_reputations", "service_labels"]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = local_session(cpus, partitions=int(cpus) if cpus.isdigit() else 8)
    start = time.perf_counter()
    land(spark, folder, f"{shared_dir(spark)}/bench-{uuid.uuid4().hex}", VIEWS)
    landing = round(time.perf_counter() - start, 3)
    times: dict[str, float] = {}
    for name in names:
        measured = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            measured.append(time.perf_counter() - start)
        times[name] = round(statistics.median(measured[1:]), 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "land_tables_sec": landing,
    }))


if __name__ == "__main__":
    main()
