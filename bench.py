"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from tidemark.session import local_session
from tidemark.workload import catalog

HEADLINE = (
    "market_board",
    "board_with_settlement",
    "market_history",
    "fixed_point_parse",
    "round_trip_audit",
    "grid_snap",
    "frame_router",
    "encode_delta",
    "minute_metrics",
    "seq_summary",
    "seq_gaps",
    "seq_verdicts",
    "session_islands",
    "coverage_daily",
    "coverage_in_windows",
    "grid_asof",
    "fee_asof",
    "book_outcomes",
    "book_bbo",
    "reconcile_missed",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session("tidemark-bench", os.environ.get("BENCH_CPUS", "8"), os.environ.get("BENCH_MEMORY", "16g"))
    chosen = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    catalog.QUERIES["captured_markets"](spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in chosen:
        begin = time.perf_counter()
        catalog.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - begin, 3)
    spark.stop()
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": scale}))


if __name__ == "__main__":
    main()
