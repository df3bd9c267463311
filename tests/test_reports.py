"""Reports end to end over written tables."""

import json

import pytest

from tidemark.operators import decode
from tidemark.plans import reports
from tidemark.schemas import FRAMES
from tidemark.sources import tables

NOW = 1_793_620_800_000  # 2026-11-02T12:00:00Z


def test_board_history_and_integrity(spark, folder):
    def tick(seq, bid, market="KXA-26NOV02AABB-AA"):
        msg = {"market_ticker": market, "price_dollars": "0.50"}
        return json.dumps({"type": "ticker", "sid": 3, "seq": seq, "msg": {**msg, **({"yes_bid_dollars": bid} if bid else {})}})

    done = json.dumps({"type": "market_lifecycle_v2", "sid": 4, "msg": {"event_type": "determined", "market_ticker": "KXA-26NOV02AABB-AA", "result": "yes", "settlement_value": "1"}})
    at = (NOW - 3_600_000) * 1_000_000
    rows = [(at, "S", tick(1, "0.40")), (at, "S", tick(2, "0.41")), (at + 10**9, "S", tick(4, None)), (at, "S", done),
            (at, "S", tick(5, "0.10", "KXB-26NOV03CCDD-CC"))]
    tables.fan_out(decode.route(spark.createDataFrame(rows, FRAMES)), folder, 0)
    first, second = reports.market_board(spark, folder, NOW).collect()
    assert (first.market_ticker, first.yes_bid_micros, first.is_settled) == ("KXB-26NOV03CCDD-CC", 100_000, False)
    assert (second.yes_bid_micros, second.result, second.settlement_value_micros) == (410_000, "yes", 1_000_000)
    (bucket,) = reports.market_history(spark, folder, "KXA-26NOV02AABB-AA", 6, NOW).collect()
    assert bucket.bucket_start_s == (NOW // 1000 - 3600) // 120 * 120 and bucket.yes_bid_micros == 410_000
    with pytest.raises(ValueError):
        reports.market_history(spark, folder, "M", 7, NOW)
    got = {r.check: (r.bad, r.verdict) for r in reports.integrity(spark, folder).collect()}
    assert got == {"round_trip": (0, "PASS"), "continuity": (1, "FAIL"), "files": (0, "PASS"), "result": (1, "FAIL")}


def test_coverage_report(spark, folder):
    with open(f"{folder}/sessions.json", "w") as f:
        for i, (a, b) in enumerate((("00:00:00", "01:00:00"), ("02:00:00", None))):
            f.write(json.dumps({"session_id": f"s{i}", "started_at": f"2026-11-02T{a}Z", "ended_at": b and f"2026-11-02T{b}Z"}) + "\n")
    out = reports.coverage_report(spark, f"{folder}/sessions.json", NOW)
    head = out["headline"].first()
    assert (head.sessions, head.running, head.covered_ms) == (2, 1, 11 * 3_600_000)
    assert out["largest_gaps"].first().gap_ms == 3_600_000
    assert out["daily"].first().flag == "gap"


def test_channel_counts_parse_each_frame_once(spark):
    from tidemark.workload import catalog

    counts = catalog.QUERIES["channel_counts"](spark, "/root/testdata/sf0.001")
    plan = counts._jdf.queryExecution().optimizedPlan().toString()
    assert "parse_json" not in plan.lower() and "relation [" in plan.lower()
