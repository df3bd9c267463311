"""Tables on disk: dates, retries, accounting, file health, records."""

import json
import os

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark.operators import audit, decode
from tidemark.schemas import FRAMES
from tidemark.sources import health, records, tables

LATE = 1_793_577_540_000_000_000  # 2026-11-01T23:59:00Z


def wire(seq, price="0.5000"):
    return json.dumps({"type": "orderbook_delta", "sid": 2, "seq": seq,
                       "msg": {"market_ticker": "M", "price_dollars": price, "delta_fp": "1.00", "side": "yes"}})


SNAP = json.dumps({"type": "orderbook_snapshot", "sid": 2, "seq": 9, "msg": {
    "market_ticker": "M", "yes_dollars_fp": [["0.1", "1"], ["0.2", "2"]], "no_dollars_fp": []}})


def frames(spark):
    rows = [(LATE, "S", wire(1)), (LATE + 120 * 10**9, "S", wire(2, "bad")), (LATE, "S", SNAP), (LATE, "S", "junk")]
    return spark.createDataFrame(rows, FRAMES)


def test_fan_out_is_counted_dated_and_repeatable(spark, folder):
    routed = decode.route(frames(spark))
    for _ in range(2):
        done = tables.fan_out(routed, folder, 0)
    assert done == {"orderbook_snapshot": (2, 2), "orderbook_delta": (2, 2), "unparsed": (1, 1)}
    assert tables.rows_lost(done) == 0
    deltas = tables.read_channel(spark, folder, "orderbook_delta")
    assert sorted(str(r.date) for r in deltas.collect()) == ["2026-11-01", "2026-11-02"]
    assert tables.read_channel(spark, folder, "orderbook_delta", "2026-11-02").count() == 1
    assert tables.read_channel(spark, folder, "orderbook_delta", None, "2026-11-01").count() == 1
    assert tables.read_channel(spark, folder, "trade").count() == 0
    everything = tables.read_all(spark, folder)
    counts = {r.channel: r.rows for r in audit.channel_counts(everything).collect()}
    assert counts == {"orderbook_snapshot": 2, "orderbook_delta": 2, "unparsed": 1, "TOTAL": 5}
    report = {(r.channel, r.column): (r.checked, r.mismatches) for r in audit.round_trip_report(everything).collect()}
    assert report["orderbook_delta", "price_raw"] == (2, 0) and report["orderbook_snapshot", "size_raw"] == (2, 0)
    plan = tables.read_channel(spark, folder, "orderbook_delta", "2026-11-02").select("seq")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(date" in plan


def test_a_corrupted_integer_is_reported(spark):
    good = decode.decode(frames(spark))["orderbook_delta"]
    bad = good.withColumn("price_micros", F.when(F.col("seq") == 1, F.col("price_micros") + 1).otherwise(F.col("price_micros")))
    rows = audit.round_trip_mismatches(bad, [("price_raw", "price_micros", 6)], ["seq"]).collect()
    assert [(r.seq, r.stored, r.expected) for r in rows] == [(1, 500_001, 500_000)]


def test_compaction_keeps_every_row(spark, folder):
    tables.fan_out(decode.route(frames(spark)), folder, 3)
    tables.compact_day(spark, folder, "orderbook_delta", "2026-11-01", 1, f"{folder}/packed")
    assert tables.read_channel(spark, f"{folder}/packed", "orderbook_delta").count() == 1


def test_session_facts_travel_with_the_file(spark, folder):
    rows = tables.with_session_facts(decode.decode(frames(spark))["unparsed"], {"pricing_convention": "no_leg"})
    rows.write.parquet(f"{folder}/x")
    assert tables.session_facts(spark.read.parquet(f"{folder}/x")) == {"pricing_convention": "no_leg"}


def test_file_health(spark, folder):
    os.makedirs(f"{folder}/trade/date=2026-11-01")
    os.makedirs(f"{folder}/_quarantine/trade")
    for name, data in {"short": b"PAR1", "head": b"x" * 64, "foot": b"PAR1" + b"\0" * 4096, "open": b"", "fine": b"PAR1" + b"x" * 9 + b"PAR1"}.items():
        with open(f"{folder}/trade/date=2026-11-01/{name}.parquet", "wb") as f:
            f.write(data)
    with open(f"{folder}/_quarantine/trade/old.parquet", "wb") as f:
        f.write(b"bad")
    got = {os.path.basename(r.path)[:-8]: r.defect for r in health.file_health(spark, folder).collect()}
    assert got == {"short": "too_short", "head": "missing_header_magic", "foot": "missing_footer_magic", "fine": None}
    assert health.quarantine_list(spark, folder).count() == 3
    usage = health.storage_usage(spark, folder).first()
    assert (usage.channel, usage.files, usage.bytes) == ("trade", 4, 4 + 64 + 4100 + 17)


def test_session_records(spark, folder):
    record = {"session_id": "A", "started_at": "2026-11-01T00:00:00Z", "ended_at": None, "pricing_convention": "no_leg", "channels": ["ticker"], "ws_url": "u"}
    for channel, extra in (("ticker", {}), ("trade", {"ended_at": "2026-11-01T01:00:00+00:00"})):
        os.makedirs(f"{folder}/legacy/{channel}/date=2026-11-01")
        with open(f"{folder}/legacy/{channel}/date=2026-11-01/_session-A.json", "w") as f:
            json.dump({**record, **extra}, f)
    with open(f"{folder}/legacy/trade/date=2026-11-01/_session-B.json", "w") as f:
        f.write("{oops")
    legacy = records.read_legacy_sidecars(spark, f"{folder}/legacy")
    from tidemark.operators.coverage import dedupe_sessions

    (one,) = dedupe_sessions(legacy).collect()
    assert (one.session_id, one.ended_ms - one.started_ms) == ("A", 3_600_000)
    records.append_sessions(legacy, f"{folder}/sessions")
    again = records.read_sessions(spark, f"{folder}/sessions")
    assert again.count() == 2
    bad = again.withColumn("ws_url", F.lit("")).limit(1)
    assert [r.refused for r in records.check_sessions(again.unionByName(bad)).collect()].count(None) == 2
    assert records.check_sessions(bad).first().refused == "missing ws_url"


def test_metrics_log_and_discovery(spark, folder):
    with open(f"{folder}/log", "w") as f:
        for at, message in (("2026-11-01T00:00:00Z", "metrics"), ("2026-11-01T00:02:00Z", "metrics"), ("2026-11-01T00:03:00Z", "other")):
            f.write(json.dumps({"timestamp": at, "fields": {"message": message, "rows_lost": 0, "about": "metrics"}}) + "\n")
        f.write('not json "metrics"\n')
    row = records.last_metrics(spark, f"{folder}/log").first()
    assert row.at == "2026-11-01T00:02:00Z" and json.loads(row.fields)["rows_lost"] == 0
    pages = [{"pass_no": 0, "page_no": 0, "finished_ms": 7, "markets": [{"ticker": "a-1", "status": "open", "price_ranges": []}, {"status": "x"}]},
             {"pass_no": 1, "page_no": 0, "finished_ms": 7, "markets": [{"ticker": "a-1", "status": "closed"}, {"ticker": "B"}]}]
    with open(f"{folder}/pages", "w") as f:
        f.write("\n".join(json.dumps(p) for p in pages))
    from tidemark.operators import grids, reconcile

    merged = reconcile.merge_crawl(records.read_discovery(spark, f"{folder}/pages"))
    assert {r.ticker: r.status for r in merged.collect()} == {"a-1": "open", "B": None}
    seen = {r.market_ticker: (r.was_renamed, r.observed_ms, r.price_ranges_raw) for r in grids.observations_from_discovery(merged).collect()}
    assert seen == {"A-1": (True, 7, "[]"), "B": (False, 7, "")}


def test_unreadable_files_fail_unless_they_are_listed(spark, folder):
    tables.fan_out(decode.route(frames(spark)), folder, 0)
    (whole,) = [r.path for r in health.list_files(spark, f"{folder}/orderbook_delta/date=2026-11-02", "*.parquet").select("path").collect()]
    name = whole.removeprefix("file:")
    with open(name, "rb") as f:
        data = f.read()
    with open(name, "wb") as f:
        f.write(data[: len(data) // 2])
    crc = os.path.join(os.path.dirname(name), f".{os.path.basename(name)}.crc")
    if os.path.exists(crc):
        os.unlink(crc)
    try:
        tables.read_channel(spark, folder, "orderbook_delta").agg(F.sum("seq")).collect()
        raise AssertionError("a cut file was read")
    except (PySparkException, Py4JJavaError):
        pass
    assert health.quarantined(spark, folder) == []
    assert health.store_manifest(spark, folder) == 4
    bad = health.quarantined(spark, folder)
    assert [os.path.basename(p) for p in bad] == [os.path.basename(name)]
    assert tables.read_all(spark, folder)["orderbook_delta"].count() == 1


def test_accounting_is_kept_and_a_loss_is_an_error(spark, folder, monkeypatch):
    tables.fan_out(decode.route(frames(spark)), folder, 4)
    rows = {r.channel: (r.batch_id, r.expected, r.stored) for r in tables.read_accounting(spark, folder).collect()}
    assert rows == {"orderbook_snapshot": (4, 2, 2), "orderbook_delta": (4, 2, 2), "unparsed": (4, 1, 1)}
    write = tables.write_channel
    monkeypatch.setattr(tables, "write_channel", lambda df, *a, **b: write(df.limit(1), *a, **b))
    try:
        tables.fan_out(decode.route(frames(spark)), folder, 5)
        raise AssertionError("lost rows went unseen")
    except RuntimeError as error:
        assert "lost rows" in str(error)


def test_grid_changes_remember_earlier_batches_and_replace_themselves(spark, folder):
    def seen(*rows):
        return spark.createDataFrame([("M", "discovery", at, text) for at, text in rows], "market_ticker string, source string, observed_ms bigint, price_ranges_raw string")

    for _ in range(2):
        tables.write_grid_changes(seen((1, "[]"), (2, "[]")), f"{folder}/grids", 0)
    tables.write_grid_changes(seen((3, "[]"), (4, '[{"start":"0.1","end":"0.2","step":"0.1"}]')), f"{folder}/grids", 1)
    assert sorted((r.batch_id, r.observed_ms) for r in spark.read.parquet(f"{folder}/grids").collect()) == [(0, 1), (1, 4)]


def test_refused_records_are_listed(spark, folder):
    with open(f"{folder}/sessions.json", "w") as f:
        f.write('{"session_id": "A", "started_at": "2026-11-01T00:00:00Z"}\n{oops\n{"session_id": ""}\n\n')
    assert [r.session_id for r in records.read_sessions(spark, f"{folder}/sessions.json").collect()] == ["A"]
    assert sorted(r.line for r in records.refused_sessions(spark, f"{folder}/sessions.json").collect()) == ['{"session_id": ""}', "{oops"]


def test_latest_values_of_a_tie_come_from_one_row(spark):
    from tidemark.operators.board import market_board

    rows = [("M", 5, None, 1, 2, 3, 4, 5), ("M", 5, None, 9, 1, 2, 3, 4), ("M", 4, None, 50, 50, 50, 50, 50)]
    columns = "market_ticker string, received_at_ns bigint, seq bigint, yes_bid_micros bigint, yes_ask_micros bigint, price_micros bigint, volume_fp_units bigint, open_interest_fp_units bigint"
    row = market_board(spark.createDataFrame(rows, columns)).first()
    assert (row.yes_bid_micros, row.yes_ask_micros, row.price_micros) == (9, 1, 2)


def test_only_new_or_changed_files_are_probed(spark, folder):
    day = f"{folder}/trade/date=2026-11-01"
    os.makedirs(day)

    def put(name, data):
        with open(f"{day}/{name}.parquet", "wb") as f:
            f.write(data)

    whole, cut = b"PAR1" + b"x" * 40 + b"PAR1", b"PAR1" + b"x" * 44
    put("a", whole)
    put("b", cut)
    assert health.store_manifest(spark, folder) == 2 and health.store_manifest(spark, folder) == 0
    assert [os.path.basename(p) for p in health.quarantined(spark, folder)] == ["b.parquet"]
    at = os.stat(f"{day}/a.parquet")
    put("a", cut)  # of the same size and time: taken for the file that was probed, as it is not opened
    os.utime(f"{day}/a.parquet", ns=(at.st_atime_ns, at.st_mtime_ns))
    put("c", cut)
    assert health.store_manifest(spark, folder) == 1
    assert [os.path.basename(p) for p in health.quarantined(spark, folder)] == ["b.parquet", "c.parquet"]
    put("b", whole + b"PAR1")  # finished since: no longer listed as it was, and sound when probed again
    os.unlink(f"{day}/c.parquet")
    assert health.quarantined(spark, folder) == []
    assert health.store_manifest(spark, folder) == 1 and health.quarantined(spark, folder) == []
    assert {os.path.basename(r.path): (r.bytes, r.defect) for r in health.read_manifest(spark, folder).collect()}["b.parquet"] == (52, None)


def test_files_are_bounded_by_bytes(spark, folder):
    """Frames of 30 to 9,000 random characters, most of them within one second: full files are within 20 % of the bound."""
    import base64
    import random

    rng = random.Random(8)
    bound = 400_000

    def junk(n, at):
        return [(at + i * 1_000_000, "S", base64.b64encode(rng.randbytes(rng.choice([20, 60, 400, 6_500]))).decode()) for i in range(n)]

    first = junk(400, LATE - 10**12)
    second = junk(900, LATE) + junk(40, LATE + 120 * 10**9)
    for batch, rows in enumerate((first, second)):
        done = tables.fan_out(decode.route(spark.createDataFrame(rows, FRAMES)), folder, batch, bound)
        assert done == {"unparsed": (len(rows), len(rows))}
    files = health.list_files(spark, f"{folder}/unparsed", "*.parquet").collect()
    own = {}
    for f in files:
        if "batch_id=1" in f.path:
            own.setdefault("date=2026-11-02" in f.path, []).append(f.bytes)
    assert len(own[True]) == 1 and len(own[False]) > 2  # the next day has few rows, this one many
    rest, *full = sorted(own[False])
    assert all(0.8 * bound < n < 1.2 * bound for n in full) and rest < 1.2 * bound
    read = tables.read_channel(spark, folder, "unparsed")
    assert sorted(r.raw_message for r in read.select("raw_message").collect()) == sorted(m for _, _, m in first + second)
    order = read.withColumn("f", F.input_file_name()).where("date = '2026-11-01'").groupBy("f").agg(F.min("received_at_ns").alias("a"), F.max("received_at_ns").alias("b"))
    spans = sorted((r.a, r.b) for r in order.collect())
    assert all(x[1] < y[0] for x, y in zip(spans, spans[1:]))  # files follow each other in time


def test_a_batch_reads_only_its_own_folders(spark, folder):
    rows = decode.route(frames(spark))
    tables.fan_out(rows, folder, 0)
    with open(next(p for p in _walk(f"{folder}/unparsed") if p.endswith(".parquet")), "wb") as f:
        f.write(b"broken")
    assert tables.fan_out(rows, folder, 1)["unparsed"] == (1, 1)


def _walk(root):
    return [os.path.join(d, n) for d, _, names in os.walk(root) for n in names]


def test_the_rows_of_a_batch_are_never_broadcast(spark, folder):
    tables.fan_out(decode.route(frames(spark)), folder, 0)
    batch = tables.read_channel(spark, folder, "orderbook_delta")
    days = [(r.date, i, 1) for i, r in enumerate(batch.select("date").distinct().collect())]
    dealt = tables.numbered(batch, days, F.lit(0))
    plan = dealt._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in plan and "BuildRight" in plan and "BuildLeft" not in plan
    assert dealt.count() == 2


def test_files_that_compress_worse_than_the_batch_before_are_written_again(spark, folder):
    rows = [(LATE + i, "S", wire(i, f"0.{i * 7919 % 10000:04d}")) for i in range(20_000)]
    routed = decode.route(spark.createDataFrame(rows, FRAMES))
    tables.fan_out(routed, folder, 0)
    bound = 1 << 16
    told = "SELECT 'orderbook_delta' AS channel, 1L AS expected, 1L AS stored, 100L AS weight, 1L AS bytes"
    spark.sql(told).write.mode("overwrite").parquet(f"{folder}/_accounting/batch_id=0")
    tables.fan_out(routed, folder, 1, bound)
    sizes = [r.bytes for r in health.list_files(spark, f"{folder}/orderbook_delta/date=*/batch_id=1", "*.parquet").collect()]
    assert len(sizes) > 1 and max(sizes) <= 1.2 * bound
    assert tables.read_channel(spark, folder, "orderbook_delta").count() == 40_000
