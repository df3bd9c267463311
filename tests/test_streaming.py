"""Streams give what one batch over the same rows gives."""

import json
import os
import random
import time

from tidemark.operators import grids, reconcile, sequence
from tidemark.sources import records, tables
from tidemark.streaming import live


def drop(folder, n, rows):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{n:03d}.json", "w") as f:
        f.write("\n".join(json.dumps(r) for r in rows))
    os.utime(f"{folder}/{n:03d}.json", (1_700_000_000 + n, 1_700_000_000 + n))


def stream(spark, folder, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(folder)


def finish(query):
    query.awaitTermination(120)
    assert query.exception() is None


def test_ingest_and_minutes(spark, folder):
    delta = {"type": "orderbook_delta", "sid": 1, "seq": 1, "msg": {"market_ticker": "M", "price_dollars": "0.1", "delta_fp": "1", "side": "no"}}
    minute = 60_000_000_000
    for n in range(2):
        drop(f"{folder}/in", n, [{"received_at_ns": minute * (n * 10 + 1) + i, "session_id": "S", "raw_message": json.dumps(delta) if i else "junk"} for i in range(5)])
    frames = records.stream_frames(spark, f"{folder}/in", 1)
    finish(live.ingest(frames, f"{folder}/out", f"{folder}/cp", None))
    assert tables.read_channel(spark, f"{folder}/out", "orderbook_delta").count() == 8
    assert tables.read_channel(spark, f"{folder}/out", "unparsed").count() == 2
    for name, make in (("minutes", live.minute_metrics), ("spells", live.rebuilt_sessions)):
        query = make(frames).writeStream.format("memory").queryName(name).outputMode("append").option(
            "checkpointLocation", f"{folder}/cp-{name}").trigger(availableNow=True).start()
        finish(query)
    (row,) = spark.table("minutes").collect()
    assert (row.messages, row.unparsed) == (5, 1)
    assert [r.frames for r in spark.table("spells").collect()] == [5]


SECOND = 1_000_000_000
BASE = 1_000_000 * SECOND
FRAMES = "session_id string, sid bigint, received_at_ns bigint, seq bigint, is_snapshot boolean, control string"


def feed(folder, rows, n, rng, reach, time, end):
    """``rows`` in ``n`` files, each up to ``reach`` places late, and a last row far ahead."""
    order = sorted(range(len(rows)), key=lambda i: i + rng.random() * reach)
    size = len(rows) // n + 1
    for k in range(n):
        drop(folder, k, [rows[i] for i in order[k * size : (k + 1) * size]])
    drop(folder, n, [{**end, time: rows[-1][time] + 10**6 * max(1, rows[-1][time] // 10**6)}])


def lives_of(rows):
    """Verdicts and closed spans of one stream's rows in order, as a plain loop."""
    out, spans = [], []
    known, live, life, last, valid, since = False, False, 0, None, False, None
    for r in rows:
        at, seq, control = r["received_at_ns"], r["seq"], r["control"]
        if control == "open":
            if live and not valid:
                spans.append((since, at))
            known, live, life, last, valid, since = True, True, life + 1, None, False, at
            out.append((at, life, "registered"))
            continue
        if not known and control is None:
            known, live, since = True, True, at
        if not live:
            known = True
            out.append((at, life, "unregistered"))
        elif control == "close":
            if not valid:
                spans.append((since, at))
            live = False
            out.append((at, life, "retired"))
        elif r["is_snapshot"]:
            out.append((at, life, "snapshot_initial" if last is None else "snapshot_continues" if seq > last else "snapshot_restarts"))
            if not valid:
                spans.append((since, at))
            last, valid = seq, True
        elif last is None or seq == last + 1:
            out.append((at, life, "first" if last is None else "in_order"))
            last = seq
        elif seq <= last:
            out.append((at, life, "regression"))
        else:
            out.append((at, life, "gap"))
            last = seq
            if valid:
                valid, since = False, at
    return out, spans


def stream_rows(rng, n):
    rows, seq = [], {}
    for i in range(n):
        k = (rng.choice("AAAB"), rng.choice([1, 2]))
        roll = rng.random()
        control = "open" if roll < 0.03 else "close" if roll < 0.07 else None
        seq[k] = 1 if control == "open" else max(1, seq.get(k, 7) + rng.choice([1, 1, 1, 1, 1, 4, 0, -1]))
        rows.append({"session_id": k[0], "sid": k[1], "received_at_ns": BASE + i * SECOND, "seq": None if control else seq[k], "is_snapshot": control is None and rng.random() < 0.12, "control": control})
    return rows


def test_tracker_and_batch_lifetimes_equal_a_plain_loop(spark, folder):
    rng = random.Random(4)
    rows = stream_rows(rng, 400)
    feed(f"{folder}/in", rows, 4, rng, 9, "received_at_ns", {**rows[0], "session_id": "end", "control": None})
    finish(live.track_sequences(stream(spark, f"{folder}/in", FRAMES), f"{folder}/st", f"{folder}/cp", late="10 seconds"))
    got = live.read_output(spark, f"{folder}/st").collect()
    frames = spark.createDataFrame([r for r in rows if r["control"] is None], FRAMES).drop("control")
    controls = spark.createDataFrame([r for r in rows if r["control"]], FRAMES)
    live_frames, lives = sequence.lifetimes(frames, controls, width=20 * SECOND)
    verdicts = sequence.sequence_verdicts(live_frames, sequence.LIFE, width=20 * SECOND)
    end = BASE + 10_000 * SECOND
    spans = sequence.invalid_spans(verdicts, end, sequence.LIFE, width=20 * SECOND, lives=lives)
    batch, closed = verdicts.collect(), spans.where("NOT is_open").collect()
    totals = sequence.live_totals(sequence.lifetime_health(verdicts, spans, lives)).first()
    retired = 0
    for key in {(r["session_id"], r["sid"]) for r in rows}:
        want, want_spans = lives_of([r for r in rows if (r["session_id"], r["sid"]) == key])
        mine = [r for r in got if (r.session_id, r.sid) == key]
        assert sorted((r.received_at_ns, r.life, r.verdict) for r in mine) == want
        assert sorted((r.span_started_ns, r.received_at_ns) for r in mine if r.span_started_ns is not None) == want_spans
        data = [w for w in want if w[2] not in ("registered", "retired", "unregistered")]
        assert sorted((r.received_at_ns, r.life, r.verdict) for r in batch if (r.session_id, r.sid) == key) == data
        assert sorted((r.started_ns, r.ended_ns) for r in closed if (r.session_id, r.sid) == key) == want_spans
        retired += sum(w[2] == "retired" for w in want)
    assert totals.retired_streams >= retired > 0


def test_outages_of_a_life_add_up_and_an_ended_one_stops_counting(spark):
    def row(at, seq, snapshot=False, sid=4):
        return ("Q", sid, at * SECOND, seq, snapshot)

    rows = [row(3, 70, True), row(9, 75), row(12, 76), row(16, 90, True), row(20, 95), row(27, 96, True), row(30, 99), row(41, 8, True, 6)]
    frames = spark.createDataFrame(rows, "session_id string, sid bigint, received_at_ns bigint, seq bigint, is_snapshot boolean")
    schema = "session_id string, sid bigint, received_at_ns bigint, control string"
    opened = [("Q", 4, 1 * SECOND, "open"), ("Q", 6, 40 * SECOND, "open"), ("Q", 9, 44 * SECOND, "open")]

    def totals(controls):
        good, lives = sequence.lifetimes(frames, spark.createDataFrame(controls, schema), width=5 * SECOND)
        verdicts = sequence.sequence_verdicts(good, sequence.LIFE, width=5 * SECOND)
        spans = sequence.invalid_spans(verdicts, 50 * SECOND, sequence.LIFE, width=5 * SECOND, lives=lives)
        health = sequence.lifetime_health(verdicts, spans, lives)
        return {r.sid: (r.gaps, r.is_invalid, r.invalid_ns // SECOND, r.is_retired) for r in health.collect()}, sequence.live_totals(health).first()

    # Sid 4: 2 s until its first snapshot, 7 s and 7 s of outages, and from 30 s on; sid 9 never got a frame.
    each, total = totals(opened)
    assert each == {4: (3, True, 2 + 7 + 7 + 20, False), 6: (0, False, 1, False), 9: (0, True, 6, False)}
    assert tuple(total) == (3, 2, (36 + 1 + 6) * SECOND, 0)
    each, total = totals([*opened, ("Q", 4, 33 * SECOND, "close")])
    assert each[4] == (3, False, 2 + 7 + 7 + 3, True) and tuple(total) == (0, 1, 7 * SECOND, 1)


def test_controls_come_from_control_rows_errors_and_lost_connections(spark):
    control = spark.createDataFrame([("A", 1, 10, "subscribed"), ("A", 2, 11, "subscribed"), ("A", 1, 30, "unsubscribed"), ("B", 1, 5, "subscribed"), ("A", None, 7, "error")],
                                    "session_id string, sid bigint, received_at_ns bigint, message_type string")
    losses = spark.createDataFrame([("A", 50)], "session_id string, received_at_ns bigint")
    errors = spark.createDataFrame([("B", 1, 20, "resubscribe"), ("B", 1, 21, None)], "session_id string, sid bigint, received_at_ns bigint, recovery string")
    got = sorted(map(tuple, sequence.stream_controls(control, losses, errors).collect()))
    assert got == [("A", 1, 10, "open"), ("A", 1, 30, "close"), ("A", 1, 50, "close"), ("A", 2, 11, "open"), ("A", 2, 50, "close"), ("B", 1, 5, "open"), ("B", 1, 20, "close")]


def test_grids_and_registry_equal_batch_and_start_warm(spark, folder):
    rng = random.Random(6)
    looks = [{"market_ticker": rng.choice("MMN"), "source": "d", "observed_ms": 1000 + i, "price_ranges_raw": rng.choice(["[1]", "[1]", "[2]"])} for i in range(60)]
    seen = [{"market_ticker": f"M{rng.randrange(12)}", "learned_via": rng.choice(reconcile.SOURCES), "seen_ms": 1000 + i // 2} for i in range(60)]
    feed(f"{folder}/g", looks, 3, rng, 8, "observed_ms", {**looks[0], "market_ticker": "end"})
    feed(f"{folder}/r", seen, 3, rng, 8, "seen_ms", {**seen[0], "market_ticker": "end"})
    finish(live.track_grids(stream(spark, f"{folder}/g", live.keyed.GRID_ROW), f"{folder}/gs", f"{folder}/gc"))
    got = {r.observed_ms: r.verdict for r in live.read_output(spark, f"{folder}/gs").collect()}
    batch = grids.grid_verdicts(spark.createDataFrame(looks, live.keyed.GRID_ROW))
    assert got == {r.observed_ms: r.verdict for r in batch.collect()}
    stored = spark.createDataFrame([("M", "d", looks[0]["price_ranges_raw"])], "market_ticker string, source string, price_ranges_raw string")
    finish(live.track_grids(stream(spark, f"{folder}/g", live.keyed.GRID_ROW), f"{folder}/ws", f"{folder}/wc", initial=stored))
    warm = {r.market_ticker: r.verdict for r in live.read_output(spark, f"{folder}/ws").where("verdict = 'first_observation'").collect()}
    assert set(warm) == {"N"}
    schema = "market_ticker string, learned_via string, seen_ms bigint"
    finish(live.track_registry(stream(spark, f"{folder}/r", schema), f"{folder}/rs", f"{folder}/rc"))
    want = {tuple(r) for r in reconcile.market_registry(spark.createDataFrame(seen, schema)).collect()}
    assert {tuple(r) for r in live.read_output(spark, f"{folder}/rs").collect()} == want
    known = spark.createDataFrame([("M1", "lifecycle", 5)], live.keyed.KNOWN)
    finish(live.track_registry(stream(spark, f"{folder}/r", schema), f"{folder}/ks", f"{folder}/kc", initial=known))
    assert {r.market_ticker for r in live.read_output(spark, f"{folder}/ks").collect()} == {w[0] for w in want} - {"M1"}


def test_a_second_query_goes_on_from_where_the_first_one_ended(spark, folder):
    rows = [{"session_id": "A", "sid": 1, "received_at_ns": BASE + i * SECOND, "seq": seq, "is_snapshot": i == 0, "control": None} for i, seq in enumerate([5, 6, 9, 10])]
    far = {"session_id": "end", "sid": 1, "seq": 1, "is_snapshot": False, "control": None}
    for n, part in enumerate((rows[:2], rows[2:])):
        drop(f"{folder}/in", 2 * n, part)
        drop(f"{folder}/in", 2 * n + 1, [{**far, "received_at_ns": BASE + (100 if n else 11) * SECOND}])
        finish(live.track_sequences(stream(spark, f"{folder}/in", FRAMES), f"{folder}/st", f"{folder}/cp", late="10 seconds"))
    got = live.read_output(spark, f"{folder}/st").where("session_id = 'A'").orderBy("received_at_ns").collect()
    assert [(r.seq, r.verdict, r.is_valid) for r in got] == [(5, "snapshot_initial", True), (6, "in_order", True), (9, "gap", False), (10, "in_order", False)]


def test_idle_sessions_raise_an_alert(spark, folder):
    drop(f"{folder}/in", 0, [{"received_at_ns": i, "session_id": s, "raw_message": "x"} for i in range(5) for s in "AB"])
    alerts = live.idle_alerts(records.stream_frames(spark, f"{folder}/in", 1), 2_000)
    query = alerts.writeStream.format("memory").queryName("alerts").outputMode("append").option(
        "checkpointLocation", f"{folder}/cp").trigger(processingTime="1 second").start()
    deadline = time.time() + 60
    while time.time() < deadline and spark.table("alerts").count() < 2:
        time.sleep(1)
    query.stop()
    assert sorted((r.session_id, r.last_received_ns) for r in spark.table("alerts").collect()) == [("A", 4), ("B", 4)]


def test_a_stream_over_a_long_time_ends(spark, folder):
    from tidemark.workload import catalog

    parts = [(k, "Brand#11", k % 7) for k in (0, 1, 60_000, 60_002, 7_200_000)]
    spark.createDataFrame(parts, "p_partkey long, p_brand string, p_size long").write.parquet(f"{folder}/part.parquet")
    got = {(r.source, r.observed_ms) for r in catalog.QUERIES["stream_grids"](spark, folder).collect()}
    assert got == {("lifecycle" if k % 5 == 0 else "discovery", k * 300_000) for k, _, _ in parts}


def test_rows_wait_in_parts_of_a_bucket_and_are_read_bucket_by_bucket(monkeypatch):
    import random

    from pyspark.sql import Row

    from tidemark.streaming import keyed

    class Value:
        def __init__(self):
            self.held = None

        exists = lambda self: self.held is not None
        get = lambda self: self.held

        def update(self, value):
            self.held = value

        def clear(self):
            self.held = None

    class Map(dict):
        largest = 0

        def updateValue(self, key, value):
            Map.largest = max(Map.largest, len(keyed.pickle.loads(value[0])))
            self[key] = value

        getValue, removeKey = dict.get, dict.pop

    class Handle:
        getValueState = lambda self, *a: Value()
        getMapState = lambda self, *a: Map()
        registerTimer = deleteTimer = lambda self, at: None

    class Times:
        def __init__(self, at):
            self.getCurrentWatermarkInMs = lambda: at

    class Plain(keyed.InEventOrder):
        def act(self, key, rows):
            yield from rows

    monkeypatch.setattr(keyed, "FRESH_ROWS", 500)
    one = Plain(["at", "n"], ["at", "n"], 1, 1_000)
    one.init(Handle())
    rows = [(at, n) for n, at in enumerate(range(0, 40_000, 10))]
    random.Random(1).shuffle(rows)
    make = Row("n", "at", "other")
    assert list(one.handleInputRows("k", (make(n, at, "x") for at, n in rows), Times(-1))) == []
    assert len(one.waiting) > 40 and Map.largest <= 100
    first = list(one.handleInputRows("k", iter([make(-1, 7, "x")]), Times(20_005)))
    assert first == sorted([r for r in rows if r[0] <= 20_005] + [(7, -1)]) and one.due.get() == (20_010,)
    assert list(one.handleExpiredTimer("k", Times(10**6), None)) == sorted(r for r in rows if r[0] > 20_005)
    assert not one.waiting and not one.buckets.exists() and not one.due.exists()


class Held:
    """State of one key, with the number of calls."""

    def __init__(self):
        self.calls = 0

    def handle(self):
        held = self

        class Value:
            def __init__(self):
                self.value = None

            exists = lambda self: self.value is not None
            get = lambda self: self.value

            def update(self, value):
                held.calls += 1
                self.value = value

            def clear(self):
                self.value = None

        class Map(dict):
            def updateValue(self, key, value):
                held.calls += 1
                self[key] = value

            def getValue(self, key):
                held.calls += 1
                return self[key]

            removeKey = dict.pop

        class Handle:
            getValueState = lambda self, *a: Value()
            getMapState = lambda self, *a: Map()
            registerTimer = deleteTimer = lambda self, at: None

        return Handle()


class At:
    def __init__(self, watermark_ms):
        self.getCurrentWatermarkInMs = lambda: watermark_ms


def in_packs(*tables):
    import pandas as pd

    from tidemark.streaming import packs

    return iter([pd.DataFrame({"pack": [packs.write(t) for t in tables]})])


def out_of_packs(frames):
    from tidemark.streaming import packs

    return [row for frame in frames for data in frame["pack"] for row in packs.read(data).to_pylist()]


def test_rows_are_packed_by_key_and_come_back_as_they_were(spark):
    from tidemark.streaming import packs

    rows = [(k, None if n % 7 == 0 else 2**62 + n, None if n % 5 == 0 else f"t{n}", n) for n in range(3_000) for k in ("a", None)]
    frame = spark.createDataFrame(rows, "k string, n bigint, t string, s bigint").selectExpr("k", "n", "t", "timestamp_seconds(s) AS at").repartition(3)
    packed = packs.pack(frame, ["k"], "at")
    assert packed.count() == 6 and packed.columns == ["k", "at", "pack"]
    assert {(r.k, r.at) for r in packed.selectExpr("k", "unix_seconds(at) >= 2900 AS at").collect()} == {("a", True), (None, True)}
    back = packs.unpack(packed, "k string, n bigint, t string").collect()
    assert sorted(map(str, map(tuple, back))) == sorted(str(r[:3]) for r in rows)


def test_packs_act_in_event_order_and_leave_out_what_their_key_has_passed(monkeypatch):
    import pyarrow as pa

    from tidemark.streaming import keyed

    monkeypatch.setattr(keyed, "ACT_ROWS", 300)
    monkeypatch.setattr(keyed, "FRESH_PACKED_ROWS", 700)
    now = 1_800_000_000 * SECOND  # a present clock in ns
    rng = random.Random(8)
    numbers = list(range(4_000))
    rng.shuffle(numbers)

    def table(some):
        n = len(some)
        return pa.table({"received_at_ns": [now + 10_000_000 * i for i in some], "seq": some, "is_snapshot": [i == 0 for i in some], "control": pa.array([None] * n, pa.string())})

    names = ["received_at_ns", "seq", "verdict"]
    held = Held()
    one = keyed.SequenceTracker(names)
    one.init(held.handle())
    assert out_of_packs(one.handleInputRows("k", in_packs(table(numbers[:2_000]), table(numbers[2_000:])), At(0))) == []
    first = out_of_packs(one.handleInputRows("k", in_packs(table([5, 4_000])), At(now // 1_000_000 + 20_005)))
    # A second row of number 5 came in time; later than the watermark is what comes next.
    assert [r["seq"] for r in first] == sorted([*range(2_001), 5])
    assert {r["verdict"] for r in first} == {"snapshot_initial", "in_order", "regression"}
    rest = out_of_packs(one.handleInputRows("k", in_packs(table([7, 4_001])), At(now // 1_000_000 + 10**6)))
    assert [r["seq"] for r in rest] == list(range(2_001, 4_002)) and {r["verdict"] for r in rest} == {"in_order"}
    assert not one.waiting and not one.due.exists()


def test_a_group_of_markets_costs_a_few_calls_of_state():
    import pyarrow as pa

    from tidemark.streaming import keyed

    def table(rows):
        names = ("market_ticker", "learned_via", "seen_ms", "rank")
        return pa.table({n: pa.array([r[i] for r in rows], pa.int32() if n == "rank" else None) for i, n in enumerate(names)})

    rng = random.Random(9)
    rows = [(f"M{rng.randrange(2_000)}", v, at, r) for at in range(5_000) for r, v in [rng.choice([(1, "lifecycle"), (2, "reconciliation")])]]
    want = {}
    for market, via, at, rank in rows:
        want[market] = min(want.get(market, (10**9,)), (at, rank, via))
    held = Held()
    one = keyed.Registry()
    one.init(held.handle())
    got, seen = [], rows[:]
    rng.shuffle(seen)
    order = sorted(seen, key=lambda r: r[2] + rng.random() * 400)
    for n in range(20):
        got += out_of_packs(one.handleInputRows((0,), in_packs(table(order[n * 250 : n * 250 + 250])), At(n * 250 - 450)))
    got += out_of_packs(one.handleExpiredTimer((0,), At(10**6), None))
    assert sorted((r["market_ticker"], r["first_seen_ms"], r["learned_via"]) for r in got) == sorted((m, at, via) for m, (at, _, via) in want.items())
    assert held.calls < 300
    assert out_of_packs(one.handleInputRows((0,), in_packs(table([("M1", "lifecycle", 10**7, 1), ("N", "lifecycle", 10**7, 1)])), At(10**8))) == [
        {"market_ticker": "N", "learned_via": "lifecycle", "first_seen_ms": 10**7}]
