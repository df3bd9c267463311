"""Books against a small in-memory replay."""

import random

from pyspark.sql import functions as F

from tidemark.operators import book

LEVELS = "session_id string, sid bigint, market_ticker string, received_at_ns bigint, seq bigint, side string, " \
         "level_index int, price_micros bigint, size_fp_units bigint"
DELTAS = "session_id string, sid bigint, market_ticker string, received_at_ns bigint, seq bigint, side string, " \
         "price_micros bigint, delta_fp_units bigint"
OTHERS = "session_id string, sid bigint, received_at_ns bigint, seq bigint"


class Ref:
    """One market on its own stream, as a plain object."""

    def __init__(self, convention="no_leg"):
        self.bids, self.asks, self.valid, self.last, self.desyncs, self.k = {}, {}, False, None, 0, convention

    def yes(self, side, p):
        return p if side == "yes" or self.k == "yes_leg" else 1_000_000 - p

    def snapshot(self, seq, levels):
        self.bids, self.asks = {}, {}
        for side, p, q in levels:
            if q:
                (self.bids if side == "yes" else self.asks)[self.yes(side, p)] = q
        self.valid, self.last = True, seq

    def delta(self, seq, side, p, d):
        if not self.valid:
            return "discarded_invalid", False
        if seq <= self.last:
            return "regression", False
        if seq > self.last + 1:
            self.valid, self.last = False, seq
            return "gapped", False
        self.last = seq
        m, p = (self.bids if side == "yes" else self.asks), self.yes(side, p)
        new = m.get(p, 0) + d
        if new < 0:
            self.valid = False
            self.desyncs += 1
            return "applied", True
        m.pop(p, None)
        if new:
            m[p] = new
        return "applied", False

    def bbo(self):
        b, a = max(self.bids, default=None), min(self.asks, default=None)
        return b, self.bids.get(b), a, self.asks.get(a), len(self.bids), len(self.asks)


def build(spark, levels, deltas, others=(), convention="no_leg", width=50):
    lv = spark.createDataFrame(levels, LEVELS)
    good = book.accepted_levels(lv)
    frames = book.book_frames(good, spark.createDataFrame(deltas, DELTAS), spark.createDataFrame(list(others), OTHERS))
    state = book.stream_state(frames, width)
    outcomes = book.frame_outcomes(state, width)
    history = book.level_history(book.level_changes(outcomes, good, F.lit(convention)), width)
    return state, outcomes, history


def random_market(rng, name, n):
    ref, levels, deltas, bbo, verdicts = Ref(), [], [], {}, {}
    seq = 0
    for i in range(n):
        at = i * 10
        roll = rng.random()
        if i == 3 or roll < 0.06:
            seq = seq + 1 if rng.random() < 0.8 else max(1, seq - 3)
            side_levels = [(s, p, rng.randrange(0, 4) * 100) for s in ("yes", "no") for p in
                           sorted(rng.sample(range(50_000, 900_000, 50_000), 3))]
            for j, (s, p, q) in enumerate(side_levels):
                levels.append((name, 1, "M", at, seq, s, j % 3, p, q))
            ref.snapshot(seq, side_levels)
            if ref.bids or ref.asks:
                bbo[at] = ref.bbo()
        else:
            seq = seq + 1 if roll < 0.9 else seq + 3 if roll < 0.94 else seq
            side, p, d = rng.choice(["yes", "no"]), rng.randrange(1, 18) * 50_000, rng.choice([100, 100, 200, 300, -100])
            deltas.append((name, 1, "M", at, seq, side, p, d))
            verdicts[at] = ref.delta(seq, side, p, d)
            if verdicts[at] == ("applied", False):
                bbo[at] = ref.bbo()
    return levels, deltas, verdicts, bbo


def test_random_streams_match_replay(spark):
    rng = random.Random(11)
    levels, deltas, want_v, want_b = [], [], {}, {}
    for name in ("A", "B"):
        lv, dl, v, b = random_market(rng, name, 500)
        levels += lv
        deltas += dl
        want_v.update({(name, k): x for k, x in v.items()})
        want_b.update({(name, k): x for k, x in b.items()})
    state, outcomes, history = build(spark, levels, deltas)
    final = book.delta_outcomes(outcomes, history).collect()
    assert {(r.session_id, r.received_at_ns): (r.outcome, r.is_desync) for r in final} == want_v
    rows = book.best_levels(history, piece=7, width=50).collect()
    got = {(r.session_id, r.received_at_ns): (r.bid_micros, r.bid_size, r.ask_micros, r.ask_size, r.bid_depth, r.ask_depth) for r in rows}
    assert len(rows) == len(got) and got == want_b


SEED = [("S", 1, "M", 31, 31, "yes", 0, 210_000, 640), ("S", 1, "M", 31, 31, "yes", 1, 280_000, 1_900),
        ("S", 1, "M", 31, 31, "no", 0, 610_000, 850), ("S", 1, "M", 31, 31, "no", 1, 690_000, 230)]


def at_end(spark, moves, levels=SEED, convention="no_leg", extra=()):
    deltas = [("S", 1, "M", s, s, side, p, d) for s, side, p, d in moves]
    state, outcomes, history = build(spark, list(levels) + list(extra), deltas, convention=convention)
    view = book.book_view(book.book_at(state, history, 10**9)).first()
    final = {r.seq: (r.outcome, r.is_desync) for r in book.delta_outcomes(outcomes, history).collect()}
    if view is None:
        return None, None, None, final
    return {b.price: b.size for b in view.bids}, {a.price: a.size for a in view.asks}, view, final


def replayed(moves, convention="no_leg"):
    ref = Ref(convention)
    ref.snapshot(31, [(side, price, size) for *_, side, _, price, size in SEED])
    return ref, {seq: ref.delta(seq, side, price, change) for seq, side, price, change in moves}


def test_single_deltas_equal_the_replay(spark):
    """A new level, more of one, exactly none of one, less than none, of one that is not there, and on the other side."""
    rng = random.Random(23)
    cases = [[(32, "yes", 150_000, 400)], [(32, "yes", 210_000, 55), (33, "yes", 210_000, 5)], [(32, "yes", 280_000, -1_900)],
             [(32, "yes", 280_000, -1_901), (33, "yes", 280_000, 10)], [(32, "yes", 90_000, -1)], [(32, "no", 720_000, 70)], [(32, "no", 690_000, -230)]]
    for _ in range(4):
        cases.append([(32 + n, rng.choice(["yes", "no"]), rng.choice([210_000, 280_000, 610_000, 690_000]), rng.choice([-200, 90, 310])) for n in range(6)])
    for convention in ("no_leg", "yes_leg"):
        levels = [(f"C{n}", *row[1:]) for n in range(len(cases)) for row in SEED]
        deltas = [(f"C{n}", 1, "M", s, s, side, p, d) for n, moves in enumerate(cases) for s, side, p, d in moves]
        state, outcomes, history = build(spark, levels, deltas, convention=convention)
        views = {r.session_id: r for r in book.book_view(book.book_at(state, history, 10**9)).collect()}
        final = {(r.session_id, r.seq): (r.outcome, r.is_desync) for r in book.delta_outcomes(outcomes, history).collect()}
        for n, moves in enumerate(cases):
            ref, want = replayed(moves, convention)
            view = views.get(f"C{n}")
            assert {seq: final[f"C{n}", seq] for seq in want} == want
            assert (view is not None) == ref.valid
            if view is None:
                continue
            bids, asks = ({x.price: x.size for x in side} for side in (view.bids, view.asks))
            assert (bids, asks) == (ref.bids, ref.asks)
            b, _, a, _, deep_b, deep_a = ref.bbo()
            assert (view.bid_micros, view.ask_micros, view.bid_depth, view.ask_depth) == (b, a, deep_b, deep_a)
            assert view.spread_micros == (a - b if a is not None and b is not None else None) and view.is_locked == (a == b) and view.is_crossed == (a is not None and b is not None and b > a)
            assert {x.price: x.size for x in view.no_bids} == {1_000_000 - p: q for p, q in asks.items()}


def test_a_gap_hides_the_book_until_a_snapshot(spark):
    gap = [(36, "yes", 210_000, 15)] + [(s, "yes", 280_000, 20) for s in range(37, 41)]
    assert at_end(spark, gap)[2] is None
    bids, asks, _, final = at_end(spark, gap, extra=[("S", 1, "M", 45, 41, "yes", 0, 330_000, 480)])
    assert bids == {330_000: 480} and asks == {}
    assert final[36][0] == "gapped" and {final[s][0] for s in range(37, 41)} == {"discarded_invalid"}


def test_strict_mode_never_crosses(spark):
    deltas = [("S", 1, "M", 32, 32, "yes", 310_000, 7), ("S", 1, "M", 33, 33, "yes", 20_000, 9)]
    _, _, history = build(spark, SEED, deltas)
    bbo = book.best_levels(history)
    assert [r.finding for r in book.invariant_findings(history, bbo).orderBy("seq").collect()] == ["locked", "locked"]
    assert [r.seq for r in book.invalidate_on_cross(bbo).collect()] == [31]


def test_a_gap_on_a_shared_stream_invalidates_every_market(spark):
    def snap(m, at, seq):
        return ("S", 1, m, at, seq, "yes", 0, 420_000, 100)

    levels = [snap("M", 10, 1), snap("N", 20, 2), snap("N", 60, 7)]
    deltas = [("S", 1, "M", 30, 3, "yes", 420_000, 5), ("S", 1, "N", 50, 6, "yes", 420_000, 5), ("S", 1, "M", 70, 8, "yes", 420_000, 5),
              ("S", 1, "N", 80, 9, "yes", 420_000, 5)]
    state, outcomes, history = build(spark, levels, deltas, [("S", 1, 40, 4)])
    got = {(r.market_ticker, r.seq): r.outcome for r in book.delta_outcomes(outcomes, history).collect()}
    assert got == {("M", 3): "applied", ("N", 6): "gapped", ("M", 8): "discarded_invalid", ("N", 9): "applied"}
    alive = {r.market_ticker for r in book.book_at(state, history, 100).collect()}
    assert alive == {"N"} and {r.market_ticker for r in book.book_at(state, history, 45).collect()} == {"M", "N"}


def test_unsorted_snapshot_is_refused_and_changes_nothing(spark):
    bad = [("S", 1, "M", 33, 33, "yes", 0, 280_000, 1), ("S", 1, "M", 33, 33, "yes", 1, 210_000, 1),
           ("S", 1, "M", 34, 34, "no", 0, 610_000, 1), ("S", 1, "M", 34, 34, "no", 1, 610_000, 1)]
    lv = spark.createDataFrame(SEED + bad, LEVELS)
    assert sorted((r.seq, r.fault) for r in book.snapshot_faults(lv).collect()) == [(33, "unsorted"), (34, "duplicate")]
    bids, _, _, final = at_end(spark, [(32, "yes", 150_000, 3)], extra=bad)
    assert bids == {150_000: 3, 210_000: 640, 280_000: 1_900}
    cont = {}
    state, outcomes, history = build(spark, SEED + [("S", 1, "M", 40, 50, "yes", 0, 1, 1), ("S", 1, "M", 60, 4, "yes", 0, 1, 1)],
                                     [("S", 1, "M", 32, 32, "yes", 280_000, 1)])
    for r in book.snapshot_continuity(outcomes, book.delta_outcomes(outcomes, history)).collect():
        cont[r.seq] = (r.previous_seq, r.continuity)
    assert cont == {31: (None, "initial"), 50: (32, "continues"), 4: (50, "restarts")}
