"""Interval arithmetic against brute force."""

import random

from tidemark.operators import coverage

DAY = 86_400_000
NOW = 20 * DAY + 5_000_000


def brute_merge(rows):
    out = []
    for s, e in sorted(rows):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [tuple(r) for r in out]


def sessions(spark, rows):
    return spark.createDataFrame(rows, "session_id string, started_ms bigint, ended_ms bigint")


def test_merge_and_gaps(spark):
    rng = random.Random(1)
    rows = [(s, s + rng.randrange(0, 9_000_000)) for s in (rng.randrange(0, 20 * DAY) for _ in range(150))]
    rows += [(0, 10), (10, 20), (21, 30), (0, 5), (100, 50 * 60_000), (200, 300)]
    df = spark.createDataFrame(rows, "start_ms bigint, end_ms bigint")
    want = brute_merge(rows)
    islands = coverage.merge_intervals(df)
    assert sorted((r.start_ms, r.end_ms) for r in islands.collect()) == want
    gaps = sorted((r.from_ms, r.to_ms) for r in coverage.gaps_between(islands).collect())
    assert gaps == [(a[1], b[0]) for a, b in zip(want, want[1:]) if b[0] - a[1] >= 120_000]
    total = coverage.gap_totals(coverage.gaps_between(islands)).first()
    assert total.gaps == len(gaps) and total.missing_ms == sum(b - a for a, b in gaps)
    daily = {str(r.date): r for r in coverage.coverage_daily(islands).collect()}
    hi = max(e for _, e in want)
    for day in range(0, -(-hi // DAY)):
        lo, up = day * DAY, (day + 1) * DAY
        covered = sum(max(0, min(e, up) - max(s, lo)) for s, e in want)
        key = f"1970-01-{day + 1:02d}"
        assert (daily[key].covered_ms, daily[key].window_ms) == (covered, min(up, hi) - max(lo, want[0][0]))
    assert len(daily) == -(-hi // DAY)
    assert min(str(r.date) for r in coverage.coverage_daily(islands, "1970-01-05").collect()) == "1970-01-05"


def test_sessions_are_deduped_and_classified(spark):
    df = sessions(spark, [("a", 1, None), ("a", 1, 50), ("b", NOW - 1_000, None), ("c", 2, None), ("d", None, 5), (None, 1, 2)])
    got = {r.session_id: (r.status, r.effective_end_ms) for r in
           coverage.classify_sessions(coverage.dedupe_sessions(df), NOW).collect()}
    assert got == {"a": ("closed", 50), "b": ("running", NOW), "c": ("unclean", None), "d": ("no_start", None)}
    classified = coverage.classify_sessions(coverage.dedupe_sessions(df), NOW)
    islands = coverage.merge_intervals(coverage.intervals_of(classified))
    head = coverage.coverage_headline(classified, islands).first()
    assert (head.sessions, head.running, head.unclean, head.covered_ms, head.span_end_ms) == (4, 1, 1, 1_049, NOW)
    assert [r.session_id for r in coverage.unclean_sessions(classified).collect()] == ["c"]
    assert coverage.current_session(coverage.dedupe_sessions(df)).first().session_id == "b"


def test_no_usable_session_gives_an_empty_report(spark):
    classified = coverage.classify_sessions(sessions(spark, [("c", 2, None)]), NOW)
    islands = coverage.merge_intervals(coverage.intervals_of(classified))
    head = coverage.coverage_headline(classified, islands).first()
    assert (head.sessions, head.covered_ms, head.span_start_ms, head.covered_bp) == (1, 0, None, 0)
    assert coverage.coverage_daily(islands).count() == 0


def test_rolling_window_has_edges_and_starts_with_the_first_session(spark):
    first = NOW - 2 * DAY
    classified = coverage.classify_sessions(
        sessions(spark, [("a", first, first + 3_600_000), ("b", first + 7_200_000, first + 9_000_000)]), NOW)
    gaps = [(r.from_ms, r.to_ms) for r in coverage.rolling_gaps(classified, NOW).collect()]
    assert gaps == [(first + 9_000_000, NOW), (first + 3_600_000, first + 7_200_000)]
    head = coverage.rolling_headline(classified, NOW).first()
    assert (head.window_start_ms, head.covered_ms, head.span_ms) == (first, 5_400_000, 2 * DAY)
    days = coverage.rolling_daily(classified, NOW).collect()
    assert sum(r.window_ms for r in days) == 2 * DAY and sum(r.covered_ms for r in days) == 5_400_000
    late = coverage.classify_sessions(sessions(spark, [("a", 5, 2 * DAY), ("b", NOW - 3_600_000, NOW)]), NOW)
    floor_ms = (NOW // DAY - 6) * DAY
    assert [(r.from_ms, r.to_ms) for r in coverage.rolling_gaps(late, NOW).collect()] == [(floor_ms, NOW - 3_600_000)]


def test_windows_and_quiet_buckets(spark):
    islands = spark.createDataFrame([(0, 2 * DAY + 10, None), (3 * DAY, 3 * DAY + 100, 2 * DAY + 10)],
                                    "start_ms bigint, end_ms bigint, prev_end_ms bigint")
    windows = spark.createDataFrame([("x", DAY - 5, 3 * DAY + 50), ("y", 4 * DAY, 4 * DAY + 9), ("z", 5, 9)],
                                    "name string, start_ms bigint, end_ms bigint")
    got = {r.name: (r.covered_ms, r.lost_ms) for r in coverage.coverage_in_windows(islands, windows).collect()}
    assert got == {"x": (DAY + 15 + 50, DAY - 10), "y": (0, 9), "z": (4, 0)}
    acts = spark.createDataFrame([(10,), (4 * DAY,)], "at bigint")
    states = {r.bucket_ms: r.state for r in coverage.quiet_or_not_captured(acts, islands, "at", DAY // 2).collect()}
    assert states == {0: "active", DAY // 2: "quiet", DAY: "quiet", 3 * DAY // 2: "quiet", 2 * DAY: "quiet",
                      5 * DAY // 2: "not_captured", 3 * DAY: "quiet", 7 * DAY // 2: "not_captured", 4 * DAY: "active"}


def test_restart_bursts(spark):
    rng = random.Random(2)
    rows = sorted(rng.randrange(0, 40_000_000) for _ in range(60)) + [5, 5, 5, 5, 5, 5]
    want = {}
    for t in rows:
        n = sum(1 for u in rows if t - 3_600_000 <= u <= t)
        if n > 5:
            want[t] = n
    df = spark.createDataFrame([(r,) for r in rows], "started_ms bigint")
    assert {r.started_ms: r.starts_in_window for r in coverage.restart_bursts(df).collect()} == want
