"""Continuity, verdicts and running values against brute force."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import ordered, sequence


def test_running_equals_plain_window(spark):
    rng = random.Random(5)
    rows = [(rng.choice("abbbbb"), rng.randrange(500), i, rng.choice([None, rng.randrange(99)])) for i in range(800)]
    df = spark.createDataFrame(rows, "k string, t bigint, i bigint, v bigint")
    runs = {"mx": ordered.Run("max", F.col("v")), "sm": ordered.Run("sum", F.col("v")), "la": ordered.Run("last", F.col("v")),
            "ct": ordered.Run("count", F.col("v") > 50)}
    for inclusive in (False, True):
        w = Window.partitionBy("k").orderBy("t", "i").rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
        want = df.select("i", F.max("v").over(w).alias("mx"), F.coalesce(F.sum("v").over(w), F.lit(0)).alias("sm"),
                         F.last("v", True).over(w).alias("la"),
                         F.coalesce(F.count_if(F.col("v") > 50).over(w), F.lit(0)).alias("ct"))
        got = ordered.running(df, ["k"], ["t", "i"], ordered.time_chunk("t", 40), runs, inclusive).select(want.columns)
        assert set(map(tuple, got.collect())) == set(map(tuple, want.collect()))
    back = ordered.running(df, ["k"], ["t", "i"], ordered.time_chunk("t", 40), {"nx": ordered.Run("last", F.col("v"))}, backward=True)
    w = Window.partitionBy("k").orderBy("t", "i").rowsBetween(1, Window.unboundedFollowing)
    want = df.select("i", F.first("v", True).over(w).alias("nx"))
    assert set(map(tuple, back.select("i", "nx").collect())) == set(map(tuple, want.collect()))


def brute(rows):
    """rows of one stream in arrival order: (seq, is_snapshot) -> verdicts."""
    last, out = None, []
    for seq, snap in rows:
        if snap:
            out.append("snapshot_initial" if last is None else "snapshot_continues" if seq > last else "snapshot_restarts")
            last = seq
        elif last is None:
            out.append("first")
            last = seq
        elif seq == last + 1:
            out.append("in_order")
            last = seq
        elif seq <= last:
            out.append("regression")
        else:
            out.append("gap")
            last = seq
    return out


def test_verdicts_match_replay(spark):
    rng = random.Random(3)
    rows, want = [], {}
    for k in ("S1", "S2", "S3"):
        seq, mine = 10, []
        for i in range(400):
            roll = rng.random()
            seq = seq + 1 if roll < 0.85 else seq + rng.randrange(2, 5) if roll < 0.92 else max(1, seq - rng.randrange(0, 4))
            mine.append((seq, rng.random() < 0.03))
        rows += [(k, 2, i * 10, s, snap) for i, (s, snap) in enumerate(mine)]
        want[k] = brute(mine)
    df = spark.createDataFrame(rows, "session_id string, sid bigint, received_at_ns bigint, seq bigint, is_snapshot boolean")
    got = sequence.sequence_verdicts(df, width=130).orderBy("session_id", "received_at_ns").collect()
    for k in want:
        assert [r.verdict for r in got if r.session_id == k] == want[k]


def test_gap_figures_and_regressions(spark):
    rows = [("S", 1, 5, 40, True), ("S", 1, 6, 47, False), ("S", 1, 8, 48, False), ("S", 1, 9, 60, True),
            ("T", 1, 2, 33, True), ("T", 1, 3, 31, False), ("T", 1, 5, 33, False), ("T", 1, 6, 34, False)]
    df = spark.createDataFrame(rows, "session_id string, sid bigint, received_at_ns bigint, seq bigint, is_snapshot boolean")
    got = {(r.session_id, r.received_at_ns): r for r in sequence.sequence_verdicts(df, width=2).collect()}
    assert (got["S", 6].verdict, got["S", 6].expected, got["S", 6].skipped) == ("gap", 41, 6)
    assert got["S", 8].verdict == "in_order"
    assert [got["T", i].verdict for i in (3, 5, 6)] == ["regression", "regression", "in_order"]


def test_invalid_time_adds_up(spark):
    s = 1_000_000_000
    rows = [("S", 1, 2 * s, 7, True), ("S", 1, 4 * s, 11, False), ("S", 1, 11 * s, 12, True), ("S", 1, 19 * s, 29, False),
            ("S", 1, 22 * s, 35, False), ("S", 1, 25 * s, 36, True), ("U", 1, 6 * s, 1, False)]
    df = spark.createDataFrame(rows, "session_id string, sid bigint, received_at_ns bigint, seq bigint, is_snapshot boolean")
    v = sequence.sequence_verdicts(df, width=2 * s)
    health = sequence.stream_health(v, sequence.invalid_spans(v, 40 * s, width=2 * s))
    got = {r.session_id: (r.gaps, r.is_invalid, r.invalid_ns) for r in health.collect()}
    assert got == {"S": (3, False, (7 + 6) * s), "U": (0, True, 34 * s)}


def test_gaps_need_both_keys(spark):
    """Two sessions reuse a sid; each has a hole the other would fill."""
    rows = [("A", 2, n) for n in range(1, 70_001) if n not in (500, 501, 32_768, 32_769, 65_000)]
    rows += [("B", 2, n) for n in range(1, 70_001) if n != 700] + [("B", 2, 5), (None, 2, 1), ("A", None, 3), ("A", 2, None)]
    df = spark.createDataFrame(rows, "session_id string, sid bigint, seq bigint").repartition(6)
    points = sequence.sequence_points([df])
    gaps = {tuple(r) for r in sequence.sequence_gaps(points).collect()}
    assert gaps == {("A", 2, 499, 502, 2), ("A", 2, 32_767, 32_770, 2), ("A", 2, 64_999, 65_001, 1), ("B", 2, 699, 701, 1)}
    assert sequence.sequence_gaps(sequence.sequence_points([df], ("sid",)), ("sid",)).count() == 0
    head = sequence.continuity_headline(points).first()
    assert (head.streams, head.messages, head.missing, head.gaps) == (2, 139_994, 6, 4)
    top = sequence.largest_gaps(sequence.sequence_gaps(points), 2).collect()
    assert [r.after_seq for r in top] == [499, 32_767]
