"""Queries over sequence streams, coverage and order books."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import audit, book, coverage, metrics, sequence
from tidemark.workload.derive import SESSION_NOW_MS
from tidemark.workload.registry import query, step

# Derived arrivals are a millisecond or less apart, so chunks are cut finer than on a real clock.
WIDTH_NS = 2_000_000_000


def channels(s) -> list[DataFrame]:
    """The streams split over three channel tables; signups are stored twice."""
    p = s.points
    return [p.where("event_type IN ('view', 'signup')"), p.where("event_type IN ('click', 'purchase')"), p.where("event_type IN ('error', 'signup')")]


def points(s):
    return sequence.sequence_points(channels(s))


step("numbered", ("points",), "SELECT session_id, sid, seq, lag(seq) OVER (PARTITION BY session_id, sid ORDER BY seq) AS before FROM points")
step("holes", ("numbered",), "SELECT session_id, sid, before AS after_seq, seq AS before_seq, seq - before - 1 AS missing FROM numbered WHERE seq <> before + 1")
step("stream_sums", ("points",), """
SELECT session_id, sid, count(*) AS messages, min(seq) AS first_seq, max(seq) AS last_seq, max(seq) - min(seq) + 1 - count(*) AS missing FROM points GROUP BY session_id, sid""")


@query("seq_gaps", ("holes",), "SELECT * FROM holes")
def _(s):
    return sequence.sequence_gaps(points(s))


@query("seq_gaps_by_sid", ("points",), """
SELECT sid, before AS after_seq, seq AS before_seq, seq - before - 1 AS missing FROM (SELECT sid, seq, lag(seq) OVER (PARTITION BY sid ORDER BY seq) AS before FROM (SELECT DISTINCT sid, seq FROM points)) WHERE seq <> before + 1""")
def _(s):
    return sequence.sequence_gaps(sequence.sequence_points(channels(s), ("sid",)), ("sid",))


@query("seq_summary", ("stream_sums",), "SELECT * FROM stream_sums")
def _(s):
    return sequence.sequence_summary(points(s))


@query("seq_headline", ("stream_sums", "holes"), """
SELECT streams, messages, missing, gaps, missing * 1000000 // (messages + missing) AS missing_ppm FROM (SELECT count(*) AS streams, CAST(sum(messages) AS BIGINT) AS messages, CAST(sum(missing) AS BIGINT) AS missing FROM stream_sums), (SELECT count(*) AS gaps FROM holes)""")
def _(s):
    return sequence.continuity_headline(points(s))


@query("seq_largest_gaps", ("holes",), "SELECT * FROM holes ORDER BY missing DESC, session_id, sid, after_seq LIMIT 8")
def _(s):
    return sequence.largest_gaps(sequence.sequence_gaps(points(s)))


@query("audit_verdict", ("stored", "stream_sums", "holes"), """
SELECT "check", n, bad, CASE WHEN bad = 0 THEN 'PASS' ELSE 'FAIL' END AS verdict FROM (SELECT 'round_trip' AS "check", count(px) AS n, count(*) FILTER (WHERE stored_px IS DISTINCT FROM px) AS bad FROM stored
UNION ALL SELECT 'continuity', CAST(sum(messages) AS BIGINT), (SELECT count(*) FROM holes) FROM stream_sums
UNION ALL SELECT 'result', (SELECT count(px) FROM stored) + CAST(sum(messages) AS BIGINT), (SELECT count(*) FROM holes) + (SELECT count(*) FROM stored WHERE stored_px IS DISTINCT FROM px) FROM stream_sums)""")
def _(s):
    from tidemark.functions import fixed

    stored = s.stored.withColumn("price_raw", fixed.format_price("px"))
    return audit.audit_verdict(audit.round_trip_counts(stored, [("price_raw", "stored_px", 6)]), points(s))


# Verdicts: the mark of an epoch is the highest number since its snapshot.
step("epochs", ("arrivals",), "SELECT *, count(*) FILTER (WHERE is_snapshot) OVER w AS epoch FROM arrivals WINDOW w AS (PARTITION BY session_id, sid ORDER BY received_at_ns, seq ROWS UNBOUNDED PRECEDING)")
step("epoch_ends", ("epochs",), "SELECT session_id, sid, epoch, max(seq) AS top FROM epochs GROUP BY 1, 2, 3")
step("marked", ("epochs", "epoch_ends"), """
SELECT e.*, CASE WHEN e.is_snapshot THEN p.top ELSE max(e.seq) OVER (PARTITION BY e.session_id, e.sid, e.epoch ORDER BY e.received_at_ns, e.seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) END AS high_water
FROM epochs e LEFT JOIN epoch_ends p ON p.session_id = e.session_id AND p.sid = e.sid AND p.epoch = e.epoch - 1""")
step("verdicts", ("marked",), """
SELECT *, CASE WHEN is_snapshot THEN CASE WHEN high_water IS NULL THEN 'snapshot_initial' WHEN seq > high_water THEN 'snapshot_continues' ELSE 'snapshot_restarts' END
  WHEN high_water IS NULL THEN 'first' WHEN seq = high_water + 1 THEN 'in_order' WHEN seq <= high_water THEN 'regression' ELSE 'gap' END AS verdict FROM marked""")


@query("seq_verdicts", ("verdicts",), """
SELECT session_id, sid, received_at_ns, seq, verdict, high_water, CASE WHEN verdict = 'gap' THEN high_water + 1 END AS expected, CASE WHEN verdict = 'gap' THEN seq - high_water - 1 END AS skipped FROM verdicts""")
def _(s):
    out = sequence.sequence_verdicts(s.arrivals, width=WIDTH_NS)
    return out.select("session_id", "sid", "received_at_ns", "seq", "verdict", "high_water", "expected", "skipped")


END_NS = 10**18
step("turns", ("verdicts",), """
SELECT *, lag(is_snapshot) OVER (PARTITION BY session_id, sid ORDER BY received_at_ns, seq) AS was FROM verdicts WHERE is_snapshot OR verdict = 'gap'""")
step("marks", ("turns", "verdicts"), """
SELECT session_id, sid, received_at_ns, seq, CASE WHEN is_snapshot THEN 1 ELSE 0 END AS kind FROM turns WHERE is_snapshot <> coalesce(was, false)
UNION ALL SELECT session_id, sid, min(received_at_ns), NULL, -1 FROM verdicts GROUP BY 1, 2""")
step("spans", ("marks",), f"""
SELECT session_id, sid, received_at_ns AS started_ns, coalesce(next_end, {END_NS}) AS ended_ns, next_end IS NULL AS is_open FROM (SELECT *, lead(received_at_ns) OVER (PARTITION BY session_id, sid ORDER BY received_at_ns, kind) AS next_end FROM marks) WHERE kind < 1""")


def spans(s):
    v = sequence.sequence_verdicts(s.arrivals, width=WIDTH_NS)
    return v, sequence.invalid_spans(v, END_NS, width=WIDTH_NS)


@query("invalid_spans", ("spans",), "SELECT * FROM spans")
def _(s):
    return spans(s)[1]


@query("stream_health", ("spans", "verdicts"), """
SELECT v.session_id, v.sid, v.gaps, coalesce(s.is_open, false) AS is_invalid, CAST(coalesce(s.lost, 0) AS BIGINT) AS invalid_ns FROM (SELECT session_id, sid, count(*) FILTER (WHERE verdict = 'gap') AS gaps FROM verdicts GROUP BY 1, 2) v
LEFT JOIN (SELECT session_id, sid, bool_or(is_open) AS is_open, sum(ended_ns - started_ns) AS lost FROM spans GROUP BY 1, 2) s USING (session_id, sid)""")
def _(s):
    return sequence.stream_health(*spans(s))


@query("stream_totals", ("spans", "verdicts"), """
SELECT (SELECT count(*) FROM verdicts WHERE verdict = 'gap') AS total_gaps, (SELECT count(*) FROM spans WHERE is_open) AS invalid_streams, CAST(sum(ended_ns - started_ns) AS BIGINT) AS invalid_ns FROM spans""")
def _(s):
    return sequence.stream_totals(sequence.stream_health(*spans(s)))


@query("gaps_near_determination", ("numbered", "points", "life"), """
SELECT session_id, count(*) AS gaps, count(*) FILTER (WHERE EXISTS (SELECT 1 FROM life l WHERE l.event_type = 'determined' AND l.session_id = g.session_id AND l.received_at_ns // 1000000 BETWEEN g.ms - 600000 AND g.ms + 600000)) AS near_determination
FROM (SELECT n.session_id, p.ms FROM numbered n JOIN points p USING (session_id, sid, seq) WHERE n.seq <> n.before + 1) g GROUP BY session_id""")
def _(s):
    gaps = sequence.sequence_gaps(points(s)).withColumnRenamed("before_seq", "seq")
    placed = gaps.join(s.points.select("session_id", "sid", "seq", "ms"), ["session_id", "sid", "seq"])
    named = placed.select("session_id", F.concat_ws("-", "sid", "seq").alias("gap_id"), F.col("ms").alias("at_ms"))
    done = s.life.where("event_type = 'determined'").select("session_id", F.expr("received_at_ns div 1000000").alias("at_ms"))
    return metrics.gaps_near_determination(named, done, 600_000)


# ---- coverage
step("one_each", ("sess",), "SELECT session_id, min(started_ms) AS started_ms, max(ended_ms) AS ended_ms, min(pricing_convention) AS pricing_convention FROM sess GROUP BY session_id")
step("classed", ("one_each",), f"""
SELECT *, CASE WHEN ended_ms IS NOT NULL THEN 'closed' WHEN {SESSION_NOW_MS} - started_ms < 86400000 THEN 'running' ELSE 'unclean' END AS status FROM one_each""")
step("spells", ("classed",), f"SELECT started_ms AS start_ms, CASE WHEN status = 'closed' THEN ended_ms ELSE {SESSION_NOW_MS} END AS end_ms FROM classed WHERE status <> 'unclean'")
ISLAND_SQL = """SELECT min(start_ms) AS start_ms, max(end_ms) AS end_ms FROM (SELECT *, sum(opens) OVER (ORDER BY start_ms, end_ms ROWS UNBOUNDED PRECEDING) AS island
  FROM (SELECT *, CASE WHEN start_ms > max(end_ms) OVER (ORDER BY start_ms, end_ms ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 1 ELSE 0 END AS opens FROM {0})) GROUP BY island"""
step("islands", ("spells",), ISLAND_SQL.format("spells"))
step("cover_gaps", ("islands",), "SELECT end_ms AS from_ms, nxt AS to_ms, nxt - end_ms AS gap_ms FROM (SELECT *, lead(start_ms) OVER (ORDER BY start_ms) AS nxt FROM islands) WHERE nxt - end_ms >= 120000")


def classified(s):
    return coverage.classify_sessions(coverage.dedupe_sessions(s.sess), SESSION_NOW_MS)


def islands(s):
    return coverage.merge_intervals(coverage.intervals_of(classified(s)))


@query("session_dedupe", ("one_each",), "SELECT * FROM one_each")
def _(s):
    return coverage.dedupe_sessions(s.sess)


@query("session_classes", ("classed",), "SELECT status, count(*) AS sessions, min(started_ms) AS first_ms, CAST(sum(ended_ms - started_ms) AS BIGINT) AS closed_ms FROM classed GROUP BY status")
def _(s):
    return classified(s).groupBy("status").agg(F.count("*").alias("sessions"), F.min("started_ms").alias("first_ms"), F.sum(F.col("ended_ms") - F.col("started_ms")).alias("closed_ms"))


@query("sessions_present", ("tick", "one_each"), """
SELECT t.session_id, coalesce(o.pricing_convention, '?') AS pricing_convention FROM (SELECT DISTINCT concat('H', CAST(user_id AS VARCHAR)) AS session_id FROM tick) t LEFT JOIN one_each o USING (session_id)""")
def _(s):
    rows = s.tick.select(F.concat(F.lit("H"), F.col("user_id").cast("string")).alias("session_id"))
    return audit.sessions_present(rows, coverage.dedupe_sessions(s.sess))


@query("session_islands", ("islands",), "SELECT * FROM islands")
def _(s):
    return islands(s).select("start_ms", "end_ms")


@query("coverage_gaps", ("cover_gaps",), "SELECT * FROM cover_gaps")
def _(s):
    return coverage.gaps_between(islands(s))


@query("coverage_gap_totals", ("cover_gaps",), "SELECT count(*) AS gaps, CAST(coalesce(sum(gap_ms), 0) AS BIGINT) AS missing_ms FROM cover_gaps")
def _(s):
    return coverage.gap_totals(coverage.gaps_between(islands(s)))


@query("coverage_largest_gaps", ("cover_gaps",), "SELECT * FROM cover_gaps ORDER BY gap_ms DESC, from_ms DESC, to_ms DESC LIMIT 12")
def _(s):
    return coverage.largest_coverage_gaps(coverage.gaps_between(islands(s)))


@query("unclean_sessions", ("classed",), "SELECT session_id, started_ms FROM classed WHERE status = 'unclean' ORDER BY started_ms, session_id LIMIT 10")
def _(s):
    return coverage.unclean_sessions(classified(s))


@query("current_session", ("one_each",), "SELECT session_id, started_ms, ended_ms FROM one_each ORDER BY ended_ms IS NULL DESC, started_ms DESC, session_id LIMIT 1")
def _(s):
    return coverage.current_session(coverage.dedupe_sessions(s.sess)).select("session_id", "started_ms", "ended_ms")


@query("coverage_headline", ("classed", "islands"), """
SELECT sessions, running, unclean, span_start_ms, span_end_ms, covered_ms, covered_ms * 10000 // (span_end_ms - span_start_ms) AS covered_bp FROM
  (SELECT count(*) AS sessions, count(*) FILTER (WHERE status = 'running') AS running, count(*) FILTER (WHERE status = 'unclean') AS unclean FROM classed),
  (SELECT min(start_ms) AS span_start_ms, max(end_ms) AS span_end_ms, CAST(sum(end_ms - start_ms) AS BIGINT) AS covered_ms FROM islands)""")
def _(s):
    return coverage.coverage_headline(classified(s), islands(s))


step("day_list", ("islands",), "SELECT lo, hi, unnest(range(lo // 86400000, (hi - 1) // 86400000 + 1)) AS day FROM (SELECT min(start_ms) AS lo, max(end_ms) AS hi FROM islands)")
step("by_day", ("day_list", "islands"), """
SELECT day, least(hi, (day + 1) * 86400000) - greatest(lo, day * 86400000) AS window_ms, CAST(coalesce((SELECT sum(greatest(0, least(i.end_ms, (day + 1) * 86400000) - greatest(i.start_ms, day * 86400000))) FROM islands i), 0) AS BIGINT) AS covered_ms FROM day_list""")


@query("coverage_daily", ("by_day",), """
SELECT CAST(DATE '1970-01-01' + CAST(day AS INT) AS VARCHAR) AS date, covered_ms, window_ms, covered_ms * 10000 // window_ms AS covered_bp, CASE WHEN covered_ms * 100 >= window_ms * 99 THEN '' WHEN covered_ms * 100 < window_ms * 90 THEN 'MAJOR GAP' ELSE 'gap' END AS flag
FROM by_day WHERE DATE '1970-01-01' + CAST(day AS INT) >= DATE '1996-01-01'""")
def _(s):
    out = coverage.coverage_daily(islands(s), "1996-01-01")
    return out.withColumn("date", F.col("date").cast("string"))


DAYS = 30
FLOOR = (SESSION_NOW_MS // 86_400_000 - (DAYS - 1)) * 86_400_000
step("recent", ("spells",), f"SELECT greatest(start_ms, {FLOOR}) AS start_ms, least(end_ms, {SESSION_NOW_MS}) AS end_ms FROM spells WHERE end_ms > {FLOOR}")
step("recent_islands", ("recent",), ISLAND_SQL.format("recent"))


@query("rolling_headline", ("recent_islands",), f"SELECT CAST({FLOOR} AS BIGINT) AS window_start_ms, CAST(sum(end_ms - start_ms) AS BIGINT) AS covered_ms, CAST({SESSION_NOW_MS - FLOOR} AS BIGINT) AS span_ms FROM recent_islands")
def _(s):
    return coverage.rolling_headline(classified(s), SESSION_NOW_MS, DAYS)


@query("rolling_daily", ("recent_islands",), f"""
SELECT CAST(DATE '1970-01-01' + CAST(day AS INT) AS VARCHAR) AS date, CAST(coalesce((SELECT sum(greatest(0, least(end_ms, (day + 1) * 86400000, {SESSION_NOW_MS}) - greatest(start_ms, day * 86400000))) FROM recent_islands), 0) AS BIGINT) AS covered_ms,
  least({SESSION_NOW_MS}, (day + 1) * 86400000) - day * 86400000 AS window_ms FROM (SELECT unnest(range(CAST({FLOOR} AS BIGINT) // 86400000, ({SESSION_NOW_MS} - 1) // 86400000 + 1)) AS day)""")
def _(s):
    return coverage.rolling_daily(classified(s), SESSION_NOW_MS, DAYS).withColumn("date", F.col("date").cast("string"))


@query("rolling_gaps", ("recent_islands",), f"""
SELECT from_ms, to_ms, to_ms - from_ms AS gap_ms FROM (SELECT end_ms AS from_ms, coalesce(lead(start_ms) OVER (ORDER BY start_ms), {SESSION_NOW_MS}) AS to_ms FROM (SELECT * FROM recent_islands UNION ALL SELECT {FLOOR}, {FLOOR})) WHERE to_ms - from_ms >= 120000""")
def _(s):
    return coverage.rolling_gaps(classified(s), SESSION_NOW_MS, DAYS)


@query("coverage_in_windows", ("windows", "islands"), """
SELECT name, window_ms, covered_ms, window_ms - covered_ms AS lost_ms, CASE WHEN window_ms > 0 THEN covered_ms * 10000 // window_ms ELSE 0 END AS covered_bp FROM
 (SELECT w.name, w.end_ms - w.start_ms AS window_ms, CAST(coalesce(sum(least(i.end_ms, w.end_ms) - greatest(i.start_ms, w.start_ms)) FILTER (WHERE i.start_ms IS NOT NULL), 0) AS BIGINT) AS covered_ms FROM windows w LEFT JOIN islands i ON i.start_ms < w.end_ms AND i.end_ms > w.start_ms GROUP BY w.name, w.start_ms, w.end_ms)""")
def _(s):
    return coverage.coverage_in_windows(islands(s), s.windows)


@query("quiet_or_dead", ("windows", "islands"), """
SELECT b * 3600000 AS bucket_ms, coalesce(c.n, 0) AS "rows", CASE WHEN c.n > 0 THEN 'active' WHEN EXISTS (SELECT 1 FROM islands i WHERE i.end_ms > i.start_ms AND i.start_ms < (b + 1) * 3600000 AND i.end_ms > b * 3600000) THEN 'quiet' ELSE 'not_captured' END AS state
FROM (SELECT unnest(range(min(start_ms) // 3600000, max(start_ms) // 3600000 + 1)) AS b FROM windows) LEFT JOIN (SELECT start_ms // 3600000 AS b, count(*) AS n FROM windows GROUP BY 1) c USING (b)""")
def _(s):
    return coverage.quiet_or_not_captured(s.windows, islands(s), "start_ms")


@query("restart_bursts", ("one_each",), """
SELECT started_ms, starts_in_window FROM (SELECT started_ms, CAST(sum(n) OVER (ORDER BY started_ms RANGE BETWEEN 21600000 PRECEDING AND CURRENT ROW) AS BIGINT) AS starts_in_window FROM (SELECT started_ms, count(*) AS n FROM one_each GROUP BY 1)) WHERE starts_in_window > 5""")
def _(s):
    return coverage.restart_bursts(coverage.dedupe_sessions(s.sess), 21_600_000)


# ---- books
step("faults", ("bk_levels",), """
SELECT *, CASE WHEN price_micros = previous THEN 'duplicate' WHEN price_micros < previous THEN 'unsorted' END AS fault FROM (SELECT *, lag(price_micros) OVER (PARTITION BY session_id, seq, side ORDER BY level_index) AS previous FROM bk_levels)""")
step("good", ("bk_levels", "faults"), "SELECT * FROM bk_levels WHERE (session_id, seq) NOT IN (SELECT (session_id, seq) FROM faults WHERE fault IS NOT NULL)")
step("line", ("good", "bk_deltas", "bk_others"), """
SELECT DISTINCT session_id, market_ticker, received_at_ns, seq, true AS snap, NULL AS side, NULL AS price, NULL AS delta FROM good
UNION ALL SELECT session_id, market_ticker, received_at_ns, seq, false, side, price_micros, delta_fp_units FROM bk_deltas UNION ALL SELECT session_id, NULL, received_at_ns, seq, false, NULL, NULL, NULL FROM bk_others""")
# Numbers only grow here, so the mark is the number before.
step("broken", ("line",), "SELECT *, coalesce(seq > lag(seq) OVER (PARTITION BY session_id ORDER BY seq) + 1, false) AS brk FROM line")
step("counted", ("broken",), "SELECT *, count(*) FILTER (WHERE brk) OVER (PARTITION BY session_id ORDER BY seq) AS brks FROM broken")
step("placed", ("counted",), """
SELECT *, max(CASE WHEN snap THEN seq END) OVER w AS epoch, max(CASE WHEN snap THEN brks END) OVER w AS epoch_brks FROM counted WHERE market_ticker IS NOT NULL WINDOW w AS (PARTITION BY session_id, market_ticker ORDER BY seq)""")
step("ruled", ("placed",), """
SELECT *, CASE WHEN snap THEN 'seed' WHEN epoch IS NULL THEN 'discarded_invalid' WHEN brks - epoch_brks = 1 AND brk THEN 'gapped' WHEN brks > epoch_brks THEN 'discarded_invalid' ELSE 'candidate' END AS outcome FROM placed""")
step("moves", ("ruled", "good"), """
SELECT session_id, market_ticker, seq AS epoch, seq, side, price_micros AS price, size_fp_units AS d FROM good WHERE size_fp_units <> 0
UNION ALL SELECT session_id, market_ticker, epoch, seq, side, price, delta FROM ruled WHERE outcome = 'candidate'""")
step("summed", ("moves",), """
SELECT *, CASE WHEN side = 'yes' THEN 'bid' ELSE 'ask' END AS book_side, CASE WHEN side = 'yes' THEN price ELSE 1000000 - price END AS p, sum(d) OVER (PARTITION BY session_id, market_ticker, epoch, side, price ORDER BY seq) AS size FROM moves""")
step("desyncs", ("summed",), "SELECT session_id, market_ticker, epoch, min(seq) AS dead FROM summed WHERE size < 0 GROUP BY 1, 2, 3")
step("sizes", ("summed", "desyncs"), "SELECT s.*, d.dead FROM summed s LEFT JOIN desyncs d USING (session_id, market_ticker, epoch) WHERE d.dead IS NULL OR s.seq <= d.dead")


def books(s):
    good = book.accepted_levels(s.bk_levels)
    state = book.stream_state(book.book_frames(good, s.bk_deltas, s.bk_others), WIDTH_NS)
    outcomes = book.frame_outcomes(state, WIDTH_NS)
    changes = book.level_changes(outcomes, good, F.lit("no_leg"))
    return state, outcomes, book.level_history(changes, WIDTH_NS)


@query("snapshot_order", ("faults",), "SELECT session_id, seq, side, CAST(level_index AS BIGINT) AS level_index, previous, price_micros, fault FROM faults WHERE fault IS NOT NULL")
def _(s):
    return book.snapshot_faults(s.bk_levels).select("session_id", "seq", "side", F.col("level_index").cast("bigint").alias("level_index"), "previous", "price_micros", "fault")


@query("book_level_sizes", ("sizes",), """
SELECT session_id, market_ticker, epoch AS epoch_seq, seq, book_side, p AS price_micros, CAST(size AS BIGINT) AS size_fp_units, coalesce(seq = dead, false) AS is_desync FROM sizes""")
def _(s):
    return books(s)[2].select("session_id", "market_ticker", "epoch_seq", "seq", "book_side", "price_micros", "size_fp_units", "is_desync")


@query("book_outcomes", ("ruled", "desyncs"), """
SELECT session_id, market_ticker, seq, CASE WHEN seq > dead THEN 'discarded_invalid' WHEN outcome = 'candidate' THEN 'applied' ELSE outcome END AS outcome, coalesce(seq = dead, false) AS is_desync
FROM ruled LEFT JOIN desyncs USING (session_id, market_ticker, epoch) WHERE NOT snap""")
def _(s):
    _, outcomes, history = books(s)
    return book.delta_outcomes(outcomes, history).select("session_id", "market_ticker", "seq", "outcome", "is_desync")


@query("snapshot_continuity", ("ruled", "desyncs"), """
SELECT session_id, market_ticker, seq, previous AS previous_seq, CASE WHEN previous IS NULL THEN 'initial' WHEN seq > previous THEN 'continues' ELSE 'restarts' END AS continuity
FROM (SELECT *, lag(seq) OVER (PARTITION BY session_id, market_ticker ORDER BY seq) AS previous FROM (SELECT r.* FROM ruled r LEFT JOIN desyncs d USING (session_id, market_ticker, epoch) WHERE snap OR (outcome IN ('candidate', 'gapped') AND (dead IS NULL OR seq <= dead)))) WHERE snap""")
def _(s):
    _, outcomes, history = books(s)
    out = book.snapshot_continuity(outcomes, book.delta_outcomes(outcomes, history), WIDTH_NS)
    return out.select("session_id", "market_ticker", "seq", "previous_seq", "continuity")


step("lives", ("sizes",), """
SELECT *, coalesce(lead(seq) OVER (PARTITION BY session_id, market_ticker, epoch, side, price ORDER BY seq), 9000000000000000000) AS gone FROM sizes WHERE dead IS NULL OR seq < dead""")
step("instants", ("lives",), "SELECT DISTINCT session_id, market_ticker, epoch, seq FROM lives")
step("bbo", ("lives", "instants"), """
SELECT t.session_id, t.market_ticker, t.epoch AS epoch_seq, t.seq, max(p) FILTER (WHERE book_side = 'bid') AS bid_micros, CAST(arg_max(size, p) FILTER (WHERE book_side = 'bid') AS BIGINT) AS bid_size,
  min(p) FILTER (WHERE book_side = 'ask') AS ask_micros, CAST(arg_min(size, p) FILTER (WHERE book_side = 'ask') AS BIGINT) AS ask_size, count(*) FILTER (WHERE book_side = 'bid') AS bid_depth, count(*) FILTER (WHERE book_side = 'ask') AS ask_depth
FROM instants t LEFT JOIN lives l ON l.session_id = t.session_id AND l.market_ticker = t.market_ticker AND l.epoch = t.epoch AND l.seq <= t.seq AND t.seq < l.gone AND l.size > 0 GROUP BY 1, 2, 3, 4""")
BBO = ["session_id", "market_ticker", "epoch_seq", "seq", "bid_micros", "bid_size", "ask_micros", "ask_size", "bid_depth", "ask_depth"]


@query("book_bbo", ("bbo",), """
SELECT *, ask_micros - bid_micros AS spread_micros, (bid_micros + ask_micros) // 2 AS mid_micros, coalesce(bid_micros = ask_micros, false) AS is_locked, coalesce(bid_micros > ask_micros, false) AS is_crossed FROM bbo""")
def _(s):
    out = book.with_spread(book.best_levels(books(s)[2], width=WIDTH_NS))
    return out.select(*BBO, "spread_micros", "mid_micros", "is_locked", "is_crossed")


@query("book_bbo_strict", ("bbo",), """
SELECT * FROM bbo WHERE seq < coalesce((SELECT min(c.seq) FROM bbo c WHERE c.session_id = bbo.session_id AND c.market_ticker = bbo.market_ticker AND c.epoch_seq = bbo.epoch_seq AND c.bid_micros >= c.ask_micros), 9000000000000000000)""")
def _(s):
    return book.invalidate_on_cross(book.best_levels(books(s)[2], width=WIDTH_NS)).select(*BBO)


@query("book_invariants", ("bbo", "desyncs"), """
SELECT session_id, market_ticker, seq, CASE WHEN bid_micros > ask_micros THEN 'crossed' ELSE 'locked' END AS finding FROM bbo WHERE bid_micros >= ask_micros
UNION ALL SELECT session_id, market_ticker, dead, 'negative_quantity' FROM desyncs""")
def _(s):
    history = books(s)[2]
    return book.invariant_findings(history, book.best_levels(history, width=WIDTH_NS)).select("session_id", "market_ticker", "seq", "finding")


AT_NS = 6_000_000_000
step("now_valid", ("counted",), f"""
SELECT c.session_id, c.market_ticker, max(c.seq) AS epoch FROM counted c WHERE snap AND received_at_ns <= {AT_NS} GROUP BY 1, 2
HAVING arg_max(brks, seq) = (SELECT max(brks) FROM counted k WHERE k.session_id = c.session_id AND k.received_at_ns <= {AT_NS})""")
step("book_now", ("now_valid", "sizes", "counted"), f"""
SELECT session_id, market_ticker, epoch AS epoch_seq, book_side, p AS price_micros, CAST(arg_max(size, seq) AS BIGINT) AS size_fp_units FROM sizes JOIN now_valid USING (session_id, market_ticker, epoch)
WHERE (session_id, seq) IN (SELECT (session_id, seq) FROM counted WHERE received_at_ns <= {AT_NS}) AND NOT EXISTS (SELECT 1 FROM counted k WHERE k.session_id = sizes.session_id AND k.seq = sizes.dead AND k.received_at_ns <= {AT_NS}) GROUP BY 1, 2, 3, 4, 5 HAVING arg_max(size, seq) > 0""")


@query("book_asof", ("book_now",), "SELECT * FROM book_now")
def _(s):
    state, _, history = books(s)
    out = book.book_at(state, history, AT_NS)
    return out.select("session_id", "market_ticker", "epoch_seq", "book_side", "price_micros", "size_fp_units")


@query("book_view", ("book_now",), """
SELECT session_id, market_ticker, count(*) FILTER (WHERE book_side = 'bid') AS bid_depth, count(*) FILTER (WHERE book_side = 'ask') AS ask_depth, max(price_micros) FILTER (WHERE book_side = 'bid') AS bid_micros,
  min(price_micros) FILTER (WHERE book_side = 'ask') AS ask_micros, coalesce(string_agg(CAST(1000000 - price_micros AS VARCHAR), ',' ORDER BY price_micros) FILTER (WHERE book_side = 'ask'), '') AS no_bids FROM book_now GROUP BY 1, 2""")
def _(s):
    state, _, history = books(s)
    view = book.book_view(book.book_at(state, history, AT_NS))
    return view.select("session_id", "market_ticker", "bid_depth", "ask_depth", "bid_micros", "ask_micros",
                       F.array_join(F.transform("no_bids", lambda x: x["price"].cast("string")), ",").alias("no_bids"))




@query("session_conventions", ("quotes", "sess"), """
SELECT pricing_convention, count(*) AS "rows", CAST(sum(price_micros) AS BIGINT) AS total FROM (SELECT concat('H', CAST(l_orderkey AS VARCHAR)) AS session_id, price_micros FROM quotes)
LEFT JOIN (SELECT DISTINCT session_id, pricing_convention FROM sess) USING (session_id) GROUP BY pricing_convention""")
def _(s):
    rows = s.quotes.select(F.concat(F.lit("H"), F.col("l_orderkey").cast("string")).alias("session_id"), "price_micros")
    joined = book.with_convention(rows, s.sess.select("session_id", "pricing_convention").distinct())
    return joined.groupBy("pricing_convention").agg(F.count("*").alias("rows"), F.sum("price_micros").alias("total"))
