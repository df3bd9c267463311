"""Queries over live operators and subscription lifetimes: derived rows arrive in shuffled, overlapping batches."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import grid
from tidemark.functions.fixed import floor_div
from tidemark.operators import grids, sequence
from tidemark.session import materialize
from tidemark.streaming import live
from tidemark.workload.registry import query, step
from tidemark.workload.storage import scratch
from tidemark.workload.streams import END_NS, WIDTH_NS

# Derived clocks start at 0, where a watermark starts too.
OFFSET_NS = 10**15
BATCHES = 4
BATCH_FILES = 8


def arriving(s, rows: DataFrame, time: str, per_ms: int) -> tuple[DataFrame, str]:
    """``rows`` as a stream of a few batches, each row up to half a batch late, and how late that is.

    A row far in the future ends the stream, so that the watermark passes all others.
    """
    path, rows = scratch(s), materialize(rows)
    low, high = rows.agg(F.min(time), F.max(time)).first()
    length = (high - low) // BATCHES + per_ms
    late = F.pmod(F.xxhash64(*[c for c, t in rows.dtypes if not t.startswith("array")]), F.lit(length // 2))
    batch = floor_div(F.col(time) + late - low, length)
    for n in range(BATCHES + 1):
        rows.where(batch == n).repartition(BATCH_FILES).write.mode("append").parquet(path)
    last = rows.limit(1).select(*[F.lit(high + 10 * length).cast(t).alias(c) if c == time else F.lit("~").alias(c) if t == "string" else F.col(c) for c, t in rows.dtypes])
    last.write.mode("append").parquet(path)
    stream = s.spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", BATCH_FILES).parquet(path)
    return stream, f"{2 * length // per_ms + 1} milliseconds"


def finished(s, start, rows: DataFrame, time: str, per_ms: int) -> DataFrame:
    stream, late = arriving(s, rows, time, per_ms)
    folder = scratch(s)
    start(stream, folder, f"{folder}/checkpoint", late=late).awaitTermination()
    return live.read_output(s.spark, folder)


step("lined", ("arrivals", "controls"), """
SELECT session_id, sid, received_at_ns, 1 AS rank, seq, is_snapshot, NULL AS control FROM arrivals
UNION ALL SELECT session_id, sid, received_at_ns, CASE control WHEN 'open' THEN 0 ELSE 2 END, -1, false, control FROM controls""")
step("lived", ("lined",), """
SELECT *, count(*) FILTER (WHERE control = 'open') OVER w AS life, last_value(control IGNORE NULLS) OVER w AS ctl FROM lined
WINDOW w AS (PARTITION BY session_id, sid ORDER BY received_at_ns, rank, seq ROWS UNBOUNDED PRECEDING)""")
step("life_times", ("lived",), """
SELECT session_id, sid, life, opened_ns, least(closed, lead(opened_ns) OVER (PARTITION BY session_id, sid ORDER BY life)) AS closed_ns FROM (
  SELECT session_id, sid, life, coalesce(min(received_at_ns) FILTER (WHERE control = 'open'), min(received_at_ns) FILTER (WHERE control IS NULL AND ctl IS DISTINCT FROM 'close')) AS opened_ns,
    min(received_at_ns) FILTER (WHERE control = 'close') AS closed FROM lived GROUP BY ALL) WHERE opened_ns IS NOT NULL""")
step("life_epochs", ("lived",), """
SELECT *, count(*) FILTER (WHERE is_snapshot) OVER (PARTITION BY session_id, sid, life ORDER BY received_at_ns, seq ROWS UNBOUNDED PRECEDING) AS epoch FROM lived WHERE control IS NULL AND ctl IS DISTINCT FROM 'close'""")
step("life_ends", ("life_epochs",), "SELECT session_id, sid, life, epoch, max(seq) AS top FROM life_epochs GROUP BY ALL")
step("life_marked", ("life_epochs", "life_ends"), """
SELECT e.*, CASE WHEN e.is_snapshot THEN p.top ELSE max(e.seq) OVER (PARTITION BY e.session_id, e.sid, e.life, e.epoch ORDER BY e.received_at_ns, e.seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) END AS high_water
FROM life_epochs e LEFT JOIN life_ends p ON p.session_id = e.session_id AND p.sid = e.sid AND p.life = e.life AND p.epoch = e.epoch - 1""")
step("life_verdicts", ("life_marked",), """
SELECT *, CASE WHEN is_snapshot THEN CASE WHEN high_water IS NULL THEN 'snapshot_initial' WHEN seq > high_water THEN 'snapshot_continues' ELSE 'snapshot_restarts' END
  WHEN high_water IS NULL THEN 'first' WHEN seq = high_water + 1 THEN 'in_order' WHEN seq <= high_water THEN 'regression' ELSE 'gap' END AS verdict FROM life_marked""")
step("life_turns", ("life_verdicts",), """
SELECT *, lag(is_snapshot) OVER (PARTITION BY session_id, sid, life ORDER BY received_at_ns, seq) AS was FROM life_verdicts WHERE is_snapshot OR verdict = 'gap'""")
step("life_marks", ("life_turns", "life_times"), """
SELECT session_id, sid, life, received_at_ns, CASE WHEN is_snapshot THEN 1 ELSE 0 END AS kind FROM life_turns WHERE is_snapshot <> coalesce(was, false)
UNION ALL SELECT session_id, sid, life, opened_ns, -1 FROM life_times UNION ALL SELECT session_id, sid, life, closed_ns, 2 FROM life_times WHERE closed_ns IS NOT NULL""")
step("life_spans", ("life_marks",), f"""
SELECT session_id, sid, life, received_at_ns AS started_ns, coalesce(next_end, {END_NS}) AS ended_ns, next_end IS NULL AS is_open FROM (
  SELECT *, lead(received_at_ns) OVER (PARTITION BY session_id, sid, life ORDER BY received_at_ns, kind) AS next_end FROM life_marks) WHERE kind < 1""")
step("life_health", ("life_times", "life_spans", "life_verdicts"), """
SELECT t.session_id, t.sid, t.life, CAST(coalesce(v.gaps, 0) AS BIGINT) AS gaps, coalesce(s.is_open, false) AS is_invalid, CAST(coalesce(s.lost, 0) AS BIGINT) AS invalid_ns, t.closed_ns IS NOT NULL AS is_retired
FROM life_times t LEFT JOIN (SELECT session_id, sid, life, count(*) AS gaps FROM life_verdicts WHERE verdict = 'gap' GROUP BY ALL) v USING (session_id, sid, life)
LEFT JOIN (SELECT session_id, sid, life, bool_or(is_open) AS is_open, sum(ended_ns - started_ns) AS lost FROM life_spans GROUP BY ALL) s USING (session_id, sid, life)""")


def lives(s):
    frames, times = sequence.lifetimes(s.arrivals.select("session_id", "sid", "received_at_ns", "seq", "is_snapshot"), s.controls, WIDTH_NS)
    verdicts = sequence.sequence_verdicts(frames, sequence.LIFE, width=WIDTH_NS)
    return verdicts, sequence.invalid_spans(verdicts, END_NS, sequence.LIFE, width=WIDTH_NS, lives=times), times


@query("lifetimes", ("life_times",), "SELECT * FROM life_times")
def _(s):
    return lives(s)[2]


@query("lifetime_verdicts", ("life_verdicts",), "SELECT session_id, sid, life, received_at_ns, seq, verdict, high_water FROM life_verdicts")
def _(s):
    return lives(s)[0].select("session_id", "sid", "life", "received_at_ns", "seq", "verdict", "high_water")


@query("lifetime_spans", ("life_spans",), "SELECT * FROM life_spans")
def _(s):
    return lives(s)[1]


@query("lifetime_health", ("life_health",), "SELECT * FROM life_health")
def _(s):
    return sequence.lifetime_health(*lives(s))


@query("lifetime_totals", ("life_health",), """
SELECT CAST(coalesce(sum(gaps) FILTER (WHERE NOT is_retired), 0) AS BIGINT) AS total_gaps, count(*) FILTER (WHERE is_invalid AND NOT is_retired) AS invalid_streams,
  CAST(coalesce(sum(invalid_ns) FILTER (WHERE NOT is_retired), 0) AS BIGINT) AS invalid_ns, count(*) FILTER (WHERE is_retired) AS retired_streams FROM life_health""")
def _(s):
    return sequence.live_totals(sequence.lifetime_health(*lives(s)))


def tracked(s):
    control = s.controls.select("session_id", "sid", "received_at_ns", F.lit(None).cast("bigint").alias("seq"), F.lit(False).alias("is_snapshot"), "control")
    frames = s.arrivals.select("session_id", "sid", "received_at_ns", "seq", "is_snapshot", F.lit(None).cast("string").alias("control"))
    rows = frames.unionByName(control).withColumn("received_at_ns", F.col("received_at_ns") + OFFSET_NS)
    found = finished(s, live.track_sequences, rows, "received_at_ns", 1_000_000)
    shifted = [(F.col(c) - OFFSET_NS).alias(c) for c in ("received_at_ns", "span_started_ns")]
    return found.select("session_id", "sid", "life", "seq", "verdict", "high_water", "expected", "skipped", "gaps", *shifted)


@query("stream_verdicts", ("life_verdicts",), """
SELECT session_id, sid, life, received_at_ns, seq, verdict, high_water, CASE WHEN verdict = 'gap' THEN high_water + 1 END AS expected, CASE WHEN verdict = 'gap' THEN seq - high_water - 1 END AS skipped FROM life_verdicts""")
def _(s):
    found = tracked(s).where("verdict NOT IN ('registered', 'retired', 'unregistered')")
    return found.select("session_id", "sid", "life", "received_at_ns", "seq", "verdict", "high_water", "expected", "skipped")


@query("stream_retired", ("life_spans",), "SELECT session_id, sid, started_ns, ended_ns FROM life_spans WHERE NOT is_open")
def _(s):
    found = tracked(s).where("span_started_ns IS NOT NULL")
    return found.select("session_id", "sid", F.col("span_started_ns").alias("started_ns"), F.col("received_at_ns").alias("ended_ns"))


def live_book(s):
    level = F.struct("level_index", "side", "price_micros", "size_fp_units")
    key = ["session_id", "sid", "market_ticker", "received_at_ns", "seq"]
    plain = F.transform(F.array_sort(F.collect_list(level)), lambda x: F.struct(x["side"].alias("side"), x["price_micros"].alias("price_micros"), x["size_fp_units"].alias("size_fp_units")))
    snapshots = s.bk_levels.groupBy(*key).agg(plain.alias("levels")).withColumn("is_snapshot", F.lit(True))
    deltas = s.bk_deltas.select(*key, "side", "price_micros", "delta_fp_units", F.lit(False).alias("is_snapshot"))
    others = s.bk_others.select("session_id", "sid", "received_at_ns", "seq", F.lit(False).alias("is_snapshot"))
    rows = snapshots.unionByName(deltas, allowMissingColumns=True).unionByName(others, allowMissingColumns=True)
    rows = rows.withColumn("received_at_ns", F.col("received_at_ns") + OFFSET_NS).withColumn("pricing_convention", F.lit("no_leg"))
    return finished(s, live.track_books, rows, "received_at_ns", 1_000_000)


@query("stream_book", ("bbo",), "SELECT * FROM bbo")
def _(s):
    return live_book(s).where("shows").select("session_id", "market_ticker", "epoch_seq", "seq", "bid_micros", "bid_size", "ask_micros", "ask_size", "bid_depth", "ask_depth")


@query("stream_book_outcomes", ("ruled", "desyncs"), """
SELECT session_id, market_ticker, seq, CASE WHEN seq > dead THEN 'discarded_invalid' WHEN outcome = 'candidate' THEN 'applied' ELSE outcome END AS outcome, coalesce(seq = dead, false) AS is_desync
FROM ruled LEFT JOIN desyncs USING (session_id, market_ticker, epoch) WHERE NOT snap""")
def _(s):
    return live_book(s).where("outcome <> 'seed'").select("session_id", "market_ticker", "seq", "outcome", "is_desync")


@query("stream_grids", ("grid_verdicts",), "SELECT market_ticker, source, observed_ms, verdict FROM grid_verdicts")
def _(s):
    rows = s.grids.select("market_ticker", "source", (F.col("observed_ms") + 1).alias("observed_ms"), "price_ranges_raw")
    found = finished(s, live.track_grids, rows, "observed_ms", 1)
    return found.select("market_ticker", "source", (F.col("observed_ms") - 1).alias("observed_ms"), "verdict")


@query("stream_registry", ("sightings",), """
SELECT market_ticker, learned_via, seen_ms AS first_seen_ms FROM (SELECT *, row_number() OVER (PARTITION BY market_ticker ORDER BY seen_ms) AS k FROM sightings) WHERE k = 1 AND learned_via = 'reconciliation'""")
def _(s):
    rows = s.sightings.withColumn("seen_ms", F.col("seen_ms") + 1)
    found = finished(s, live.track_registry, rows, "seen_ms", 1).where("learned_via = 'reconciliation'")
    return found.withColumn("first_seen_ms", F.col("first_seen_ms") - 1).select("market_ticker", "learned_via", "first_seen_ms")


# Two times: since when a grid holds, and when that was seen.
GRID_AS_OF = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, price_ranges_raw FROM (SELECT q.*, g.price_ranges_raw, row_number() OVER (PARTITION BY l_orderkey, l_linenumber, l_partkey, l_suppkey
  ORDER BY coalesce(g.effective_ms, g.observed_ms) DESC NULLS LAST, g.source = 'lifecycle' DESC, g.observed_ms DESC, g.price_ranges_raw DESC) AS k
  FROM quotes q LEFT JOIN grid_moves g ON g.market_ticker = q.market_ticker AND coalesce(g.effective_ms, g.observed_ms) <= q.at_ms {seen}) WHERE k = 1"""


def moved(s, hindsight: bool):
    seen = s.grid_moves.withColumn("bands", grid.parse_grid("price_ranges_raw"))
    out = grids.grid_in_force(s.quotes, seen, "at_ms", hindsight)
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "bands")


def as_cuts(rows: DataFrame) -> DataFrame:
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("bands")[0]["end"].alias("cut_micros"), F.col("bands")[1]["step"].alias("fine_step"))


CUTS = """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(round(CAST(regexp_extract(price_ranges_raw, 'end":"([0-9.]+)', 1) AS DECIMAL(9, 4)) * 1000000) AS BIGINT) AS cut_micros,
  CAST(round(CAST(regexp_extract(price_ranges_raw, '.*step":"([0-9.]+)', 1) AS DECIMAL(9, 4)) * 1000000) AS BIGINT) AS fine_step FROM"""


def _cuts(seen: str) -> str:
    found = GRID_AS_OF.format(seen=seen)
    return f"{CUTS} ({found})"


@query("grid_asof_known", ("quotes", "grid_moves"), _cuts("AND g.observed_ms <= q.at_ms"))
def _(s):
    return as_cuts(moved(s, hindsight=False))


@query("grid_asof_hindsight", ("quotes", "grid_moves"), _cuts(""))
def _(s):
    return as_cuts(moved(s, hindsight=True))
