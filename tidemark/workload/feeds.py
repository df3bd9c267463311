"""Queries over decoding, the board, grids, fees, reconciliation and operational figures."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import grid
from tidemark.functions.clocks import received_ms
from tidemark.operators import audit, board, decode, grids, metrics, reconcile
from tidemark.schemas import CHANNELS
from tidemark.session import materialize
from tidemark.workload.derive import NOW_MS
from tidemark.workload.registry import query, step

CHANNEL_SQL = """CASE kind WHEN 'snapshot' THEN 'orderbook_snapshot' WHEN 'delta' THEN 'orderbook_delta' WHEN 'bad' THEN 'unparsed' WHEN 'lifecycle' THEN 'market_lifecycle'
  WHEN 'event' THEN 'market_lifecycle' WHEN 'fee' THEN 'event_fee_update' WHEN 'ticker' THEN 'ticker' WHEN 'trade' THEN 'trade' ELSE 'control' END"""
HEAD = "received_at_ns, session_id, sid, raw_message"
QUANTITY = "concat(CAST(cents % 500 AS VARCHAR), '.', lpad(CAST(cents % 100 AS VARCHAR), 2, '0'))"


def price_sql(x, n=99):
    return f"concat('0.', lpad(CAST(({x}) % {n} + 1 AS VARCHAR), 2, '0'), '00')"


def frames(s) -> DataFrame:
    return s.wire.select("received_at_ns", "session_id", "raw_message")


def channel(s, name) -> DataFrame:
    return decode.decode_channel(decode.route(frames(s)), name)


@query("frame_router", ("wire",), f"""
SELECT channel, count(*) AS records, CAST(sum(CASE WHEN kind = 'snapshot' THEN greatest(cents % 3 + user_id % 2, 1) ELSE 1 END) AS BIGINT) AS rows_expected
FROM (SELECT *, {CHANNEL_SQL} AS channel FROM wire) GROUP BY channel""")
def _(s):
    return decode.expected_rows(decode.route(frames(s)))


step("snap_levels", ("wire",), f"""
SELECT w.*, CASE WHEN k < 3 THEN 'yes' ELSE 'no' END AS side, CAST(k % 3 AS INT) AS level_index,
  CASE WHEN k < 3 THEN (cents % 40 + k * 5) % 99 + 1 ELSE cents % 30 % 99 + 1 END AS c FROM wire w, (VALUES (0), (1), (3)) AS v(k)
WHERE kind = 'snapshot' AND (CASE WHEN k < 3 THEN k < cents % 3 ELSE user_id % 2 = 1 END)
UNION ALL SELECT w.*, NULL, NULL, NULL FROM wire w WHERE kind = 'snapshot' AND cents % 3 = 0 AND user_id % 2 = 0""")


@query("encode_snapshot", ("snap_levels",), f"""
SELECT {HEAD}, seq, CAST(NULL AS BIGINT) AS exchange_ts_ms, market_ticker, CAST(user_id AS VARCHAR) AS market_id, side, concat('0.', lpad(CAST(c AS VARCHAR), 2, '0'), '00') AS price_raw,
  c * 10000 AS price_micros, CASE WHEN c IS NOT NULL THEN {QUANTITY} END AS size_raw, CASE WHEN c IS NOT NULL THEN cents % 500 * 100 + cents % 100 END AS size_fp_units, level_index FROM
  (SELECT * FROM snap_levels) WHERE c IS NOT NULL
UNION ALL SELECT {HEAD}, seq, NULL, market_ticker, CAST(user_id AS VARCHAR), NULL, NULL, NULL, NULL, NULL, NULL FROM snap_levels WHERE c IS NULL""")
def _(s):
    return channel(s, "orderbook_snapshot")


@query("encode_delta", ("wire",), f"""
SELECT {HEAD}, seq, ms - 40 AS exchange_ts_ms, market_ticker, CAST(user_id AS VARCHAR) AS market_id, CASE WHEN user_id % 2 = 0 THEN 'yes' ELSE 'no' END AS side,
  {price_sql('cents')} AS price_raw, (cents % 99 + 1) * 10000 AS price_micros, concat(CASE WHEN cents % 2 = 0 THEN '-' ELSE '' END, {QUANTITY}) AS delta_raw,
  (cents % 500 * 100 + cents % 100) * CASE WHEN cents % 2 = 0 THEN -1 ELSE 1 END AS delta_fp_units FROM wire WHERE kind = 'delta'""")
def _(s):
    return channel(s, "orderbook_delta")


@query("encode_ticker", ("wire",), f"""
SELECT {HEAD}, CAST(NULL AS BIGINT) AS seq, ms // 1000 * 1000 AS exchange_ts_ms, market_ticker, CAST(user_id AS VARCHAR) AS market_id, {price_sql('cents')} AS price_raw,
  (cents % 99 + 1) * 10000 AS price_micros, {price_sql('cents', 98)} AS yes_bid_raw, (cents % 98 + 1) * 10000 AS yes_bid_micros, CAST(NULL AS VARCHAR) AS yes_ask_raw, CAST(NULL AS BIGINT) AS yes_ask_micros,
  CAST(NULL AS VARCHAR) AS yes_bid_size_raw, CAST(NULL AS BIGINT) AS yes_bid_size_fp_units, CAST(NULL AS VARCHAR) AS yes_ask_size_raw, CAST(NULL AS BIGINT) AS yes_ask_size_fp_units,
  {QUANTITY} AS volume_raw, cents % 500 * 100 + cents % 100 AS volume_fp_units, 'bad' AS open_interest_raw, CAST(NULL AS BIGINT) AS open_interest_fp_units FROM wire WHERE kind = 'ticker'""")
def _(s):
    return channel(s, "ticker")


@query("encode_trade", ("wire",), f"""
SELECT {HEAD}, CAST(NULL AS BIGINT) AS seq, ms AS exchange_ts_ms, concat('t', CAST(event_id AS VARCHAR)) AS trade_id, market_ticker, {price_sql('cents')} AS yes_price_raw,
  (cents % 99 + 1) * 10000 AS yes_price_micros, CAST(NULL AS VARCHAR) AS no_price_raw, CAST(NULL AS BIGINT) AS no_price_micros, {QUANTITY} AS count_raw,
  cents % 500 * 100 + cents % 100 AS count_fp_units, CASE user_id % 3 WHEN 0 THEN 'no' END AS taker_outcome_side, CASE user_id % 3 WHEN 1 THEN 'bid' END AS taker_book_side,
  CASE user_id % 3 WHEN 2 THEN 'yes' END AS taker_side_deprecated, true AS is_block_trade FROM wire WHERE kind = 'trade'""")
def _(s):
    return channel(s, "trade")


@query("encode_lifecycle", ("wire",), f"""
SELECT {HEAD}, CAST(NULL AS BIGINT) AS seq, CAST(NULL AS BIGINT) AS exchange_ts_ms, CASE WHEN kind = 'event' THEN '' WHEN user_id % 2 = 0 THEN 'determined' ELSE 'created' END AS event_type,
  CASE WHEN kind = 'event' THEN concat('KXEV', CAST(g AS VARCHAR)) ELSE market_ticker END AS market_ticker, CASE WHEN d THEN 'yes' END AS result, CASE WHEN d THEN '1.0000' END AS settlement_value_raw,
  CASE WHEN d THEN CAST(1000000 AS BIGINT) END AS settlement_value_micros, CASE WHEN c THEN ms END AS open_ts, CAST(NULL AS BIGINT) AS close_ts, CASE WHEN d THEN ms END AS determination_ts,
  CAST(NULL AS BIGINT) AS settled_ts, CASE WHEN c THEN false END AS is_deactivated, CASE WHEN c THEN 'linear' END AS price_level_structure
FROM (SELECT *, user_id // 2 AS g, kind = 'lifecycle' AND user_id % 2 = 0 AS d, kind = 'lifecycle' AND user_id % 2 = 1 AS c FROM wire WHERE kind IN ('lifecycle', 'event'))""")
def _(s):
    return channel(s, "market_lifecycle")


@query("encode_fee_update", ("wire",), f"""
SELECT {HEAD}, CAST(NULL AS BIGINT) AS seq, CAST(NULL AS BIGINT) AS exchange_ts_ms, concat('KXEV', CAST(user_id // 2 AS VARCHAR)) AS event_ticker, CASE WHEN user_id % 3 <> 0 THEN 'flat' END AS fee_type_override,
  CASE WHEN user_id % 3 <> 0 THEN concat(CAST(user_id % 5 AS VARCHAR), '.', CAST(cents % 9 + 1 AS VARCHAR)) END AS fee_multiplier_override_raw FROM wire WHERE kind = 'fee'""")
def _(s):
    return channel(s, "event_fee_update")


@query("encode_control", ("wire",), f"""
SELECT received_at_ns, session_id, CASE WHEN kind <> 'error' THEN sid END AS sid, raw_message, CASE WHEN kind = 'unsubscribed' THEN seq END AS seq, CAST(NULL AS BIGINT) AS exchange_ts_ms,
  kind AS message_type, CASE WHEN kind = 'subscribed' THEN regexp_extract(raw_message, '"channel":"([a-z]+)"', 1) END AS channel,
  CASE WHEN kind = 'error' THEN CAST(cents % 30 AS INT) END AS error_code, CASE WHEN kind = 'error' THEN 'refused' END AS error_message
FROM wire WHERE kind IN ('subscribed', 'error', 'unsubscribed')""")
def _(s):
    return channel(s, "control")


@query("encode_unparsed", ("wire",), """
SELECT received_at_ns, session_id, CASE case_no WHEN 1 THEN sid WHEN 2 THEN sid WHEN 4 THEN 1 END AS sid, raw_message, CASE case_no WHEN 1 THEN seq WHEN 4 THEN 2 END AS seq, CAST(NULL AS BIGINT) AS exchange_ts_ms,
  CASE case_no WHEN 0 THEN 'not json' WHEN 1 THEN 'unknown type' WHEN 2 THEN 'field msg.count_fp' WHEN 3 THEN 'field sid' ELSE 'field msg.side' END AS parse_error,
  CASE case_no WHEN 0 THEN NULL WHEN 1 THEN 'some_future_channel' WHEN 2 THEN 'trade' WHEN 3 THEN 'ticker' ELSE 'orderbook_delta' END AS message_type FROM wire WHERE kind = 'bad'""")
def _(s):
    return channel(s, "unparsed")


@query("encode_price_ranges", ("grids",), """
SELECT observed_ms * 1000000 AS received_at_ns, CAST(NULL AS BIGINT) AS exchange_ts_ms, 'G' AS session_id, CAST(NULL AS BIGINT) AS sid, CAST(NULL AS BIGINT) AS seq, market_ticker, source,
  effective_ms * 1000000 AS effective_at, 'tapered' AS price_level_structure, CAST(2 AS INT) AS band_count, lo * 0.01 = 0.01 AS has_text FROM grids""")
def _(s):
    effective = F.when(F.col("effective_ms").isNotNull(), F.concat(F.lit(',"effective_at_ns":'), (F.col("effective_ms") * 1_000_000).cast("string"))).otherwise("")
    text = F.concat(F.lit('{"type":"price_ranges","msg":{"market_ticker":"'), F.col("market_ticker"), F.lit('","source":"'), F.col("source"), F.lit('"'), effective,
                    F.lit(',"price_level_structure":"tapered","price_ranges":'), F.col("price_ranges_raw"), F.lit("}}"))
    raw = s.grids.select((F.col("observed_ms") * 1_000_000).alias("received_at_ns"), F.lit("G").alias("session_id"), text.alias("raw_message"))
    out = decode.decode_channel(decode.route(raw).withColumn("channel", F.lit("price_ranges")), "price_ranges")
    known = F.length("price_ranges_hash") == 16
    return out.withColumn("has_text", known & grid.parse_grid("price_ranges_raw").isNotNull()).drop("raw_message", "price_ranges_raw", "price_ranges_hash")


@query("rederive_snapshot", ("snap_levels",), """
SELECT session_id, count(*) AS "rows", CAST(coalesce(sum(c), 0) * 10000 AS BIGINT) AS price_total, count(c) AS levels FROM snap_levels GROUP BY session_id""")
def _(s):
    again = decode.rederive(channel(s, "orderbook_snapshot"), "orderbook_snapshot")
    return again.groupBy("session_id").agg(F.count("*").alias("rows"), F.coalesce(F.sum("price_micros"), F.lit(0)).alias("price_total"), F.count("price_micros").alias("levels"))


@query("channel_counts", ("wire",), f"""
SELECT coalesce(channel, 'TOTAL') AS channel, CAST(sum(CASE WHEN kind = 'snapshot' THEN greatest(cents % 3 + user_id % 2, 1) ELSE 1 END) AS BIGINT) AS "rows"
FROM (SELECT *, {CHANNEL_SQL} AS channel FROM wire) GROUP BY ROLLUP (channel)""")
def _(s):
    routed = materialize(decode.route(frames(s)))  # every channel reads it
    return audit.channel_counts({name: decode.decode_channel(routed, name) for name in CHANNELS if name != "price_ranges"})


@query("non_lifecycle_counts", ("wire",), f"""
SELECT coalesce(channel, 'TOTAL') AS channel, count(*) AS "rows" FROM (SELECT {CHANNEL_SQL} AS channel FROM wire WHERE kind NOT IN ('lifecycle', 'event')) GROUP BY ROLLUP (channel)""")
def _(s):
    routed = decode.non_lifecycle(decode.route(frames(s)))
    return routed.rollup("channel").agg(F.count("*").alias("rows")).withColumn("channel", F.coalesce("channel", F.lit("TOTAL")))


@query("minute_metrics", ("wire",), f"""
SELECT minute_ms, count(*) AS messages, CAST(sum(strlen(raw_message)) AS BIGINT) AS bytes, count(*) FILTER (WHERE kind IN ('lifecycle', 'event')) AS lifecycle_events,
  count(*) FILTER (WHERE kind = 'bad') AS unparsed, count(*) * 1000 // 60 AS milli_per_second FROM (SELECT *, received_at_ns // 60000000000 * 60000 AS minute_ms FROM wire) GROUP BY minute_ms""")
def _(s):
    return metrics.minute_metrics(decode.route(frames(s)))


@query("subscribed_rows", ("wire",), """
SELECT w.session_id, w.sid, c.subscribed_channel, count(*) AS "rows" FROM wire w LEFT JOIN (SELECT session_id, sid, min(regexp_extract(raw_message, '"channel":"([a-z]+)"', 1)) AS subscribed_channel
  FROM wire WHERE kind = 'subscribed' GROUP BY 1, 2) c USING (session_id, sid) WHERE kind = 'delta' GROUP BY 1, 2, 3""")
def _(s):
    routed = decode.route(frames(s))
    rows = metrics.with_subscription(decode.decode_channel(routed, "orderbook_delta"), decode.decode_channel(routed, "control"))
    return rows.groupBy("session_id", "sid", "subscribed_channel").agg(F.count("*").alias("rows"))


step("board_rows", ("tick",), "SELECT *, row_number() OVER (PARTITION BY market_ticker ORDER BY received_at_ns, seq) AS n FROM tick")
LAST = [f"arg_max({x}, n) FILTER (WHERE {x} IS NOT NULL) AS {x}" for x in board.LATEST]
step("board", ("board_rows",), f"SELECT market_ticker, {', '.join(LAST)}, max(received_at_ns) // 1000000 AS updated_ms FROM board_rows GROUP BY market_ticker")
step("settled", ("life",), """
SELECT market_ticker, arg_max(result, n) FILTER (WHERE result IS NOT NULL) AS result, arg_max(settlement_value_micros, n) FILTER (WHERE settlement_value_micros IS NOT NULL) AS settlement_value_micros
FROM (SELECT *, row_number() OVER (PARTITION BY market_ticker ORDER BY received_at_ns, seq) AS n FROM life WHERE event_type = 'determined') GROUP BY market_ticker""")
step("full_board", ("board", "settled"), """
SELECT b.*, regexp_replace(market_ticker, '-[^-]*$', '') AS event, CAST(make_date(2024, 1, CAST(regexp_extract(market_ticker, '24JAN([0-9]{2})', 1) AS INT)) AS VARCHAR) AS event_date,
  regexp_extract(market_ticker, '([^-]*)$', 1) AS outcome, s.result, s.settlement_value_micros FROM board b LEFT JOIN settled s USING (market_ticker)""")


@query("market_board", ("board",), "SELECT * FROM board")
def _(s):
    return board.market_board(s.tick)


@query("board_freshness", ("tick",), "SELECT max(received_at_ns) // 1000000 AS as_of_ms FROM tick")
def _(s):
    return board.freshness(board.market_board(s.tick))


@query("captured_markets", ("tick",), "SELECT DISTINCT market_ticker FROM tick")
def _(s):
    return s.tick.select("market_ticker").distinct()


@query("settlements", ("settled", "tick"), "SELECT * FROM settled WHERE market_ticker IN (SELECT market_ticker FROM tick)")
def _(s):
    return board.settlements_of(s.life, s.tick.select("market_ticker").distinct())


def full_board(s):
    return board.board_with_settlement(board.market_board(s.tick), board.settlements(s.life))


@query("board_with_settlement", ("full_board",), "SELECT * FROM full_board")
def _(s):
    return full_board(s).withColumn("event_date", F.col("event_date").cast("string"))


@query("board_order", ("full_board",), """
SELECT market_ticker, event, outcome, is_settled, CASE WHEN is_settled THEN -d ELSE d END AS date_key FROM (SELECT *, bool_or(result IS NOT NULL) OVER (PARTITION BY event) AS is_settled,
  CAST(datediff('day', DATE '1970-01-01', CAST(event_date AS DATE)) AS INT) AS d FROM full_board)""")
def _(s):
    return board.board_order(full_board(s)).select("market_ticker", "event", "outcome", "is_settled", "date_key")


HIST = [f"arg_max({x}, n) FILTER (WHERE {x} IS NOT NULL) AS {x}" for x in board.LATEST[:3]]


@query("market_history", ("board_rows",), f"""
SELECT market_ticker, received_at_ns // 1000000 // 300000 * 300 AS bucket_start_s, {', '.join(HIST)} FROM board_rows GROUP BY 1, 2""")
def _(s):
    return board.bucketed(s.tick, board.bucket_seconds(24))


CHART = "KXEV7-24JAN08AAABBB-BBB"


@query("market_chart", ("board_rows",), f"""
SELECT received_at_ns // 1000000 // 3600000 * 3600 AS bucket_start_s, {', '.join(HIST)} FROM board_rows WHERE market_ticker = '{CHART}' AND received_at_ns >= ({NOW_MS} - 168 * 3600000) * 1000000 GROUP BY 1""")
def _(s):
    return board.market_history(s.tick, CHART, 168, NOW_MS)


step("grid_rows", ("grids",), "SELECT *, lag(price_ranges_raw) OVER (PARTITION BY market_ticker, source ORDER BY observed_ms) AS before FROM grids")
step("grid_verdicts", ("grid_rows",), "SELECT *, CASE WHEN before IS NULL THEN 'first_observation' WHEN before = price_ranges_raw THEN 'unchanged' ELSE 'changed' END AS verdict FROM grid_rows")


@query("grid_changes", ("grid_verdicts",), "SELECT market_ticker, source, observed_ms, verdict FROM grid_verdicts")
def _(s):
    return grids.grid_verdicts(s.grids).select("market_ticker", "source", "observed_ms", "verdict")


@query("grid_counters", ("grid_verdicts",), """
SELECT count(*) FILTER (WHERE verdict <> 'unchanged') AS changes, count(*) FILTER (WHERE verdict = 'unchanged') AS suppressed, count(DISTINCT (market_ticker, source)) AS tracked FROM grid_verdicts""")
def _(s):
    return grids.grid_counters(grids.grid_verdicts(s.grids))


@query("grid_intervals", ("grid_verdicts",), """
SELECT market_ticker, source, coalesce(effective_ms, observed_ms) AS from_ms, lead(coalesce(effective_ms, observed_ms)) OVER (PARTITION BY market_ticker, source ORDER BY coalesce(effective_ms, observed_ms), observed_ms) AS to_ms,
  price_ranges_raw FROM grid_verdicts WHERE verdict <> 'unchanged'""")
def _(s):
    changes = grids.grid_changes(grids.grid_verdicts(s.grids))
    return grids.grid_intervals(changes).select("market_ticker", "source", "from_ms", "to_ms", "price_ranges_raw")


step("in_force", ("quotes", "grids"), "SELECT q.*, g.cut, g.fine FROM quotes q ASOF LEFT JOIN grids g ON q.market_ticker = g.market_ticker AND q.at_ms >= g.observed_ms")
step("judged", ("in_force",), """
SELECT *, cut IS NOT NULL AND NOT ((price_micros BETWEEN 10000 AND (cut % 99) * 10000 AND price_micros % 10000 = 0)
  OR (price_micros BETWEEN (cut % 99) * 10000 AND 990000 AND (price_micros - (cut % 99) * 10000) % CASE WHEN fine = '0.0100' THEN 10000 ELSE 1000 END = 0)) AS off FROM in_force""")


def priced(s):
    seen = s.grids.withColumn("bands", grid.parse_grid("price_ranges_raw"))
    return grids.grid_in_force(s.quotes, seen, "at_ms")


@query("grid_asof", ("in_force",), """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, market_ticker, CAST((cut % 99) * 10000 AS BIGINT) AS cut_micros, CASE WHEN fine = '0.0100' THEN CAST(10000 AS BIGINT) WHEN fine IS NOT NULL THEN 1000 END AS fine_step FROM in_force""")
def _(s):
    out = priced(s)
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "market_ticker", F.col("bands")[0]["end"].alias("cut_micros"), F.col("bands")[1]["step"].alias("fine_step"))


@query("off_grid_count", ("judged",), 'SELECT market_ticker, count(*) AS prices, count(*) FILTER (WHERE "off") AS off_grid FROM judged GROUP BY market_ticker')
def _(s):
    return grids.off_grid_counts(priced(s))


@query("fee_asof", ("trades", "fees"), """
SELECT t.l_orderkey, t.l_linenumber, t.l_partkey, t.l_suppkey, regexp_replace(t.market_ticker, '-[^-]*$', '') AS event_ticker, f.o_orderkey IS NOT NULL AS has_record, f.fee_type_override, f.fee_multiplier_override_raw
FROM trades t ASOF LEFT JOIN fees f ON regexp_replace(t.market_ticker, '-[^-]*$', '') = f.event_ticker AND t.at_ms >= f.at_ms""")
def _(s):
    out = grids.fee_in_force(s.trades, s.fees, "at_ms")
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "event_ticker", "has_record", "fee_type_override", "fee_multiplier_override_raw")


@query("market_registry", ("sightings",), """
SELECT market_ticker, learned_via, seen_ms AS first_seen_ms FROM (SELECT DISTINCT *, row_number() OVER (PARTITION BY market_ticker ORDER BY seen_ms,
  CASE learned_via WHEN 'startup_discovery' THEN 1 WHEN 'lifecycle' THEN 2 ELSE 3 END) AS n FROM sightings) WHERE n = 1""")
def _(s):
    return reconcile.market_registry(s.sightings)


@query("reconcile_missed", ("sightings",), """
SELECT DISTINCT market_ticker FROM sightings WHERE learned_via = 'reconciliation' AND market_ticker NOT IN (SELECT market_ticker FROM sightings WHERE learned_via <> 'reconciliation')""")
def _(s):
    crawl = s.sightings.where("learned_via = 'reconciliation'")
    return reconcile.missed_by_live_path(crawl, s.sightings.where("learned_via <> 'reconciliation'"))


@query("needing_subscription", ("sightings",), """
SELECT market_ticker, min(seen_ms) AS position FROM sightings WHERE learned_via = 'lifecycle' AND market_ticker NOT IN (SELECT market_ticker FROM sightings WHERE learned_via = 'startup_discovery') GROUP BY market_ticker""")
def _(s):
    offered = s.sightings.where("learned_via = 'lifecycle'").withColumn("position", F.col("seen_ms"))
    return reconcile.needing_subscription(offered, s.sightings.where("learned_via = 'startup_discovery'"))


step("crawled", ("crawl",), "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY pass_no, page_no, place) AS n FROM crawl) WHERE n = 1")


@query("discovery_markets", ("crawled",), "SELECT ticker, pass_no, page_no, place, status, series_ticker, o_orderkey FROM crawled WHERE series_ticker IN ('SER1', 'SER2') AND status IN ('O', 'F')")
def _(s):
    return reconcile.filter_discovery(reconcile.merge_crawl(s.crawl), ["SER1", "SER2"], ["O", "F"])


@query("discovery_observations", ("names",), r"""
SELECT upper(raw) AS market_ticker, 'discovery' AS source, CAST(5 AS BIGINT) AS observed_ms, CAST(NULL AS BIGINT) AS effective_ms, raw <> upper(raw) AS was_renamed FROM names WHERE regexp_full_match(raw, '[A-Za-z0-9_-][A-Za-z0-9._-]{0,127}')""")
def _(s):
    markets = s.names.select(F.col("raw").alias("ticker"), F.lit(5).cast("bigint").alias("finished_ms"), F.lit("linear").alias("price_level_structure"), F.lit("[]").alias("price_ranges_raw"))
    return grids.observations_from_discovery(markets).drop("price_level_structure", "price_ranges_raw")


@query("stall_report", ("ev",), """
SELECT session_id, from_ms, to_ms, to_ms - from_ms AS silent_ms FROM (SELECT concat('U', CAST(user_id % 20 AS VARCHAR)) AS session_id, ms AS to_ms, lag(ms) OVER (PARTITION BY user_id % 20 ORDER BY ms, event_id) AS from_ms FROM ev)
WHERE to_ms - from_ms > 7200000""")
def _(s):
    rows = s.ev.select(F.concat(F.lit("U"), (F.col("user_id") % 20).cast("string")).alias("session_id"), F.col("ms").alias("received_ms"), "event_id")
    return metrics.stalls(rows, tie=("event_id",), idle_ms=7_200_000)


@query("last_seen", ("tick",), f"""
SELECT session_id, max(ms) AS last_ms, {NOW_MS} - max(ms) AS age_ms, {NOW_MS} - max(ms) > 180000 AS is_stale FROM (SELECT session_id, received_at_ns // 1000000 AS ms FROM tick) GROUP BY session_id""")
def _(s):
    rows = s.tick.select("session_id", received_ms("received_at_ns").alias("received_ms"))
    return metrics.last_seen(rows, NOW_MS)


@query("health_class", ("ev",), """
SELECT health, count(*) AS n FROM (SELECT CASE WHEN event_type = 'error' THEN 'no_heartbeat' WHEN user_id * 2 > 180 THEN 'stalled' WHEN cents % 7 > 5 OR cents % 11 > 9 THEN 'issues' ELSE 'good' END AS health FROM ev) GROUP BY health""")
def _(s):
    age = F.when(F.col("event_type") != "error", F.col("user_id") * 2)
    lost = F.when(F.col("cents") % 7 > 5, F.lit(1))
    missed = F.when(F.col("cents") % 11 > 9, F.lit(2))
    return s.ev.groupBy(metrics.health_class(age, lost, missed).alias("health")).agg(F.count("*").alias("n"))


step("legs", ("bk_levels",), """
SELECT market_ticker, received_at_ns * 10 + level_index AS level_index, price_micros AS a, CASE WHEN market_ticker = 'M3' THEN price_micros WHEN market_ticker = 'M4' AND size_fp_units % 2 = 0 THEN price_micros + 1 ELSE 1000000 - price_micros END AS b
FROM bk_levels WHERE side = 'no'""")


@query("convention_check", ("legs",), """
SELECT market_ticker, count(*) AS levels, count(*) FILTER (WHERE a + b = 1000000) AS complementary, count(*) FILTER (WHERE a = b) AS identical,
  CASE WHEN bool_and(coalesce(a = b, false)) THEN 'identical' WHEN bool_and(coalesce(a + b = 1000000, false)) THEN 'complementary' ELSE 'mixed' END AS verdict FROM (SELECT market_ticker, CASE WHEN level_index // 10000000 % 13 <> 7 THEN a END AS a, b FROM legs) GROUP BY market_ticker""")
def _(s):
    no = s.bk_levels.where("side = 'no'").withColumn("level_index", F.col("received_at_ns") * 10 + F.col("level_index"))
    other = F.when(F.col("market_ticker") == "M3", F.col("price_micros")).when(
        (F.col("market_ticker") == "M4") & (F.col("size_fp_units") % 2 == 0), F.col("price_micros") + 1).otherwise(1_000_000 - F.col("price_micros"))
    return metrics.convention_check(no.where("level_index div 10000000 % 13 <> 7"), no.withColumn("price_micros", other))
