"""Queries over scalar functions."""

from pyspark.sql import functions as F

from tidemark.functions import clocks, display, fixed, grid, tickers
from tidemark.operators import audit
from tidemark.workload.registry import query, step

PARSE_SQL = r"""CASE WHEN regexp_full_match({c}, '-?[0-9]+(\.[0-9]+)?') AND NOT regexp_matches(substr(split_part({c}, '.', 2), {n} + 1), '[1-9]')
  THEN TRY_CAST(concat(split_part({c}, '.', 1), rpad(substr(split_part({c}, '.', 2), 1, {n}), {n}, '0')) AS BIGINT) END"""


def parse_sql(c, n):
    return PARSE_SQL.format(c=c, n=n)


FORMAT_SQL = """concat(CASE WHEN {v} < 0 THEN '-' ELSE '' END, CAST(abs(CAST({v} AS HUGEINT)) // CAST(10 ** {n} AS HUGEINT) AS VARCHAR), '.',
  lpad(CAST(abs(CAST({v} AS HUGEINT)) % CAST(10 ** {n} AS HUGEINT) AS VARCHAR), {n}, '0'))"""


def format_sql(v, n):
    return FORMAT_SQL.format(v=v, n=n)


@query("fixed_point_parse", ("spelled",), f"""
SELECT l_orderkey, l_linenumber, raw, {parse_sql('raw', 6)} AS price_micros, {parse_sql('raw', 2)} AS quantity_units FROM spelled""")
def _(s):
    return s.spelled.select("l_orderkey", "l_linenumber", "raw", fixed.parse_price("raw").alias("price_micros"),
                            fixed.parse_quantity("raw").alias("quantity_units"))


@query("fixed_point_failures", ("spelled",), rf"""
SELECT why AS reason, count(*) AS n, min(raw) AS first_raw, max(raw) AS last_raw FROM (
  SELECT raw, CASE WHEN raw = '' THEN 'empty' WHEN raw LIKE '%.%.%' THEN 'multiple_decimal_points'
    WHEN regexp_full_match(raw, '-?(\..*)?') THEN 'missing_integer_digits'
    WHEN NOT regexp_full_match(split_part(raw, '.', 1), '-?[0-9]+') THEN 'invalid_char'
    WHEN raw LIKE '%.' THEN 'missing_fraction_digits'
    WHEN raw LIKE '%.%' AND NOT regexp_full_match(split_part(raw, '.', 2), '[0-9]+') THEN 'invalid_char'
    WHEN regexp_matches(substr(split_part(raw, '.', 2), 7), '[1-9]') THEN 'excess_precision'
    WHEN {parse_sql('raw', 6)} IS NULL THEN 'overflow' ELSE 'ok' END AS why FROM spelled) GROUP BY why""")
def _(s):
    why = F.coalesce(fixed.parse_failure("raw", 6), F.lit("ok")).alias("reason")
    return s.spelled.groupBy(why).agg(F.count("*").alias("n"), F.min("raw").alias("first_raw"), F.max("raw").alias("last_raw"))


@query("fixed_point_format", ("amounts",), f"""
SELECT l_orderkey, l_linenumber, px, {format_sql('px', 6)} AS price_text, {format_sql('qty', 2)} AS quantity_text, px AS reparsed FROM amounts""")
def _(s):
    out = s.amounts.select("l_orderkey", "l_linenumber", "px", fixed.format_price("px").alias("price_text"),
                           fixed.format_quantity("qty").alias("quantity_text"))
    return out.withColumn("reparsed", fixed.parse_price("price_text"))


def in_i64(x):
    return f"CASE WHEN {x} BETWEEN -9223372036854775808 AND 9223372036854775807 THEN CAST({x} AS BIGINT) END"


@query("price_arithmetic", ("amounts",), f"""
SELECT l_orderkey, l_linenumber, CAST(1000000 - px AS BIGINT) AS complement, CAST(px + qty AS BIGINT) AS added, CAST(px - qty AS BIGINT) AS subtracted,
  CAST((px + qty - ((px + qty) % 2 + 2) % 2) // 2 AS BIGINT) AS mid, qty = 0 AS is_zero, qty < 0 AS is_negative FROM amounts""")
def _(s):
    return s.amounts.select(
        "l_orderkey", "l_linenumber", fixed.complement("px").alias("complement"), fixed.checked_add("px", "qty").alias("added"),
        fixed.checked_subtract("px", "qty").alias("subtracted"), fixed.midpoint("px", "qty").alias("mid"),
        (F.col("qty") == 0).alias("is_zero"), (F.col("qty") < 0).alias("is_negative"))


step("notionals", ("amounts",), f"SELECT *, {in_i64('CAST(px AS HUGEINT) * qty')} AS n FROM amounts")


@query("notional_rounding", ("notionals",), f"""
SELECT l_orderkey, l_linenumber, n AS notional, CAST(CASE WHEN n >= 0 THEN (CAST(n AS HUGEINT) + 50) // 100 ELSE -((-CAST(n AS HUGEINT) + 50) // 100) END AS BIGINT) AS micros,
  {format_sql('n', 8)} AS notional_text, {in_i64('CAST(n AS HUGEINT) + n')} AS doubled FROM notionals WHERE n IS NOT NULL
UNION ALL SELECT l_orderkey, l_linenumber, NULL, NULL, NULL, NULL FROM notionals WHERE n IS NULL""")
def _(s):
    n = s.amounts.withColumn("notional", fixed.notional("px", "qty"))
    return n.select("l_orderkey", "l_linenumber", "notional", fixed.notional_micros("notional").alias("micros"),
                    fixed.format_notional("notional").alias("notional_text"), fixed.checked_add("notional", "notional").alias("doubled"))


step("stored_text", ("stored",), f"""
SELECT *, {format_sql('px', 6)} AS price_raw, CASE WHEN l_partkey % 29 = 3 THEN 'junk' WHEN l_partkey % 29 = 4 THEN NULL ELSE {format_sql('qty', 2)} END AS size_raw FROM stored""")


def stored_text(s):
    odd = F.when(F.col("l_partkey") % 29 == 3, "junk").when(F.col("l_partkey") % 29 == 4, F.lit(None))
    return s.stored.withColumn("price_raw", fixed.format_price("px")).withColumn("size_raw", odd.otherwise(fixed.format_quantity("qty")))


STORED_DUALS = [("price_raw", "stored_px", 6), ("size_raw", "stored_qty", 2)]


@query("round_trip_audit", ("stored_text",), """
SELECT 'price_raw' AS "column", count(price_raw) AS checked, count(*) FILTER (WHERE stored_px IS DISTINCT FROM px) AS mismatches FROM stored_text
UNION ALL SELECT 'size_raw', count(size_raw), count(*) FILTER (WHERE size_raw IS NOT NULL AND stored_qty IS DISTINCT FROM CASE WHEN size_raw = 'junk' THEN NULL ELSE qty END) FROM stored_text""")
def _(s):
    return audit.round_trip_counts(stored_text(s), STORED_DUALS)


@query("round_trip_mismatches", ("stored_text",), """
SELECT l_orderkey, l_linenumber, 'price_raw' AS "column", price_raw AS raw, stored_px AS stored, px AS expected FROM stored_text WHERE stored_px IS DISTINCT FROM px
UNION ALL SELECT l_orderkey, l_linenumber, 'size_raw', size_raw, stored_qty, CASE WHEN size_raw = 'junk' THEN NULL ELSE qty END FROM stored_text
WHERE size_raw IS NOT NULL AND stored_qty IS DISTINCT FROM CASE WHEN size_raw = 'junk' THEN NULL ELSE qty END""")
def _(s):
    return audit.round_trip_mismatches(stored_text(s), STORED_DUALS, ["l_orderkey", "l_linenumber"])


NAME_DEFECT = r"""CASE WHEN raw = '' THEN 'empty' WHEN strlen(raw) > 128 THEN 'too_long' WHEN NOT regexp_full_match(raw, '[A-Za-z0-9._-]*') THEN 'invalid_char'
  WHEN raw LIKE '.%' THEN 'unsafe_as_path' END"""


@query("ticker_validate", ("names",), f"""
SELECT c_custkey, raw, {NAME_DEFECT} AS defect, CASE WHEN {NAME_DEFECT} IS NULL THEN upper(raw) END AS ticker,
  CASE WHEN {NAME_DEFECT} IS NULL AND raw = upper(raw) THEN raw END AS strict_ticker, raw = upper(raw) AS is_canonical FROM names""")
def _(s):
    return s.names.select("c_custkey", "raw", tickers.ticker_failure("raw").alias("defect"), tickers.normalize_ticker("raw").alias("ticker"),
                          tickers.strict_ticker("raw").alias("strict_ticker"), tickers.is_canonical("raw").alias("is_canonical"))


step("name_parts", ("names",), r"""
SELECT *, CASE WHEN raw LIKE '%-%' THEN regexp_replace(raw, '-[^-]*$', '') ELSE '' END AS event FROM names""")


@query("ticker_parts", ("name_parts",), r"""
SELECT c_custkey, event, CAST(TRY_CAST(concat('20', y, '-', CASE m WHEN 'JAN' THEN '01' WHEN 'FEB' THEN '02' WHEN 'MAR' THEN '03' END, '-', d) AS DATE) AS VARCHAR) AS event_date, outcome
FROM (SELECT c_custkey, event, regexp_extract(event, '-([0-9]{2})([A-Z]{3})([0-9]{2})', 1) AS y, regexp_extract(event, '-([0-9]{2})([A-Z]{3})([0-9]{2})', 2) AS m,
  regexp_extract(event, '-([0-9]{2})([A-Z]{3})([0-9]{2})', 3) AS d, CASE WHEN raw LIKE '%-%' THEN regexp_extract(raw, '([^-]*)$', 1) ELSE raw END AS outcome FROM name_parts)""")
def _(s):
    return s.names.select("c_custkey", tickers.event_ticker("raw").alias("event"),
                          tickers.event_date("raw").cast("string").alias("event_date"), tickers.outcome("raw").alias("outcome"))


@query("trade_direction", ("spelled",), """
SELECT l_orderkey, l_linenumber, CASE WHEN o IS NOT NULL THEN o WHEN b = 'bid' THEN 'yes' WHEN b = 'ask' THEN 'no' WHEN b IS NULL THEN t END AS direction,
  CASE WHEN o = 'yes' THEN 'no' WHEN o = 'no' THEN 'yes' END AS opposite
FROM (SELECT *, CASE l_partkey % 4 WHEN 0 THEN 'yes' WHEN 1 THEN 'no' END AS o, CASE l_suppkey % 5 WHEN 0 THEN 'bid' WHEN 1 THEN 'ask' WHEN 2 THEN 'odd' END AS b,
  CASE l_linenumber % 3 WHEN 0 THEN 'yes' WHEN 1 THEN 'no' END AS t FROM spelled)""")
def _(s):
    def pick(col, n, *names):
        out = F.when(F.lit(False), "")
        for i, name in enumerate(names):
            out = out.when(F.col(col) % n == i, name)
        return out

    o, b, t = pick("l_partkey", 4, "yes", "no"), pick("l_suppkey", 5, "bid", "ask", "odd"), pick("l_linenumber", 3, "yes", "no")
    return s.spelled.select("l_orderkey", "l_linenumber", tickers.trade_direction(o, b, t).alias("direction"),
                            tickers.opposite_side(o).alias("opposite"))


@query("convention_prices", ("amounts",), """
SELECT l_orderkey, l_linenumber, side, rule, CASE WHEN side = 'no' AND rule = 'no_leg' THEN 1000000 - px ELSE px END AS yes_micros
FROM (SELECT *, CASE WHEN l_partkey % 2 = 0 THEN 'yes' ELSE 'no' END AS side, CASE WHEN l_suppkey % 2 = 0 THEN 'no_leg' ELSE 'yes_leg' END AS rule FROM amounts)""")
def _(s):
    side = F.when(F.col("l_partkey") % 2 == 0, "yes").otherwise("no")
    rule = F.when(F.col("l_suppkey") % 2 == 0, "no_leg").otherwise("yes_leg")
    return s.amounts.select("l_orderkey", "l_linenumber", side.alias("side"), rule.alias("rule"), tickers.yes_price(side, "px", rule).alias("yes_micros"))


@query("error_recovery", ("ev",), """
SELECT code, count(*) AS n, CASE WHEN code IN (10, 17, 25) THEN 'resubscribe' END AS recovery, code IN (10, 17, 25) AS is_terminal, code = 25 AS is_overflow
FROM (SELECT cents % 30 AS code FROM ev) GROUP BY code""")
def _(s):
    out = s.ev.groupBy((F.col("cents") % 30).alias("code")).agg(F.count("*").alias("n"))
    return out.select("*", tickers.recovery_for_error("code").alias("recovery"), tickers.is_terminal_error("code").alias("is_terminal"),
                      tickers.is_overflow_error("code").alias("is_overflow"))


# Every market quote against a grid of three bands of unlike steps.
BANDS = ((2_000, 200_000, 2_000), (200_000, 700_000, 25_000), (700_000, 998_000, 500))
step("bands", (), "SELECT * FROM (VALUES (CAST(2000 AS BIGINT), CAST(200000 AS BIGINT), CAST(2000 AS BIGINT)), (200000, 700000, 25000), (700000, 998000, 500)) AS b(lo, hi, tick)")
step("prices", ("quotes",), "SELECT l_orderkey, l_linenumber, l_partkey, price_micros + l_partkey % 7 * 130 - 20000 AS p FROM quotes")
step("ticks", ("prices", "bands"), """
SELECT p, lo, hi, tick, least(greatest(p, lo), hi) AS t, lo + (least(greatest(p, lo), hi) - lo) // tick * tick AS below FROM (SELECT DISTINCT p FROM prices) CROSS JOIN bands""")
step("snaps", ("ticks",), """
SELECT p, bool_or(p BETWEEN lo AND hi) AS inside, bool_or(p BETWEEN lo AND hi AND (p - lo) % tick = 0) AS valid,
  first(c ORDER BY abs(c - p), c DESC) AS snap FROM (SELECT *, CASE WHEN below + tick <= hi AND below + tick - t <= t - below THEN below + tick ELSE below END AS c FROM ticks) GROUP BY p""")


def bands():
    return F.array(*[F.struct(*[F.lit(v).cast("bigint").alias(n) for v, n in zip(b, ("start", "end", "step"))]) for b in BANDS])


def prices(s):
    return s.quotes.select("l_orderkey", "l_linenumber", (F.col("price_micros") + F.col("l_partkey") % 7 * 130 - 20_000).alias("p"))


@query("grid_snap", ("prices", "snaps"), """
SELECT l_orderkey, l_linenumber, p, valid, snap, CASE WHEN snap = p THEN 'exact' WHEN inside THEN 'snapped' ELSE 'clamped' END AS verdict FROM prices JOIN snaps USING (p)""")
def _(s):
    out = prices(s).select("*", grid.is_on_grid(bands(), "p").alias("valid"), grid.snap_to_grid(bands(), "p").alias("_s"))
    return out.select("l_orderkey", "l_linenumber", "p", "valid", F.col("_s.price").alias("snap"), F.col("_s.verdict").alias("verdict"))


@query("grid_structure", ("amounts",), """
SELECT l_orderkey, l_linenumber, CASE WHEN s1 <= 0 THEN 0 WHEN a1 > e1 THEN 0 WHEN a2 > e2 THEN 1 WHEN a2 < a1 THEN 1 END AS band,
  CASE WHEN s1 <= 0 THEN 'non_positive_step' WHEN a1 > e1 THEN 'inverted' WHEN a2 > e2 THEN 'inverted' WHEN a2 < a1 THEN 'unsorted' END AS reason
FROM (SELECT l_orderkey, l_linenumber, l_partkey % 100 AS a1, l_suppkey % 100 AS e1, l_partkey % 4 AS s1, l_suppkey % 60 AS a2, l_partkey % 90 AS e2 FROM amounts)""")
def _(s):
    def band(a, b, c):
        return F.struct(a.alias("start"), b.alias("end"), c.alias("step"))

    p, q = F.col("l_partkey"), F.col("l_suppkey")
    bands = F.array(band(p % 100, q % 100, p % 4), band(q % 60, p % 90, F.lit(1).cast("bigint")))
    out = s.amounts.select("l_orderkey", "l_linenumber", grid.grid_defect(bands).alias("_d"))
    return out.select("l_orderkey", "l_linenumber", F.col("_d.band").alias("band"), F.col("_d.reason").alias("reason"))


@query("grid_text", ("grids",), """
SELECT market_ticker, observed_ms, CAST(2 AS BIGINT) AS bands, concat('[$0.010000..=$0.', CAST((cut % 99) * 10000 AS VARCHAR), ' step $0.010000, $0.', CAST((cut % 99) * 10000 AS VARCHAR), '..=$0.990000 step $', fine, '00]') AS rendered,
  format('{:016x}', list_reduce(list_prepend(CAST(14695981039346656037 AS UHUGEINT), list_transform(range(1, length(price_ranges_raw) + 1), lambda i: CAST(ascii(substr(price_ranges_raw, CAST(i AS INT), 1)) AS UHUGEINT))),
    lambda h, x: xor(h, x) * CAST(1099511628211 AS UHUGEINT) % CAST(18446744073709551616 AS UHUGEINT))) AS hash FROM grids""")
def _(s):
    bands = grid.parse_grid("price_ranges_raw")
    return s.grids.select("market_ticker", "observed_ms", F.size(bands).cast("bigint").alias("bands"), grid.render_grid(bands).alias("rendered"),
                          grid.grid_hash("price_ranges_raw").alias("hash"))


@query("feed_latency", ("tick",), """
SELECT session_id, count(*) AS "rows", min(late) AS min_ms, max(late) AS max_ms, CAST(sum(late) AS BIGINT) AS total_ms, count(*) FILTER (WHERE late BETWEEN 5000 AND 29999) AS warn,
  count(*) FILTER (WHERE late >= 30000) AS error FROM (SELECT session_id, received_at_ns // 1000000 - exchange_ts_ms AS late FROM tick) GROUP BY session_id""")
def _(s):
    from tidemark.operators import metrics

    return metrics.feed_latency(s.tick)


@query("partition_dates", ("tick",), """
SELECT CAST(DATE '1970-01-01' + CAST(received_at_ns // 86400000000000 AS INT) AS VARCHAR) AS date, count(*) AS n FROM tick GROUP BY 1""")
def _(s):
    return s.tick.groupBy(clocks.partition_date("received_at_ns").cast("string").alias("date")).agg(F.count("*").alias("n"))


@query("display_labels", ("ev",), """
SELECT event_id, concat(CAST((m + 5000) // 10000 AS VARCHAR), '¢') AS price_label,
  CASE WHEN s < 90 THEN concat(CAST(s AS VARCHAR), 's') WHEN s < 5400 THEN concat(CAST((s + 30) // 60 AS VARCHAR), ' min') WHEN s < 172800 THEN concat(printf('%.1f', round(s / 3600.0, 1)), ' h') ELSE concat(printf('%.1f', round(s / 86400.0, 1)), ' d') END AS age_label,
  CASE WHEN b < 1024 THEN concat(CAST(b AS VARCHAR), ' B') WHEN b < 10240 THEN concat(printf('%.1f', round(b / 1024.0, 1)), ' KB') WHEN b < 1048576 THEN concat(printf('%.0f', round(b / 1024.0)), ' KB') WHEN b < 10485760 THEN concat(printf('%.1f', round(b / 1048576.0, 1)), ' MB') ELSE concat(printf('%.0f', round(b / 1048576.0)), ' MB') END AS size_label
FROM (SELECT event_id, cents % 100 * 10007 AS m, user_id * 1009 AS s, cents * 1021 AS b FROM ev)""")
def _(s):
    return s.ev.select("event_id", display.cents_label(F.col("cents") % 100 * 10_007).alias("price_label"),
                       display.duration_label(F.col("user_id") * 1_009).alias("age_label"), display.bytes_label(F.col("cents") * 1_021).alias("size_label"))


@query("display_scaling", ("amounts",), """
SELECT l_orderkey, l_linenumber, CAST(px AS DOUBLE) / 1000000e0 AS dollars, CAST(qty AS DOUBLE) / 100e0 AS contracts FROM amounts""")
def _(s):
    return s.amounts.select("l_orderkey", "l_linenumber", display.money("px").alias("dollars"), display.contracts("qty").alias("contracts"))
