"""Feed tables derived from the supplied star-schema tables, as SQL for either engine.

Sequence numbers come from arithmetic on the event id, so that no derivation
needs a sort or a window and all of it grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BASE = ("events", "orders", "lineitem", "part", "customer", "supplier", "documents")

# The "now" of reports, 2024-02-01 and 2001-08-02 UTC.
NOW_MS = 1_706_745_600_000
SESSION_NOW_MS = 996_710_400_000


class Spark:
    """Spark SQL spelling."""

    prefix = "tidemark_base_"

    @staticmethod
    def div(a: str, b: str | int) -> str:
        return f"(({a}) div {b})"

    @staticmethod
    def ms(column: str) -> str:
        return f"(timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {column}) div 1000)"


class Duck:
    """DuckDB spelling."""

    prefix = ""

    @staticmethod
    def div(a: str, b: str | int) -> str:
        return f"(({a}) // {b})"

    @staticmethod
    def ms(column: str) -> str:
        return f"(epoch_us({column}) // 1000)"


def text(x: str) -> str:
    return f"CAST({x} AS VARCHAR(40))"


def cents_text(x: str, modulus: int = 99) -> str:
    """A price text like 0.4300 from an integer expression."""
    return f"concat('0.', lpad({text(f'({x}) % {modulus} + 1')}, 2, '0'), '00')"


MARKET = (
    "concat('KXEV', {g}, '-24JAN', lpad({d}, 2, '0'), 'AAABBB-', CASE WHEN user_id % 2 = 0 THEN 'AAA' ELSE 'BBB' END)"
)


def ctes(e) -> dict[str, tuple[tuple[str, ...], str]]:
    """name -> (tables it needs, SELECT text)."""
    base = e.prefix
    market = MARKET.format(g=text("g"), d=text("g % 28 + 1"))
    quantity = f"concat({text('cents % 500')}, '.', lpad({text('cents % 100')}, 2, '0'))"
    body_ids = f"""'"market_ticker":"', market_ticker, '","market_id":"', {text('user_id')}, '",'"""
    levels = "CASE {n} WHEN 0 THEN '' WHEN 1 THEN {a} ELSE concat({a}, ',', {b}) END"

    def level(price: str) -> str:
        return f"""concat('["', {cents_text(price)}, '","', {quantity}, '"]')"""

    out: dict[str, tuple[tuple[str, ...], str]] = {}
    out["ev"] = (("events",), f"""
        SELECT event_id, user_id, event_type, {e.ms('ts')} AS ms, CAST(round(value * 100) AS BIGINT) AS cents,
               {e.div('user_id', 2)} AS g FROM {base}events""")
    out["tick"] = (("ev",), f"""
        SELECT event_id AS seq, ms * 1000000 AS received_at_ns, concat('S', {text('event_id % 4')}) AS session_id,
               ms - cents % 40000 AS exchange_ts_ms, {market} AS market_ticker, user_id, cents,
               {cents_text('cents')} AS price_raw, (cents % 99 + 1) * 10000 AS price_micros,
               CASE WHEN event_type = 'error' THEN NULL ELSE (cents % 98 + 1) * 10000 END AS yes_bid_micros,
               CASE WHEN event_type = 'signup' THEN NULL ELSE (cents % 98 + 2) * 10000 END AS yes_ask_micros,
               cents AS volume_fp_units, CASE WHEN event_type = 'view' THEN cents * 3 END AS open_interest_fp_units
        FROM ev""")
    out["life"] = (("ev",), f"""
        SELECT event_id AS seq, ms * 1000000 AS received_at_ns, concat('S', {text('event_id % 4')}) AS session_id,
               {market} AS market_ticker,
               CASE WHEN event_id % 3 = 0 THEN 'determined' ELSE 'created' END AS event_type,
               CASE cents % 3 WHEN 0 THEN 'yes' WHEN 1 THEN 'no' END AS result,
               CASE cents % 4 WHEN 0 THEN NULL ELSE cents % 2 * 1000000 END AS settlement_value_micros
        FROM ev""")
    # Twelve numbered streams; every 97th frame is lost; some frames are stored by two channels.
    out["points"] = (("ev",), f"""
        SELECT event_id, event_type, ms, concat('S', {text('event_id % 4')}) AS session_id, {e.div('event_id', 4)} % 3 + 1 AS sid,
               {e.div('event_id', 12)} + 1 AS seq, {market} AS market_ticker
        FROM ev WHERE event_id % 97 <> 13""")
    # The same streams in an arrival order with late frames, and with snapshots of which some step back.
    out["arrivals"] = (("points",), """
        SELECT session_id, sid, market_ticker,
               (event_id * 10 + CASE WHEN event_id % 53 = 7 THEN 900 ELSE 0 END) * 100000 + event_id % 100000 AS received_at_ns,
               CASE WHEN event_id % 82 = 5 AND seq > 4 THEN seq - 3 ELSE seq END AS seq, event_id % 41 = 5 AS is_snapshot
        FROM points""")
    # Subscriptions opened and closed between the arrivals, and connections lost.
    out["controls"] = (("ev",), f"""
        SELECT concat('S', {text('event_id % 4')}) AS session_id, {e.div('event_id', 4)} % 3 + 1 AS sid, event_id * 1000000 + 500000 AS received_at_ns,
               CASE WHEN event_id % 397 = 250 THEN 'open' ELSE 'close' END AS control FROM ev WHERE event_id % 397 IN (100, 250, 300)
        UNION ALL SELECT concat('S', {text('event_id % 4')}), k.sid, event_id * 1000000 + 600000, 'close'
        FROM ev CROSS JOIN (VALUES (CAST(1 AS BIGINT)), (2), (3)) AS k(sid) WHERE event_id % 1501 = 700""")
    out["bk"] = (("ev",), f"""
        SELECT event_id, concat('S', {text('event_id % 4')}) AS session_id, CAST(1 AS BIGINT) AS sid,
               concat('M', {text('user_id % 12')}) AS market_ticker, event_id * 1000000 AS received_at_ns,
               {e.div('event_id', 4)} + 1 AS seq, {e.div('event_id', 4)} % 10 = 3 AS is_snapshot,
               {e.div('event_id', 4)} % 130 = 3 AS is_bad,
               CASE WHEN event_type IN ('view', 'click', 'purchase') THEN 'yes' ELSE 'no' END AS side,
               (cents % 9 + 1) * 50000 AS price_micros, cents % 2001 - 300 AS delta_fp_units, cents, user_id
        FROM ev WHERE event_id % 997 <> 17""")
    out["bk_levels"] = (("bk",), """
        SELECT session_id, sid, market_ticker, received_at_ns, seq, k.side, CAST(k.k AS INT) AS level_index,
               (cents % 5 + 1 + CASE WHEN is_bad THEN 3 - k.k ELSE k.k END) * 50000 AS price_micros,
               CASE WHEN (cents + k.k) % 6 = 0 THEN 0 ELSE (cents + k.k * 700) % 5000 + 100 END AS size_fp_units
        FROM bk CROSS JOIN (VALUES ('yes', 0), ('yes', 1), ('yes', 2), ('no', 0), ('no', 1)) AS k(side, k)
        WHERE is_snapshot""")
    out["bk_deltas"] = (("bk",), """
        SELECT session_id, sid, market_ticker, received_at_ns, seq, side, price_micros, delta_fp_units
        FROM bk WHERE NOT is_snapshot AND user_id % 17 <> 4""")
    out["bk_others"] = (("bk",), "SELECT session_id, sid, received_at_ns, seq FROM bk WHERE NOT is_snapshot AND user_id % 17 = 4")
    out["sess"] = (("orders",), f"""
        SELECT session_id, started_ms, CASE WHEN copy = 1 THEN NULL ELSE ended_ms END AS ended_ms, pricing_convention
        FROM (SELECT concat('H', {text('o_orderkey')}) AS session_id, o_orderkey,
                     {e.ms('o_orderdate')} + o_orderkey * 7919 % 86400 * 1000 AS started_ms,
                     CASE WHEN o_orderkey % 7 = 3 THEN NULL ELSE {e.ms('o_orderdate')} + o_orderkey * 7919 % 86400 * 1000
                          + CAST(floor(o_totalprice) AS BIGINT) % 5400 * 1000 END AS ended_ms,
                     CASE o_orderkey % 3 WHEN 0 THEN 'yes_leg' WHEN 1 THEN 'no_leg' END AS pricing_convention
              FROM {base}orders) AS o CROSS JOIN (VALUES (0), (1)) AS c(copy)
        WHERE copy = 0 OR o_orderkey % 5 = 0""")
    out["windows"] = (("lineitem",), f"""
        SELECT concat('W', {text('l_orderkey')}, '-', {text('l_linenumber')}) AS name, min({e.ms('l_shipdate')} + l_partkey % 24 * 3600000) AS start_ms,
               max({e.ms('l_shipdate')} + l_partkey % 24 * 3600000 + CAST(l_quantity AS BIGINT) * 1800000) AS end_ms
        FROM {base}lineitem GROUP BY l_orderkey, l_linenumber""")
    # Price and quantity texts in good and bad spellings.
    out["spelled"] = (("lineitem",), f"""
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
               CASE l_partkey % 12
                    WHEN 0 THEN {text('c')} WHEN 1 THEN concat({text('c')}, '.') WHEN 2 THEN concat('.', {text('c')})
                    WHEN 3 THEN concat('-', {text('c')}, '.5') WHEN 4 THEN concat({text('c')}, '.1234567')
                    WHEN 5 THEN concat({text('c')}, '.12000000') WHEN 6 THEN concat('+', {text('c')})
                    WHEN 7 THEN concat({text('c')}, '.1.2') WHEN 8 THEN concat({text('c')}, 'e6')
                    WHEN 9 THEN concat({text('c')}, '00000000000000000000') WHEN 10 THEN ''
                    ELSE concat({text('c')}, '.', lpad({text('c % 1000')}, 3, '0')) END AS raw
        FROM (SELECT *, CAST(round(l_extendedprice * 100) AS BIGINT) AS c FROM {base}lineitem) AS l""")
    out["amounts"] = (("lineitem",), f"""
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
               (CAST(round(l_extendedprice * 100) AS BIGINT) - 2500000) * CASE WHEN l_partkey % 50 = 7 THEN 1000000000000 ELSE 1 END AS px,
               CAST(l_quantity AS BIGINT) * 101 - 2500 AS qty FROM {base}lineitem""")
    out["stored"] = (("amounts",), """
        SELECT l_orderkey, l_linenumber, l_partkey, px, qty,
               CASE WHEN l_partkey % 31 = 5 THEN px + 1 WHEN l_partkey % 31 = 6 THEN NULL ELSE px END AS stored_px,
               CASE WHEN l_suppkey % 41 = 2 THEN 7 ELSE qty END AS stored_qty FROM amounts""")
    # Market names in mixed spellings.
    out["names"] = (("customer",), f"""
        SELECT c_custkey,
               CASE c_custkey % 9 WHEN 0 THEN concat('kx', lower(c_mktsegment), '-24feb', {text('c_custkey % 40')}, '-t0.1')
                    WHEN 1 THEN '' WHEN 2 THEN concat('.', c_mktsegment) WHEN 3 THEN concat('A B', {text('c_custkey')})
                    WHEN 4 THEN concat('A/B', {text('c_custkey')}) WHEN 5 THEN rpad(c_name, 129, 'X')
                    WHEN 6 THEN concat('KX', c_mktsegment, '-24FEB', lpad({text('c_custkey % 40')}, 2, '0'), 'TBDAL-', {text('c_custkey')})
                    WHEN 7 THEN concat('KX', c_mktsegment, '-24XYZ01-A') ELSE replace(c_name, '#', '_') END AS raw
        FROM {base}customer""")
    # Tick-grid observations: a crawl sees a market's grid again and again, and now and then it changed.
    out["grids"] = (("part",), f"""
        SELECT concat('MK', p_brand) AS market_ticker, CASE WHEN p_partkey % 5 = 0 THEN 'lifecycle' ELSE 'discovery' END AS source,
               p_partkey * 300000 AS observed_ms, CASE WHEN p_partkey % 5 = 0 THEN p_partkey * 300000 - 1000 END AS effective_ms,
               lo, cut, fine,
               concat('[{{"start":"0.0100","end":"', {cents_text('cut - 1')}, '","step":"0.0100"}},{{"start":"', {cents_text('cut - 1')},
                      '","end":"0.9900","step":"', fine, '"}}]') AS price_ranges_raw
        FROM (SELECT p_partkey, p_brand, CAST(1 AS BIGINT) AS lo, p_size % 3 * 10 + 30 AS cut,
                     CASE WHEN p_size % 2 = 0 THEN '0.0100' ELSE '0.0010' END AS fine FROM {base}part) AS p""")
    # The same, announced ahead of time or told late.
    out["grid_moves"] = (("grids",), """
        SELECT market_ticker, source, observed_ms, CASE WHEN source = 'lifecycle' THEN observed_ms + (observed_ms % 7 - 3) * 9000000 END AS effective_ms,
               cut, fine, price_ranges_raw FROM grids""")
    out["quotes"] = (("lineitem",), f"""
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, concat('MKBrand#', {text('l_partkey % 30')}) AS market_ticker,
               l_orderkey * 40000 + l_linenumber AS at_ms, (CAST(round(l_extendedprice * 100) AS BIGINT) % 1100) * 1000 AS price_micros
        FROM {base}lineitem""")
    out["fees"] = (("orders",), f"""
        SELECT concat('KXEV', {text('o_custkey % 200')}, '-24JAN') AS event_ticker, o_orderkey, o_orderkey * 100000 AS at_ms,
               CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderpriority END AS fee_type_override,
               CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE concat('1.', {text('o_orderkey % 90 + 10')}) END AS fee_multiplier_override_raw
        FROM {base}orders""")
    out["trades"] = (("lineitem",), f"""
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, concat('KXEV', {text('l_suppkey % 230')}, '-24JAN-T', {text('l_linenumber')}) AS market_ticker,
               l_orderkey * 100000 + l_partkey AS at_ms FROM {base}lineitem""")
    out["sightings"] = (("customer", "orders"), f"""
        SELECT concat('C', {text('c_custkey')}) AS market_ticker, 'startup_discovery' AS learned_via, CAST(0 AS BIGINT) AS seen_ms
        FROM {base}customer WHERE c_custkey % 4 < 2
        UNION ALL SELECT concat('C', {text('o_custkey')}), 'lifecycle', o_orderkey * 1000 FROM {base}orders WHERE o_orderstatus = 'O' AND o_custkey % 4 <> 3
        UNION ALL SELECT concat('C', {text('o_custkey')}), 'reconciliation', o_orderkey * 1000 + 500 FROM {base}orders WHERE o_orderstatus <> 'O'""")
    out["crawl"] = (("orders",), f"""
        SELECT concat('C', {text('o_custkey')}) AS ticker, o_orderkey % 3 AS pass_no, {e.div('o_orderkey', 1000)} AS page_no,
               o_orderkey % 1000 AS place, o_orderstatus AS status, concat('SER', {text('o_custkey % 5')}) AS series_ticker, o_orderkey FROM {base}orders""")
    # One wire frame per event.
    snapshot = f"""concat('{{"type":"orderbook_snapshot","sid":', {text('sid')}, ',"seq":', {text('seq')}, ',"msg":{{', {body_ids},
        '"yes_dollars_fp":[', {levels.format(n='cents % 3', a=level('cents % 40'), b=level('cents % 40 + 5'))}, '],"no_dollars_fp":[',
        {levels.format(n='user_id % 2', a=level('cents % 30'), b=level('cents % 30'))}, ']}}}}')"""
    head = f"""',"sid":', {text('sid')}, ',"msg":{{'"""
    out["wire"] = (("ev",), f"""
        SELECT event_id, user_id, ms, cents, kind, case_no, market_ticker, sid, seq, ms * 1000000 + event_id % 1000 AS received_at_ns, session_id,
        CASE kind
          WHEN 'snapshot' THEN {snapshot}
          WHEN 'bad' THEN CASE case_no
            WHEN 0 THEN concat('{{"type":"orderbook_delta","sid":', {text('sid')})
            WHEN 1 THEN concat('{{"type":"some_future_channel","sid":', {text('sid')}, ',"seq":', {text('seq')}, '}}')
            WHEN 2 THEN concat('{{"type":"trade"', {head}, '"market_ticker":"', market_ticker, '","count_fp":5}}}}')
            WHEN 3 THEN concat('{{"type":"ticker","msg":{{"market_ticker":"', market_ticker, '"}}}}')
            ELSE concat('{{"type":"orderbook_delta","sid":1,"seq":2,"msg":{{"market_ticker":"', market_ticker, '","price_dollars":"0.1","delta_fp":"1","side":"up"}}}}') END
          WHEN 'lifecycle' THEN CASE WHEN user_id % 2 = 0
            THEN concat('{{"type":"market_lifecycle_v2"', {head}, '"event_type":"determined","market_ticker":"', market_ticker, '","result":"yes","settlement_value":"1.0000","determination_ts":', {text('ms')}, '}}}}')
            ELSE concat('{{"type":"market_lifecycle_v2"', {head}, '"event_type":"created","market_ticker":"', market_ticker, '","open_ts":', {text('ms')}, ',"is_deactivated":false,"price_level_structure":"linear"}}}}') END
          WHEN 'event' THEN concat('{{"type":"event_lifecycle"', {head}, '"event_ticker":"KXEV', {text('g')}, '","title":"t"}}}}')
          WHEN 'fee' THEN CASE WHEN user_id % 3 = 0
            THEN concat('{{"type":"event_fee_update"', {head}, '"event_ticker":"KXEV', {text('g')}, '","fee_type_override":null,"fee_multiplier_override":null}}}}')
            ELSE concat('{{"type":"event_fee_update"', {head}, '"event_ticker":"KXEV', {text('g')}, '","fee_type_override":"flat","fee_multiplier_override":', {text('user_id % 5')}, '.', {text('cents % 9 + 1')}, '}}}}') END
          WHEN 'subscribed' THEN concat('{{"type":"subscribed","id":1,"msg":{{"channel":"', event_type, '","sid":', {text('sid')}, '}}}}')
          WHEN 'error' THEN concat('{{"type":"error","id":1,"msg":{{"code":', {text('cents % 30')}, ',"msg":"refused","market_ticker":"', market_ticker, '"}}}}')
          WHEN 'unsubscribed' THEN concat('{{"type":"unsubscribed","sid":', {text('sid')}, ',"seq":', {text('seq')}, '}}')
          WHEN 'ticker' THEN concat('{{"type":"ticker"', {head}, {body_ids}, '"price_dollars":"', {cents_text('cents')}, '","yes_bid_dollars":"', {cents_text('cents', 98)},
            '","volume_fp":"', {quantity}, '","open_interest_fp":"bad","ts":', {text(e.div('ms', 1000))}, '}}}}')
          WHEN 'trade' THEN concat('{{"type":"trade"', {head}, '"trade_id":"t', {text('event_id')}, '","market_ticker":"', market_ticker, '","yes_price_dollars":"', {cents_text('cents')},
            '","count_fp":"', {quantity}, CASE user_id % 3 WHEN 0 THEN '","taker_outcome_side":"no' WHEN 1 THEN '","taker_book_side":"bid' ELSE '","taker_side":"yes' END, '","is_block_trade":true,"ts_ms":', {text('ms')}, '}}}}')
          ELSE concat('{{"type":"orderbook_delta","sid":', {text('sid')}, ',"seq":', {text('seq')}, ',"msg":{{', {body_ids}, '"price_dollars":"', {cents_text('cents')},
            '","delta_fp":"', CASE WHEN cents % 2 = 0 THEN '-' ELSE '' END, {quantity}, '","side":"', CASE WHEN user_id % 2 = 0 THEN 'yes' ELSE 'no' END, '","ts_ms":', {text('ms - 40')}, '}}}}') END AS raw_message
        FROM (SELECT *, {market} AS market_ticker, concat('S', {text('event_id % 4')}) AS session_id, {e.div('event_id', 4)} % 3 + 1 AS sid, {e.div('event_id', 12)} + 1 AS seq,
                     {e.div('event_id', 20)} % 5 AS case_no,
                     CASE event_id % 20 WHEN 0 THEN 'snapshot' WHEN 1 THEN 'bad' WHEN 2 THEN 'lifecycle' WHEN 3 THEN 'event' WHEN 4 THEN 'fee'
                          WHEN 5 THEN 'subscribed' WHEN 6 THEN 'error' WHEN 7 THEN 'unsubscribed' WHEN 8 THEN 'ticker' WHEN 9 THEN 'ticker' WHEN 10 THEN 'ticker'
                          WHEN 11 THEN 'trade' WHEN 12 THEN 'trade' WHEN 13 THEN 'trade' ELSE 'delta' END AS kind FROM ev) AS w""")
    return out


def with_clause(e, names: list[str], extra: dict[str, tuple[tuple[str, ...], str]] | None = None) -> str:
    """WITH text of the named derivations and of what they need, in order."""
    known = {**ctes(e), **(extra or {})}
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in ordered or name not in known:
            return
        for need in known[name][0]:
            visit(need)
        ordered.append(name)

    for name in names:
        visit(name)
    return "WITH " + ", ".join(f"{n} AS ({known[n][1]})" for n in ordered) if ordered else ""


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A derived table over the parquet files of ``folder``."""
    known = ctes(Spark)
    needed: set[str] = set()

    def visit(n: str) -> None:
        for need in known[n][0] if n in known else ():
            needed.add(need)
            visit(need)

    visit(name)
    for base in needed.intersection(BASE):
        spark.read.parquet(f"{folder}/{base}.parquet").createOrReplaceTempView(Spark.prefix + base)
    return spark.sql(f"{with_clause(Spark, [name])} SELECT * FROM {name}")
