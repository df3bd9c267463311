"""Raw JSON frames -> nine typed channel tables.

A frame is parsed once into a VARIANT. ``route`` decides its channel from its
``type`` and from the declared shape of that type; one projection per channel
then reads the fields. No row is ever dropped: what does not fit goes to
``unparsed`` with a reason.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.fixed import dual, PX_DIGITS, QTY_DIGITS
from tidemark.functions.grid import grid_hash
from tidemark.schemas import channel_schema

# Message types of the wire and the channel each is stored in.
CHANNEL_OF_TYPE = {
    "orderbook_snapshot": "orderbook_snapshot",
    "orderbook_delta": "orderbook_delta",
    "ticker": "ticker",
    "trade": "trade",
    "market_lifecycle_v2": "market_lifecycle",
    "event_lifecycle": "market_lifecycle",
    "event_fee_update": "event_fee_update",
    "subscribed": "control",
    "unsubscribed": "control",
    "ok": "control",
    "error": "control",
}

# Declared fields per type as path -> kind; a trailing '!' means required.
SHAPES = {
    "subscribed": {"id": "u64", "msg.channel": "str!", "msg.sid": "u64!"},
    "unsubscribed": {"id": "u64", "sid": "u64!", "seq": "u64"},
    "ok": {"id": "u64", "sid": "u64", "seq": "u64"},
    "error": {"id": "u64", "msg.code": "u32!", "msg.msg": "str!", "msg.market_ticker": "str"},
    "orderbook_snapshot": {
        "sid": "u64!", "seq": "u64!", "msg.market_ticker": "str!", "msg.market_id": "str",
        "msg.yes_dollars_fp": "levels", "msg.no_dollars_fp": "levels",
    },
    "orderbook_delta": {
        "sid": "u64!", "seq": "u64!", "msg.market_ticker": "str!", "msg.price_dollars": "str!", "msg.delta_fp": "str!",
        "msg.side": "side!", "msg.market_id": "str", "msg.ts": "str", "msg.ts_ms": "i64",
    },
    "ticker": {
        "sid": "u64!", "msg.market_ticker": "str!", "msg.market_id": "str", "msg.price_dollars": "str",
        "msg.yes_bid_dollars": "str", "msg.yes_ask_dollars": "str", "msg.yes_bid_size_fp": "str",
        "msg.yes_ask_size_fp": "str", "msg.last_trade_size_fp": "str", "msg.volume_fp": "str",
        "msg.open_interest_fp": "str", "msg.dollar_volume": "i64", "msg.dollar_open_interest": "i64",
        "msg.ts_ms": "i64", "msg.ts": "i64", "msg.time": "str",
    },
    "trade": {
        "sid": "u64!", "msg.trade_id": "str", "msg.market_ticker": "str!", "msg.yes_price_dollars": "str",
        "msg.no_price_dollars": "str", "msg.count_fp": "str", "msg.taker_outcome_side": "side",
        "msg.taker_book_side": "str", "msg.taker_side": "side", "msg.is_block_trade": "bool",
        "msg.ts_ms": "i64", "msg.ts": "i64",
    },
    "market_lifecycle_v2": {
        "sid": "u64!", "msg.event_type": "str!", "msg.market_ticker": "str!", "msg.exchange_index": "i64",
        "msg.open_ts": "i64", "msg.close_ts": "i64", "msg.result": "str", "msg.determination_ts": "i64",
        "msg.settlement_value": "str", "msg.settled_ts": "i64", "msg.is_deactivated": "bool",
        "msg.price_level_structure": "str", "msg.strike_type": "str", "msg.yes_sub_title": "str",
    },
    "event_lifecycle": {
        "sid": "u64!", "msg.event_ticker": "str!", "msg.series_ticker": "str", "msg.title": "str", "msg.subtitle": "str",
        "msg.collateral_return_type": "str", "msg.strike_date": "i64", "msg.strike_period": "str", "msg.exchange_index": "i64",
    },
    "event_fee_update": {
        "sid": "u64!", "msg.event_ticker": "str!", "msg.fee_type_override": "str", "msg.fee_multiplier_override": "num",
    },
}


def _get(path: str, kind: str) -> str:
    return f"try_variant_get(v, '$.{path}', '{kind}')"


def _kind(path: str) -> str:
    """SQL for the type name of a field: ``ABSENT`` when missing, ``VOID`` for JSON null."""
    return f"coalesce(schema_of_variant({_get(path, 'variant')}), 'ABSENT')"


# SQL test per kind, for a present value. Each looks a field up once where it can: a frame has many fields.
_NUMBER = "(BIGINT|DECIMAL|DOUBLE|FLOAT)"


def _fits(path: str, kind: str) -> str:
    """SQL condition: the field holds the declared JSON type, or may be missing or null and is."""
    required = kind.endswith("!")
    kind = kind.rstrip("!")
    found = _kind(path)
    if kind == "levels":
        # Absent, or a list of pairs of strings; an explicit null is not a list. The type name
        # alone does not show nulls and lengths.
        pairs = f"forall({_get(path, 'array<array<string>>')}, e -> size(e) = 2 AND e[0] IS NOT NULL AND e[1] IS NOT NULL)"
        return (
            f"({found} = 'ABSENT' OR ({found} IN ('ARRAY<VOID>', 'ARRAY<ARRAY<STRING>>') AND coalesce({pairs}, false)))"
        )
    allowed = "" if required else ", 'VOID', 'ABSENT'"
    if kind == "str":
        return f"{found} IN ('STRING'{allowed})"
    if kind == "bool":
        return f"{found} IN ('BOOLEAN'{allowed})"
    if kind == "i64":
        return f"{found} IN ('BIGINT'{allowed})"
    missing = "false" if required else f"{found} IN ('VOID', 'ABSENT')"
    present = {
        "u64": f"CASE WHEN {found} = 'BIGINT' THEN {_get(path, 'bigint')} >= 0 "
        f"WHEN {found} IN ('DECIMAL(19,0)', 'DECIMAL(20,0)') THEN {_get(path, 'decimal(38,0)')} "
        f"BETWEEN 0 AND CAST('18446744073709551615' AS DECIMAL(38,0)) ELSE {missing} END",
        "u32": f"CASE WHEN {found} = 'BIGINT' THEN {_get(path, 'bigint')} BETWEEN 0 AND 4294967295 ELSE {missing} END",
        "num": f"CASE WHEN {found} RLIKE '^{_NUMBER}' THEN true ELSE {missing} END",
        "side": f"CASE WHEN {found} = 'STRING' THEN {_get(path, 'string')} IN ('yes', 'no') ELSE {missing} END",
    }
    return f"({present[kind]})"


def _first_misfit(message_type: str, levels: bool) -> str:
    """SQL for the first declared field a frame of this type breaks, NULL when it fits.

    Level lists are tested apart: their lambda would keep every other test out of generated code.
    """
    fields = [(path, kind) for path, kind in SHAPES[message_type].items() if (kind == "levels") == levels]
    tests = " ".join(f"WHEN NOT {_fits(path, kind)} THEN 'field {path}'" for path, kind in fields)
    return f"CASE {tests} END"


def _checked(path: str, names: str, kind: str) -> Column:
    """A declared field. Its type was tested on routing; only frames that failed there are tested again."""
    return F.expr(f"CASE WHEN parse_error IS NULL OR {_kind(path)} IN ({names}) THEN {_get(path, kind)} END")


def text_at(path: str) -> Column:
    return _checked(path, "'STRING'", "string")


def int_at(path: str) -> Column:
    return _checked(path, "'BIGINT'", "bigint")


def bool_at(path: str) -> Column:
    return _checked(path, "'BOOLEAN'", "boolean")


def unsigned_at(path: str) -> Column:
    """An unsigned number that fits BIGINT, else NULL."""
    return F.expr(f"CASE WHEN {_kind(path)} = 'BIGINT' AND {_get(path, 'bigint')} >= 0 THEN {_get(path, 'bigint')} END")


def loose_text_at(path: str) -> Column:
    """A JSON string outside the declared shape; any other type gives NULL and is not turned into text."""
    return F.expr(f"CASE WHEN {_kind(path)} = 'STRING' THEN {_get(path, 'string')} END")


def loose_int_at(path: str) -> Column:
    return F.expr(f"CASE WHEN {_kind(path)} = 'BIGINT' THEN {_get(path, 'bigint')} END")


def number_text_at(path: str) -> Column:
    """A JSON number as text; a plain decimal never becomes a float."""
    return F.expr(f"CASE WHEN {_kind(path)} RLIKE '^{_NUMBER}' THEN {_get(path, 'string')} END")


def parse_frames(frames: DataFrame) -> DataFrame:
    """Add the parsed message ``v`` and its ``message_type``. Invalid JSON and repeated keys give NULL."""
    return frames.withColumn("v", F.try_parse_json("raw_message")).withColumn("message_type", loose_text_at("type"))


def route(frames: DataFrame) -> DataFrame:
    """Add ``channel`` and, for what cannot be typed, ``parse_error``."""
    known = ", ".join(f"'{name}'" for name in CHANNEL_OF_TYPE)
    misfits = " ".join(f"WHEN message_type = '{name}' THEN {_first_misfit(name, False)}" for name in CHANNEL_OF_TYPE)
    misfit = (
        "CASE WHEN v IS NULL THEN 'not json' WHEN message_type IS NULL THEN 'no type' "
        f"WHEN message_type NOT IN ({known}) THEN 'unknown type' {misfits} END"
    )
    targets = " ".join(f"WHEN message_type = '{name}' THEN '{channel}'" for name, channel in CHANNEL_OF_TYPE.items())
    channel = F.expr(f"CASE WHEN parse_error IS NOT NULL THEN 'unparsed' {targets} END")
    # A one-element explode, so that a filter on the channel stays above the parse. As a plain
    # projection the optimizer would copy the whole parse into the filter, once per use.
    return (
        parse_frames(frames)
        .withColumn("misfit", F.expr(misfit))
        .withColumn(
            "parse_error",
            F.expr(
                "CASE WHEN misfit IS NULL AND message_type = 'orderbook_snapshot' "
                f"THEN {_first_misfit('orderbook_snapshot', True)} ELSE misfit END"
            ),
        )
        .drop("misfit")
        .select("*", F.explode(F.array(channel)).alias("channel"))
    )


COMMON_FIELDS = ("received_at_ns", "exchange_ts_ms", "session_id", "sid", "seq", "raw_message")


def _common(exchange_ts: Column, sid: Column | None = None) -> list[Column]:
    return [
        F.col("received_at_ns"),
        exchange_ts.cast("bigint").alias("exchange_ts_ms"),
        F.col("session_id"),
        (unsigned_at("sid") if sid is None else sid).alias("sid"),
        unsigned_at("seq").alias("seq"),
        F.col("raw_message"),
    ]


def _or_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def _ts_with_fallback() -> Column:
    """``ts_ms``, else the deprecated whole seconds."""
    return F.coalesce(int_at("msg.ts_ms"), F.try_multiply(int_at("msg.ts"), F.lit(1000).cast("bigint")))


def _side_levels(side: str) -> str:
    """SQL for the levels of one side as ``(side, level_index, price, size)`` structs.

    The index is the position in the wire list, entries that are no list
    included; those give no row. A routed frame holds only pairs of strings.
    """
    path = f"msg.{side}_dollars_fp"
    fast = (
        f"transform({_get(path, 'array<array<string>>')}, (e, i) -> named_struct('side', '{side}', 'level_index', "
        "cast(i AS int), 'price', e[0], 'size', e[1]))"
    )
    item = (
        "CASE WHEN schema_of_variant(try_variant_get(x.e, '$[{0}]', 'variant')) = 'STRING' "
        "THEN try_variant_get(x.e, '$[{0}]', 'string') END"
    )
    slow = (
        f"transform(filter(transform({_get(path, 'array<variant>')}, (e, i) -> named_struct('i', cast(i AS int), 'e', e)), "
        f"x -> schema_of_variant(x.e) LIKE 'ARRAY%'), x -> named_struct('side', '{side}', 'level_index', x.i, "
        f"'price', {item.format(0)}, 'size', {item.format(1)}))"
    )
    return f"coalesce(CASE WHEN parse_error IS NULL THEN {fast} ELSE {slow} END, array())"


def tagged_levels() -> Column:
    """All levels of a snapshot, the yes side first."""
    return F.expr(f"concat({_side_levels('yes')}, {_side_levels('no')})")


def encode_snapshot(routed: DataFrame) -> DataFrame:
    """One row per level; an empty book still gives one row, so that its ``seq`` is not lost."""
    exploded = routed.select(
        *_common(loose_int_at("msg.ts_ms")),
        _or_empty(text_at("msg.market_ticker")).alias("market_ticker"),
        text_at("msg.market_id").alias("market_id"),
        F.explode_outer(tagged_levels()).alias("level"),
    )
    fields = exploded.select(
        *COMMON_FIELDS, "market_ticker", "market_id", F.col("level.side").alias("side"), F.col("level.price").alias("price"),
        F.col("level.size").alias("size"), F.col("level.level_index").alias("level_index"),
    )
    return _with_duals(fields, ["market_ticker", "market_id", "side", ("price", PX_DIGITS), ("size", QTY_DIGITS), "level_index"])


def _with_duals(fields: DataFrame, order: list[str | tuple[str, int]]) -> DataFrame:
    """Second projection: the looked-up texts are columns by now, so parsing reads each of them once.

    A ``(name, digits)`` entry becomes the raw text and the integer read from it.
    """
    out: list[Column] = [F.col(c) for c in COMMON_FIELDS]
    for item in order:
        out += dual(F.col(item[0]), item[0], item[1]) if isinstance(item, tuple) else [F.col(item)]
    return fields.select(*out)


def encode_delta(routed: DataFrame) -> DataFrame:
    fields = routed.select(
        *_common(int_at("msg.ts_ms")),
        _or_empty(text_at("msg.market_ticker")).alias("market_ticker"),
        text_at("msg.market_id").alias("market_id"),
        _or_empty(text_at("msg.side")).alias("side"),
        text_at("msg.price_dollars").alias("price"),
        text_at("msg.delta_fp").alias("delta"),
    )
    return _with_duals(fields, ["market_ticker", "market_id", "side", ("price", PX_DIGITS), ("delta", QTY_DIGITS)])


def encode_ticker(routed: DataFrame) -> DataFrame:
    fields = routed.select(
        *_common(_ts_with_fallback()),
        _or_empty(text_at("msg.market_ticker")).alias("market_ticker"),
        text_at("msg.market_id").alias("market_id"),
        *[text_at(f"msg.{n}_dollars").alias(n) for n in ("price", "yes_bid", "yes_ask")],
        *[text_at(f"msg.{n}_fp").alias(n) for n in ("yes_bid_size", "yes_ask_size", "volume", "open_interest")],
    )
    return _with_duals(fields, [
        "market_ticker", "market_id", ("price", PX_DIGITS), ("yes_bid", PX_DIGITS), ("yes_ask", PX_DIGITS),
        ("yes_bid_size", QTY_DIGITS), ("yes_ask_size", QTY_DIGITS), ("volume", QTY_DIGITS), ("open_interest", QTY_DIGITS),
    ])


def encode_trade(routed: DataFrame) -> DataFrame:
    fields = routed.select(
        *_common(_ts_with_fallback()),
        text_at("msg.trade_id").alias("trade_id"),
        _or_empty(text_at("msg.market_ticker")).alias("market_ticker"),
        text_at("msg.yes_price_dollars").alias("yes_price"),
        text_at("msg.no_price_dollars").alias("no_price"),
        text_at("msg.count_fp").alias("count"),
        text_at("msg.taker_outcome_side").alias("taker_outcome_side"),
        text_at("msg.taker_book_side").alias("taker_book_side"),
        text_at("msg.taker_side").alias("taker_side_deprecated"),
        bool_at("msg.is_block_trade").alias("is_block_trade"),
    )
    return _with_duals(fields, [
        "trade_id", "market_ticker", ("yes_price", PX_DIGITS), ("no_price", PX_DIGITS), ("count", QTY_DIGITS),
        "taker_outcome_side", "taker_book_side", "taker_side_deprecated", "is_block_trade",
    ])


def encode_lifecycle(routed: DataFrame) -> DataFrame:
    """Market and event transitions. An event frame has no market, so its event ticker stands in."""
    fields = routed.select(
        *_common(loose_int_at("msg.ts_ms")),
        _or_empty(loose_text_at("msg.event_type")).alias("event_type"),
        F.coalesce(loose_text_at("msg.market_ticker"), loose_text_at("msg.event_ticker"), F.lit("")).alias("market_ticker"),
        loose_text_at("msg.result").alias("result"),
        loose_text_at("msg.settlement_value").alias("settlement_value"),
        *[loose_int_at(f"msg.{n}").alias(n) for n in ("open_ts", "close_ts", "determination_ts", "settled_ts")],
        bool_at("msg.is_deactivated").alias("is_deactivated"),
        loose_text_at("msg.price_level_structure").alias("price_level_structure"),
    )
    return _with_duals(fields, [
        "event_type", "market_ticker", "result", ("settlement_value", PX_DIGITS), "open_ts", "close_ts",
        "determination_ts", "settled_ts", "is_deactivated", "price_level_structure",
    ])


def encode_fee_update(routed: DataFrame) -> DataFrame:
    """A cleared override is a row of its own with NULL values."""
    return routed.select(
        *_common(loose_int_at("msg.ts_ms")),
        _or_empty(text_at("msg.event_ticker")).alias("event_ticker"),
        text_at("msg.fee_type_override").alias("fee_type_override"),
        number_text_at("msg.fee_multiplier_override").alias("fee_multiplier_override_raw"),
    )


def encode_price_ranges(routed: DataFrame) -> DataFrame:
    """Grid observations. ``effective_at`` is only what the wire said, never the time of reading."""
    fields = routed.select(
        *_common(loose_int_at("msg.ts_ms")),
        _or_empty(loose_text_at("msg.market_ticker")).alias("market_ticker"),
        F.coalesce(loose_text_at("msg.source"), F.lit("discovery")).alias("source"),
        loose_int_at("msg.effective_at_ns").alias("effective_at"),
        loose_text_at("msg.price_level_structure").alias("price_level_structure"),
        F.expr(f"coalesce(to_json({_get('msg.price_ranges', 'variant')}), '')").alias("price_ranges_raw"),
        F.expr(f"size({_get('msg.price_ranges', 'array<variant>')})").alias("band_count"),
    )
    return fields.withColumn("price_ranges_hash", grid_hash("price_ranges_raw")).withColumn(
        "band_count", F.when(F.col("band_count") >= 0, F.col("band_count"))
    )


def encode_control(routed: DataFrame) -> DataFrame:
    code = loose_int_at("msg.code")
    return routed.select(
        *_common(F.lit(None), F.coalesce(unsigned_at("sid"), unsigned_at("msg.sid"))),
        F.col("message_type"),
        loose_text_at("msg.channel").alias("channel"),
        F.when(code.between(-(2**31), 2**31 - 1), code).cast("int").alias("error_code"),
        loose_text_at("msg.msg").alias("error_message"),
    )


def encode_unparsed(routed: DataFrame) -> DataFrame:
    """What could not be typed, with its place in the sequence stream and the reason."""
    return routed.select(*_common(F.lit(None)), F.col("parse_error"), F.col("message_type"))


ENCODERS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "orderbook_snapshot": encode_snapshot,
    "orderbook_delta": encode_delta,
    "ticker": encode_ticker,
    "trade": encode_trade,
    "market_lifecycle": encode_lifecycle,
    "event_fee_update": encode_fee_update,
    "price_ranges": encode_price_ranges,
    "control": encode_control,
    "unparsed": encode_unparsed,
}


def decode_channel(routed: DataFrame, channel: str) -> DataFrame:
    """The typed table of one channel, columns in schema order."""
    encoded = ENCODERS[channel](routed.where(F.col("channel") == channel))
    return encoded.select(*channel_schema(channel).fieldNames())


def decode(frames: DataFrame) -> dict[str, DataFrame]:
    """All nine tables of a batch of frames. ``price_ranges`` stays empty: no wire type feeds it."""
    routed = route(frames)
    return {channel: decode_channel(routed, channel) for channel in ENCODERS}


def expected_rows(routed: DataFrame) -> DataFrame:
    """Rows each channel must receive: a snapshot counts its levels, at least one; all else counts one."""
    rows = F.when(F.col("channel") == "orderbook_snapshot", F.greatest(F.size(tagged_levels()), F.lit(1))).otherwise(1)
    return routed.groupBy("channel").agg(
        F.count("*").alias("records"), F.sum(rows).cast("bigint").alias("rows_expected")
    )


def rederive(stored: DataFrame, channel: str) -> DataFrame:
    """Rebuild the typed columns of a stored table from its raw text.

    A snapshot's text is stored once per level, so distinct frames are taken first.
    The caller's channel stands, as the grid channel has no wire type of its own.
    """
    frames = stored.select("received_at_ns", "session_id", "raw_message")
    if channel == "orderbook_snapshot":
        frames = frames.distinct()
    return decode_channel(route(frames).withColumn("channel", F.lit(channel)), channel)


def non_lifecycle(routed: DataFrame) -> DataFrame:
    """Frames of the per-market channels only."""
    return routed.where(F.col("channel") != "market_lifecycle")
