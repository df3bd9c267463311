"""Fixed schemas of the nine channel tables and of the session records."""

from __future__ import annotations

from pyspark.sql import types as T

from tidemark.functions.fixed import PX_DIGITS, QTY_DIGITS

COMMON = (
    "received_at_ns bigint not null, exchange_ts_ms bigint, session_id string not null, sid bigint, seq bigint, "
    "raw_message string not null"
)

EXTRAS = {
    "orderbook_snapshot": "market_ticker string not null, market_id string, side string, price_raw string, "
    "price_micros bigint, size_raw string, size_fp_units bigint, level_index int",
    "orderbook_delta": "market_ticker string not null, market_id string, side string not null, price_raw string not null, "
    "price_micros bigint, delta_raw string not null, delta_fp_units bigint",
    "ticker": "market_ticker string not null, market_id string, price_raw string, price_micros bigint, "
    "yes_bid_raw string, yes_bid_micros bigint, yes_ask_raw string, yes_ask_micros bigint, "
    "yes_bid_size_raw string, yes_bid_size_fp_units bigint, yes_ask_size_raw string, yes_ask_size_fp_units bigint, "
    "volume_raw string, volume_fp_units bigint, open_interest_raw string, open_interest_fp_units bigint",
    "trade": "trade_id string, market_ticker string not null, yes_price_raw string, yes_price_micros bigint, "
    "no_price_raw string, no_price_micros bigint, count_raw string, count_fp_units bigint, "
    "taker_outcome_side string, taker_book_side string, taker_side_deprecated string, is_block_trade boolean",
    "market_lifecycle": "event_type string not null, market_ticker string not null, result string, "
    "settlement_value_raw string, settlement_value_micros bigint, open_ts bigint, close_ts bigint, "
    "determination_ts bigint, settled_ts bigint, is_deactivated boolean, price_level_structure string",
    "event_fee_update": "event_ticker string not null, fee_type_override string, fee_multiplier_override_raw string",
    "price_ranges": "market_ticker string not null, source string not null, effective_at bigint, "
    "price_level_structure string, price_ranges_raw string not null, price_ranges_hash string not null, band_count int",
    "control": "message_type string, channel string, error_code int, error_message string",
    "unparsed": "parse_error string, message_type string",
}

CHANNELS = tuple(EXTRAS)



def _duals(columns: str) -> list[tuple[str, str, int]]:
    """Each ``*_raw`` column with the integer that follows it, and the scale its unit means."""
    names = [c.split()[0] for c in columns.split(", ")]
    scale = {"micros": PX_DIGITS, "units": QTY_DIGITS}
    return [(raw, parsed, scale[parsed.rsplit("_", 1)[1]]) for raw, parsed in zip(names, names[1:]) if raw.endswith("_raw") and parsed.rsplit("_", 1)[1] in scale]


# Raw and parsed column pairs with their scale, per channel.
DUALS = {channel: pairs for channel, columns in EXTRAS.items() if (pairs := _duals(columns))}

FRAMES = "received_at_ns bigint, session_id string, raw_message string"

SESSIONS = (
    "session_id string, started_at string, ended_at string, pricing_convention string, parser_version int, "
    "px_scale bigint, qty_scale bigint, environment string, git_sha string, docs_spec_date string, "
    "orderbook_shard_size int, channels array<string>, ws_url string"
)


def channel_schema(channel: str) -> T.StructType:
    return T.StructType.fromDDL(f"{COMMON}, {EXTRAS[channel]}")


def ddl(text: str) -> T.StructType:
    return T.StructType.fromDDL(text)
