"""The market board: latest values per market, settlements, bucketed history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import tickers
from tidemark.functions.clocks import received_ms
from tidemark.functions.fixed import floor_div

LATEST = ("yes_bid_micros", "yes_ask_micros", "price_micros", "volume_fp_units", "open_interest_fp_units")
# Chart bucket widths in seconds.
BUCKETS = (60, 120, 300, 600, 900, 1800, 3600)
CHART_HOURS = (6, 24, 168)


def latest(column: str, order: Sequence[str], row: Sequence[str] = ()) -> Column:
    """Last non-NULL value. Where the order leaves a tie, all columns of ``row`` decide together, so values of different rows do not mix."""
    tie = [F.col(c).alias(f"_tie_{c}") for c in row]
    tagged = F.when(F.col(column).isNotNull(), F.struct(*order, *tie, F.col(column).alias("_value")))
    return F.max(tagged)["_value"].alias(column)


def market_board(
    ticker: DataFrame, order: Sequence[str] = ("received_at_ns", "seq"), columns: Sequence[str] = LATEST
) -> DataFrame:
    """Latest bid, ask, last price, volume and open interest of each market, and when it was last seen.

    One aggregation with map-side partials: a market with a third of all rows
    leaves each input task as one row.
    """
    return (
        ticker.groupBy("market_ticker")
        .agg(*[latest(c, order, columns) for c in columns], F.max("received_at_ns").alias("_seen"))
        .withColumn("updated_ms", received_ms("_seen"))
        .drop("_seen")
    )


def settlements(lifecycle: DataFrame, order: Sequence[str] = ("received_at_ns", "seq")) -> DataFrame:
    """Result and settlement value of each determined market."""
    return (
        lifecycle.where("event_type = 'determined'")
        .groupBy("market_ticker")
        .agg(*[latest(c, order, ("result", "settlement_value_micros")) for c in ("result", "settlement_value_micros")])
    )


def settlements_of(lifecycle: DataFrame, markets: DataFrame, order: Sequence[str] = ("received_at_ns", "seq")) -> DataFrame:
    """Settlements of listed markets only; the list prunes the lifecycle rows before they are grouped."""
    return settlements(lifecycle.join(markets.select("market_ticker"), "market_ticker", "left_semi"), order)


def with_events(board: DataFrame) -> DataFrame:
    """Split tickers into event, event date and outcome."""
    return board.select(
        "*",
        tickers.event_ticker("market_ticker").alias("event"),
        tickers.event_date("market_ticker").alias("event_date"),
        tickers.outcome("market_ticker").alias("outcome"),
    )


def board_with_settlement(board: DataFrame, settled: DataFrame) -> DataFrame:
    return with_events(board).join(settled, "market_ticker", "left")


def board_order(settled_board: DataFrame) -> DataFrame:
    """Display order: open events by date, then settled ones newest first, outcomes A to Z.

    ``position`` is the sort key within the whole board; the sort is a range
    exchange, so no task sees everything.
    """
    by_event = Window.partitionBy("event")
    lead = Window.partitionBy("event").orderBy("market_ticker")
    keyed = settled_board.select(
        "*",
        F.max(F.col("result").isNotNull() & (F.col("result") != "")).over(by_event).alias("is_settled"),
        F.coalesce(F.first("event_date").over(lead).cast("string"), F.lit("")).alias("_date"),
    )
    day = F.coalesce(F.datediff(F.col("_date").try_cast("date"), F.lit("1970-01-01").cast("date")), F.lit(-1))
    return (
        keyed.withColumn("date_key", F.when(F.col("is_settled"), -day).otherwise(day))
        .orderBy("is_settled", "date_key", "event", "outcome", "market_ticker")
        .drop("_date")
    )


def freshness(board: DataFrame) -> DataFrame:
    return board.agg(F.max("updated_ms").alias("as_of_ms"))


def bucket_seconds(hours: int) -> int:
    """Narrowest clock-friendly width that keeps a chart near 300 points."""
    target = hours * 3600 / 300
    return next((b for b in BUCKETS if b >= target), BUCKETS[-1])


def bucketed(
    ticker: DataFrame, bucket_s: int, order: Sequence[str] = ("received_at_ns", "seq"), keys: Sequence[str] = ("market_ticker",)
) -> DataFrame:
    """Last bid, ask and price per market and time bucket; empty buckets give no row."""
    start = (floor_div(received_ms("received_at_ns"), bucket_s * 1000) * bucket_s).alias("bucket_start_s")
    return ticker.groupBy(*keys, start).agg(*[latest(c, order, LATEST[:3]) for c in LATEST[:3]])


def market_history(
    ticker: DataFrame, market: str, hours: int, now_ms: int, order: Sequence[str] = ("received_at_ns", "seq")
) -> DataFrame:
    """Chart of one market. The floor is stated on the stored column, so that it reaches the scan."""
    since_ns = (now_ms - hours * 3_600_000) * 1_000_000
    rows = ticker.where((F.col("market_ticker") == market) & (F.col("received_at_ns") >= since_ns))
    return bucketed(rows, bucket_seconds(hours), order).drop("market_ticker").orderBy("bucket_start_s")
