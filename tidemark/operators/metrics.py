"""Operational figures from the tables: rates, stalls, health, subscriptions and their correlations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import tickers
from tidemark.functions.clocks import feed_latency_ms, received_ms, skew_class
from tidemark.functions.fixed import floor_div
from tidemark.operators.ordered import TIME_CHUNK_MS, Run, running, time_chunk

MINUTE_MS = 60_000
# Silence that means a dead connection, and heartbeat age that means a stall.
IDLE_MS = 35_000
STALE_SECONDS = 180


def minute_metrics(routed: DataFrame) -> DataFrame:
    """Messages, bytes, lifecycle and unparsed frames per minute; the rate is kept as per mille per second."""
    minute = (floor_div(received_ms("received_at_ns"), MINUTE_MS) * MINUTE_MS).alias("minute_ms")
    return (
        routed.groupBy(minute)
        .agg(
            F.count("*").alias("messages"),
            F.sum(F.octet_length("raw_message")).alias("bytes"),
            F.count_if(F.col("channel") == "market_lifecycle").alias("lifecycle_events"),
            F.count_if(F.col("channel") == "unparsed").alias("unparsed"),
        )
        .withColumn("milli_per_second", floor_div(F.col("messages") * 1000, 60))
    )


def stalls(frames: DataFrame, at: str = "received_ms", tie: Sequence[str] = (), idle_ms: int = IDLE_MS,
           width: int = TIME_CHUNK_MS) -> DataFrame:
    """Silences longer than ``idle_ms`` inside a session."""
    before = running(frames, ["session_id"], [at, *tie], time_chunk(at, width), {"from_ms": Run("max", F.col(at))})
    return before.where(F.col(at) - F.col("from_ms") > idle_ms).select(
        "session_id", "from_ms", F.col(at).alias("to_ms"), (F.col(at) - F.col("from_ms")).alias("silent_ms")
    )


def last_seen(frames: DataFrame, now_ms: int, at: str = "received_ms") -> DataFrame:
    """Newest frame per session and whether it is older than the stall limit."""
    age = F.lit(now_ms) - F.max(at)
    return frames.groupBy("session_id").agg(F.max(at).alias("last_ms"), age.alias("age_ms")).withColumn(
        "is_stale", F.col("age_ms") > STALE_SECONDS * 1000
    )


def feed_latency(rows: DataFrame, keys: Sequence[str] = ("session_id",)) -> DataFrame:
    """Receive minus exchange clock: range, total and how many rows are in each skew class."""
    late = rows.where("exchange_ts_ms IS NOT NULL").withColumn("_late", feed_latency_ms("received_at_ns", "exchange_ts_ms"))
    kind = skew_class("_late")
    return late.groupBy(*keys).agg(
        F.count("*").alias("rows"),
        F.min("_late").alias("min_ms"),
        F.max("_late").alias("max_ms"),
        F.sum("_late").alias("total_ms"),
        F.count_if(kind == "warn").alias("warn"),
        F.count_if(kind == "error").alias("error"),
    )


def health_class(heartbeat_age_s: Column, rows_lost: Column, misses: Column, stale_after_s: int = STALE_SECONDS) -> Column:
    """Status of a capture: no heartbeat, stalled, capturing with issues, or capturing."""
    return (
        F.when(heartbeat_age_s.isNull(), "no_heartbeat")
        .when(heartbeat_age_s > stale_after_s, "stalled")
        .when((F.coalesce(rows_lost, F.lit(0)) > 0) | (F.coalesce(misses, F.lit(0)) > 0), "issues")
        .otherwise("good")
    )


def subscription_map(rows: DataFrame) -> DataFrame:
    """Channels and number of distinct markets carried by each subscription.

    Markets are made distinct before they are counted, so that one busy
    subscription spreads over its markets.
    """
    pairs = rows.where("sid IS NOT NULL").groupBy("session_id", "sid", "channel", "market_ticker").agg(F.lit(1).alias("_one"))
    per_market = pairs.groupBy("session_id", "sid", "market_ticker").agg(F.collect_set("channel").alias("_channels"))
    return per_market.groupBy("session_id", "sid").agg(
        F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_set("_channels")))), ",").alias("channels"),
        F.count("market_ticker").alias("markets"),
    )


def subscription_channels(control: DataFrame) -> DataFrame:
    """sid -> channel from the acknowledgements of a session."""
    return (
        control.where("message_type = 'subscribed' AND sid IS NOT NULL")
        .groupBy("session_id", "sid")
        .agg(F.min("channel").alias("subscribed_channel"))
    )


def with_subscription(rows: DataFrame, control: DataFrame) -> DataFrame:
    """Data rows with the channel their subscription was opened for (NULL when never acknowledged)."""
    return rows.join(subscription_channels(control), ["session_id", "sid"], "left")


def attribute_errors(control: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """Error frames carry no sid: find their subscriptions by the market named in their raw text.

    ``subscriptions`` lists distinct ``(session_id, sid, market_ticker)``.
    """
    market = F.try_variant_get(F.try_parse_json("raw_message"), "$.msg.market_ticker", "string")
    errors = control.where("message_type = 'error'").select(
        "session_id", "received_at_ns", "error_code", market.alias("market_ticker"),
        tickers.recovery_for_error("error_code").alias("recovery"),
    )
    return errors.join(
        subscriptions.select("session_id", "market_ticker", "sid"), ["session_id", "market_ticker"], "left"
    )


def gaps_near_determination(gaps: DataFrame, determined: DataFrame, slack_ms: int) -> DataFrame:
    """How many sequence gaps have a market determination within ``slack_ms`` in the same session.

    ``gaps`` carries ``(session_id, gap_id, at_ms)``. Time is cut in slack-wide
    cells; a gap looks into its own and the two neighbouring cells, an equality
    join. Determinations are reduced to the first and last of each cell, which
    is all the question needs.
    """
    cells = (
        determined.groupBy("session_id", floor_div("at_ms", slack_ms).alias("cell"))
        .agg(F.min("at_ms").alias("lo"), F.max("at_ms").alias("hi"))
    )
    cell = floor_div("at_ms", slack_ms)
    probes = gaps.select("session_id", "gap_id", "at_ms", F.explode(F.array(cell - 1, cell, cell + 1)).alias("cell"))
    near = (F.col("lo").between(F.col("at_ms") - slack_ms, F.col("at_ms") + slack_ms)) | (
        F.col("hi").between(F.col("at_ms") - slack_ms, F.col("at_ms") + slack_ms)
    )
    hits = probes.join(cells, ["session_id", "cell"]).where(near).select("session_id", "gap_id").distinct()
    totals = gaps.groupBy("session_id").agg(F.count("*").alias("gaps"))
    matched = hits.groupBy("session_id").agg(F.count("*").alias("near_determination"))
    return totals.join(matched, "session_id", "left").select(
        "session_id", "gaps", F.coalesce("near_determination", F.lit(0)).alias("near_determination")
    )


def convention_check(no_leg: DataFrame, yes_leg: DataFrame) -> DataFrame:
    """Pair a market's NO levels as seen under both conventions by wire position.

    Each pair should add to exactly $1.00; equal pairs mean that the flag did nothing.
    """
    a = no_leg.select("market_ticker", "level_index", F.col("price_micros").alias("no_leg_micros"))
    b = yes_leg.select("market_ticker", "level_index", F.col("price_micros").alias("yes_leg_micros"))
    pairs = a.join(b, ["market_ticker", "level_index"], "full")
    x, y = F.col("no_leg_micros"), F.col("yes_leg_micros")
    return (
        pairs.groupBy("market_ticker")
        .agg(
            F.count("*").alias("levels"),
            F.count_if(x + y == 1_000_000).alias("complementary"),
            F.count_if(x == y).alias("identical"),
        )
        .withColumn(
            "verdict",
            F.when(F.col("identical") == F.col("levels"), "identical")
            .when(F.col("complementary") == F.col("levels"), "complementary")
            .otherwise("mixed"),
        )
    )


