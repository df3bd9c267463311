"""Tick-grid history: what changed, what was in force when, and prices off the grid. Times are BIGINT milliseconds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import grid, tickers
from tidemark.operators.ordered import TIME_CHUNK_MS, Run, as_of, running, time_chunk

GRID_KEY = ("market_ticker", "source")


def grid_verdicts(
    observations: DataFrame, order: Sequence[str] = ("observed_ms",), width: int = TIME_CHUNK_MS
) -> DataFrame:
    """Each observation as first, changed or unchanged against the one before it; going back is a change.

    Compared by the text itself, which cannot collide as a hash could.
    """
    seen = running(
        observations, GRID_KEY, order, time_chunk(order[0], width), {"_before": Run("last", F.col("price_ranges_raw"))}
    )
    verdict = (
        F.when(F.col("_before").isNull(), "first_observation")
        .when(F.col("_before") == F.col("price_ranges_raw"), "unchanged")
        .otherwise("changed")
    )
    return seen.withColumn("verdict", verdict).drop("_before")


def grid_changes(verdicts: DataFrame) -> DataFrame:
    """What is worth storing: first observations and changes."""
    return verdicts.where("verdict <> 'unchanged'")


def grid_counters(verdicts: DataFrame) -> DataFrame:
    """Changes recorded, repeats suppressed and (market, source) pairs tracked; every pair has one first observation."""
    return verdicts.agg(
        F.count_if(F.col("verdict") != "unchanged").alias("changes"),
        F.count_if(F.col("verdict") == "unchanged").alias("suppressed"),
        F.count_if(F.col("verdict") == "first_observation").alias("tracked"),
    )


def grid_intervals(
    changes: DataFrame, order: Sequence[str] = ("observed_ms",), width: int = TIME_CHUNK_MS
) -> DataFrame:
    """Validity ``[from_ms, to_ms)`` of each grid; ``to_ms`` is NULL for the one in force.

    A stated effective time is used where there is one, else the time of observation.
    """
    dated = changes.withColumn("from_ms", F.coalesce(F.col("effective_ms"), F.col("observed_ms")))
    axis = ["from_ms", *order]
    return running(
        dated, GRID_KEY, axis, time_chunk("from_ms", width), {"to_ms": Run("last", F.col("from_ms"))}, backward=True
    )


# At equal effective times the market's own announcement outranks what a crawl saw.
SOURCE_RANK = {"discovery": 1, "lifecycle": 2}


def grid_in_force(prices: DataFrame, observations: DataFrame, at: str, hindsight: bool = False, width: int = TIME_CHUNK_MS) -> DataFrame:
    """Add the bands in force at each price's time (NULL before any was), from every source's observations.

    Two times count: since when a grid holds (``effective_ms``, else ``observed_ms``) and when it was seen. In force is the newest by the first
    among those that hold and have been seen by then; with ``hindsight``, also those seen later, which agrees with ``grid_intervals``. Ties
    go to the lifecycle source, then the later observation, then the greater text. Stored changes serve as well as observations.
    """
    columns = observations.columns
    holds = F.coalesce("effective_ms", "observed_ms") if "effective_ms" in columns else F.col("observed_ms")
    rank = F.lit(0)
    if "source" in columns:
        for source, place in SOURCE_RANK.items():
            rank = F.when(F.col("source") == source, place).otherwise(rank)
    words = F.col("price_ranges_raw") if "price_ranges_raw" in columns else F.lit("")
    known = holds if hindsight else F.greatest(holds, "observed_ms")
    order = F.struct(holds.alias("holds"), rank.alias("rank"), F.col("observed_ms").alias("seen"), words.alias("words"), F.col("bands").alias("bands"))
    facts = observations.select("market_ticker", known.alias(at), F.lit(0).alias("_is_price"), order.alias("_grid"))
    both = prices.withColumn("_is_price", F.lit(1)).unionByName(facts, allowMissingColumns=True)
    ran = running(both, ["market_ticker"], [at, "_is_price"], time_chunk(at, width), {"_best": Run("max", F.col("_grid"))})
    return ran.where("_is_price = 1").select(*prices.columns, F.col("_best.bands").alias("bands"))


def off_grid_counts(priced: DataFrame, price: str = "price_micros") -> DataFrame:
    """Prices seen and prices off the grid in force, per market; an unknown or empty grid judges nothing."""
    off = F.coalesce((F.size("bands") > 0) & ~grid.is_on_grid("bands", price), F.lit(False))
    return priced.groupBy("market_ticker").agg(F.count("*").alias("prices"), F.count_if(off).alias("off_grid"))


def fee_in_force(trades: DataFrame, overrides: DataFrame, at: str, tie: Sequence[str] = ()) -> DataFrame:
    """Add the fee override of the trade's event at its time.

    ``has_record`` tells "cleared" (a record with NULL values) from "never set". Records of one time are told apart by ``tie``.
    """
    events = trades.withColumn("event_ticker", tickers.event_ticker("market_ticker"))
    payload = ["fee_type_override", "fee_multiplier_override_raw"]
    found = as_of(events, overrides, ["event_ticker"], at, payload, tie, name="_fee")
    return found.select(
        *events.columns, F.col("_fee").isNotNull().alias("has_record"), *[F.col(f"_fee.{p}").alias(p) for p in payload]
    )


def observations_from_discovery(markets: DataFrame) -> DataFrame:
    """One grid observation per discovered market; ``effective_ms`` stays NULL, as a crawl cannot know it."""
    return markets.where(tickers.normalize_ticker("ticker").isNotNull()).select(
        tickers.normalize_ticker("ticker").alias("market_ticker"),
        F.lit("discovery").alias("source"),
        F.col("finished_ms").alias("observed_ms"),
        F.lit(None).cast("bigint").alias("effective_ms"),
        "price_level_structure",
        "price_ranges_raw",
        (~tickers.is_canonical("ticker")).alias("was_renamed"),
    )
