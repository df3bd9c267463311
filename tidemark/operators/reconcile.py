"""Which markets were known, by which path, and which ones only a crawl found."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Paths a market can be learned by. At equal times the earlier one in this list wins.
SOURCES = ("startup_discovery", "lifecycle", "reconciliation")


def market_registry(sightings: DataFrame) -> DataFrame:
    """First sighting per market from ``(market_ticker, learned_via, seen_ms)``; later ones change nothing."""
    rank = F.array_position(F.array(*[F.lit(s) for s in SOURCES]), F.col("learned_via"))
    return (
        sightings.groupBy("market_ticker")
        .agg(F.min(F.struct("seen_ms", rank.alias("_rank"), "learned_via")).alias("_first"))
        .select("market_ticker", "_first.learned_via", F.col("_first.seen_ms").alias("first_seen_ms"))
    )


def missed_by_live_path(crawl: DataFrame, known: DataFrame) -> DataFrame:
    """Crawled markets that nothing had reported before. Known afterwards, so a second pass is clean."""
    return crawl.select("market_ticker").distinct().join(known.select("market_ticker"), "market_ticker", "left_anti")


def needing_subscription(offered: DataFrame, opened: DataFrame) -> DataFrame:
    """Offered markets without an open book, once each, at the first position they were offered."""
    fresh = offered.join(opened.select("market_ticker"), "market_ticker", "left_anti")
    return fresh.groupBy("market_ticker").agg(F.min("position").alias("position"))


def merge_crawl(pages: DataFrame) -> DataFrame:
    """One row per market over all status passes: the first by pass, page and place on the page."""
    order = F.struct("pass_no", "page_no", "place")
    rest = [c for c in pages.columns if c != "ticker"]
    first = F.min_by(F.struct(*rest), order)
    return pages.groupBy("ticker").agg(first.alias("_first")).select("ticker", "_first.*").select(pages.columns)


def filter_discovery(markets: DataFrame, series: list[str] | None = None, statuses: list[str] | None = None) -> DataFrame:
    """Series and status filter; an empty list means no filter."""
    out = markets
    if series:
        out = out.where(F.col("series_ticker").isin(*series))
    if statuses:
        out = out.where(F.col("status").isin(*statuses))
    return out


