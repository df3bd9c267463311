"""Reports over stored tables, each a DataFrame. Every ``now`` is an argument."""

from __future__ import annotations

from datetime import UTC, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators import audit, board, coverage, sequence
from tidemark.sources import health
from tidemark.sources.records import read_sessions
from tidemark.sources.tables import read_all, read_channel, read_sequence_columns

BOARD_DAYS = 2
SETTLEMENT_DAYS = 14


def _date(now_ms: int, days_back: int = 0) -> str:
    return str((datetime.fromtimestamp(now_ms / 1000, UTC) - timedelta(days=days_back)).date())


def market_board(spark: SparkSession, root: str, now_ms: int) -> DataFrame:
    """Board of the last days' markets with settlements, in display order."""
    today = _date(now_ms)
    bad = health.quarantined(spark, root)
    ticks = read_channel(spark, root, "ticker", _date(now_ms, BOARD_DAYS), today, bad)
    life = read_channel(spark, root, "market_lifecycle", _date(now_ms, SETTLEMENT_DAYS), today, bad)
    latest = board.market_board(ticks)
    return board.board_order(board.board_with_settlement(latest, board.settlements_of(life, latest)))


def market_history(spark: SparkSession, root: str, market: str, hours: int, now_ms: int) -> DataFrame:
    """Chart of one market over 6, 24 or 168 hours."""
    if hours not in board.CHART_HOURS:
        raise ValueError(f"hours must be one of {board.CHART_HOURS}")
    since = _date(now_ms - hours * 3_600_000)
    return board.market_history(read_channel(spark, root, "ticker", since, _date(now_ms), health.quarantined(spark, root)), market, hours, now_ms)


def integrity(spark: SparkSession, root: str, date: str | None = None) -> DataFrame:
    """Files, round trip and continuity, one verdict row each."""
    round_trip = audit.round_trip_report(read_all(spark, root, date))
    points = sequence.sequence_points(read_sequence_columns(spark, root, date))
    return audit.audit_verdict(round_trip, points, health.file_health(spark, root))


def coverage_report(spark: SparkSession, sessions_path: str, now_ms: int, since: str | None = None) -> dict[str, DataFrame]:
    """Headline, days, gaps and unclean sessions of a capture."""
    sessions = coverage.classify_sessions(coverage.dedupe_sessions(read_sessions(spark, sessions_path)), now_ms)
    islands = coverage.merge_intervals(coverage.intervals_of(sessions))
    gaps = coverage.gaps_between(islands)
    return {
        "headline": coverage.coverage_headline(sessions, islands),
        "daily": coverage.coverage_daily(islands, since),
        "gap_totals": coverage.gap_totals(gaps),
        "largest_gaps": coverage.largest_coverage_gaps(gaps),
        "unclean": coverage.unclean_sessions(sessions),
    }


