"""Receive and exchange clocks. Receive time is BIGINT nanoseconds; Spark timestamps hold microseconds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.fixed import as_col, floor_div

DAY_MS = 86_400_000

# Clock-skew thresholds in milliseconds.
SKEW_WARN_MS = 5_000
SKEW_ERROR_MS = 30_000


def received_ts(ns: Column | str) -> Column:
    return F.timestamp_micros(floor_div(ns, 1_000))


def received_ms(ns: Column | str) -> Column:
    """Whole milliseconds by integer division: rounding would move a row across a bucket edge."""
    return floor_div(ns, 1_000_000)


def utc_day(ms: Column | str) -> Column:
    """Days since the epoch; independent of the session time zone."""
    return floor_div(ms, DAY_MS)


def day_date(day: Column | str) -> Column:
    return F.date_add(F.lit("1970-01-01").cast("date"), as_col(day).cast("int"))


def partition_date(ns: Column | str) -> Column:
    """UTC date partition of a receive time."""
    return day_date(floor_div(ns, DAY_MS * 1_000_000))


def parse_instant(text: Column | str) -> Column:
    """ISO-8601 text with ``Z`` or an offset -> TIMESTAMP, NULL when unreadable."""
    return as_col(text).try_cast("timestamp")


def parse_instant_ms(text: Column | str) -> Column:
    return floor_div(F.unix_micros(parse_instant(text)), 1_000)


def feed_latency_ms(ns: Column | str, exchange_ms: Column | str) -> Column:
    return received_ms(ns) - as_col(exchange_ms)


def skew_class(latency_ms: Column | str) -> Column:
    size = F.abs(as_col(latency_ms))
    return F.when(size >= SKEW_ERROR_MS, "error").when(size >= SKEW_WARN_MS, "warn").when(size.isNotNull(), "ok")
