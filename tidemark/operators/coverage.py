"""How much wall-clock time a capture covered, from session records. Times are BIGINT milliseconds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.clocks import DAY_MS, day_date, utc_day
from tidemark.functions.fixed import int_div
from tidemark.operators.ordered import Run, as_of, running, time_chunk
from tidemark.session import materialize

OPEN_LIMIT_MS = 86_400_000
HOUR_MS = 3_600_000
MIN_GAP_MS = 120_000
# A supervisor stops restarting after this many starts inside the window.
BURST_WINDOW_MS = 3_600_000
BURST_STARTS = 5


def dedupe_sessions(records: DataFrame) -> DataFrame:
    """One record per session id: a copy with an end wins over one without."""
    rest = [c for c in records.columns if c not in ("session_id", "ended_ms")]
    best = F.max_by(
        F.struct(*[F.col(c) for c in records.columns if c != "session_id"]),
        F.struct(F.col("ended_ms").isNotNull(), F.coalesce("ended_ms", F.lit(0)), F.struct(*rest)),
    )
    return (
        records.where(F.coalesce("session_id", F.lit("")) != "")
        .groupBy("session_id")
        .agg(best.alias("_best"))
        .select("session_id", "_best.*")
        .select(records.columns)
    )


def classify_sessions(sessions: DataFrame, now_ms: int) -> DataFrame:
    """Closed, running (open for under a day: ends now) or unclean (died without closing: no end)."""
    started, ended = F.col("started_ms"), F.col("ended_ms")
    status = (
        F.when(started.isNull(), "no_start")
        .when(ended.isNotNull(), "closed")
        .when(F.lit(now_ms) - started < OPEN_LIMIT_MS, "running")
        .otherwise("unclean")
    )
    return sessions.select(
        "*",
        status.alias("status"),
        F.when(status == "closed", ended).when(status == "running", F.lit(now_ms).cast("bigint")).alias("effective_end_ms"),
    )


def intervals_of(classified: DataFrame) -> DataFrame:
    return classified.where(F.col("status").isin("closed", "running")).select(
        F.col("started_ms").alias("start_ms"), F.col("effective_end_ms").alias("end_ms")
    )


def merge_intervals(intervals: DataFrame, chunk_ms: int = HOUR_MS) -> DataFrame:
    """Union of intervals as islands ``(start_ms, end_ms, prev_end_ms)``; touching ones merge.

    ``prev_end_ms`` is the end of the island before, so that the hole before an
    island needs no further pass. Equal starts are folded first, which bounds the
    rows of an hour by the clock and not by the number of sessions.
    """
    folded = materialize(intervals.groupBy("start_ms").agg(F.max("end_ms").alias("end_ms"))).withColumn("axis", F.lit(0))
    reached = running(
        folded, ["axis"], ["start_ms"], time_chunk("start_ms", chunk_ms), {"prev_end_ms": Run("max", F.col("end_ms"))}
    )
    opens = F.col("prev_end_ms").isNull() | (F.col("start_ms") > F.col("prev_end_ms"))
    placed = running(
        reached, ["axis"], ["start_ms"], time_chunk("start_ms", chunk_ms),
        {"island_ms": Run("max", F.when(opens, F.col("start_ms")))}, inclusive=True,
    )
    return placed.groupBy(F.col("island_ms").alias("start_ms")).agg(
        F.max("end_ms").alias("end_ms"),
        F.max(F.when(F.col("start_ms") == F.col("island_ms"), F.col("prev_end_ms"))).alias("prev_end_ms"),
    )


def gaps_between(islands: DataFrame, min_gap_ms: int = MIN_GAP_MS) -> DataFrame:
    """Complement of the islands inside their span."""
    return (
        islands.where(F.col("start_ms") - F.col("prev_end_ms") >= min_gap_ms)
        .select(F.col("prev_end_ms").alias("from_ms"), F.col("start_ms").alias("to_ms"))
        .withColumn("gap_ms", F.col("to_ms") - F.col("from_ms"))
    )


def largest_coverage_gaps(gaps: DataFrame, limit: int = 12) -> DataFrame:
    return gaps.orderBy(F.col("gap_ms").desc(), F.col("from_ms").desc(), F.col("to_ms").desc()).limit(limit)


def gap_totals(gaps: DataFrame) -> DataFrame:
    return gaps.agg(F.count("*").alias("gaps"), F.coalesce(F.sum("gap_ms"), F.lit(0)).alias("missing_ms"))


def unclean_sessions(classified: DataFrame, limit: int = 10) -> DataFrame:
    return (
        classified.where("status = 'unclean'").select("session_id", "started_ms").orderBy("started_ms", "session_id").limit(limit)
    )


def share_bp(part: Column, whole: Column) -> Column:
    """Share in hundredths of a percent; 0 for an empty whole."""
    return F.when(whole > 0, int_div(part * 10_000, whole)).otherwise(F.lit(0).cast("bigint"))


def coverage_headline(classified: DataFrame, islands: DataFrame) -> DataFrame:
    """Session counts, span and covered time. One row, also when nothing usable exists."""
    counts = classified.agg(
        F.count("*").alias("sessions"),
        F.count_if(F.col("status") == "running").alias("running"),
        F.count_if(F.col("status") == "unclean").alias("unclean"),
    )
    span = islands.agg(
        F.min("start_ms").alias("span_start_ms"),
        F.max("end_ms").alias("span_end_ms"),
        F.coalesce(F.sum(F.col("end_ms") - F.col("start_ms")), F.lit(0)).alias("covered_ms"),
    )
    # Both sides are single-row aggregates.
    return counts.join(span, F.lit(True)).withColumn(
        "covered_bp", share_bp(F.col("covered_ms"), F.coalesce(F.col("span_end_ms") - F.col("span_start_ms"), F.lit(0)))
    )


def split_by_day(intervals: DataFrame, start: str, end: str) -> DataFrame:
    """One row per UTC day an interval touches, clipped to that day."""
    first, last = utc_day(start), utc_day(F.greatest(F.col(end) - 1, F.col(start)))
    day = F.explode(F.sequence(first, last)).alias("day")
    return intervals.select("*", day).select(
        *[F.col(c) for c in intervals.columns if c not in (start, end)],
        "day",
        F.greatest(F.col(start), F.col("day") * DAY_MS).alias(start),
        F.least(F.col(end), (F.col("day") + 1) * DAY_MS).alias(end),
    )


def _days_of(span: DataFrame) -> DataFrame:
    """Every UTC day of a one-row span ``(lo_ms, hi_ms)`` with its window; days without data included."""
    return (
        span.where(F.col("lo_ms") < F.col("hi_ms"))
        .select("*", F.explode(F.sequence(utc_day("lo_ms"), utc_day(F.col("hi_ms") - 1))).alias("day"))
        .withColumn(
            "window_ms",
            F.least(F.col("hi_ms"), (F.col("day") + 1) * DAY_MS) - F.greatest(F.col("lo_ms"), F.col("day") * DAY_MS),
        )
    )


def _per_day(islands: DataFrame, span: DataFrame) -> DataFrame:
    covered = split_by_day(islands.select("start_ms", "end_ms"), "start_ms", "end_ms").groupBy("day").agg(
        F.sum(F.col("end_ms") - F.col("start_ms")).alias("covered_ms")
    )
    return _days_of(span).join(covered, "day", "left").select(
        "day", "window_ms", F.coalesce("covered_ms", F.lit(0)).alias("covered_ms")
    )


def coverage_daily(islands: DataFrame, since: str | None = None) -> DataFrame:
    """Covered share of each UTC day between first start and last end, each day judged on its own."""
    span = islands.agg(F.min("start_ms").alias("lo_ms"), F.max("end_ms").alias("hi_ms"))
    days = _per_day(islands, span)
    if since is not None:
        days = days.where(day_date("day") >= F.lit(since).cast("date"))
    whole, part = F.col("window_ms"), F.col("covered_ms")
    flag = F.when(part * 100 >= whole * 99, "").when(part * 100 < whole * 90, "MAJOR GAP").otherwise("gap")
    return days.select(
        day_date("day").alias("date"), "covered_ms", "window_ms", share_bp(part, whole).alias("covered_bp"), flag.alias("flag")
    )


def rolling_window(classified: DataFrame, now_ms: int, days: int = 7) -> tuple[DataFrame, DataFrame]:
    """Intervals clipped to the last ``days`` UTC days, and the one-row window they are judged on.

    The window never starts before the first session: time before a host ever
    captured is not a gap.
    """
    floor_ms = (now_ms // DAY_MS - (days - 1)) * DAY_MS
    clipped = (
        intervals_of(classified)
        .where(F.col("end_ms") > floor_ms)
        .select(
            F.greatest("start_ms", F.lit(floor_ms).cast("bigint")).alias("start_ms"),
            F.least("end_ms", F.lit(now_ms).cast("bigint")).alias("end_ms"),
        )
    )
    window = classified.agg(
        F.greatest(F.min("started_ms"), F.lit(floor_ms).cast("bigint")).alias("lo_ms"),
        F.lit(now_ms).cast("bigint").alias("hi_ms"),
    )
    return clipped, window


def rolling_daily(classified: DataFrame, now_ms: int, days: int = 7) -> DataFrame:
    clipped, window = rolling_window(classified, now_ms, days)
    return _per_day(merge_intervals(clipped), window).select(day_date("day").alias("date"), "covered_ms", "window_ms")


def rolling_gaps(classified: DataFrame, now_ms: int, days: int = 7, min_gap_ms: int = MIN_GAP_MS) -> DataFrame:
    """Holes of the rolling window, its two edges included, newest first."""
    clipped, window = rolling_window(classified, now_ms, days)
    edges = window.select(F.explode(F.array("lo_ms", "hi_ms")).alias("start_ms")).withColumn("end_ms", F.col("start_ms"))
    islands = merge_intervals(clipped.unionByName(edges))
    return gaps_between(islands, min_gap_ms).orderBy(F.col("from_ms").desc())


def rolling_headline(classified: DataFrame, now_ms: int, days: int = 7) -> DataFrame:
    clipped, window = rolling_window(classified, now_ms, days)
    covered = merge_intervals(clipped).agg(
        F.coalesce(F.sum(F.col("end_ms") - F.col("start_ms")), F.lit(0)).alias("covered_ms")
    )
    return covered.join(window, F.lit(True)).select(
        F.col("lo_ms").alias("window_start_ms"), "covered_ms", (F.col("hi_ms") - F.col("lo_ms")).alias("span_ms")
    )


def covered_until(islands: DataFrame, instants: DataFrame, at: str = "at_ms", chunk_ms: int = HOUR_MS) -> DataFrame:
    """Total covered time before each distinct instant.

    The islands' lengths are summed along time, and each instant looks up the
    island that began last. Instants are made distinct first, so the rows of an
    hour are bounded by the clock.
    """
    axis = F.lit(0)
    length = F.col("end_ms") - F.col("start_ms")
    summed = running(
        islands.select("start_ms", "end_ms").withColumn("axis", axis), ["axis"], ["start_ms"],
        time_chunk("start_ms", chunk_ms), {"before_ms": Run("sum", length)},
    )
    facts = summed.withColumn(at, F.col("start_ms"))
    found = as_of(
        instants.select(at).distinct().withColumn("axis", axis), facts, ["axis"], at, ["start_ms", "end_ms", "before_ms"],
        width=chunk_ms, name="_island",
    )
    within = F.least(F.col(at), F.col("_island.end_ms")) - F.col("_island.start_ms")
    return found.select(
        at, F.when(F.col("_island").isNull(), F.lit(0)).otherwise(F.col("_island.before_ms") + within).alias("covered_ms")
    )


def coverage_in_windows(islands: DataFrame, windows: DataFrame) -> DataFrame:
    """Covered and lost time inside named windows ``(name, start_ms, end_ms)``.

    Cover inside a window is cover until its end minus cover until its start:
    two look-ups per window, and no pairs of windows and islands.
    """
    instants = windows.select(F.explode(F.array("start_ms", "end_ms")).alias("at_ms"))
    until = materialize(covered_until(materialize(islands.select("start_ms", "end_ms")), instants))
    length = F.col("end_ms") - F.col("start_ms")
    part = F.col("until_end") - F.col("until_start")
    return (
        windows.join(until.select(F.col("at_ms").alias("start_ms"), F.col("covered_ms").alias("until_start")), "start_ms")
        .join(until.select(F.col("at_ms").alias("end_ms"), F.col("covered_ms").alias("until_end")), "end_ms")
        .select(
            "name", length.alias("window_ms"), part.alias("covered_ms"), (length - part).alias("lost_ms"),
            share_bp(part, length).alias("covered_bp"),
        )
    )


def quiet_or_not_captured(activity: DataFrame, islands: DataFrame, at_ms: str, bucket_ms: int = HOUR_MS) -> DataFrame:
    """Each time bucket as ``active``, ``quiet`` or ``not_captured``: absence of rows alone proves nothing."""
    counts = activity.groupBy(time_chunk(at_ms, bucket_ms).alias("bucket")).agg(F.count("*").alias("rows"))
    span = counts.agg(F.min("bucket").alias("lo"), F.max("bucket").alias("hi"))
    spine = span.where("lo IS NOT NULL").select(F.explode(F.sequence("lo", "hi")).alias("bucket"))
    covered = (
        split_by_day(islands.select("start_ms", "end_ms"), "start_ms", "end_ms")
        .where("end_ms > start_ms")
        .select(F.explode(F.sequence(time_chunk("start_ms", bucket_ms), int_div(F.col("end_ms") - 1, bucket_ms))).alias("bucket"))
        .distinct()
        .withColumn("captured", F.lit(True))
    )
    return (
        spine.join(counts, "bucket", "left")
        .join(covered, "bucket", "left")
        .select(
            (F.col("bucket") * bucket_ms).alias("bucket_ms"),
            F.coalesce("rows", F.lit(0)).alias("rows"),
            F.when(F.col("rows") > 0, "active").when(F.col("captured"), "quiet").otherwise("not_captured").alias("state"),
        )
    )


def current_session(sessions: DataFrame) -> DataFrame:
    """The open session started last, else the closed one started last."""
    return sessions.orderBy(
        F.col("ended_ms").isNull().desc(), F.col("started_ms").desc_nulls_last(), "session_id"
    ).limit(1)


def restart_bursts(
    starts: DataFrame, window_ms: int = BURST_WINDOW_MS, limit: int = BURST_STARTS
) -> DataFrame:
    """Start times with more than ``limit`` session starts in the window that ends there.

    Starts are counted per instant first, and each instant is copied to the next
    bucket, so that a bucket-wide frame sees the whole window and its size is
    bounded by the clock.
    """
    per_instant = starts.where("started_ms IS NOT NULL").groupBy("started_ms").agg(F.count("*").alias("starts"))
    home = time_chunk("started_ms", window_ms)
    copied = per_instant.withColumn("home", home).select("*", F.explode(F.array("home", F.col("home") + 1)).alias("bucket"))
    frame = Window.partitionBy("bucket").orderBy("started_ms").rangeBetween(-window_ms, 0)
    return (
        copied.withColumn("starts_in_window", F.sum("starts").over(frame))
        .where(F.col("bucket") == F.col("home"))
        .where(F.col("starts_in_window") > limit)
        .select("started_ms", "starts_in_window")
    )
