"""Sequence continuity: ``seq`` counts frames per (session, subscription), over all channels together."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.fixed import int_div
from tidemark.operators.ordered import TIME_CHUNK_NS, Run, running, running_high_water, time_chunk
from tidemark.session import materialize

STREAM = ("session_id", "sid")
LIFE = (*STREAM, "life")
# Sorts behind every number of a stream.
LAST_SEQ = (1 << 63) - 1
BITMAP_BITS = 32_768
BITMAP_BYTES = BITMAP_BITS // 8


def sequence_points(tables: Sequence[DataFrame], keys: Sequence[str] = STREAM) -> DataFrame:
    """(key, seq) of every frame in every channel; rows without a key or a number take no part."""
    parts = [t.select(*keys, "seq") for t in tables]
    union = reduce(DataFrame.unionByName, parts)
    return union.where(reduce(Column.__and__, [F.col(c).isNotNull() for c in (*keys, "seq")]))


def sequence_bitmaps(points: DataFrame, keys: Sequence[str] = STREAM) -> DataFrame:
    """One row per 32,768 consecutive numbers of a stream: lowest, highest, how many, and which.

    The set of numbers seen is kept as a bitmap that is merged map-side, so about
    one bit per frame is shuffled and repeated numbers cost nothing. A busy stream
    spreads over as many groups as it has blocks.
    """
    return (
        points.groupBy(*keys, F.bitmap_bucket_number("seq").alias("block"))
        .agg(
            F.min("seq").alias("first_seq"),
            F.max("seq").alias("last_seq"),
            F.bitmap_construct_agg(F.bitmap_bit_position("seq")).alias("bits"),
        )
        .withColumn("messages", F.bitmap_count("bits"))
    )


def sequence_summary(points: DataFrame, keys: Sequence[str] = STREAM) -> DataFrame:
    """Distinct messages, range and missing count per stream."""
    return (
        sequence_bitmaps(points, keys)
        .groupBy(*keys)
        .agg(
            F.sum("messages").alias("messages"),
            F.min("first_seq").alias("first_seq"),
            F.max("last_seq").alias("last_seq"),
        )
        .withColumn("missing", F.col("last_seq") - F.col("first_seq") + 1 - F.col("messages"))
    )


def sequence_gaps(points: DataFrame, keys: Sequence[str] = STREAM) -> DataFrame:
    """Every hole ``(after_seq, before_seq, missing)`` between neighbouring numbers of a stream.

    Blocks without holes are settled by their counts alone. Only blocks that
    lost something are opened, each at most 32,768 rows wide.
    """
    blocks = sequence_bitmaps(points, keys)
    between = Window.partitionBy(*keys).orderBy("block")
    edges = (
        blocks.select(*keys, "block", "first_seq", "last_seq")
        .withColumn("after_seq", F.lag("last_seq").over(between))
        .select(*keys, "after_seq", F.col("first_seq").alias("before_seq"))
    )
    opened = (
        blocks.where(F.col("messages") < F.col("last_seq") - F.col("first_seq") + 1)
        .select(
            *keys,
            "block",
            F.posexplode(
                F.transform(
                    F.sequence(F.lit(1), F.lit(BITMAP_BYTES)),
                    lambda i: F.conv(F.hex(F.substring("bits", i, F.lit(1))), 16, 10).cast("int"),
                )
            ).alias("octet", "mask"),
        )
        .where("mask <> 0")
        .select(
            *keys,
            "block",
            "octet",
            F.explode(
                F.filter(
                    F.array(*[F.lit(b) for b in range(8)]),
                    lambda b: F.col("mask").bitwiseAND(F.call_function("shiftleft", F.lit(1), b)) != 0,
                )
            ).alias("bit"),
        )
        .withColumn("seq", (F.col("block") - 1) * BITMAP_BITS + F.col("octet") * 8 + F.col("bit") + 1)
    )
    inside = Window.partitionBy(*keys, "block").orderBy("seq")
    holes = opened.select(*keys, F.lag("seq").over(inside).alias("after_seq"), F.col("seq").alias("before_seq"))
    return (
        edges.unionByName(holes)
        .where(F.col("before_seq") != F.col("after_seq") + 1)
        .withColumn("missing", F.col("before_seq") - F.col("after_seq") - 1)
    )


def continuity_headline(points: DataFrame, keys: Sequence[str] = STREAM) -> DataFrame:
    """Streams, messages, gaps and missing messages over everything, as one row."""
    totals = sequence_summary(points, keys).agg(
        F.count("*").alias("streams"),
        F.coalesce(F.sum("messages"), F.lit(0)).alias("messages"),
        F.coalesce(F.sum("missing"), F.lit(0)).alias("missing"),
    )
    gaps = sequence_gaps(points, keys).agg(F.count("*").alias("gaps"))
    # Both sides are single-row aggregates.
    return totals.join(gaps, F.lit(True)).withColumn(
        "missing_ppm",
        int_div(F.col("missing") * 1_000_000, F.greatest(F.col("messages") + F.col("missing"), F.lit(1))),
    )


def largest_gaps(gaps: DataFrame, limit: int = 8, keys: Sequence[str] = STREAM) -> DataFrame:
    return gaps.orderBy(F.col("missing").desc(), *keys, "after_seq").limit(limit)


def sequence_verdicts(
    frames: DataFrame,
    keys: Sequence[str] = STREAM,
    order: Sequence[str] = ("received_at_ns", "seq"),
    width: int = TIME_CHUNK_NS,
) -> DataFrame:
    """Verdict of each frame in arrival order, against a mark that a lower number never rewinds.

    ``frames`` carries ``is_snapshot``. A snapshot re-bases the mark whatever its
    number; its verdict says how it relates to the stream so far. ``is_break``
    marks frames before which something was lost on the stream, snapshots included:
    the snapshot repairs its own market, not the others on the same subscription.
    """
    marked = running_high_water(
        frames, keys, order, time_chunk(order[0], width), "seq", F.col("is_snapshot")
    )
    seq, last = F.col("seq"), F.col("high_water")
    gap = seq > last + 1
    verdict = (
        F.when(
            F.col("is_snapshot"),
            F.when(last.isNull(), "snapshot_initial").when(seq > last, "snapshot_continues").otherwise("snapshot_restarts"),
        )
        .when(last.isNull(), "first")
        .when(seq == last + 1, "in_order")
        .when(seq <= last, "regression")
        .otherwise("gap")
    )
    return marked.select(
        "*",
        verdict.alias("verdict"),
        F.when(~F.col("is_snapshot") & gap, last + 1).alias("expected"),
        F.when(~F.col("is_snapshot") & gap, seq - last - 1).alias("skipped"),
        F.coalesce(gap, F.lit(False)).alias("is_break"),
    )


def invalid_spans(
    verdicts: DataFrame,
    now_ns: int,
    keys: Sequence[str] = STREAM,
    order: Sequence[str] = ("received_at_ns", "seq"),
    width: int = TIME_CHUNK_NS,
    lives: DataFrame | None = None,
) -> DataFrame:
    """Times during which a stream could not be trusted: from registration or a gap to the next snapshot.

    A further gap inside a span does not restart it. Spans still open end at ``now_ns``. With ``lives`` (see ``lifetimes``; ``keys`` then
    include ``life``) a stream is registered when it was opened, if it has no frame too, and a span ends at the latest when it was closed.
    """
    at = order[0]
    chunk = time_chunk(at, width)
    turns = verdicts.where(F.col("is_snapshot") | (F.col("verdict") == "gap")).select(*keys, *order, "is_snapshot")
    # Validity before each turning point: set by the turn before it, invalid at first.
    stated = running(turns, keys, order, chunk, {"was_valid": Run("last", F.col("is_snapshot"))})
    changes = stated.where(F.col("is_snapshot") != F.coalesce("was_valid", F.lit(False)))
    registered = verdicts.groupBy(*keys).agg(F.min(F.struct(*order)).alias("_first")).select(*keys, "_first.*")
    if lives is not None:
        registered = lives.select(*keys, F.col("opened_ns").alias(at), F.lit(-1).cast("bigint").alias(order[1]))
    marks = changes.select(*keys, *order, F.when(F.col("is_snapshot"), 1).otherwise(0).alias("kind")).unionByName(
        registered.withColumn("kind", F.lit(-1))
    )
    if lives is not None:
        closed = lives.where("closed_ns IS NOT NULL").select(*keys, F.col("closed_ns").alias(at), F.lit(LAST_SEQ).alias(order[1]))
        marks = marks.unionByName(closed.withColumn("kind", F.lit(1)))
    # Starts and ends alternate in arrival order, so the end of a span is the next end after it.
    paired = running(
        marks, keys, [*order, "kind"], chunk, {"next_end": Run("last", F.when(F.col("kind") == 1, F.col(at)))},
        backward=True,
    )
    return paired.where("kind < 1").select(
        *keys,
        F.col(at).alias("started_ns"),
        F.coalesce("next_end", F.lit(now_ns).cast("bigint")).alias("ended_ns"),
        F.col("next_end").isNull().alias("is_open"),
    )


def stream_health(verdicts: DataFrame, spans: DataFrame, keys: Sequence[str] = STREAM) -> DataFrame:
    """Gaps, open invalidity and total invalid time per stream."""
    gaps = verdicts.groupBy(*keys).agg(F.count_if(F.col("verdict") == "gap").alias("gaps"))
    lost = spans.groupBy(*keys).agg(
        F.max("is_open").alias("is_invalid"),
        F.sum(F.col("ended_ns") - F.col("started_ns")).alias("invalid_ns"),
    )
    return gaps.join(lost, list(keys), "left").select(
        *keys,
        "gaps",
        F.coalesce("is_invalid", F.lit(False)).alias("is_invalid"),
        F.coalesce("invalid_ns", F.lit(0)).alias("invalid_ns"),
    )


def stream_totals(health: DataFrame) -> DataFrame:
    return health.agg(
        F.coalesce(F.sum("gaps"), F.lit(0)).alias("total_gaps"),
        F.count_if("is_invalid").alias("invalid_streams"),
        F.coalesce(F.sum("invalid_ns"), F.lit(0)).alias("invalid_ns"),
    )


def stream_controls(control: DataFrame, losses: DataFrame | None = None, errors: DataFrame | None = None) -> DataFrame:
    """Openings and closings ``(session_id, sid, received_at_ns, control)`` from stored control rows.

    'subscribed' opens a sid and 'unsubscribed' closes it. ``errors`` are attributed error rows (``metrics.attribute_errors``), whose
    terminal ones close; ``losses`` (session_id, received_at_ns) are lost connections, which close every sid the session has opened.
    """
    kinds = F.when(F.col("message_type") == "subscribed", "open").when(F.col("message_type") == "unsubscribed", "close")
    out = control.where("sid IS NOT NULL").select(*STREAM, "received_at_ns", kinds.alias("control")).where("control IS NOT NULL")
    closing = F.lit("close").alias("control")
    if errors is not None:
        out = out.unionByName(errors.where("recovery IS NOT NULL AND sid IS NOT NULL").select(*STREAM, "received_at_ns", closing))
    if losses is not None:
        opened = control.where("message_type = 'subscribed' AND sid IS NOT NULL").select(*STREAM).distinct()
        out = out.unionByName(losses.select("session_id", "received_at_ns").join(opened, "session_id").select(*STREAM, "received_at_ns", closing))
    return out


def lifetimes(frames: DataFrame, controls: DataFrame, width: int = TIME_CHUNK_NS) -> tuple[DataFrame, DataFrame]:
    """Frames of registered streams with their ``life``, and the lives ``(session_id, sid, life, opened_ns, closed_ns)``.

    A life runs from an opening to the next closing or opening of the same sid; its counter starts from nothing. What arrives before any
    control is life 0, opened by its first frame; frames after a closing belong to no life and are left out. At one time openings
    come before frames and closings after.
    """
    rank = F.when(F.col("control").isNull(), 1).when(F.col("control") == "open", 0).otherwise(2)
    both = frames.withColumn("control", F.lit(None).cast("string")).unionByName(
        controls.select(*STREAM, "received_at_ns", "control"), allowMissingColumns=True
    )
    lined = both.withColumn("_rank", rank).withColumn("_seq", F.coalesce("seq", F.lit(-1).cast("bigint")))
    opens = F.col("control") == "open"
    ran = running(
        lined, STREAM, ["received_at_ns", "_rank", "_seq"], time_chunk("received_at_ns", width),
        {"life": Run("count", opens), "_last": Run("last", F.col("control"))}, inclusive=True,
    )
    ran = materialize(ran)
    data = F.col("control").isNull() & ~(F.coalesce("_last", F.lit("open")) == "close")
    at = F.col("received_at_ns")
    lives = ran.groupBy(*LIFE).agg(
        F.coalesce(F.min(F.when(opens, at)), F.min(F.when(data, at))).alias("opened_ns"), F.min(F.when(F.col("control") == "close", at)).alias("_closed")
    ).where("opened_ns IS NOT NULL")
    following = F.lead("opened_ns").over(Window.partitionBy(*STREAM).orderBy("life"))
    lives = lives.select(*LIFE, "opened_ns", F.least("_closed", following).alias("closed_ns"))
    return ran.where(data).select(*frames.columns, "life"), lives


def lifetime_health(verdicts: DataFrame, spans: DataFrame, lives: DataFrame) -> DataFrame:
    """``stream_health`` of every life, and whether it has ended."""
    healthy = stream_health(verdicts, spans, LIFE)
    silent = lives.join(spans.groupBy(*LIFE).agg(F.max("is_open").alias("_open"), F.sum(F.col("ended_ns") - F.col("started_ns")).alias("_lost")), list(LIFE), "left")
    return silent.join(healthy.select(*LIFE, "gaps"), list(LIFE), "left").select(
        *LIFE,
        F.coalesce("gaps", F.lit(0)).alias("gaps"),
        F.coalesce("_open", F.lit(False)).alias("is_invalid"),
        F.coalesce("_lost", F.lit(0)).alias("invalid_ns"),
        F.col("closed_ns").isNotNull().alias("is_retired"),
    )


def live_totals(health: DataFrame) -> DataFrame:
    """``stream_totals`` of the lives that go on; one that has ended stops counting."""
    live = health.where("NOT is_retired")
    ended = health.agg(F.count_if("is_retired").alias("retired_streams"))
    # Both sides are single-row aggregates.
    return stream_totals(live).join(ended, F.lit(True))
