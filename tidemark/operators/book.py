"""Order books rebuilt from snapshots and deltas, readable only while they can be trusted.

Frames of many markets share one numbered stream, so continuity is judged on the
stream and validity on the market: a book holds from its own snapshot until the
first break of its stream or its own first impossible delta.

An *epoch* is the life of one accepted snapshot, named by its place in arrival
order. Level sizes are running sums inside an epoch; nothing is replayed row by
row except the best bid and offer, and that in pieces of bounded length.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import fixed, tickers
from tidemark.operators.ordered import TIME_CHUNK_NS, Run, running, time_chunk
from tidemark.operators.sequence import STREAM, sequence_verdicts
from tidemark.session import materialize

MARKET = (*STREAM, "market_ticker")
ORDER = ("received_at_ns", "seq")
EPOCH = ("epoch_ns", "epoch_seq")
LEVEL = ("book_side", "price_micros")
# Frames replayed in one piece; bounds the memory of a replay task whatever the market.
REPLAY_FRAMES = 20_000

FRAME_COLUMNS = (*STREAM, "market_ticker", *ORDER, "is_snapshot", "side", "price_micros", "delta_fp_units")


def snapshot_faults(levels: DataFrame) -> DataFrame:
    """Levels that are not strictly ascending within their frame and side, or have no readable price.

    The exchange sends best bid last; a frame with any fault is refused whole.
    """
    frame = Window.partitionBy(*MARKET, *ORDER, "side").orderBy("level_index")
    before = F.lag("price_micros").over(frame)
    reason = (
        F.when(F.col("price_micros").isNull() | F.col("size_fp_units").isNull(), "unreadable")
        .when(F.col("price_micros") == F.col("previous"), "duplicate")
        .when(F.col("price_micros") < F.col("previous"), "unsorted")
    )
    return (
        levels.where("side IS NOT NULL")
        .withColumn("previous", before)
        .withColumn("fault", reason)
        .where("fault IS NOT NULL")
        .select(*MARKET, *ORDER, "side", "level_index", "previous", "price_micros", "fault")
    )


def accepted_levels(levels: DataFrame) -> DataFrame:
    """Snapshot levels without the frames that are refused."""
    refused = snapshot_faults(levels).select(*MARKET, *ORDER).distinct()
    return levels.join(refused, [*MARKET, *ORDER], "left_anti")


def book_frames(levels: DataFrame, deltas: DataFrame, others: DataFrame | None = None) -> DataFrame:
    """One row per frame of the stream. ``others`` are frames that only use up sequence numbers."""
    nothing = {"side": "string", "price_micros": "bigint", "delta_fp_units": "bigint"}
    blanks = [F.lit(None).cast(t).alias(n) for n, t in nothing.items()]
    snapshots = levels.groupBy(*MARKET, *ORDER).agg(F.lit(True).alias("is_snapshot")).select(
        *MARKET, *ORDER, "is_snapshot", *blanks
    )
    changes = deltas.select(*MARKET, *ORDER, F.lit(False).alias("is_snapshot"), "side", "price_micros", "delta_fp_units")
    frames = snapshots.unionByName(changes)
    if others is not None:
        frames = frames.unionByName(
            others.select(
                *STREAM, F.lit(None).cast("string").alias("market_ticker"), *ORDER, F.lit(False).alias("is_snapshot"), *blanks
            )
        )
    return frames.where("sid IS NOT NULL AND seq IS NOT NULL").select(*FRAME_COLUMNS)


def stream_state(frames: DataFrame, width: int = TIME_CHUNK_NS) -> DataFrame:
    """Verdict of every frame on its stream, and how many breaks the stream has had so far."""
    verdicts = sequence_verdicts(frames, width=width)
    return materialize(
        running(
            verdicts, STREAM, ORDER, time_chunk(ORDER[0], width), {"breaks": Run("count", F.col("is_break"))}, inclusive=True
        )
    )


def frame_outcomes(state: DataFrame, width: int = TIME_CHUNK_NS) -> DataFrame:
    """What each frame does to its market's book, sequence only; impossible deltas are found later.

    ``seed`` and ``candidate`` reach the book; ``gapped``, ``regression`` and
    ``discarded_invalid`` do not.
    """
    own = state.where("market_ticker IS NOT NULL")
    placed = running(
        own, MARKET, ORDER, time_chunk(ORDER[0], width),
        {"_epoch": Run("last", F.when(F.col("is_snapshot"), F.struct(*ORDER, "breaks")))}, inclusive=True,
    )
    since = F.col("breaks") - F.col("_epoch.breaks")
    outcome = (
        F.when(F.col("is_snapshot"), "seed")
        .when(F.col("_epoch").isNull(), "discarded_invalid")
        .when((since == 1) & F.col("is_break"), "gapped")
        .when(since > 0, "discarded_invalid")
        .when(F.col("verdict") == "regression", "regression")
        .otherwise("candidate")
    )
    return placed.select(
        "*",
        F.col("_epoch.received_at_ns").alias("epoch_ns"),
        F.col("_epoch.seq").alias("epoch_seq"),
        outcome.alias("outcome"),
    ).drop("_epoch")


def with_convention(rows: DataFrame, sessions: DataFrame) -> DataFrame:
    """Add the pricing convention of the row's session. A row without one fails later, in the price conversion."""
    return rows.join(sessions.select("session_id", "pricing_convention"), "session_id", "left")


def _canonical(rows: DataFrame, convention: Column) -> DataFrame:
    """YES bids stay; a NO bid becomes a YES ask at the converted price."""
    return rows.withColumn("book_side", F.when(F.col("side") == "yes", "bid").otherwise("ask")).withColumn(
        "price_micros", tickers.yes_price("side", "price_micros", convention)
    )


def level_changes(outcomes: DataFrame, levels: DataFrame, convention: Column | None = None) -> DataFrame:
    """Signed size changes per canonical level: snapshot sizes as seeds, then the candidate deltas.

    ``convention`` defaults to a ``pricing_convention`` column on both inputs.
    """
    rule = F.col("pricing_convention") if convention is None else convention
    seeds = (
        _canonical(levels.where("side IS NOT NULL AND size_fp_units <> 0"), rule)
        .select(
            *MARKET, F.col("received_at_ns").alias("epoch_ns"), F.col("seq").alias("epoch_seq"), *ORDER, *LEVEL,
            F.col("size_fp_units").alias("change"), F.lit(True).alias("is_seed"),
        )
    )
    moves = _canonical(
        outcomes.where("outcome = 'candidate' AND price_micros IS NOT NULL AND delta_fp_units IS NOT NULL"), rule
    ).select(*MARKET, *EPOCH, *ORDER, *LEVEL, F.col("delta_fp_units").alias("change"), F.lit(False).alias("is_seed"))
    return seeds.unionByName(moves)


def level_history(changes: DataFrame, width: int = TIME_CHUNK_NS) -> DataFrame:
    """Size of the touched level after each change, and whether that was possible.

    ``is_desync`` marks the first change of an epoch that would leave a level
    below zero; later changes of that epoch are dropped, as the book is invalid.
    """
    sized = materialize(
        running(
            changes, [*MARKET, *EPOCH, *LEVEL], ORDER, time_chunk(ORDER[0], width),
            {"size_fp_units": Run("sum", F.col("change"))}, inclusive=True,
        )
    )
    desync = sized.where("size_fp_units < 0").groupBy(*MARKET, *EPOCH).agg(F.min(F.struct(*ORDER)).alias("_broken"))
    here = F.struct(*ORDER)
    return (
        sized.join(desync, [*MARKET, *EPOCH], "left")
        .where(F.col("_broken").isNull() | (here <= F.col("_broken")))
        .withColumn("is_desync", F.coalesce(here == F.col("_broken"), F.lit(False)))
        .drop("_broken")
    )


def delta_outcomes(outcomes: DataFrame, history: DataFrame) -> DataFrame:
    """Final outcome of each delta; a desync is an applied frame that broke the book, not a gap."""
    desync = history.where("is_desync").groupBy(*MARKET, *EPOCH).agg(F.min(F.struct(*ORDER)).alias("_broken"))
    here = F.struct(*ORDER)
    after = F.col("_broken").isNotNull() & (here > F.col("_broken"))
    return (
        outcomes.where("NOT is_snapshot")
        .join(desync, [*MARKET, *EPOCH], "left")
        .select(
            *MARKET, *ORDER, *EPOCH, "side", "price_micros", "delta_fp_units",
            F.when(after, "discarded_invalid").when(F.col("outcome") == "candidate", "applied").otherwise(F.col("outcome")).alias("outcome"),
            F.coalesce(here == F.col("_broken"), F.lit(False)).alias("is_desync"),
        )
    )


def snapshot_continuity(outcomes: DataFrame, final: DataFrame, width: int = TIME_CHUNK_NS) -> DataFrame:
    """How each snapshot's number relates to the last one its own book took: initial, continues or restarts."""
    taken = final.where("outcome IN ('applied', 'gapped')").select(*MARKET, *ORDER, F.lit(False).alias("is_snapshot"))
    rows = outcomes.where("is_snapshot").select(*MARKET, *ORDER, "is_snapshot").unionByName(taken)
    ran = running(rows, MARKET, ORDER, time_chunk(ORDER[0], width), {"previous_seq": Run("last", F.col("seq"))})
    kind = (
        F.when(F.col("previous_seq").isNull(), "initial")
        .when(F.col("seq") > F.col("previous_seq"), "continues")
        .otherwise("restarts")
    )
    return ran.where("is_snapshot").select(*MARKET, *ORDER, "previous_seq", kind.alias("continuity"))


BBO_FIELDS = ("bid_micros", "bid_size", "ask_micros", "ask_size", "bid_depth", "ask_depth")


def _replay(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Best levels after each frame. Rows come sorted by book, piece and step, in batches of any length.

    Only the ladders of the current book are held. Carried levels have a
    negative step and give no output of their own.
    """
    group = frame = None
    sizes: dict = {}
    ladders: dict = {}

    def top() -> tuple:
        bids, asks = ladders["bid"], ladders["ask"]
        bid, ask = (bids[-1] if bids else None), (asks[0] if asks else None)
        return (*group[:5], *frame[1:], bid, sizes["bid"].get(bid), ask, sizes["ask"].get(ask), len(bids), len(asks))

    names = [*MARKET, *EPOCH, *ORDER, *BBO_FIELDS]

    def packed(out: list) -> pd.DataFrame:
        return pd.DataFrame(out, columns=names).astype(dict.fromkeys(BBO_FIELDS, "Int64"))

    for batch in batches:
        out = []
        columns = [batch[c].tolist() for c in (*MARKET, *EPOCH, "piece", "step", *ORDER, *LEVEL, "size_fp_units")]
        for row in zip(*columns):
            side, price, size = row[9:]
            if frame is not None and (row[:6] != group or row[6:9] != frame) and frame[0] >= 0:
                out.append(top())
            if row[:6] != group:
                group = row[:6]
                sizes, ladders = {"bid": {}, "ask": {}}, {"bid": [], "ask": []}
            frame = row[6:9]
            if size == 0:
                if sizes[side].pop(price, None) is not None:
                    del ladders[side][bisect_left(ladders[side], price)]
            else:
                if price not in sizes[side]:
                    insort(ladders[side], price)
                sizes[side][price] = size
        yield packed(out)
    if frame is not None and frame[0] >= 0:
        yield packed([top()])


def best_levels(history: DataFrame, piece: int = REPLAY_FRAMES, width: int = TIME_CHUNK_NS) -> DataFrame:
    """Best bid and offer with sizes and depths after every frame of every valid book.

    An epoch is cut into pieces of at most ``piece`` deltas. Each piece starts
    from the levels alive at its start, which are known from the running sizes,
    so a busy market is replayed by many tasks.
    """
    good = history.where("NOT is_desync")
    counted = running(
        good, [*MARKET, *EPOCH], ORDER, time_chunk(ORDER[0], width), {"step": Run("count", ~F.col("is_seed"))}, inclusive=True
    )
    pieces = materialize(counted.withColumn("piece", fixed.int_div("step", piece)))
    level = Window.partitionBy(*MARKET, *EPOCH, *LEVEL).orderBy("piece")
    last_piece = pieces.groupBy(*MARKET, *EPOCH).agg(F.max("piece").alias("_last"))
    carried = (
        pieces.groupBy(*MARKET, *EPOCH, *LEVEL, "piece")
        .agg(F.max(F.struct("step", *ORDER, "size_fp_units")).alias("_end"))
        .withColumn("_next", F.lead("piece").over(level))
        .where("_end.size_fp_units > 0")
        .join(last_piece, [*MARKET, *EPOCH])
        .withColumn("_until", F.coalesce("_next", "_last"))
        .where("_until > piece")
        .select(
            *MARKET, *EPOCH, *LEVEL, F.explode(F.sequence(F.col("piece") + 1, F.col("_until"))).alias("piece"),
            F.lit(-1).cast("bigint").alias("step"), "_end.received_at_ns", "_end.seq", "_end.size_fp_units",
        )
    )
    columns = [*MARKET, *EPOCH, *LEVEL, "piece", "step", *ORDER, "size_fp_units"]
    schema = ", ".join(
        ["session_id string", "sid bigint", "market_ticker string"] + [f"{c} bigint" for c in (*EPOCH, *ORDER, *BBO_FIELDS)]
    )
    book = [*MARKET, *EPOCH, "piece"]
    rows = pieces.select(columns).unionByName(carried.select(columns))
    return rows.repartition(*book).sortWithinPartitions(*book, "step", *ORDER).mapInPandas(_replay, schema)


def with_spread(bbo: DataFrame) -> DataFrame:
    """Spread, floor midpoint and whether the book is locked (equal) or crossed (bid above ask)."""
    bid, ask = F.col("bid_micros"), F.col("ask_micros")
    return bbo.select(
        "*",
        fixed.checked_subtract(ask, bid).alias("spread_micros"),
        F.when(bid.isNotNull() & ask.isNotNull(), fixed.midpoint(bid, ask)).alias("mid_micros"),
        F.coalesce(bid == ask, F.lit(False)).alias("is_locked"),
        F.coalesce(bid > ask, F.lit(False)).alias("is_crossed"),
    )


def invalidate_on_cross(bbo: DataFrame) -> DataFrame:
    """Strict reading: the first frame that locks or crosses a book ends its epoch, itself not applied."""
    touching = bbo.where(F.col("bid_micros") >= F.col("ask_micros"))
    first = touching.groupBy(*MARKET, *EPOCH).agg(F.min(F.struct(*ORDER)).alias("_crossed"))
    return (
        bbo.join(first, [*MARKET, *EPOCH], "left")
        .where(F.col("_crossed").isNull() | (F.struct(*ORDER) < F.col("_crossed")))
        .drop("_crossed")
    )


def invariant_findings(history: DataFrame, bbo: DataFrame) -> DataFrame:
    """Violations as rows: a size below zero, a locked or a crossed book."""
    negative = history.where("is_desync").select(*MARKET, *ORDER, F.lit("negative_quantity").alias("finding"))
    touch = with_spread(bbo).where("is_locked OR is_crossed").select(
        *MARKET, *ORDER, F.when(F.col("is_crossed"), "crossed").otherwise("locked").alias("finding")
    )
    return negative.unionByName(touch)


def book_at(state: DataFrame, history: DataFrame, at_ns: int) -> DataFrame:
    """Levels of every book that is valid at ``at_ns``: newest epoch, no stream break since, no desync.

    Aggregations only; an invalid book gives no rows.
    """
    upto = F.col("received_at_ns") <= at_ns
    past = state.where(upto)
    breaks = past.groupBy(*STREAM).agg(F.max("breaks").alias("_breaks_now"))
    seeded = (
        past.where("is_snapshot AND market_ticker IS NOT NULL")
        .groupBy(*MARKET)
        .agg(F.max(F.struct(*ORDER, "breaks")).alias("_epoch"))
        .join(breaks, list(STREAM))
        .where("_epoch.breaks = _breaks_now")
        .select(*MARKET, F.col("_epoch.received_at_ns").alias("epoch_ns"), F.col("_epoch.seq").alias("epoch_seq"))
    )
    known = history.where(upto)
    broken = known.where("is_desync").select(*MARKET, *EPOCH).distinct()
    live = seeded.join(broken, [*MARKET, *EPOCH], "left_anti")
    return (
        known.join(live, [*MARKET, *EPOCH], "left_semi")
        .groupBy(*MARKET, *EPOCH, *LEVEL)
        .agg(F.max(F.struct(*ORDER, "size_fp_units"))["size_fp_units"].alias("size_fp_units"))
        .where("size_fp_units > 0")
    )


def book_view(levels: DataFrame) -> DataFrame:
    """Ladders per book: YES bids and asks ascending, derived NO bids, depths, best levels, spread and mid.

    A ladder holds one entry per tick at most, so its length is bounded by the grid.
    """
    entry = F.struct(F.col("price_micros").alias("price"), F.col("size_fp_units").alias("size"))

    def ladder(side: str) -> Column:
        return F.array_sort(F.collect_list(F.when(F.col("book_side") == side, entry)))

    view = levels.groupBy(*MARKET).agg(ladder("bid").alias("bids"), ladder("ask").alias("asks"))
    view = view.select(
        "*",
        F.transform("asks", lambda a: F.struct(fixed.complement(a["price"]).alias("price"), a["size"].alias("size"))).alias("no_bids"),
        F.size("bids").cast("bigint").alias("bid_depth"),
        F.size("asks").cast("bigint").alias("ask_depth"),
        F.try_element_at("bids", F.lit(-1))["price"].alias("bid_micros"),
        F.try_element_at("asks", F.lit(1))["price"].alias("ask_micros"),
    )
    return with_spread(view)
