"""Structured Streaming forms of ingest, metrics, trackers and books. Ordered operators use the engine's keyed state (``keyed``)."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidemark.functions.clocks import received_ts
from tidemark.operators import decode
from tidemark.operators.grids import GRID_KEY
from tidemark.operators.metrics import IDLE_MS
from tidemark.operators.reconcile import SOURCES
from tidemark.operators.sequence import STREAM
from tidemark.sources.tables import ROLL_PERIOD, fan_out
from tidemark.streaming import keyed, packs


def _start(frames: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None], period: str | None) -> StreamingQuery:
    writer = frames.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if period is None else writer.trigger(processingTime=period)
    return writer.start()


def _ingest_batch(batch: DataFrame, root: str, batch_id: int) -> None:
    fan_out(decode.route(batch), root, batch_id)  # counts what it stored, and fails if that is not all


def ingest(frames: DataFrame, root: str, checkpoint: str, period: str | None = ROLL_PERIOD) -> StreamingQuery:
    """Decode a stream of raw frames into the channel tables; each micro-batch closes its files."""
    return _start(frames, checkpoint, lambda batch, n: _ingest_batch(batch, root, n), period)


def minute_metrics(frames: DataFrame, late: str = "2 minutes") -> DataFrame:
    """Messages, bytes and unparsed frames per minute, final once the watermark has passed."""
    routed = decode.route(frames).withColumn("at", received_ts("received_at_ns")).withWatermark("at", late)
    return routed.groupBy(F.window("at", "60 seconds")).agg(
        F.count("*").alias("messages"),
        F.sum(F.octet_length("raw_message")).alias("bytes"),
        F.count_if(F.col("channel") == "market_lifecycle").alias("lifecycle_events"),
        F.count_if(F.col("channel") == "unparsed").alias("unparsed"),
    ).select(F.col("window.start").alias("minute"), "messages", "bytes", "lifecycle_events", "unparsed")


def rebuilt_sessions(frames: DataFrame, gap: str = "120 seconds", late: str = "2 minutes") -> DataFrame:
    """Capture spells from arrivals alone, for sessions whose record was never closed."""
    timed = frames.withColumn("at", received_ts("received_at_ns")).withWatermark("at", late)
    return timed.groupBy("session_id", F.session_window("at", gap)).agg(F.count("*").alias("frames")).select(
        "session_id", F.col("session_window.start").alias("started"), F.col("session_window.end").alias("ended"), "frames"
    )


# Keyed state is kept by the engine's RocksDB store; a new query takes this setting with it.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
LATE = "10 seconds"
# Markets of the registry share the state of a group; a query keeps its number of groups.
REGISTRY_GROUPS = 512


def _into(rows: DataFrame, folder: str, checkpoint: str, period: str | None) -> StreamingQuery:
    """Rows appended to the table ``folder``/out, each batch once."""
    writer = rows.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if period is None else writer.trigger(processingTime=period)
    return writer.start()


def read_output(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/out")


def _keyed(rows: DataFrame, keys: list[str], processor, schema: str, initial: DataFrame | None, mode: str = "eventTime") -> DataFrame:
    rows.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    seed = None if initial is None else initial.groupBy(*keys)
    return rows.groupBy(*keys).transformWithState(processor, schema, "Append", mode, seed)


def _packed(rows: DataFrame, keys: list[str], late: str, processor, schema: str, initial: DataFrame | None) -> DataFrame:
    """Keyed state over the packs of ``rows``, whose time is ``at``; a pack is as late as its last row."""
    rows.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    seed = None if initial is None else packs.pack(initial, keys).groupBy(*keys)
    packed = packs.pack(rows, keys, "at").withWatermark("at", late)
    return packed.groupBy(*keys).transformWithStateInPandas(processor, schema, "Append", "eventTime", seed)


def sequence_events(frames: DataFrame, payload: Sequence[str] = ()) -> DataFrame:
    """Frames as the tracker takes them: keys and numbers, ``control`` where the input has it, and their arrival as a time."""
    control = F.col("control") if "control" in frames.columns else F.lit(None).cast("string").alias("control")
    columns = ["session_id", "sid", "received_at_ns", "seq", "is_snapshot"]
    kept = frames.select(*columns, control, *payload, received_ts("received_at_ns").alias("at"))
    return kept.where("session_id IS NOT NULL AND sid IS NOT NULL AND (seq IS NOT NULL OR control IS NOT NULL)")


def live_verdicts(frames: DataFrame, late: str = LATE, initial: DataFrame | None = None) -> DataFrame:
    """Verdict rows of a stream of ``(session_id, sid, received_at_ns, seq, is_snapshot[, control])``; see ``keyed.SequenceTracker``.

    ``initial`` holds the newest verdict row per stream of an earlier query, with ``open_since_ns`` (NULL when valid).
    """
    tracker = keyed.SequenceTracker([c.split()[0] for c in keyed.VERDICT.split(", ")])
    return packs.unpack(_packed(sequence_events(frames), list(STREAM), late, tracker, "pack binary", initial), keyed.VERDICT)


def track_sequences(frames: DataFrame, folder: str, checkpoint: str, period: str | None = None, late: str = LATE, initial: DataFrame | None = None) -> StreamingQuery:
    return _into(live_verdicts(frames, late, initial), folder, checkpoint, period)


def readable_snapshot(levels: Column) -> Column:
    """Levels that ascend strictly within each side and can all be read; a frame of others is refused whole."""

    def ascends(side: str) -> Column:
        own = F.filter(levels, lambda x: x["side"] == side)
        prices = F.transform(own, lambda x: x["price_micros"])
        sound = F.forall(own, lambda x: x["price_micros"].isNotNull() & x["size_fp_units"].isNotNull())
        return F.coalesce(sound & (F.array_sort(F.array_distinct(prices)) == prices), F.lit(False))

    return levels.isNull() | (ascends("yes") & ascends("no"))


def live_books(frames: DataFrame, late: str = LATE) -> DataFrame:
    """Outcome of every market frame and the best levels after it, live; see ``keyed.LiveBook``.

    One row per frame: ``(session_id, sid, received_at_ns, seq, is_snapshot, market_ticker, side, price_micros, delta_fp_units, levels,
    pricing_convention[, control])``, ``levels`` for snapshots only, frames of other channels with a NULL market. Two steps of keyed state: frames are put
    in order and judged per stream, then books are kept per market.
    """
    sound = frames.where(~F.coalesce("is_snapshot", F.lit(False)) | readable_snapshot(F.col("levels")))
    # Levels travel as JSON, which a book reads where it is seeded.
    flat = sound.withColumn("levels", F.to_json("levels"))
    book = [*STREAM, "market_ticker"]
    tracker = keyed.SequenceTracker(keyed.BOOK_FRAME, "market_ticker")
    frames = sequence_events(flat, keyed.BOOK_PAYLOAD_NAMES)
    judged = _packed(frames, list(STREAM), late, tracker, "session_id string, sid bigint, market_ticker string, received_at_ns bigint, pack binary", None)
    return packs.unpack(judged.groupBy(*book).transformWithStateInPandas(keyed.LiveBook(), "pack binary", "Append", "None"), keyed.BOOK)


def track_books(frames: DataFrame, folder: str, checkpoint: str, period: str | None = None, late: str = LATE) -> StreamingQuery:
    return _into(live_books(frames, late), folder, checkpoint, period)


def live_grids(observations: DataFrame, late: str = LATE, initial: DataFrame | None = None) -> DataFrame:
    """Verdicts of grid observations against the last one of their (market, source); ``initial``: the last stored ones."""
    rows = observations.select("market_ticker", "source", "observed_ms", "price_ranges_raw", F.timestamp_millis("observed_ms").alias("at"))
    return _keyed(rows.withWatermark("at", late), list(GRID_KEY), keyed.GridDetector(), keyed.GRID_VERDICT, initial)


def track_grids(observations: DataFrame, folder: str, checkpoint: str, period: str | None = None, late: str = LATE, initial: DataFrame | None = None) -> StreamingQuery:
    return _into(live_grids(observations, late, initial), folder, checkpoint, period)


def live_registry(sightings: DataFrame, late: str = LATE, initial: DataFrame | None = None) -> DataFrame:
    """Markets seen for the first time; those learned by reconciliation are the alerts. ``initial``: the markets known before."""
    rank = F.array_position(F.array(*[F.lit(s) for s in SOURCES]), F.col("learned_via")).cast("int")
    group = F.pmod(F.xxhash64("market_ticker"), F.lit(REGISTRY_GROUPS)).alias("group")
    rows = sightings.select(group, "market_ticker", "learned_via", "seen_ms", rank.alias("rank"), F.timestamp_millis("seen_ms").alias("at"))
    seed = None if initial is None else initial.select(group, "market_ticker")
    return packs.unpack(_packed(rows, ["group"], late, keyed.Registry(), "pack binary", seed), keyed.KNOWN)


def track_registry(sightings: DataFrame, folder: str, checkpoint: str, period: str | None = None, late: str = LATE, initial: DataFrame | None = None) -> StreamingQuery:
    return _into(live_registry(sightings, late, initial), folder, checkpoint, period)


def idle_alerts(frames: DataFrame, idle_ms: int = IDLE_MS) -> DataFrame:
    """One alert each time a session has been silent for ``idle_ms`` of processing time.

    The input arrives in bounded batches; only a running maximum is kept.
    """

    def watch(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            (last,) = state.get
            state.remove()
            yield pd.DataFrame({"session_id": [key[0]], "last_received_ns": [last]})
            return
        last = state.get[0] if state.exists else -1
        for batch in batches:
            last = max(last, int(batch["received_at_ns"].max()))
        state.update((last,))
        state.setTimeoutDuration(idle_ms)

    return frames.select("session_id", "received_at_ns").groupBy("session_id").applyInPandasWithState(
        watch, "session_id string, last_received_ns bigint", "last_received_ns bigint", "append", GroupStateTimeout.ProcessingTimeTimeout
    )
