"""Reading and writing the channel tables: ``root/<channel>/date=YYYY-MM-DD/batch_id=N/``."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from tidemark.functions.clocks import partition_date
from tidemark.operators import decode
from tidemark.operators.grids import grid_changes, grid_verdicts
from tidemark.operators.ordered import TIME_CHUNK_NS, Run, running, time_chunk
from tidemark.schemas import CHANNELS, channel_schema
from tidemark.session import materialize
from tidemark.sources.health import list_files, quarantined

# Upper bounds of a stored file.
ROLL_BYTES = 128 << 20
ROLL_PERIOD = "5 minutes"
# Bytes that a value of fixed width adds to the estimate of a row, and the share of the estimate that is stored while nothing is known yet.
VALUE_BYTES = 8
FIRST_RATIO = 0.25
# A batch with files beyond the slack is written again with its own ratio; a single row may be larger than any file, so not without end.
ROLL_SLACK = 1.2
REWRITES = 3
MOST_CORRECTION = 4
ACCOUNTING = "channel string, expected long, stored long, weight long, bytes long"


def _plain(path: str) -> str:
    return re.sub("^file:/+", "file:/", path)


def read_channel(
    spark: SparkSession,
    root: str,
    channel: str,
    since: str | None = None,
    until: str | None = None,
    quarantined: Sequence[str] = (),
) -> DataFrame:
    """Rows of the UTC dates ``[since, until]``, both inclusive; a missing folder is an empty table.

    The dates prune partitions. Files in ``quarantined`` (paths as ``sources.health.quarantine_list``
    gives them) are not opened; any other file that cannot be read fails the job, so no row goes missing unseen.
    """
    schema = channel_schema(channel).add("date", T.DateType()).add("batch_id", T.LongType())
    try:
        rows = spark.read.schema(schema).parquet(f"{root}/{channel}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], schema)
    else:
        if quarantined:
            # Spark holds the list of files on the driver in any case; a listed one is left out of it.
            bad = {_plain(q) for q in quarantined}
            left = [f for f in rows.inputFiles() if _plain(f) not in bad]
            reader = spark.read.schema(schema).option("basePath", f"{root}/{channel}")
            rows = reader.parquet(*left) if left else spark.createDataFrame([], schema)
    if since is not None:
        rows = rows.where(F.col("date") >= F.lit(since).cast("date"))
    if until is not None:
        rows = rows.where(F.col("date") <= F.lit(until).cast("date"))
    return rows.drop("batch_id")


def read_legacy_channel(spark: SparkSession, root: str, channel: str) -> DataFrame:
    """Tables of other writers: columns by name, missing ones NULL, nanosecond clocks as BIGINT.

    Their partition date is the time of writing, so it is kept as it is and
    should be padded by a day before filtering on receive time.
    """
    own = spark.newSession()  # the setting holds for this table only
    own.conf.set("spark.sql.legacy.parquet.nanosAsLong", "true")
    rows = own.read.option("mergeSchema", "true").parquet(f"{root}/{channel}")
    wanted = channel_schema(channel)
    return rows.select(
        *[F.col(f.name).cast(f.dataType) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in wanted],
        *[c for c in ("date",) if c in rows.columns],
    )


def union_by_name(tables: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def read_all(spark: SparkSession, root: str, date: str | None = None) -> dict[str, DataFrame]:
    """Every channel, for audits; one date or all of them, without the files of the stored manifest."""
    bad = quarantined(spark, root)
    return {c: read_channel(spark, root, c, date, date, bad) for c in CHANNELS}


def read_sequence_columns(spark: SparkSession, root: str, date: str | None = None) -> list[DataFrame]:
    """Only what continuity needs of each channel; the raw text never leaves the files."""
    return [df.select("session_id", "sid", "seq") for df in read_all(spark, root, date).values()]


def row_weight(rows: DataFrame) -> Column:
    """Estimated bytes of a row: its texts, and a fixed width for each other value."""
    texts = [f.name for f in rows.schema if isinstance(f.dataType, T.StringType)]
    fixed = VALUE_BYTES * (len(rows.columns) - len(texts))
    return reduce(lambda a, b: a + b, [F.coalesce(F.octet_length(F.col(t)), F.lit(0)) for t in texts], F.lit(fixed)).cast("bigint")


def numbered(placed: DataFrame, files: list[tuple], number: Column) -> DataFrame:
    """``placed`` with the ``_file`` of each row, from (date, first file, files) and the ``number`` of the file within its date.

    Spark knows no size of a list from the driver and would broadcast the batch instead where its files are small; hence the hint.
    """
    starts = placed.sparkSession.createDataFrame(files, "date date, _first long, _files long")
    return placed.join(F.broadcast(starts), "date").withColumn("_file", (F.col("_first") + number).cast("int"))


def write_channel(
    rows: DataFrame, root: str, channel: str, batch_id: int, max_bytes: int = ROLL_BYTES, ratio: float = FIRST_RATIO,
    width: int = TIME_CHUNK_NS,
) -> int:
    """Write one batch of one channel in files of about ``max_bytes`` and return its estimated bytes.

    Writing the same batch again replaces it, so a retry adds nothing. Rows are dealt to the files of their date in order of
    receipt, by the running sum of their estimated bytes times ``ratio``, the share of the estimate that the batch before
    took on disk. A date's last file holds the rest. A burst is cut like any other rows; a row alone may exceed the bound.
    """
    names = channel_schema(channel).fieldNames()
    placed = rows.select(*names).withColumn("date", partition_date("received_at_ns")).withColumn("_weight", row_weight(rows.select(*names)))
    # One row per date of the batch.
    sizes = {r.date: r.n for r in placed.groupBy("date").agg(F.sum("_weight").alias("n")).collect()}
    total = sum(sizes.values())
    if not total:
        return 0
    share = max_bytes / ratio  # estimated bytes of a full file
    files = {date: int(n / share) + 1 for date, n in sizes.items()}
    first = dict(zip(files, accumulate(files.values(), initial=0)))
    if max(files.values()) > 1:
        order = ["received_at_ns", "_weight"]
        placed = running(placed, ["date"], order, time_chunk(order[0], width), {"_before": Run("sum", F.col("_weight"))})
        number = F.least(F.floor(F.col("_before") / F.lit(share)), F.col("_files") - 1)
    else:
        number = F.lit(0)
    dealt = numbered(placed, [(d, first[d], n) for d, n in files.items()], number)
    (
        dealt.repartitionById(sum(files.values()), "_file")
        .select(*names, "date", F.lit(batch_id).cast("bigint").alias("batch_id"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("date", "batch_id")
        .parquet(f"{root}/{channel}")
    )
    return total


def stored_ratios(spark: SparkSession, root: str, batch_id: int) -> dict[str, float]:
    """Bytes on disk per estimated byte of each channel in the batch before; a batch costs the same however long the history."""
    try:
        before = spark.read.schema(ACCOUNTING).parquet(f"{root}/_accounting/batch_id={batch_id - 1}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}
    return {r.channel: r.bytes / r.weight for r in before.where("weight > 0 AND bytes > 0").collect()}


def fan_out(routed: DataFrame, root: str, batch_id: int, max_bytes: int = ROLL_BYTES, width: int = TIME_CHUNK_NS) -> dict[str, tuple[int, int]]:
    """Write a mixed batch to all its channels; returns (rows expected, rows stored) per channel.

    The routed frames are written once, by channel, and every encoder reads its
    own part, so that nothing is parsed twice and nothing has to fit in memory.
    What is stored is counted in the batch's own files. A difference is an error, and the counts and sizes of
    each batch stay in ``_accounting``; the next batch takes its file sizes from there. Where they come out too large, the channel is
    written again by its own ratio.
    """
    spark = routed.sparkSession
    staging = f"{root}/_staging/batch_id={batch_id}"
    wanted = Observation(f"expected-{batch_id}")
    sizes = F.when(F.col("channel") == "orderbook_snapshot", F.greatest(F.size(decode.tagged_levels()), F.lit(1))).otherwise(1)
    counted = routed.withColumn("expected", sizes).observe(
        wanted, *[F.sum(F.when(F.col("channel") == c, F.col("expected"))).alias(c) for c in CHANNELS]
    )
    counted.drop("expected").write.mode("overwrite").partitionBy("channel").parquet(staging)
    expected = wanted.get
    staged = spark.read.schema(routed.schema).parquet(staging)
    ratios = stored_ratios(spark, root, batch_id)
    result, facts = {}, []
    for channel in CHANNELS:
        if not expected[channel]:
            continue
        rows = decode.decode_channel(staged, channel)
        own = f"{root}/{channel}/date=*/batch_id={batch_id}"
        ratio = ratios.get(channel, FIRST_RATIO)
        for left in range(REWRITES, -1, -1):
            weight = write_channel(rows, root, channel, batch_id, max_bytes, ratio, width)
            held, largest = list_files(spark, own, "*.parquet").agg(F.sum("bytes"), F.max("bytes")).first()
            if not left or (largest or 0) <= ROLL_SLACK * max_bytes:
                break
            # Smaller files may compress worse than those the ratio was learned from.
            ratio *= min(largest / max_bytes, MOST_CORRECTION)
        stored = spark.read.schema(channel_schema(channel)).parquet(own).count()
        result[channel] = (int(expected[channel]), stored)
        facts.append((channel, *result[channel], weight, held))
    spark.createDataFrame(facts, ACCOUNTING).coalesce(1).write.mode("overwrite").parquet(f"{root}/_accounting/batch_id={batch_id}")
    if rows_lost(result):
        raise RuntimeError(f"batch {batch_id} of {root} lost rows: {result}")
    return result


def read_accounting(spark: SparkSession, root: str) -> DataFrame:
    """(batch_id, channel, expected, stored) of every batch."""
    return spark.read.schema(f"{ACCOUNTING}, batch_id long").parquet(f"{root}/_accounting").select("batch_id", "channel", "expected", "stored")


def rows_lost(accounting: dict[str, tuple[int, int]]) -> int:
    """Expected minus written rows; anything but zero is a fault."""
    return sum(expected - written for expected, written in accounting.values())


def write_grid_changes(observations: DataFrame, path: str, batch_id: int) -> None:
    """Store first observations and changes only, judged with what earlier batches stored; a repeated batch replaces itself."""
    spark = observations.sparkSession
    seen = observations.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
    try:
        earlier = spark.read.parquet(path).where(F.col("batch_id") < batch_id).select(*[c for c in seen.columns])
        seen = materialize(earlier).withColumn("batch_id", F.col("batch_id").cast("bigint")).unionByName(seen)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    fresh = grid_changes(grid_verdicts(seen)).where(F.col("batch_id") == batch_id)
    fresh.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path)


def with_session_facts(rows: DataFrame, facts: dict[str, str]) -> DataFrame:
    """Attach session facts to the ``session_id`` column; they travel in the footer of each file."""
    return rows.withMetadata("session_id", {**rows.schema["session_id"].metadata, **facts})


def session_facts(rows: DataFrame) -> dict[str, str]:
    return dict(rows.schema["session_id"].metadata)


def compact_day(spark: SparkSession, root: str, channel: str, date: str, files: int, target: str) -> None:
    """Rewrite one day into ``files`` files ordered by market and time, under another root.

    Range partitioning splits a busy market over several files, and the order
    gives row groups narrow minima and maxima for market and time filters.
    """
    rows = read_channel(spark, root, channel, date, date)
    keys = [c for c in ("market_ticker", "received_at_ns") if c in rows.columns]
    (
        rows.repartitionByRange(files, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("batch_id", F.lit(-1).cast("bigint"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("date", "batch_id")
        .parquet(f"{target}/{channel}")
    )
