"""Queries over stored tables: frames are decoded, written, counted and read back under the shared folder."""

import uuid

from pyspark.sql import functions as F

from tidemark.operators import audit, decode, metrics, reconcile
from tidemark.session import checkpoint_dir
from tidemark.sources import health, records, tables
from tidemark.workload.feeds import CHANNEL_SQL, frames
from tidemark.workload.registry import query, step

ROWS_SQL = "CASE WHEN kind = 'snapshot' THEN greatest(cents % 3 + user_id % 2, 1) ELSE 1 END"
step("stored_rows", ("wire",), f"SELECT *, {CHANNEL_SQL} AS channel, {ROWS_SQL} AS n FROM wire")


def scratch(s) -> str:
    return f"{checkpoint_dir(s.spark).rstrip('/')}/stored-{uuid.uuid4().hex}"


def stored(s) -> str:
    """All frames of the feed as channel tables; the folder."""
    root = scratch(s)
    tables.fan_out(decode.route(frames(s)), root, 0)
    return root


@query("ingest_channels", ("stored_rows",), """
SELECT coalesce(channel, 'TOTAL') AS channel, CAST(sum(n) AS BIGINT) AS "rows" FROM stored_rows GROUP BY ROLLUP (channel)""")
def _(s):
    return audit.channel_counts(tables.read_all(s.spark, stored(s)))


@query("ingest_accounting", ("stored_rows",), """
SELECT CAST(0 AS BIGINT) AS batch_id, channel, CAST(sum(n) AS BIGINT) AS expected, CAST(sum(n) AS BIGINT) AS stored FROM stored_rows GROUP BY channel""")
def _(s):
    return tables.read_accounting(s.spark, stored(s)).withColumn("batch_id", F.col("batch_id").cast("bigint"))


@query("channel_scan_dates", ("stored_rows",), """
SELECT CAST(make_timestamp(received_at_ns // 1000) AS DATE) AS date, count(*) AS deltas, CAST(sum(seq) AS BIGINT) AS seqs FROM stored_rows
WHERE channel = 'orderbook_delta' AND received_at_ns >= 1704844800000000000 AND received_at_ns < 1705708800000000000 GROUP BY 1""")
def _(s):
    rows = tables.read_channel(s.spark, stored(s), "orderbook_delta", "2024-01-10", "2024-01-19")
    return rows.groupBy("date").agg(F.count("*").alias("deltas"), F.sum("seq").alias("seqs"))


@query("sequence_scan", ("stored_rows",), """
SELECT session_id, count(*) AS frames FROM stored_rows, range(n) WHERE channel <> 'price_ranges' GROUP BY session_id""")
def _(s):
    parts = tables.read_sequence_columns(s.spark, stored(s))
    return tables.union_by_name(parts).groupBy("session_id").agg(F.count("*").alias("frames"))


DATES_SQL = "count(DISTINCT CAST(make_timestamp(received_at_ns // 1000) AS DATE))"


DATA_CHANNELS = ("orderbook_snapshot", "orderbook_delta", "ticker", "trade", "market_lifecycle", "event_fee_update")
step("pairs", ("stored_rows",), """SELECT session_id, sid, channel, CASE kind WHEN 'event' THEN concat('KXEV', CAST(user_id // 2 AS VARCHAR)) WHEN 'fee' THEN NULL ELSE market_ticker END AS market_ticker
FROM stored_rows WHERE channel NOT IN ('control', 'unparsed')""")


def carried(s, root: str):
    """(session_id, sid, channel, market_ticker) of every stored data frame; an event's own ticker stands in where a frame names no market, fee updates name none."""
    def part(channel):
        rows = tables.read_channel(s.spark, root, channel)
        market = F.col("market_ticker") if "market_ticker" in rows.columns else F.lit(None).cast("string")
        return rows.select("session_id", "sid", F.lit(channel).alias("channel"), market.alias("market_ticker"))

    return tables.union_by_name([part(c) for c in DATA_CHANNELS])


@query("subscription_map", ("pairs",), """
SELECT session_id, sid, array_to_string(list_sort(list(DISTINCT channel)), ',') AS channels, count(DISTINCT market_ticker) AS markets FROM pairs GROUP BY session_id, sid""")
def _(s):
    return metrics.subscription_map(carried(s, stored(s)))


@query("error_attribution", ("wire", "pairs"), """
SELECT e.session_id, e.market_ticker, d.sid, e.cents % 30 IN (10, 17, 25) AS terminal, count(*) AS errors
FROM wire e LEFT JOIN (SELECT DISTINCT session_id, market_ticker, sid FROM pairs WHERE market_ticker IS NOT NULL) d USING (session_id, market_ticker)
WHERE e.kind = 'error' GROUP BY ALL""")
def _(s):
    root = stored(s)
    known = carried(s, root).where("market_ticker IS NOT NULL").select("session_id", "market_ticker", "sid").distinct()
    out = metrics.attribute_errors(tables.read_channel(s.spark, root, "control"), known)
    return out.groupBy("session_id", "market_ticker", "sid", F.col("recovery").isNotNull().alias("terminal")).agg(F.count("*").alias("errors"))


@query("storage_usage", ("stored_rows",), f"""
SELECT channel, {DATES_SQL} AS files, true AS has_bytes FROM stored_rows GROUP BY channel""")
def _(s):
    """A batch below the bound has one file per date."""
    used = health.storage_usage(s.spark, stored(s)).where("channel <> ''")
    return used.select("channel", "files", (F.col("bytes") > 0).alias("has_bytes"))


def cut_copies(s, root: str) -> None:
    """Beside each stored file of ``root``, a copy of its first half, as a writer leaves one that is stopped."""
    from pyarrow import fs

    def cut(batches):
        for batch in batches:
            for path, size in zip(batch["path"], batch["bytes"]):
                filesystem, name = fs.FileSystem.from_uri(path)
                with filesystem.open_input_file(name) as whole, filesystem.open_output_stream(name.replace(".parquet", ".cut.parquet")) as half:
                    half.write(whole.read(int(size) // 2))
            yield batch[["path"]]

    files = health.list_files(s.spark, root, "part-*.parquet").select("path", "bytes").where("path NOT LIKE '%.cut.parquet'")
    files.mapInPandas(cut, "path string").write.format("noop").mode("overwrite").save()


@query("file_health", ("stored_rows",), f"""
SELECT channel, {DATES_SQL} AS sound, {DATES_SQL} AS unfinished FROM stored_rows GROUP BY channel""")
def _(s):
    root = stored(s)
    cut_copies(s, root)
    found = health.file_health(s.spark, root).where("channel <> ''")
    return found.groupBy("channel").agg(F.count_if(F.col("defect").isNull()).alias("sound"), F.count("defect").alias("unfinished"))


@query("read_around_cut_files", ("stored_rows",), f"""
SELECT channel, CAST(sum(n) AS BIGINT) AS "rows", {DATES_SQL} AS unfinished, CAST(0 AS BIGINT) AS probed_again FROM stored_rows GROUP BY channel""")
def _(s):
    """Files are probed before and after some are cut, so the second manifest opens the cut ones alone; reads leave those out."""
    root = stored(s)
    health.store_manifest(s.spark, root)
    cut_copies(s, root)
    health.store_manifest(s.spark, root)
    again = health.store_manifest(s.spark, root)
    counts = audit.channel_counts(tables.read_all(s.spark, root)).where("channel <> 'TOTAL' AND rows > 0")
    bad = health.unfinished(s.spark, root).groupBy(F.regexp_extract("path", r"/([a-z_]+)/date=", 1).alias("channel")).agg(F.count("*").alias("unfinished"))
    return counts.join(bad, "channel", "left").select("channel", "rows", "unfinished", F.lit(again).cast("bigint").alias("probed_again"))


# Bound of a file in the query below; the whole feed is below the real one on test data.
SMALL_FILE = 1 << 18


@query("bounded_files", ("stored_rows",), """
SELECT channel, 2 * CAST(sum(n) AS BIGINT) AS "rows", CAST(0 AS BIGINT) AS oversized FROM stored_rows GROUP BY channel""")
def _(s):
    """The feed stored as two batches; files of the second take their size from the first and stay within 20 % of the bound."""
    root = scratch(s)
    for batch in (0, 1):
        tables.fan_out(decode.route(frames(s)), root, batch, SMALL_FILE)
    sizes = health.list_files(s.spark, root, "*.parquet").where("channel <> '' AND path LIKE '%/batch_id=1/%'")
    over = sizes.groupBy("channel").agg(F.count_if(F.col("bytes") > 1.2 * SMALL_FILE).alias("oversized"))
    rows = audit.channel_counts(tables.read_all(s.spark, root)).where("channel <> 'TOTAL' AND rows > 0")
    return rows.join(over, "channel").select("channel", "rows", "oversized")


@query("session_scan", ("sess",), """
SELECT session_id, started_ms, ended_ms, pricing_convention FROM sess""")
def _(s):
    def instant(column):
        return F.date_format(F.timestamp_millis(column), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")

    path = scratch(s)
    written = s.sess.select("session_id", instant("started_ms").alias("started_at"), instant("ended_ms").alias("ended_at"), "pricing_convention")
    records.append_sessions(written, path)
    return records.read_sessions(s.spark, path).select("session_id", "started_ms", "ended_ms", "pricing_convention")


@query("discovery_scan", ("crawl",), """
SELECT ticker, status FROM (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY pass_no, page_no, place, o_orderkey) AS k FROM crawl) WHERE k = 1""")
def _(s):
    path = scratch(s)
    market = F.struct("ticker", "status", "series_ticker")
    places = F.array_sort(F.collect_list(F.struct("place", "o_orderkey", market.alias("m"))))
    pages = s.crawl.groupBy("pass_no", "page_no").agg(F.transform(places, lambda p: p["m"]).alias("markets"))
    pages.select(F.to_json(F.struct("pass_no", "page_no", F.lit(7).alias("finished_ms"), "markets")).alias("value")).write.text(path)
    return reconcile.merge_crawl(records.read_discovery(s.spark, path)).select("ticker", "status")
