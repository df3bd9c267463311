"""Session records, raw frames, metrics logs and discovery dumps."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.clocks import parse_instant_ms
from tidemark.functions.tickers import CONVENTIONS
from tidemark.schemas import FRAMES, SESSIONS, ddl


def read_frames(spark: SparkSession, path: str) -> DataFrame:
    """Landed frames as JSON lines of receive clock, session and raw text."""
    return spark.read.schema(ddl(FRAMES)).json(path)


def stream_frames(spark: SparkSession, path: str, max_files: int = 1000) -> DataFrame:
    """The same as a stream; a backlog waits in the source and nothing is dropped."""
    return spark.readStream.schema(ddl(FRAMES)).option("maxFilesPerTrigger", max_files).json(path)


def with_times(sessions: DataFrame) -> DataFrame:
    """Add millisecond times; an unreadable time is NULL."""
    return sessions.withColumn("started_ms", parse_instant_ms("started_at")).withColumn("ended_ms", parse_instant_ms("ended_at"))


def read_sessions(spark: SparkSession, path: str) -> DataFrame:
    """Session records, one JSON document per line; lines without an id or of another form are in ``refused_sessions``."""
    return with_times(_session_lines(spark, path).where("malformed IS NULL").drop("malformed"))


def refused_sessions(spark: SparkSession, path: str) -> DataFrame:
    """(line) of every record that ``read_sessions`` leaves out."""
    return _session_lines(spark, path).where("malformed IS NOT NULL").select(F.col("malformed").alias("line"))


def _session_lines(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.text(path).where(F.trim("value") != "")
    parsed = lines.select("value", F.from_json("value", ddl(SESSIONS).add("_broken", "string"), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"}).alias("r"))
    sound = F.col("r._broken").isNull() & (F.coalesce("r.session_id", F.lit("")) != "")
    return parsed.select(*[F.col(f"r.{n}") for n in ddl(SESSIONS).fieldNames()], F.when(~sound, F.col("value")).alias("malformed"))


def append_sessions(sessions: DataFrame, path: str) -> None:
    """Add records; a session is written at its start and again at its end, and readers keep the closed copy."""
    names = ddl(SESSIONS).fieldNames()
    sessions.select(*[c for c in names if c in sessions.columns]).write.mode("append").json(path)


def read_legacy_sidecars(spark: SparkSession, root: str) -> DataFrame:
    """Records of the ``_session-*.json`` files beside the data; files of another form are in ``refused_sidecars``."""
    rows = _sidecars(spark, root).where("text IS NOT NULL").select(F.from_json("text", ddl(SESSIONS)).alias("r")).select("r.*")
    return with_times(rows.where(F.coalesce("session_id", F.lit("")) != ""))


def refused_sidecars(spark: SparkSession, root: str) -> DataFrame:
    """(path) of every sidecar whose content is no JSON document."""
    return _sidecars(spark, root).where("text IS NULL").select("path")


def _sidecars(spark: SparkSession, root: str) -> DataFrame:
    """Path and text of each sidecar, NULL for content that is malformed. Spark's readers skip names that start with ``_``.

    Only the paths are listed on the driver; executors read the files, and one that cannot be read fails its task.
    """
    from pyarrow import fs

    hadoop = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/*/date=*/_session-*.json")
    found = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(hadoop) or []
    paths = [(str(f.getPath().toUri().toString()),) for f in found]

    def read(batches):
        for batch in batches:
            out = []
            for path in batch["path"]:
                filesystem, name = fs.FileSystem.from_uri(path)
                with filesystem.open_input_file(name) as handle:
                    content = handle.read()
                try:
                    text = content.decode("utf-8")
                    json.loads(text)
                except ValueError:
                    text = None
                out.append(text)
            yield pd.DataFrame({"path": batch["path"], "text": pd.Series(out, dtype=object)})

    return spark.createDataFrame(paths, "path string").mapInPandas(read, "path string, text string")


def check_sessions(sessions: DataFrame) -> DataFrame:
    """Add ``refused``: why a record may not be used, NULL when it may."""
    return sessions.withColumn(
        "refused",
        F.when(F.coalesce("pricing_convention", F.lit("")) == "", "missing pricing_convention")
        .when(~F.col("pricing_convention").isin(*CONVENTIONS), "unknown pricing_convention")
        .when(F.coalesce("ws_url", F.lit("")) == "", "missing ws_url")
        .when(F.coalesce(F.size("channels"), F.lit(0)) <= 0, "missing channels"),
    )


def last_metrics(spark: SparkSession, path: str) -> DataFrame:
    """Newest ``metrics`` line of a JSON log as ``(at, fields)``; other lines and broken ones are skipped."""
    lines = spark.read.text(path).where(F.col("value").contains('"metrics"'))
    parsed = lines.select(F.try_parse_json("value").alias("v")).select(
        F.try_variant_get("v", "$.timestamp", "string").alias("at"), F.try_variant_get("v", "$.fields", "variant").alias("f")
    )
    mine = parsed.where(F.try_variant_get("f", "$.message", "string") == "metrics")
    return mine.agg(F.max(F.struct("at", F.to_json("f").alias("fields"))).alias("m")).where("m IS NOT NULL").select("m.at", "m.fields")


def read_discovery(spark: SparkSession, path: str) -> DataFrame:
    """One row per market of crawl pages ``{pass_no, page_no, finished_ms, markets: [...]}``.

    A market without a ticker is skipped and does not stop the others.
    """
    pages = spark.read.text(path).select(F.try_parse_json("value").alias("p"))

    def page(name: str) -> Column:
        return F.try_variant_get("p", f"$.{name}", "bigint").alias(name)

    markets = pages.select(
        page("pass_no"), page("page_no"), page("finished_ms"), F.posexplode(F.expr("try_variant_get(p, '$.markets', 'array<variant>')")).alias("place", "m")
    )

    def field(name: str) -> Column:
        return F.try_variant_get("m", f"$.{name}", "string").alias(name)

    return markets.select(
        "pass_no", "page_no", "place", "finished_ms", field("ticker"), field("event_ticker"), field("series_ticker"), field("status"),
        field("price_level_structure"), F.coalesce(F.to_json(F.try_variant_get("m", "$.price_ranges", "variant")), F.lit("")).alias("price_ranges_raw"),
    ).where("ticker IS NOT NULL")
