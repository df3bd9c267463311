"""State of the stored files: sizes, and files that were never finished."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tidemark.session import materialize

# A Parquet file starts and ends with these bytes and cannot be shorter.
MAGIC = b"PAR1"
SHORTEST = 12
MANIFEST = "_probed"
MANIFEST_FIELDS = "path string, bytes bigint, modified timestamp, channel string, defect string"


def list_files(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """Path, size and channel folder of every visible file; contents are not read.

    Empty files do not appear: a file of no bytes is still being written.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(root)
        .select("path", F.col("length").alias("bytes"), "modificationTime")
    )
    return files.withColumn("channel", F.regexp_extract("path", r"/([a-z_]+)/date=", 1))


def storage_usage(spark: SparkSession, root: str) -> DataFrame:
    return list_files(spark, root).groupBy("channel").agg(F.count("*").alias("files"), F.sum("bytes").alias("bytes"))


def probed(files: DataFrame) -> DataFrame:
    """``files`` (path, bytes, modified, channel) with the defect of each, NULL when sound.

    Executors read the first and last four bytes of each file and nothing more.
    """
    from pyarrow import fs

    def probe(batches):
        for batch in batches:
            defects = []
            for path, size in zip(batch["path"], batch["bytes"]):
                if size < SHORTEST:
                    defects.append("too_short")
                    continue
                filesystem, name = fs.FileSystem.from_uri(path)
                with filesystem.open_input_file(name) as handle:
                    head, tail = handle.read_at(4, 0), handle.read_at(4, int(size) - 4)
                defects.append(
                    "missing_header_magic" if head != MAGIC else "missing_footer_magic" if tail != MAGIC else None
                )
            yield batch.assign(defect=pd.Series(defects, index=batch.index, dtype=object))

    return files.select("path", "bytes", "modified", "channel").mapInPandas(probe, MANIFEST_FIELDS)


def _data_files(spark: SparkSession, root: str) -> DataFrame:
    return list_files(spark, root, "*.parquet").withColumnRenamed("modificationTime", "modified")


def file_health(spark: SparkSession, root: str) -> DataFrame:
    """Defect of each data file, NULL when sound; every file is probed."""
    return probed(_data_files(spark, root)).select("path", "bytes", "channel", "defect")


def read_manifest(spark: SparkSession, root: str) -> DataFrame:
    """What was found in each file when it was last probed; no rows before the first time."""
    try:
        known = spark.read.schema(MANIFEST_FIELDS).parquet(f"{root}/{MANIFEST}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST_FIELDS)
    newest = F.max(F.struct("modified", "bytes", "channel", "defect")).alias("f")
    return known.groupBy("path").agg(newest).select("path", "f.bytes", "f.modified", "f.channel", "f.defect")


def store_manifest(spark: SparkSession, root: str) -> int:
    """Probe the files that are new or have changed since, and add them to the manifest; returns how many.

    Path, size and time are compared with the listing, so a file that was probed before is not opened again. A run that is
    repeated finds nothing new and adds nothing.
    """
    same = ["path", "bytes", "modified"]
    fresh = _data_files(spark, root).join(read_manifest(spark, root).select(same), same, "left_anti")
    found = materialize(probed(fresh))
    count = found.count()
    if count:
        found.coalesce(1).write.mode("append").parquet(f"{root}/{MANIFEST}")
    return count


def unfinished(spark: SparkSession, root: str) -> DataFrame:
    """Listed files that the manifest has as defective (path, defect, bytes); one that has changed since is not among them."""
    same = ["path", "bytes", "modified"]
    bad = read_manifest(spark, root).where("defect IS NOT NULL")
    return _data_files(spark, root).select(same).join(bad, same).select("path", "defect", "bytes")


def quarantined(spark: SparkSession, root: str) -> list[str]:
    """Paths of ``unfinished``: as many as there are broken files; none if no manifest was stored."""
    if not read_manifest(spark, root).where("defect IS NOT NULL").take(1):
        return []
    return sorted(r.path for r in unfinished(spark, root).select("path").collect())


def quarantine_list(spark: SparkSession, root: str) -> DataFrame:
    """Unfinished files to be kept out of reads, with defect and size, probed now; nothing is deleted or moved."""
    return file_health(spark, root).where("defect IS NOT NULL").select("path", "defect", "bytes")
