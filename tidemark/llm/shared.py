"""Helpers of the training-data operators: stage boundaries, document columns, connected components."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import checkpoint_dir, materialize

# A side of at most so many narrow rows (ids, hashes) may be broadcast; beyond it the join shuffles.
BROADCAST_ROWS = 500_000
# So many distinct edges (16 bytes each) are small enough for one task, which saves rounds.
ONE_TASK_EDGES = 1 << 19
# Bytes of text that one numpy pass handles at once.
PIECE_BYTES = 2 << 20


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def small(side: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """The stored ``side``, marked for broadcast only if a count proves that it is small."""
    return F.broadcast(side) if side.limit(rows + 1).count() <= rows else side


def stage(df: DataFrame) -> tuple[DataFrame, str]:
    """``df`` written to the shared folder and read back, with its path for ``drop_stage``."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/stage-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def drop_stage(spark: SparkSession, path: str) -> None:
    """Remove a stage that no later step reads."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def pieces(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``limit`` bytes of ``column``; a longer value has a batch of its own."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        begin, held = 0, 0
        for row, size in enumerate(sizes):
            if row > begin and held + size > limit:
                yield batch.slice(begin, row - begin)
                begin, held = row, 0
            held += size
        if begin < batch.num_rows:
            yield batch.slice(begin)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges`` (a, b: long) as (node, component), component being the smallest node.

    Large-star and small-star rounds: each is an aggregation and a join, and each
    round is stored, so nothing is gathered in one place; edges that a count proves to be few
    are joined by one task instead. Nodes without edges do not appear. Loops and repeated edges are harmless; no edges give no rows.
    """
    flat = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    flat = materialize(flat)
    if flat.limit(ONE_TASK_EDGES + 1).count() <= ONE_TASK_EDGES:
        return materialize(flat.repartition(1).mapInArrow(_joined, "node long, component long"))
    mark = _mark(flat)
    while mark[0]:
        both = flat.unionByName(flat.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        star = large.join(least, "u")
        star = star.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        flat = materialize(star.where("u <> v").distinct())
        before, mark = mark, _mark(flat)
        if before == mark:
            break
    roots = flat.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return flat.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _joined(batches):
    edges = pa.Table.from_batches(list(batches), pa.schema([("u", pa.int64()), ("v", pa.int64())]))
    nodes, place = np.unique(np.concatenate([edges.column("u").to_numpy(), edges.column("v").to_numpy()]), return_inverse=True)
    root = smallest_reached(place[: edges.num_rows], place[edges.num_rows :], len(nodes))
    yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(nodes[root])], ["node", "component"])


def _mark(flat: DataFrame) -> tuple:
    total = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    return tuple(flat.agg(F.count("*"), total).first())


def smallest_reached(a: np.ndarray, b: np.ndarray, size: int) -> np.ndarray:
    """The smallest of ``size`` numbers that each one reaches by the links a - b of one task."""
    root = np.arange(size)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new
