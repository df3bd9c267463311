"""Exact near-duplicates among embedding vectors: spherical k-means cells, blocked cosine products, one representative per group.

A vector is compared with all vectors of its own cell. It visits another cell as a guest if it
lies so near to the plane between the two centroids that a vector beyond it could be similar enough, so cells
never cost a link. Cells are cut into blocks of bounded size; a task holds two blocks.
"""

from __future__ import annotations

import math
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import components, small, smallest_reached
from tidemark.session import materialize

# Vectors of a label per cell, at least; cells of all labels together, at most (about: a few vectors per cell are learned from).
CELL_ROWS = 4096
MOST_CELLS = 2048
SAMPLE_PER_CELL = 64
ROUNDS = 12
BLOCK_ROWS = 1024


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def spherical_kmeans(x: np.ndarray, k: int) -> np.ndarray:
    """``k`` unit centroids (fewer if there are fewer vectors) of the unit vectors ``x``; the same for the same input."""
    centroids = x[np.linspace(0, len(x) - 1, min(k, len(x))).astype(int)]
    for _ in range(ROUNDS):
        near = x @ centroids.T
        home = near.argmax(axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, home, x)
        far = iter(np.argsort(near.max(axis=1), kind="stable"))
        for cell in np.flatnonzero(np.linalg.norm(sums, axis=1) < 1e-9):
            sums[cell] = x[next(far)]
        centroids = unit(sums)
    return centroids


def _vectors(table) -> np.ndarray:
    return np.frombuffer(b"".join(table.column("vec").to_pylist()), "<f4").reshape(table.num_rows, -1).astype(np.float64)


def _learn(key, table, cells):
    order = np.argsort(table.column("node").to_numpy())
    found = spherical_kmeans(unit(_vectors(table))[order], cells[key[0].as_py(), key[1].as_py()])
    return pa.table({"label": [key[0].as_py()], "dim": [key[1].as_py()], "centroids": pa.array([found.tobytes()], pa.binary())}, schema=pa.schema([("label", pa.int64()), ("dim", pa.int64()), ("centroids", pa.binary())]))


def _assign(batches, centroids, threshold):
    reach = math.sqrt(1 - threshold * threshold) + 1e-9
    for batch in batches:
        label, dim = batch.column("label").to_numpy(), batch.column("dim").to_numpy()
        for key in sorted(set(zip(label.tolist(), dim.tolist()))):
            rows = np.flatnonzero((label == key[0]) & (dim == key[1]))
            part = batch.take(pa.array(rows))
            if key not in centroids:
                yield _placed(part, np.arange(len(rows)), np.zeros(len(rows), np.int64), False)
                continue
            c = centroids[key]
            near = unit(_vectors(part)) @ c.T
            home = near.argmax(axis=1)
            yield _placed(part, np.arange(len(rows)), home, False)
            apart = np.linalg.norm(c[:, None] - c[None], axis=2)
            guest = near[np.arange(len(rows)), home][:, None] - near <= reach * apart[home]
            guest[np.arange(len(rows)), home] = False
            row, cell = np.nonzero(guest)
            if len(row):
                yield _placed(part, row, cell, True)


def _placed(part, rows, cell, guest):
    taken = part.take(pa.array(rows))
    columns = [taken.column(c) for c in ("label", "dim", "node", "mult", "vec")]
    return pa.RecordBatch.from_arrays([*columns, pa.array(cell.astype(np.int64)), pa.array([guest] * len(rows), pa.bool_())], ["label", "dim", "node", "mult", "vec", "cell", "guest"])


def _compare(key, table, threshold):
    guests, left, right = key[3].as_py(), key[4].as_py(), key[5].as_py()
    x = _vectors(table)
    node, mult = table.column("node").to_numpy(), table.column("mult").to_numpy()
    side = table.column("side").to_numpy(zero_copy_only=False).astype(bool)
    same = not guests and left == right
    rows, columns = (np.flatnonzero(~side),) * 2 if same else (np.flatnonzero(~side), np.flatnonzero(side))
    norm = np.linalg.norm(x, axis=1)
    close = (x[rows] @ x[columns].T) / (norm[rows][:, None] * norm[columns][None]) >= threshold
    if same:
        np.fill_diagonal(close, False)
    links = np.zeros(len(x), np.int64)
    links[rows] += close @ mult[columns]
    if not same and not guests:  # a guest's links are counted here, those to it where the other one is the guest
        links[columns] += close.T @ mult[rows]
    a, b = np.nonzero(close)
    order = np.argsort(node, kind="stable")
    place = np.argsort(order)
    root = order[smallest_reached(place[rows[a]], place[columns[b]], len(x))[place]]
    told = (links > 0) | (root != np.arange(len(x)))
    return pa.table({"node": node[told], "links": links[told], "root": node[root[told]]})


def embedding_groups(vectors: DataFrame, threshold: float = 0.93) -> DataFrame:
    """Per row of ``vectors`` (vec_id, embedding, label; more columns are ignored): vec_id, n_links, component_id, kept.

    Two rows link when their labels are equal and not null, their vectors have the same number of components, and the cosine (double
    precision) is at least ``threshold``. n_links counts the other rows linked directly, component_id is the smallest vec_id
    reachable, kept marks the group's representative. Vectors that are null, empty, zero or hold null, NaN or
    infinite components, and rows with a null vec_id or label, link with nothing and are kept. Equal vectors are compared once, as one with a multiplicity;
    a repeated row is one more copy. No rows give no rows.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<float>").alias("embedding"), F.col("label").cast("long").alias("label"))
    sound = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("embedding", lambda x: x != 0)
    sound = F.coalesce(sound & F.col("label").isNotNull() & F.col("vec_id").isNotNull(), F.lit(False))
    distinct = rows.where(sound).groupBy("label", "embedding").agg(F.min("vec_id").alias("node"), F.count("*").alias("mult"))
    distinct = materialize(distinct.withColumn("dim", F.size("embedding").cast("long")))
    packed = distinct.select("label", "dim", "node", "mult", "embedding").mapInArrow(_pack, "label long, dim long, node long, mult long, vec binary")
    total = distinct.count()
    per_cell = max(CELL_ROWS, -(-total // MOST_CELLS))
    large = distinct.groupBy("label", "dim").count().where(F.col("count") > per_cell).collect()  # at most MOST_CELLS rows
    cells = {(r["label"], r["dim"]): -(-r["count"] // per_cell) for r in large}
    centroids = {}
    if cells:
        share = {key: min(1.0, SAMPLE_PER_CELL * k / next(r["count"] for r in large if (r["label"], r["dim"]) == key)) for key, k in cells.items()}
        chosen = packed.join(F.broadcast(packed.sparkSession.createDataFrame([(*key, s) for key, s in share.items()], "label long, dim long, share double")), ["label", "dim"])
        chosen = chosen.where(F.pmod(F.xxhash64(F.lit("cell"), "node"), F.lit(1 << 20)) < F.col("share") * (1 << 20))
        found = chosen.groupBy("label", "dim").applyInArrow(partial(_learn, cells=cells), "label long, dim long, centroids binary").collect()
        centroids = {(r["label"], r["dim"]): np.frombuffer(r["centroids"]).reshape(-1, r["dim"]) for r in found}
    placed = materialize(packed.mapInArrow(partial(_assign, centroids=centroids, threshold=threshold), "label long, dim long, node long, mult long, vec binary, cell long, guest boolean"))
    place = ["label", "dim", "cell"]
    sizes = placed.groupBy(*place).agg(F.count_if(~F.col("guest")).alias("homes"), F.count_if(F.col("guest")).alias("guests"))
    sizes = sizes.select(*place, F.ceil(F.col("homes") / BLOCK_ROWS).alias("homes"), F.ceil(F.col("guests") / BLOCK_ROWS).alias("guests"))
    sized = placed.join(small(materialize(sizes)), place).where("homes > 0")
    block = F.pmod(F.xxhash64("node"), F.when(F.col("guest"), F.col("guests")).otherwise(F.col("homes")))
    sized = sized.withColumn("block", block)
    task = "struct<guests: boolean, left: bigint, right: bigint, side: boolean>"
    home = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("homes") - 1),
        lambda j: F.struct(F.lit(False), F.least(j, F.col("block")), F.greatest(j, F.col("block")), j < F.col("block")).cast(task),
    )
    host = F.transform(F.slice(F.sequence(F.lit(0).cast("long"), F.col("guests")), 1, F.col("guests").cast("int")), lambda g: F.struct(F.lit(True), g, F.col("block"), F.lit(True)).cast(task))
    visit = F.transform(F.sequence(F.lit(0).cast("long"), F.col("homes") - 1), lambda j: F.struct(F.lit(True), F.col("block"), j, F.lit(False)).cast(task))
    tasks = sized.withColumn("task", F.explode(F.when(F.col("guest"), visit).otherwise(F.concat(home, host)))).select(*place, "node", "mult", "vec", "task.*")
    parts = tasks.groupBy(*place, "guests", "left", "right").applyInArrow(partial(_compare, threshold=threshold), "node long, links long, root long")
    parts = materialize(parts)
    counted = parts.groupBy("node").agg(F.sum("links").alias("links"))
    groups = components(parts.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")))
    judged = distinct.join(counted, "node", "left").join(groups, "node", "left")
    judged = judged.select("label", "embedding", (F.coalesce("links", F.lit(0)) + F.col("mult") - 1).alias("n_links"), F.coalesce("component", "node").alias("component_id"))
    good = rows.where(sound).join(judged, ["label", "embedding"]).select("vec_id", "n_links", "component_id")
    alone = rows.where(~sound).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return good.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def _pack(batches):
    for batch in batches:
        flat = batch.column("embedding")
        values = flat.flatten().to_numpy(zero_copy_only=False).astype("<f4")
        ends = np.cumsum(batch.column("dim").to_numpy())
        vec = [values[e - d : e].tobytes() for d, e in zip(batch.column("dim").to_pylist(), ends.tolist())]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("label", "dim", "node", "mult")), pa.array(vec, pa.binary())], ["label", "dim", "node", "mult", "vec"])
