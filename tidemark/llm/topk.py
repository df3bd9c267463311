"""Exact top-k by inner product, block at a time: blocks in order of their bounds per query, until a bound falls below the k-th score.

Vectors are renumbered so that like ones are neighbours, and cut into ranges (blocks) that keep, per component, the greatest and least value:
the summed products of a query with them bound every score in the block. Consecutive blocks form shards. A query first searches its own shard,
whose k-th score then decides which other shards it must visit at all; there the same search goes on from that score.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.embed import spherical_kmeans, unit
from tidemark.session import materialize

BLOCK_ROWS = 256
SHARD_BLOCKS = 256
# Queries that search a shard in one task, at most about.
BATCH_ROWS = 8192
# Shards whose bounds one task computes for a batch.
PACK_SHARDS = 64
# The order of vectors, which affects speed alone, is learned from so many of them.
SAMPLE_ROWS = 4096
PIVOTS = 64
# Integer components at or beyond this size are refused: scores would not fit a long.
MOST = 1 << 26
NOTHING = np.iinfo(np.int64).min


def exact_type(left: np.ndarray, right: np.ndarray) -> type:
    """The fastest number type in which all products of rows are exact."""
    most = int(np.abs(left).max(initial=0)) * int(np.abs(right).max(initial=0)) * max(left.shape[1], 1)
    return np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else np.int64


def upper_bounds(queries: np.ndarray, high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """(queries, blocks): summed greatest products per component."""
    kind = np.float64 if exact_type(queries, np.concatenate([high, low])) is not np.int64 else np.int64
    q, high, low = queries.astype(kind), high.astype(kind), low.astype(kind)
    return (np.maximum(q, 0) @ high.T + np.minimum(q, 0) @ low.T).astype(np.int64)


def search(queries, own, kth, blocks, high, low, k):
    """The k best of ``blocks`` [(ids, vectors)] per query as flat arrays (query row, id, score), ordered, and the number of scores computed.

    Only scores of at least ``kth`` count (``NOTHING``: all). Ids equal to the query's ``own`` are left out.
    """
    kth = kth.copy()
    bound = upper_bounds(queries, high, low)
    order = np.argsort(-bound, axis=1, kind="stable")
    best = [np.zeros(0, np.int64)] * 3
    live, scored = np.arange(len(queries)), 0
    kind = exact_type(queries, np.concatenate([high, low]))
    q = queries.astype(kind)
    ready = {}
    for step in range(len(blocks)):
        at = order[live, step]
        alive = bound[live, at] >= kth[live]
        live, at = live[alive], at[alive]
        if not len(live):
            break
        found = [best]
        for block in np.unique(at):
            rows = live[at == block]
            ids, vectors = blocks[block]
            if block not in ready:
                ready[block] = vectors.astype(kind).T
            scores = q[rows] @ ready[block]
            scored += scores.size
            row, place = np.nonzero(scores >= kth[rows][:, None])
            other = ids[place] != own[rows[row]]
            row, place = row[other], place[other]
            found.append([rows[row], ids[place], scores[row, place].astype(np.int64)])
        row, ids, score = (np.concatenate(parts) for parts in zip(*found))
        sort = np.lexsort((ids, -score, row))
        row, ids, score = row[sort], ids[sort], score[sort]
        begin = np.searchsorted(row, row)
        top = np.arange(len(row)) - begin < k
        best = [row[top], ids[top], score[top]]
        last = np.flatnonzero((np.arange(len(row)) - begin) == k - 1)
        kth[row[last]] = np.maximum(kth[row[last]], score[last])
    return *best, scored


def _numbers(column, kind, rows) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(rows, -1)


def _place(batches, pivots, kind):
    """Pack each vector and name the pivot it points to most."""
    for batch in batches:
        dims = batch.column("dim").to_numpy()
        flat = batch.column("ints").flatten().to_numpy()
        ends = np.cumsum(dims)
        cell = np.zeros(len(dims), np.int64)
        for dim, c in pivots.items():
            rows = np.flatnonzero(dims == dim)
            if len(rows):
                x = np.stack([flat[e - dim : e] for e in ends[rows]])
                cell[rows] = (x @ c.T).argmax(axis=1)
        packed = [flat[e - d : e].astype(kind).tobytes() for e, d in zip(ends, dims)]
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("dim"), pa.array(cell), pa.array(packed, pa.binary())], ["vec_id", "dim", "cell", "vec"])


BLOCK = pa.schema([("dim", pa.int64()), ("shard", pa.int64()), ("ids", pa.binary()), ("vecs", pa.binary()), ("high", pa.binary()), ("low", pa.binary())])


def _cut(batches, kind, block_rows, shard_blocks):
    """Blocks of consecutive vectors; a block has vectors of one length, a shard at most ``shard_blocks`` blocks."""
    shard, made, dim, held = TaskContext.get().partitionId() << 32, 0, None, []

    def close():
        nonlocal shard, made, held
        x = np.frombuffer(b"".join(v for _, v in held), kind).reshape(len(held), dim)
        ids = np.array([i for i, _ in held], "<i8")
        row = [[dim], [shard], [ids.tobytes()], [x.tobytes()], [x.max(axis=0).tobytes()], [x.min(axis=0).tobytes()]]
        made, held = made + 1, []
        if made == shard_blocks:
            shard, made = shard + 1, 0
        return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(row, BLOCK)], schema=BLOCK)

    for batch in batches:
        for vec_id, size, vec in zip(*(batch.column(c).to_pylist() for c in ("vec_id", "dim", "vec"))):
            if held and (size != dim or len(held) == block_rows):
                yield close()
            if size != dim and made:
                shard, made = shard + 1, 0
            dim = size
            held.append((vec_id, vec))
    if held:
        yield close()


def _open(table, kind):
    """Blocks, highest and lowest values of a table of block rows."""
    ids, vecs = table.column("ids").to_pylist(), table.column("vecs").to_pylist()
    blocks = [(np.frombuffer(i, "<i8"), np.frombuffer(v, kind).reshape(len(i) // 8, -1)) for i, v in zip(ids, vecs)]
    return blocks, _numbers(table.column("high"), kind, len(ids)), _numbers(table.column("low"), kind, len(ids))


HOME = "query_id long, dim long, vec binary, shard long, kth long, tops array<struct<vec_id:long,score:long>>"
HOME_ARROW = pa.schema([(c, pa.int64()) for c in ("query_id", "dim")] + [("vec", pa.binary()), ("shard", pa.int64()), ("kth", pa.int64())] + [("tops", pa.list_(pa.struct([("vec_id", pa.int64()), ("score", pa.int64())])))])
REACH = pa.schema([(c, pa.int64()) for c in ("batch", "query", "query_id", "kth")] + [("vec", pa.binary()), ("shard", pa.int64())])


def _home(key, table, kind, k, every):
    """The queries among a shard's own vectors, searched in that shard."""
    done = []
    blocks, high, low = _open(table, kind)
    asks = [(ids[ids % every == 0], x[ids % every == 0]) for ids, x in blocks]
    own, q = np.concatenate([a for a, _ in asks]), np.concatenate([x for _, x in asks])
    for begin in range(0, len(own), BATCH_ROWS):
        part, x = own[begin : begin + BATCH_ROWS], q[begin : begin + BATCH_ROWS]
        row, ids, score, _ = search(x, part, np.full(len(part), NOTHING), blocks, high, low, k)
        ends = np.searchsorted(row, np.arange(len(part) + 1)).astype(np.int32)
        full = np.diff(ends) == k
        kth = np.where(full, score[np.maximum(ends[1:] - 1, 0)] if len(score) else 0, 0)
        tops = pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays([pa.array(ids), pa.array(score)], ["vec_id", "score"]))
        n = len(part)
        columns = [pa.array(part), pa.array([x.shape[1]] * n, pa.int64()), pa.array([v.tobytes() for v in x], pa.binary()), pa.array([key[0].as_py()] * n, pa.int64()), pa.array(kth, mask=~full), tops]
        done.append(pa.Table.from_arrays(columns, ["query_id", "dim", "vec", "shard", "kth", "tops"]))
    return pa.concat_tables(done) if done else HOME_ARROW.empty_table()


def _reach(key, table, kind):
    """Which shards hold a block that may beat a query's k-th score; the query's own shard is done."""
    asks, shards = table.filter(table.column("ask")), table.filter(pc.invert(table.column("ask")))
    if not asks.num_rows or not shards.num_rows:
        return REACH.empty_table()
    q = _numbers(asks.column("vec"), kind, asks.num_rows)
    bound = upper_bounds(q, _numbers(shards.column("high"), kind, shards.num_rows), _numbers(shards.column("low"), kind, shards.num_rows))
    kth, home, number = asks.column("kth").fill_null(NOTHING).to_numpy(), asks.column("shard").to_numpy(), shards.column("shard").to_numpy()
    row, column = np.nonzero((bound >= kth[:, None]) & (home[:, None] != number[None]))
    taken = asks.take(pa.array(row)).select(["batch", "query", "query_id", "kth", "vec"])
    return taken.append_column("shard", pa.array(number[column]))


def _visit(key, table, kind, k):
    """A batch of queries in a shard they must visit."""
    asks, rows = table.filter(table.column("ask")), table.filter(pc.invert(table.column("ask")))
    blocks, high, low = _open(rows, kind)
    number, own = asks.column("query").to_numpy(), asks.column("query_id").to_numpy()
    kth = asks.column("kth").fill_null(NOTHING).to_numpy()
    row, ids, score, _ = search(_numbers(asks.column("vec"), kind, asks.num_rows), own, kth, blocks, high, low, k)
    return pa.table({"query": number[row], "query_id": own[row], "vec_id": ids, "score": score})


def _edges(key, table, kind):
    """The greatest and least values of a whole shard."""
    high, low = (_numbers(table.column(c), kind, table.num_rows) for c in ("high", "low"))
    row = {"dim": pa.array([key[0].as_py()], pa.int64()), "shard": pa.array([key[1].as_py()], pa.int64())}
    return pa.table(row | {"high": [high.max(axis=0).tobytes()], "low": [low.min(axis=0).tobytes()]})


def top_k(vectors: DataFrame, k: int = 20, every: int = 20, scale: int = 64) -> DataFrame:
    """Per query its ``k`` highest inner products: query_id, rank (from 1), vec_id, score; ties go to the smaller vec_id.

    ``vectors`` (vec_id, embedding; more columns are ignored): components become floor(``scale`` * x). Queries are the rows whose vec_id
    is divisible by ``every``, candidates all rows but those with the query's own vec_id; vectors of another length than the query's
    are no candidates. Null vectors, those with null, NaN or infinite components and rows without a vec_id take no part. Repeated rows
    are one query but each a candidate; rows with one vec_id and different vectors are queries of their own. Queries
    without candidates have no rows. An integer component of 2 ** 26 or more is an error.
    """
    sound = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.col("vec_id").isNotNull()
    ints = F.transform(F.col("embedding").cast("array<double>"), lambda x: F.floor(F.lit(float(scale)) * x)).cast("array<long>")
    rows = vectors.where(F.coalesce(sound, F.lit(False))).select(F.col("vec_id").cast("long").alias("vec_id"), ints.alias("ints"))
    rows = rows.withColumn("dim", F.size("ints").cast("long"))
    greatest = rows.agg(F.max(F.greatest(F.array_max("ints"), -F.array_min("ints")))).first()[0] or 0
    if greatest >= MOST:
        raise ValueError(f"component {greatest} is too large for exact scores")
    kind = "<i1" if greatest < 1 << 7 else "<i2" if greatest < 1 << 15 else "<i4"
    learned = rows.orderBy(F.xxhash64("vec_id"), "vec_id", "ints").limit(SAMPLE_ROWS).collect()
    pivots = {}
    for dim in {r["dim"] for r in learned if r["dim"]}:
        x = np.array([r["ints"] for r in learned if r["dim"] == dim], np.float64)
        x = x[np.linalg.norm(x, axis=1) > 0]
        if len(x):
            pivots[dim] = spherical_kmeans(unit(x), PIVOTS)
    placed = rows.mapInArrow(partial(_place, pivots=pivots, kind=kind), "vec_id long, dim long, cell long, vec binary")
    ordered = placed.repartitionByRange("dim", "cell", "vec_id", "vec").sortWithinPartitions("dim", "cell", "vec_id", "vec")
    blocks = materialize(ordered.mapInArrow(partial(_cut, kind=kind, block_rows=BLOCK_ROWS, shard_blocks=SHARD_BLOCKS), "dim long, shard long, ids binary, vecs binary, high binary, low binary"))
    found = materialize(blocks.groupBy("shard").applyInArrow(partial(_home, kind=kind, k=k, every=every), HOME))
    single = found.groupBy("query_id", "dim", "vec").agg(F.min("shard").alias("shard"), F.min_by(F.struct("kth", "tops"), "shard").alias("got"))
    asks = materialize(single.select(F.monotonically_increasing_id().alias("query"), "query_id", "dim", "vec", "shard", "got.*"))

    edges = blocks.select("dim", "shard", "high", "low").groupBy("dim", "shard").applyInArrow(partial(_edges, kind=kind), "dim long, shard long, high binary, low binary")
    edges = materialize(edges)
    counts = edges.groupBy("dim").agg(F.ceil(F.count("*") / PACK_SHARDS).alias("packs")).join(
        asks.groupBy("dim").agg(F.ceil(F.count("*") / BATCH_ROWS).alias("lots")), "dim"
    )
    counts = materialize(counts)
    number = F.sequence(F.lit(0).cast("long"), F.col("packs") - 1)
    # Queries of neighbouring shards share a batch where they can.
    left = asks.join(counts, "dim").withColumn("batch", F.pmod(F.xxhash64("query"), F.col("lots")))
    left = left.select("dim", "batch", F.explode(number).alias("pack"), F.lit(True).alias("ask"), "query", "query_id", "kth", "vec", "shard")
    right = edges.join(counts, "dim").withColumn("pack", F.pmod(F.xxhash64("shard"), F.col("packs")))
    right = right.select("dim", F.explode(F.sequence(F.lit(0).cast("long"), F.col("lots") - 1)).alias("batch"), "pack", F.lit(False).alias("ask"), "shard", "high", "low")
    reach = left.unionByName(right, allowMissingColumns=True).groupBy("dim", "batch", "pack")
    visits = materialize(reach.applyInArrow(partial(_reach, kind=kind), "batch long, query long, query_id long, kth long, vec binary, shard long"))

    wanted = visits.select("batch", "shard").distinct()
    hosts = blocks.join(wanted, "shard").select("batch", "shard", F.lit(False).alias("ask"), "ids", "vecs", "high", "low")
    guests = visits.withColumn("ask", F.lit(True))
    both = guests.unionByName(hosts, allowMissingColumns=True).groupBy("batch", "shard")
    away = both.applyInArrow(partial(_visit, kind=kind, k=k), "query long, query_id long, vec_id long, score long")
    home = asks.select("query", "query_id", F.explode("tops").alias("t")).select("query", "query_id", "t.*")
    best = Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id")
    ranked = home.unionByName(away).withColumn("rank", F.row_number().over(best))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
