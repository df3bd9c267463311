"""Packing of documents into sequences: dominance reduction, then best fit, on the histogram of lengths.

A plan depends on how many pieces of each length there are, never on which ones, and
there are at most ``capacity`` lengths. So the driver sees only the histogram, whatever the corpus holds; the plan
is a list of patterns with multiplicities, and every piece finds its place from its rank among the pieces of its length.
"""

from __future__ import annotations

import zlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.encode import Encoder
from tidemark.llm.shared import pieces
from tidemark.session import materialize

RANK_SHIFT = 44
# Salts that split the ranking of one length, at least and at most, and pieces per salt between.
SALTS, MOST_SALTS, PER_SALT = 64, 1024, 500_000


def reduce_instance(counts: np.ndarray, capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Fix sets that dominate every other set with their largest item; ``counts`` keeps the rest.

    For an item j and the largest other item b that fits beside it: {j} is fixed if nothing fits beside
    it; {j, b} if they fill the sequence, or if no two items fit beside j, or if all items that together fit
    beside j fit into the place of b. Whatever a best packing puts beside j can then be exchanged for the
    fixed set without another sequence.
    """
    fixed = []
    changed = True
    while changed:
        changed = False
        for j in range(capacity, 0, -1):
            while counts[j]:
                counts[j] -= 1
                rest = np.flatnonzero(counts[: capacity - j + 1])
                counts[j] += 1
                if not len(rest):
                    fixed.append((int(counts[j]), [(j, 1)]))
                    counts[j] = 0
                    changed = True
                    continue
                b = int(rest[-1])
                two = 2 * int(rest[0]) if counts[rest[0]] > 1 + (rest[0] == j) else int(rest[0] + rest[1]) if len(rest) > 1 else capacity + 1
                if j + b != capacity and two <= capacity - j and _may_exceed(rest, b, capacity - j):
                    break
                times = int(counts[j] // 2 if b == j else min(counts[j], counts[b]))
                fixed.append((times, [(j, 2)] if b == j else [(j, 1), (b, 1)]))
                counts[j] -= times
                counts[b] -= times
                changed = True
    return fixed


def _may_exceed(lengths: np.ndarray, most: int, room: int) -> bool:
    """Whether two or more of ``lengths``, each used as often as wished, can sum to over ``most`` within ``room``."""
    if most + int(lengths[0]) <= room:
        return True
    within = (1 << (room + 1)) - 1
    reach = 0
    single = 0
    for x in lengths:
        single |= 1 << int(x)
    many = 0
    frontier = single
    while True:
        grown = 0
        for x in lengths:
            grown |= frontier << int(x)
        grown &= within
        many |= grown
        if many >> (most + 1):
            return True
        if not grown & ~reach:
            return False
        reach |= grown
        frontier = grown


def best_fit(counts: np.ndarray, capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Best-fit decreasing over the histogram: equal sequences are one group with a multiplicity."""
    groups: dict[int, list[tuple[int, list[tuple[int, int]]]]] = {}
    open_rooms = 0

    def put(room, times, pattern):
        nonlocal open_rooms
        groups.setdefault(room, []).append((times, pattern))
        open_rooms |= 1 << room

    for length in range(capacity, 0, -1):
        left = int(counts[length])
        while left:
            fitting = open_rooms >> length
            if fitting:
                room = (fitting & -fitting).bit_length() - 1 + length
                times, pattern = groups[room].pop()
                if not groups[room]:
                    open_rooms &= ~(1 << room)
            else:
                room, times, pattern = capacity, left, []
            each = room // length
            used = min(times, left // each)
            if used:
                put(room - each * length, used, pattern + [(length, each)])
                left -= used * each
            elif left:
                used = 1
                put(room - left * length, 1, pattern + [(length, left)])
                left = 0
            if times > used and pattern:
                put(room, times - used, pattern)
    return [entry for held in groups.values() for entry in held]


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Patterns (how often, [(length, how many of it)]) that hold every piece of the histogram."""
    counts = np.zeros(capacity + 1, np.int64)
    for length, count in histogram.items():
        if not 0 < length <= capacity:
            raise ValueError(f"length {length} is not between 1 and {capacity}")
        counts[length] = count
    return reduce_instance(counts, capacity) + best_fit(counts, capacity)


def slots(patterns) -> dict[str, np.ndarray]:
    """For each length, in order: rank of the first piece of an interval, its first sequence, pieces of that length in a sequence, and their offset."""
    rows, taken, sequence = [], {}, 0
    for times, pattern in patterns:
        offset = 0
        for length, each in pattern:
            begin = taken.get(length, 0)
            rows.append((length, begin, sequence, each, offset))
            taken[length] = begin + times * each
            offset += length * each
        sequence += times
    rows.sort()
    table = np.array(rows, np.int64).reshape(-1, 5)
    return {"key": (table[:, 0] << RANK_SHIFT) + table[:, 1], "sequence": table[:, 2], "each": table[:, 3], "offset": table[:, 4]}


def _place(batches, table):
    for batch in batches:
        length = batch.column("length").to_numpy()
        key = (length << RANK_SHIFT) + batch.column("rank").to_numpy()
        at = np.searchsorted(table["key"], key, side="right") - 1
        step = key - table["key"][at]
        sequence = table["sequence"][at] + step // table["each"][at]
        offset = table["offset"][at] + step % table["each"][at] * length
        kept = [n for n in batch.schema.names if n not in ("rank", "sequence_id", "offset")]
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in kept), pa.array(sequence), pa.array(offset)], [*kept, "sequence_id", "offset"])


def best_fit_pack(items: DataFrame, capacity: int) -> DataFrame:
    """``items`` (key columns and length: long, 1 to ``capacity``) with sequence_id and offset.

    Every row gets a place; rows of one sequence fill it from offset 0 without gaps. No
    rows give no rows; a length out of range is an error. Which of several rows of equal length gets which place
    follows their other columns and is the same in every run; equal rows get different places.
    """
    items = materialize(items)
    parts = items.groupBy("length").count()
    histogram = {row["length"]: row["count"] for row in parts.collect()}  # at most ``capacity`` rows
    table = slots(plan(histogram, capacity))
    salts = max(SALTS, min(MOST_SALTS, sum(histogram.values()) // PER_SALT))
    names = [c for c in items.columns if c not in ("sequence_id", "offset")]
    salted = items.select(*names, F.pmod(F.xxhash64(*names), F.lit(salts)).alias("salt"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = salted.groupBy("length", "salt").count().select("length", "salt", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("begin"))
    local = salted.withColumn("local", F.row_number().over(Window.partitionBy("length", "salt").orderBy(*[n for n in names if n != "length"])))
    ranked = local.join(starts, ["length", "salt"]).select(*names, (F.col("begin") + F.col("local") - 1).alias("rank"))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in items.schema if f.name in names]
    return ranked.mapInArrow(partial(_place, table=table), ", ".join([*fields, "sequence_id long", "offset long"]))


def _cut_tokens(batches, path, end_id, capacity):
    encoder = Encoder(path)
    end = np.array([end_id], "<u4").tobytes()
    for batch in pieces(batches):
        rows: list[tuple] = []
        for doc, ids in zip(batch.column("doc_id").to_pylist(), encoder.encode([t or "" for t in batch.column("text").to_pylist()])):
            ids += end
            for n, begin in enumerate(range(0, len(ids), 4 * capacity)):
                part = ids[begin : begin + 4 * capacity]
                rows.append((doc, n, begin // 4, len(part) // 4, zlib.crc32(part)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(values, kind) for values, kind in zip(zip(*rows), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
            ["doc_id", "piece", "start", "length", "ids_crc32"],
        )


def token_pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int) -> DataFrame:
    """Per piece of each row of ``docs`` (doc_id, text): doc_id, piece, start, length, ids_crc32.

    A document is its token ids (null text: none) and ``end_id``; only a document of more than ``capacity`` ids
    has several pieces, all full but the last. Repeated rows are documents of their own; a null doc_id stays null.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return docs.mapInArrow(partial(_cut_tokens, path=tokenizer, end_id=end_id, capacity=capacity), "doc_id long, piece int, start long, length long, ids_crc32 long")
