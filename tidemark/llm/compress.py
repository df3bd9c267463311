"""Product codes of integer vectors: exact integer k-means per part, with stored distances so that settled parts look at moved entries only.

The vectors pass through one task function per round and are written with the entry and exact distance of each part. A part
whose entry kept its place keeps its distance, and no unmoved entry can have become nearer, so only moved
entries are compared; a part whose entry moved compares all. Each task adds one row of sums per entry to what it writes;
these are added up by Spark, and only the codebooks (parts x entries) reach the driver.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.shared import drop_stage, small, stage
from tidemark.session import materialize

# Integer components at or beyond this size are refused: squares and their sums would not fit a long.
MOST = 1 << 24
STATE = "vec_id long, label {label}, ints array<long>, code binary, nearest array<long>, totals array<long>"


def distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of rows ``x`` to ``entries``, exact."""
    out = np.zeros((len(x), len(entries)), np.int64)
    for d in range(x.shape[1]):
        apart = x[:, d, None] - entries[None, :, d]
        out += apart * apart
    return out


def reassign(x: np.ndarray, entries: np.ndarray, moved: np.ndarray, code: np.ndarray, nearest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry and distance of each row of ``x``, the lowest index of equally near ones, from those before ``entries`` moved."""
    code, nearest = code.copy(), nearest.copy()
    lost = np.flatnonzero(moved[code])
    if len(lost):
        far = distances(x[lost], entries)
        code[lost] = far.argmin(axis=1)
        nearest[lost] = far.min(axis=1)
    settled = np.ones(len(x), bool)
    settled[lost] = False
    settled, active = np.flatnonzero(settled), np.flatnonzero(moved)
    if len(settled) and len(active):
        far = distances(x[settled], entries[active])
        rival, best = active[far.argmin(axis=1)], far.min(axis=1)
        wins = (best < nearest[settled]) | ((best == nearest[settled]) & (rival < code[settled]))
        code[settled[wins]], nearest[settled[wins]] = rival[wins], best[wins]
    return code, nearest


def _pass(batches, books: np.ndarray, moved: np.ndarray | None, label: pa.DataType, rows: int = 8192):
    """One assignment of every row; the last row of a task holds its sums and counts per entry instead of a vector."""
    parts, entries, sub = books.shape
    sums = np.zeros((parts, entries, sub + 1), np.int64)
    longs = pa.list_(pa.int64())
    schema = pa.schema([("vec_id", pa.int64()), ("label", label), ("ints", longs), ("code", pa.binary()), ("nearest", longs), ("totals", longs)])
    for whole in batches:
        for begin in range(0, whole.num_rows, rows):
            batch = whole.slice(begin, rows)
            n = batch.num_rows
            x = batch.column("ints").flatten().to_numpy().reshape(n, parts, sub)
            if moved is None:
                code, nearest = np.zeros((n, parts), np.int64), np.zeros((n, parts), np.int64)
            else:
                code = np.frombuffer(b"".join(batch.column("code").to_pylist()), np.uint8).reshape(n, parts).astype(np.int64)
                nearest = batch.column("nearest").flatten().to_numpy().reshape(n, parts).copy()
            for p in range(parts):
                fresh = np.ones(entries, bool) if moved is None else moved[p]
                new, near = reassign(x[:, p], books[p], fresh, code[:, p], nearest[:, p])
                code[:, p], nearest[:, p] = new, near
                np.add.at(sums[p, :, :sub], new, x[:, p])
                sums[p, :, sub] += np.bincount(new, minlength=entries)
            ends = pa.array(np.arange(n + 1, dtype=np.int32) * parts)
            packed = pa.array([row.tobytes() for row in code.astype(np.uint8)], pa.binary())
            columns = [batch.column("vec_id"), batch.column("label"), batch.column("ints"), packed, pa.ListArray.from_arrays(ends, pa.array(nearest.ravel())), pa.nulls(n, longs)]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)
    if sums[:, :, sub].any():
        yield pa.RecordBatch.from_arrays([pa.nulls(1, f.type) for f in list(schema)[:5]] + [pa.array([sums.ravel()], longs)], schema=schema)


def _totals(state: DataFrame, shape: tuple[int, int, int]) -> np.ndarray:
    """Sums and counts of all tasks: one row per component of the codebooks, so a few thousand."""
    spread = state.where("totals is not null").select(F.posexplode("totals").alias("at", "value"))
    found = spread.groupBy("at").agg(F.sum("value").alias("value")).collect()
    flat = np.zeros(int(np.prod(shape)), np.int64)
    for row in found:
        flat[row["at"]] = row["value"]
    return flat.reshape(shape)


def product_codes(vectors: DataFrame, parts: int = 8, entries: int = 16, scale: int = 4096, rounds: int = 6) -> tuple[DataFrame, np.ndarray]:
    """Codes of ``vectors`` (vec_id, embedding, label; more columns are ignored) and the codebooks (parts, entries, components of a part).

    Rows: vec_id, label, code (binary, an entry's index per part), error (long, squared distances to the entries added up). Components
    become floor(``scale`` * x). Vectors that are null, empty or hold null, NaN or infinite components are left out. Codebooks start as the
    parts of the vectors with the smallest vec_ids (nulls last; equal ones by their components), fewer than ``entries`` if there are fewer
    vectors. A round assigns each part to its nearest entry, ties to the lower index, and moves each entry to the componentwise floor of its
    parts' mean; entries without parts stay. Repeated rows count each. Without vectors there are no rows and the codebooks are empty. An error
    is raised if vectors differ in length, if it is no multiple of ``parts``, or for an integer of 2 ** 24 or more.
    """
    if not 1 <= entries <= 256:
        raise ValueError("an entry's index has one byte")
    ints = F.transform(F.col("embedding").cast("array<double>"), lambda x: F.floor(F.lit(float(scale)) * x))
    sound = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & (F.size("embedding") > 0)
    base = vectors.where(F.coalesce(sound, F.lit(False))).select(F.col("vec_id").cast("long").alias("vec_id"), "label", ints.cast("array<long>").alias("ints"))
    state, held = stage(base)
    largest = F.max(F.greatest(F.array_max("ints"), -F.array_min("ints")))
    shortest, longest, top = state.agg(F.min(F.size("ints")), F.max(F.size("ints")), largest).first()
    if shortest != longest or (shortest or 0) % parts:
        raise ValueError(f"vectors have {shortest} to {longest} components, not one multiple of {parts}")
    if (top or 0) >= MOST:
        raise ValueError(f"component {top} is too large for exact squared distances")
    first = [r["ints"] for r in state.orderBy(F.col("vec_id").asc_nulls_last(), "ints").select("ints").limit(entries).collect()]
    books = np.array(first, np.int64).reshape(len(first), parts, -1 if first else 0).transpose(1, 0, 2)
    kind = state.schema["label"].dataType
    schema = STATE.format(label=kind.simpleString())
    label = pa.schema([("l", _arrow(kind))]).field("l").type
    moved = None
    for turn in range(rounds + 1):
        before = held
        source = state if moved is None else state.where("totals is null")
        state, held = stage(source.mapInArrow(partial(_pass, books=books, moved=moved, label=label), schema))
        drop_stage(state.sparkSession, before)
        if turn == rounds or not first:
            break
        found = _totals(state, (*books.shape[:2], books.shape[2] + 1))
        count = found[:, :, -1:]
        new = np.where(count > 0, found[:, :, :-1] // np.maximum(count, 1), books)
        moved = (new != books).any(axis=2)
        books = new
        if not moved.any():  # the rounds left would change nothing
            break
    error = F.aggregate("nearest", F.lit(0).cast("long"), lambda total, more: total + more)
    return state.where("totals is null").select("vec_id", "label", "code", error.alias("error")), books


def _arrow(kind):
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def with_label_error(coded: DataFrame) -> DataFrame:
    """``coded`` plus label_error, the errors of all rows with the same label added up; rows without a label are one group."""
    sums = materialize(coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error")))
    return coded.join(small(sums), F.col("label").eqNullSafe(F.col("of")), "left").drop("of")
