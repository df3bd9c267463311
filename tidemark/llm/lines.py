"""Removal of lines that an earlier document holds already.

Lines found in several documents are indexed by a sharded minimal perfect hash: each shard maps its
line hashes without gaps to positions of flat arrays, which hold a fingerprint, the count and the smallest document.
Documents send the hashes of their lines to the shards and probe the arrays there; lines are never joined with lines.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import pieces, small
from tidemark.llm.words import _SPACE, buffers, constants, mix, span_hashes
from tidemark.session import materialize

KEYS_PER_SHARD = 4096
# Probes, in the mean, that one copy of a shard answers at most.
PROBES_PER_COPY = 20_000
# Slots per key of one level: more is faster to probe, fewer is smaller.
SLOTS = 1.5
LEVELS = 40
_LEVEL = constants(LEVELS, 909)


def line_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end byte of every line, and the number of lines of each text (at least one)."""
    breaks = np.flatnonzero(data == 10)
    counts = np.diff(np.searchsorted(breaks, offsets)) + 1
    begin = np.sort(np.concatenate([offsets[:-1], breaks + 1]), kind="stable")
    end = np.concatenate([begin[1:] - 1, offsets[-1:]])
    end[np.cumsum(counts) - 1] = offsets[1:]
    return begin, end, counts


def line_keys(column: pa.Array, least: int):
    """Of all lines: begin, end, lines per text; which have a key of ``least`` code points; the 128-bit hashes of those keys."""
    data, offsets = buffers(column)
    begin, end, counts = line_spans(data, offsets)
    solid = np.flatnonzero(~_SPACE[data])
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    low, high = np.searchsorted(solid, begin), np.searchsorted(solid, end) - 1
    full = high >= low
    first, last = np.zeros(len(begin), np.int64), np.zeros(len(begin), np.int64)
    first[full], last[full] = solid[low[full]], solid[high[full]] + 1
    keyed = full & (points[last] - points[first] >= least)
    first, last = first[keyed], last[keyed]
    return begin, end, counts, keyed, span_hashes(data, first, last, seed=11), span_hashes(data, first, last, seed=12)


def _probes(batches, least):
    for batch in pieces(batches):
        doc = batch.column("doc_id")
        _, _, counts, keyed, a, b = line_keys(batch.column("text"), least)
        owner = np.repeat(np.arange(len(counts)), counts)[keyed]
        order = np.lexsort((b, a, owner))
        owner, a, b = owner[order], a[order], b[order]
        new = np.ones(len(order), bool)
        new[1:] = (owner[1:] != owner[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        new &= ~doc.is_null().to_numpy(zero_copy_only=False)[owner]
        ids = doc.fill_null(0).to_numpy()
        yield pa.RecordBatch.from_arrays([pa.array(ids[owner[new]]), pa.array(a[new].view(np.int64)), pa.array(b[new].view(np.int64))], ["doc_id", "a", "b"])


def build_index(a: np.ndarray, b: np.ndarray, keeper: np.ndarray, count: np.ndarray) -> dict:
    """A minimal perfect hash of the distinct ``a`` and, in its order, fingerprints, keepers and counts.

    Level by level, the keys that are alone in a slot settle there and the others go on to
    the next level; the rank of a key's bit among all levels is its position. Keys that never settle
    (two lines with the same ``a``) come last and are looked up one by one.
    """
    rest = np.arange(len(a))
    sizes, bits, settled = [], [], []
    for level in range(LEVELS):
        if not len(rest):
            break
        size = max(64, int(SLOTS * len(rest)))
        slot = (mix(a[rest] ^ _LEVEL[level]) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(slot, minlength=size) == 1
        done = alone[slot]
        order = np.argsort(slot[done], kind="stable")
        settled.append(rest[done][order])
        sizes.append(size)
        bits.append(alone)
        rest = rest[~done]
    order = np.concatenate([*settled, rest]).astype(np.int64)
    flat = np.concatenate(bits) if bits else np.zeros(0, bool)
    return {
        "sizes": np.array(sizes, np.int64),
        "bits": np.packbits(flat),
        "loose": a[rest],
        "fingerprint": b[order],
        "keeper": keeper[order],
        "count": count[order],
    }


def probe(index: dict, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Position of every (a, b) in the arrays of ``index``, -1 where it is not among its lines."""
    at = np.full(len(a), -1, np.int64)
    flat = np.unpackbits(index["bits"], count=int(index["sizes"].sum())).astype(bool)
    rank = np.cumsum(flat) - 1
    open_, base = np.arange(len(a)), 0
    for level, size in enumerate(index["sizes"]):
        slot = base + (mix(a[open_] ^ _LEVEL[level]) % np.uint64(size)).astype(np.int64)
        hit = flat[slot]
        at[open_[hit]] = rank[slot[hit]]
        open_, base = open_[~hit], base + int(size)
    right = at >= 0
    right[right] = index["fingerprint"][at[right]] == b[right]
    at[~right] = -1
    first = len(index["fingerprint"]) - len(index["loose"])
    for n, value in enumerate(index["loose"]):
        at[(a == value) & (b == index["fingerprint"][first + n])] = first + n
    return at


_ARRAYS = {"sizes": np.int64, "bits": np.uint8, "loose": np.uint64, "fingerprint": np.uint64, "keeper": np.int64, "count": np.int64}
_SHARD = "shard long, " + ", ".join(f"{name} binary" for name in _ARRAYS)


def _build(key, table):
    a, b = (table.column(c).to_numpy().view(np.uint64) for c in ("a", "b"))
    count = table.column("n_docs").to_numpy()
    index = build_index(a, b, table.column("keeper").to_numpy(), count)
    columns = [pa.array([key[0].as_py()]), *(pa.array([index[n].astype(kind).tobytes()], pa.binary()) for n, kind in _ARRAYS.items())]
    return pa.table(columns, names=["shard", *_ARRAYS])


def _look_up(left, right):
    if not right.num_rows:
        return pa.table({"doc_id": pa.array([], pa.int64()), "line": pa.array([], pa.int64())})
    index = {n: np.frombuffer(right.column(n)[0].as_py(), kind) for n, kind in _ARRAYS.items()}
    doc = left.column("doc_id").to_numpy()
    a, b = (left.column(c).to_numpy().view(np.uint64) for c in ("a", "b"))
    at = probe(index, a, b)
    gone = (at >= 0) & (index["keeper"][at] < doc) if len(index["keeper"]) else at >= 0
    return pa.table({"doc_id": pa.array(doc[gone]), "line": pa.array((mix(a[gone]) + b[gone]).view(np.int64))})


def _rewrite(batches, least):
    for batch in pieces(batches):
        text = batch.column("text")
        begin, end, counts, keyed, a, b = line_keys(text, least)
        names = np.zeros(len(begin), np.uint64)
        names[keyed] = mix(a) + b
        first = np.concatenate([[0], np.cumsum(counts)])
        kept, dropped = [], np.zeros(len(counts), np.int64)
        for row, gone in enumerate(batch.column("gone").to_pylist()):
            whole = text[row].as_py() or ""
            if gone:
                own = slice(first[row], first[row + 1])
                out = keyed[own] & np.isin(names[own], np.array(gone, np.int64).view(np.uint64))
                dropped[row] = out.sum()
                whole = "\n".join(line for line, drop in zip(whole.split("\n"), out) if not drop)
            kept.append(whole)
        columns = {n: batch.column(n) for n in batch.schema.names if n not in ("text", "gone")}
        columns |= {"text": pa.array(kept, pa.string()), "n_lines": pa.array(counts.astype(np.int64)), "n_dropped": pa.array(dropped)}
        yield pa.RecordBatch.from_pydict(columns)


def dedup_lines(docs: DataFrame, least: int = 10) -> DataFrame:
    """``docs`` (doc_id, text, more) with the lines gone that a smaller doc_id holds, and n_lines (before), n_dropped (long).

    A line's key is the line stripped of blanks, tabs and breaks at both ends, with A-Z
    lower-cased. Keys of at least ``least`` code points found in several documents stay only in the smallest doc_id, there
    as often as they stand. A null or empty text is one empty line and comes back empty. Rows that repeat a doc_id are one document to
    the rule. A null doc_id loses no lines and takes none away. Columns named n_lines or n_dropped are replaced.
    """
    docs = docs.drop("n_lines", "n_dropped", "gone").withColumn("doc_id", F.col("doc_id").cast("long"))
    spark = docs.sparkSession
    probes = docs.select("doc_id", "text").mapInArrow(partial(_probes, least=least), "doc_id long, a long, b long")
    found = probes.groupBy("a", "b").agg(F.min("doc_id").alias("keeper"), F.max("doc_id").alias("last"), F.count("*").alias("n_docs"))
    repeated = materialize(found.where("keeper < last").select("a", "b", "keeper", "n_docs"))
    keys = repeated.count()
    shard = F.pmod(F.shiftrightunsigned("a", 8), F.lit(keys // KEYS_PER_SHARD + 1)).alias("shard")
    shards = repeated.select(shard, "*").groupBy("shard").applyInArrow(_build, _SHARD)
    shards = materialize(shards)
    # A shard is copied as its probes ask, those of lines found once included, and they are dealt over the copies; no shard, no probes.
    asked = materialize(probes.groupBy(shard).agg(F.count("*").alias("n_probes")))
    total = asked.agg(F.coalesce(F.sum("n_probes"), F.lit(0))).first()[0]
    each = min(PROBES_PER_COPY, max(500, total // (4 * int(spark.conf.get("spark.sql.shuffle.partitions")))))
    copies = (F.col("n_probes") / each).cast("long") + 1
    dealt = small(materialize(asked.join(shards.select("shard"), "shard").select("shard", copies.alias("copies"))))
    probing = probes.select("*", shard).join(dealt, "shard")
    probing = probing.withColumn("copy", F.pmod(F.xxhash64("doc_id", "b"), F.col("copies"))).drop("copies")
    copied = shards.join(dealt, "shard").withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1))).drop("copies")
    gone = probing.groupBy("shard", "copy").cogroup(copied.groupBy("shard", "copy")).applyInArrow(_look_up, "doc_id long, line long")
    gone = gone.groupBy("doc_id").agg(F.collect_set("line").alias("gone"))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != "text"]
    return docs.join(gone, "doc_id", "left").mapInArrow(partial(_rewrite, least=least), ", ".join([*fields, "text string", "n_lines long", "n_dropped long"]))
