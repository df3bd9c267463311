"""Removal of 50-byte strings that an earlier document holds, by suffix arrays over the places where documents can agree.

Every 50-byte window is assigned to the smallest hash among the short grams in it, so equal windows, wherever
they stand, have the same anchor. Runs of windows with one anchor are cut out where several documents have that anchor; the cut-outs of an anchor
meet in one task, equal ones once, and the suffix array of each anchor's cut-outs brings equal windows side by side.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.gsaca import suffix_arrays
from tidemark.llm.shared import pieces, small
from tidemark.llm.words import buffers, constants, mix
from tidemark.session import materialize

SPAN = 50
GRAM = 16
# Windows that one run holds at most.
RUN = 64
# An anchor is refined, its windows then being told apart by their DEPTH smallest hashes, where it has over HOT runs
# (before they are dealt out) or over DISTINCT different cut-outs (in the task that has them).
HOT = 20_000
DISTINCT = 200
DEPTH = 4
# Bytes whose suffix arrays are built at once, and bytes of cut-outs that a task gathers for that.
BATCH = 1 << 19
GATHERED = 2 << 20
_FACTOR = constants(4, 1717)


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes from each place on."""
    x = data.astype(np.uint64)
    for shift in (1, 2, 4):
        x = x[:-shift] | (x[shift:] << np.uint64(8 * shift)) if len(x) > shift else x[:0]
    if len(x) <= 8:
        return x[:0]
    return mix(mix(x[:-8] * _FACTOR[0]) + x[8:] * _FACTOR[1])


def window_least(hashes: np.ndarray, count: int) -> np.ndarray:
    """The smallest of ``count`` consecutive hashes, from each place on."""
    width, least = 1, hashes
    while 2 * width <= count:
        least = np.minimum(least[:-width], least[width:]) if len(least) > width else least[:0]
        width *= 2
    rest = count - width
    return np.minimum(least[:-rest], least[rest:]) if rest and len(least) > rest else least if not rest else least[:0]


def _runs(batches):
    grams = SPAN - GRAM + 1
    for batch in pieces(batches):
        data, offsets = buffers(batch.column("text"))
        least = window_least(gram_hashes(data), grams)
        sizes = np.diff(offsets)
        counts = np.maximum(0, sizes - SPAN + 1)
        if not counts.any():
            continue
        ends = np.cumsum(counts)
        place = np.arange(ends[-1]) + np.repeat(offsets[:-1] - (ends - counts), counts)
        owner = np.repeat(np.arange(len(counts)), counts)
        value = least[place]
        new = np.ones(len(place), bool)
        new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
        begin = np.flatnonzero(new)
        length = np.diff(np.append(begin, len(place)))
        parts = -(-length // RUN)
        begin, length = np.repeat(begin, parts) + _inner(parts) * RUN, np.minimum(RUN, np.repeat(length, parts) - _inner(parts) * RUN)
        doc = batch.column("doc_id").to_numpy()
        at = place[begin] - offsets[owner[begin]]
        yield pa.RecordBatch.from_arrays([pa.array(value[begin].view(np.int64)), pa.array(doc[owner[begin]]), pa.array((at << 8) + length)], ["anchor", "doc_id", "run"])


def _inner(parts: np.ndarray) -> np.ndarray:
    ends = np.cumsum(parts)
    return np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - parts, parts)


def _lists(column: pa.ListArray) -> list[list]:
    """A column of lists as Python lists, its values turned at once."""
    bounds = (column.offsets.to_numpy() - column.offsets[0].as_py()).tolist()
    values = column.flatten().to_pylist()
    return [values[begin:end] for begin, end in zip(bounds[:-1], bounds[1:])]


def _cut(batches):
    for batch in batches:
        rows: list[tuple] = []
        lists = (_lists(batch.column(c)) for c in ("anchors", "runs", "hot"))
        for doc, text, anchors, runs, hot in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), *lists):
            data = text.encode()
            places: dict[tuple, list[int]] = {}  # a document that repeats a cut-out sends it once
            for anchor, run, often in zip(anchors, runs, hot):
                at, length = run >> 8, run & 255
                parts = _refined(data[at : at + length + SPAN - 1], length) if often else ((anchor, 0, length),)
                for key, b, n in parts:
                    places.setdefault((key, n, data[at + b : at + b + n + SPAN - 1]), []).append(at + b)
            rows.extend((key, doc, spots, n, content) for (key, n, content), spots in places.items())
            if len(rows) > 20_000:
                yield _cut_rows(rows)
                rows = []
        yield _cut_rows(rows)


def _cut_rows(rows):
    columns = list(zip(*rows)) or [[]] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, (pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.int32(), pa.binary()))], ["anchor", "doc_id", "at", "length", "bytes"])


def _refined(data: bytes, length: int):
    """The run in parts whose windows share their DEPTH smallest hashes, each with a key of these."""
    hashes = gram_hashes(np.frombuffer(data, np.uint8))
    view = np.lib.stride_tricks.sliding_window_view(hashes, SPAN - GRAM + 1)[:length]
    deep = np.sort(np.partition(view, DEPTH - 1, axis=1)[:, :DEPTH], axis=1)
    key = mix((deep * _FACTOR[None, :DEPTH]).sum(axis=1, dtype=np.uint64))
    cuts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    for begin, end in zip(cuts.tolist(), [*cuts[1:].tolist(), length]):
        yield int(key[begin].view(np.int64)), begin, end - begin


def repeated_windows(groups: list[list[tuple[bytes, int, int]]]) -> list[list[list[tuple[int, int]]]]:
    """For each group of distinct cut-outs (bytes, windows, smallest document): per cut-out its spans of windows that a smaller document of the group has.

    Cut-outs of one document and different ones are told apart by document only. The suffix arrays of all groups are built together.
    """
    data, sizes, first, limit, docs = [], [], [], [], []
    at = 0
    for group in groups:
        begin = at
        for content, windows, doc in group:
            own = np.frombuffer(content, np.uint8).astype(np.int64) + 2
            data += [own, np.ones(1, np.int64)]
            first.append(at)
            limit.append(windows)
            docs.append(doc)
            at += len(own) + 1
        data.append(np.zeros(1, np.int64))
        at += 1
        sizes.append(at - begin)
    flat = np.concatenate(data)
    sizes = np.array(sizes)
    order = suffix_arrays(flat, sizes)
    first, limit, docs = np.array(first), np.array(limit), np.array(docs)
    item = np.full(len(flat), -1, np.int64)
    spots = np.repeat(first, limit) + _inner(limit)
    item[spots] = np.repeat(np.arange(len(first)), limit)
    starts = order[item[order] >= 0]  # windows only, equal ones of a group side by side
    padded = np.concatenate([flat, np.zeros(SPAN, np.int64)])
    same = np.ones(max(0, len(starts) - 1), bool)
    group_of = np.repeat(np.arange(len(sizes)), sizes)[starts]
    same &= group_of[1:] == group_of[:-1]
    for j in range(SPAN):
        alike = np.flatnonzero(same)
        same[alike] = padded[starts[alike] + j] == padded[starts[alike + 1] + j]
    heads = np.flatnonzero(np.concatenate([[True], ~same])) if len(starts) else np.zeros(0, np.int64)
    own = docs[item[starts]]
    least = np.repeat(np.minimum.reduceat(own, heads), np.diff(np.append(heads, len(starts)))) if len(starts) else own
    gone = np.zeros(len(flat) + 1, bool)
    gone[starts[least < own]] = True
    result, n = [], 0
    for group in groups:
        result.append([])
        for _ in group:
            edge = np.diff(np.concatenate([[0], gone[first[n] : first[n] + limit[n]].astype(np.int8), [0]]))
            result[-1].append(list(zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist())))
            n += 1
    return result


def alike(group: np.ndarray, docs: np.ndarray, content: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The cut-outs, cut to the runs of windows whose hash another document of the group has: (cut-out, first window, windows).

    What is left out has no equal in another document; what is kept is compared as bytes.
    """
    data, offsets = buffers(content)
    sizes = np.diff(offsets)
    limit = sizes - SPAN + 1
    lots = np.flatnonzero(np.diff((offsets[:-1] - offsets[0]) // BATCH, prepend=-1))
    key = []
    for begin, end in zip(lots, [*lots[1:], len(sizes)]):
        hashes = gram_hashes(data[offsets[begin] : offsets[end]])
        spot = np.repeat(offsets[begin:end] - offsets[begin], limit[begin:end]) + _inner(limit[begin:end])
        # Four grams cover a window.
        mixed = np.repeat(group[begin:end].astype(np.uint64), limit[begin:end])
        for at, factor in zip((0, GRAM, 2 * GRAM, SPAN - GRAM), _FACTOR):
            mixed = mix(mixed) + hashes[spot + at] * factor
        key.append(mix(mixed))
    key = np.concatenate(key)
    order = np.argsort(key)
    heads = np.flatnonzero(np.concatenate([[True], key[order[1:]] != key[order[:-1]]]))
    own = np.repeat(docs, limit)[order]
    several = np.minimum.reduceat(own, heads) < np.maximum.reduceat(own, heads)
    kept = np.zeros(len(key), bool)
    kept[order] = np.repeat(several, np.diff(np.append(heads, len(key))))
    item = np.repeat(np.arange(len(sizes)), limit)
    edge = np.concatenate([[True], item[1:] != item[:-1], [True]])
    start = np.flatnonzero(kept & (edge[:-1] | np.concatenate([[True], ~kept[:-1]])))
    stop = np.flatnonzero(kept & (edge[1:] | np.concatenate([~kept[1:], [True]]))) + 1
    return item[start], start - (np.cumsum(limit) - limit)[item[start]], stop - start


class Cuts:
    """Cut-outs as columns: keys of their groups, documents, the places where each document has them, and their bytes."""

    def __init__(self, key: np.ndarray, doc: np.ndarray, spots: pa.ListArray, content: pa.BinaryArray):
        self.key, self.doc, self.spots, self.content = key, doc, spots, content

    def take(self, rows: np.ndarray) -> Cuts:
        some = pa.array(rows)
        return Cuts(self.key[rows], self.doc[rows], self.spots.take(some), self.content.take(some))

    def spans(self) -> np.ndarray:
        """Documents, begins and ends of all that the cut-outs cover."""
        counts = np.diff(self.spots.offsets.to_numpy())
        begin = self.spots.flatten().to_numpy()
        return np.stack([np.repeat(self.doc, counts), begin, begin + np.repeat(np.diff(buffers(self.content)[1]), counts)])

    def distinct(self) -> tuple[np.ndarray, Cuts]:
        """The spans of cut-outs that a smaller document of their group has, and the other cut-outs in order of their groups."""
        code = pc.dictionary_encode(self.content).indices.to_numpy()
        order = np.lexsort((self.doc, code, self.key))
        key, code, doc = self.key[order], code[order], self.doc[order]
        new = np.ones(len(order), bool)
        new[1:] = (key[1:] != key[:-1]) | (code[1:] != code[:-1])
        # A document whose rows repeat stays beside itself.
        again = doc != doc[np.flatnonzero(new)[np.cumsum(new) - 1]]
        return self.take(order[again]).spans(), self.take(order[~again])

    def several(self) -> Cuts:
        """Without the groups of one cut-out, which nothing else can equal; in order of their groups."""
        new = np.concatenate([[True], self.key[1:] != self.key[:-1]])
        sizes = np.diff(np.append(np.flatnonzero(new), len(new)))
        return self.take(np.flatnonzero(np.repeat(sizes > 1, sizes)))

    def pieces(self, item: np.ndarray, at: np.ndarray, windows: np.ndarray) -> Cuts:
        """Parts of the cut-outs: of ``item`` the ``windows`` from ``at`` on."""
        data, offsets = buffers(self.content)
        sizes = windows + SPAN - 1
        place = np.repeat(offsets[item] + at, sizes) + _inner(sizes)
        ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        content = pa.BinaryArray.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(data[place])])
        spots = self.spots.take(pa.array(item))
        moved = spots.flatten().to_numpy() + np.repeat(at, np.diff(spots.offsets.to_numpy()))
        return Cuts(self.key[item], self.doc[item], pa.ListArray.from_arrays(spots.offsets, pa.array(moved)), content)

    def groups(self) -> list[tuple[list, list]]:
        """Per group the distinct cut-outs (bytes, windows, document) and who has them where."""
        found, last = [], None
        for key, doc, spots, content in zip(self.key.tolist(), self.doc.tolist(), _lists(self.spots), self.content.to_pylist()):
            if key != last:
                last = key
                found.append(([], []))
            found[-1][0].append((content, len(content) - SPAN + 1, doc))
            found[-1][1].append((doc, spots))
        return found

    def refined(self) -> Cuts:
        """Each cut-out in the parts of ``_refined``, which make groups of their own."""
        keys, item, at, windows = [], [], [], []
        for n, content in enumerate(self.content.to_pylist()):
            for key, begin, count in _refined(content, len(content) - SPAN + 1):
                keys.append(key)
                item.append(n)
                at.append(begin)
                windows.append(count)
        finer = self.pieces(*(np.array(x, np.int64) for x in (item, at, windows)))
        finer.key = np.array(keys, np.int64)
        return finer

    def repeated(self) -> tuple[list[np.ndarray], list[tuple[list, list]]]:
        """The spans of cut-outs, whole or cut to windows that others have, that a smaller document of their group has, and the groups left to ``compared``."""
        spans, cuts = self.distinct()
        found, cuts = [spans], cuts.several()
        if not len(cuts.key):
            return found, []
        spans, cuts = cuts.pieces(*alike(cuts.key, cuts.doc, cuts.content)).distinct()
        found.append(spans)
        if not len(cuts.key):
            return found, []
        cuts = cuts.several()
        _, group, sizes = np.unique(cuts.key, return_inverse=True, return_counts=True)
        large = sizes[group] > DISTINCT
        work = cuts.take(np.flatnonzero(~large)).groups()
        if large.any():
            spans, finer = cuts.take(np.flatnonzero(large)).refined().distinct()
            found.append(spans)
            work += finer.groups()
        return found, [g for g in work if len(g[0]) > 1]


class Groups:
    """Cut-outs gathered row by row; ``close`` turns them into spans."""

    def __init__(self):
        self.rows: list[tuple] = []
        self.spans: list[tuple] = []

    def add(self, key, doc, spots, length, content):
        self.rows.append((key, doc, spots, content))

    def close(self):
        kinds = (pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary())
        key, doc, spots, content = (pa.array(c, kind) for c, kind in zip(zip(*self.rows), kinds))
        found, work = Cuts(key.to_numpy(), doc.to_numpy(), spots, content).repeated()
        self.spans += [tuple(span) for some in found for span in some.T.tolist()] + compared(work)
        self.rows = []


def compared(work: list[tuple[list, list]]) -> list[tuple]:
    """(document, begin, end) of all repeated windows of the gathered groups, groups of a size together."""
    work = sorted((g for g in work if len(g[0]) > 1), key=lambda g: sum(len(c[0]) for c in g[0]))
    found = []
    while work:
        part, size = [], 0
        while work and (not part or size < BATCH):
            part.append(work.pop())
            size += sum(len(c[0]) for c in part[-1][0])
        for (_, places), spans in zip(part, repeated_windows([g[0] for g in part])):
            for (doc, spots), own in zip(places, spans):
                found.extend((doc, at + b, at + e + SPAN - 1) for at in spots for b, e in own)
    return found


def _match(batches):
    """Rows sorted by anchor, bytes and document: spans of each document that a smaller one holds.

    The last anchor gathered may go on, so its different cut-outs wait for the next lot. Groups wait until their suffix arrays fill a batch.
    """
    held: list[Cuts] = []
    work: list[tuple[list, list]] = []
    size = waiting = 0

    def joined() -> Cuts:
        return Cuts(*(np.concatenate([getattr(c, n) for c in held]) for n in ("key", "doc")), *(pa.concat_arrays([getattr(c, n) for c in held]) for n in ("spots", "content")))

    for batch in batches:
        if batch.num_rows:
            held.append(Cuts(*(batch.column(c).to_numpy() for c in ("anchor", "doc_id")), *(batch.column(c) for c in ("at", "bytes"))))
            size += batch.column("bytes").nbytes
        if size > GATHERED:
            cuts = joined()
            last = cuts.key == cuts.key[-1]
            spans, rest = cuts.take(np.flatnonzero(last)).distinct()
            yield _span_rows(spans)
            found, more = cuts.take(np.flatnonzero(~last)).repeated() if not last.all() else ([], [])
            for spans in found:
                yield _span_rows(spans)
            work += more
            waiting += sum(len(c[0]) for g in more for c in g[0])
            if waiting >= BATCH:
                yield _span_rows(_listed(compared(work)))
                work, waiting = [], 0
            held, size = [rest], 0
    found, more = joined().repeated() if held else ([], [])
    for spans in found:
        yield _span_rows(spans)
    yield _span_rows(_listed(compared(work + more)))


def _listed(spans: list[tuple]) -> np.ndarray:
    return np.array(spans, np.int64).reshape(-1, 3).T


def _span_rows(spans):
    return pa.RecordBatch.from_arrays([pa.array(c) for c in np.ascontiguousarray(spans)], ["doc_id", "begin", "end"])


def _erase(batches):
    for batch in pieces(batches):
        sizes, removed, spans, kept = [], [], [], []
        for text, begins, ends, copy in zip(*(batch.column(c).to_pylist() for c in ("text", "begins", "ends", "copy"))):
            data = np.frombuffer((text or "").encode(), np.uint8)
            edge = np.zeros(len(data) + 1, np.int64)
            if copy and len(data) >= SPAN:
                edge[0], edge[-1] = 1, -1
            elif begins:
                np.add.at(edge, np.array(begins), 1)
                np.add.at(edge, np.array(ends), -1)
            gone = np.cumsum(edge[:-1]) > 0
            sizes.append(len(data))
            removed.append(int(gone.sum()))
            spans.append(int((np.diff(np.concatenate([[0], gone.astype(np.int8)])) == 1).sum()))
            kept.append(data[~gone].tobytes())
        columns = {n: batch.column(n) for n in batch.schema.names if n not in ("text", "begins", "ends", "copy")}
        columns |= {"n_bytes": pa.array(sizes, pa.int64()), "n_removed": pa.array(removed, pa.int64()), "n_spans": pa.array(spans, pa.int64()), "kept": pa.array(kept, pa.binary())}
        yield pa.RecordBatch.from_pydict(columns)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text; more columns are ignored): doc_id, n_bytes, n_removed, n_spans, kept (binary).

    A byte goes if a SPAN-byte string over it also starts in a document with a smaller doc_id; strings are judged
    on the input, and never cross documents. Null texts are empty, texts of fewer than SPAN bytes stay whole. Rows that repeat a doc_id are
    one document to the rule. A null doc_id loses nothing and takes nothing away. No rows give no rows.

    A text equal to that of a smaller doc_id goes whole and is compared with nothing else. Suffix arrays are built over those windows of an
    anchor's cut-outs alone whose hash several of its documents have. An anchor
    of many runs is refined by further hashes of its windows, so that what one task compares at once stays small.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    keyed = docs.where("doc_id is not null and text is not null").select("doc_id", F.md5("text").alias("digest"))
    first = keyed.groupBy("digest").agg(F.min("doc_id").alias("least"))
    copies = materialize(keyed.join(first, "digest").where("doc_id > least").select("doc_id", "digest", F.lit(True).alias("copy")).distinct())
    listed = small(copies)
    marked = docs.withColumn("digest", F.md5("text")).join(listed, ["doc_id", "digest"], "left").drop("digest")
    fresh = marked.where("copy is null and doc_id is not null and text is not null").select("doc_id", "text")
    runs = fresh.mapInArrow(_runs, "anchor long, doc_id long, run long")
    bucket = Window.partitionBy("anchor")
    shared = runs.select("*", F.min("doc_id").over(bucket).alias("least"), F.max("doc_id").over(bucket).alias("most"), (F.count("*").over(bucket) > HOT).alias("often"))
    shared = materialize(shared.where("least < most").select("anchor", "doc_id", "run", "often"))
    lists = shared.groupBy("doc_id").agg(F.collect_list(F.struct("anchor", "run", "often")).alias("r"))
    lists = lists.select("doc_id", F.col("r.anchor").alias("anchors"), F.col("r.run").alias("runs"), F.col("r.often").alias("hot"))
    need = small(materialize(shared.select("doc_id").distinct()))
    cut = fresh.join(need, "doc_id", "left_semi").join(lists, "doc_id").mapInArrow(_cut, "anchor long, doc_id long, at array<long>, length int, bytes binary")
    spans = cut.repartition("anchor").sortWithinPartitions("anchor", "bytes", "doc_id").mapInArrow(_match, "doc_id long, begin long, end long")
    spans = materialize(spans)
    gone = spans.groupBy("doc_id").agg(F.collect_list(F.struct("begin", "end")).alias("s"))
    gone = gone.select("doc_id", F.col("s.begin").alias("begins"), F.col("s.end").alias("ends"))
    hit = small(materialize(spans.select("doc_id").distinct().withColumn("hit", F.lit(True))))
    told = marked.join(hit, "doc_id", "left")
    changed = told.where("hit and copy is null").drop("hit").join(gone, "doc_id")
    none = F.lit(None).cast("array<long>")
    rest = told.where("hit is null or copy is not null").drop("hit").withColumns({"begins": none, "ends": none})
    columns = ["doc_id", "text", "copy", "begins", "ends"]
    return changed.select(*columns).unionByName(rest.select(*columns)).mapInArrow(_erase, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
