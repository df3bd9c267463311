"""Exact similarity join of word-shingle sets with PartEnum signatures.

Sizes fall into bands, each band's upper end being the largest size that can still
link to its lower end, so linked sets lie in one band or in two neighbours, and every set signs in its own
band and the next. Within a band two linked sets differ in at most ``k`` shingles.
The shingle domain is hashed into first-level parts, enough that at least two of
them hold at most one difference, and each part into three cells: two of the cells
then agree. The signatures are all (part, pair of cells) with the hash of what the
set has there, so linked sets share one. Candidates are verified on the whole sets.
"""

from __future__ import annotations

import zlib
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import components, pieces, small, smallest_reached
from tidemark.llm.words import constants, mix, shingle_sets
from tidemark.session import materialize

CELLS = 3
PAIRS = list(combinations(range(CELLS), 2))
# One in so many parts is beyond those the bound asks for, and one at least.
SPARE_IN = 5
# Documents that a block holds at most, and shingles, beside those of the document that fills it.
BLOCK_DOCS = 512
BLOCK_SHINGLES = 1 << 20
# Cells of a sketch, a bit each, and candidate pairs whose sketches are compared at once.
SKETCH = 768
_PAIRS = 1 << 18
# Blocks that share so many signatures across groups meet as a whole before candidates are looked at one by one.
PARTNER_SIGNS = 256
# Shingles whose incidence is multiplied at once, and ranges of shingles that a comparison of blocks sorts one after the other.
COLUMNS = 4096
RANGES = 16
_SEEDS = constants(4, 4242)
_ROWS = 500_000


def band_ends(size: int, percent: int) -> list[int]:
    """Upper ends of the size bands up to the one after that of ``size``."""
    ends, low = [], 1
    while not ends or len(ends) < 2 or ends[-2] < size:
        ends.append(low * 100 // percent)
        low = ends[-1] + 1
    return ends


def allowed(end: int, percent: int) -> int:
    """The most shingles in which two linked sets of at most ``end`` shingles can differ."""
    return 2 * end * (100 - percent) // (100 + percent)


def spare(k: int) -> int:
    """Parts beyond those that ``k`` differences ask for: a set with no more parts than that with an empty pair of cells need not sign empty pairs."""
    return 1 + (k // 2 + 2) // SPARE_IN


def signatures(shingles: np.ndarray, percent: int, ends: list[int]) -> np.ndarray:
    """All signatures of a set. A set that can only link to equal ones (k = 0) has none: equal sets are one class already."""
    out = []
    home = int(np.searchsorted(ends, len(shingles)))
    spread = mix(shingles ^ _SEEDS[0])
    weight = mix(shingles + _SEEDS[1])
    for band in (home, home + 1):
        k = allowed(ends[band], percent)
        if k < 1:
            continue
        parts = k // 2 + 1 + spare(k)
        cell = ((spread >> np.uint64(32)) * np.uint64(parts * CELLS)) >> np.uint64(32)
        cell = cell.astype(np.int64)
        sums = np.zeros(parts * CELLS, np.uint64)
        np.add.at(sums, cell, weight)
        filled = (np.bincount(cell, minlength=parts * CELLS) > 0).reshape(parts, CELLS)
        sums = sums.reshape(parts, CELLS)
        place = np.arange(parts, dtype=np.uint64) * _SEEDS[2] + band * _SEEDS[3:]
        held = np.stack([filled[:, a] | filled[:, b] for a, b in PAIRS])
        signs = np.stack([mix(sums[:, a] + sums[:, b] + mix(place + np.uint64(n + 1))) for n, (a, b) in enumerate(PAIRS)])
        scarce = int((~held.all(axis=0)).sum()) > spare(k)
        out.append(signs.ravel() if scarce else signs[held])
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def _digest(sets):
    """Size, and two sums of hashes that tell sets apart, of each set."""
    size = np.fromiter((len(s) for s in sets), np.int64, len(sets))
    low = np.fromiter((int(s.sum(dtype=np.uint64)) for s in sets), np.uint64, len(sets)).view(np.int64)
    high = np.fromiter((int(mix(s + _SEEDS[2]).sum(dtype=np.uint64)) for s in sets), np.uint64, len(sets)).view(np.int64)
    return [pa.array(size), pa.array(low), pa.array(high)]


def _digests(batches, width, percent):
    ends = band_ends(1, percent)
    for batch in pieces(batches):
        sets = shingle_sets(batch.column("text"), width)
        longest = max((len(s) for s in sets), default=0)
        if ends[-2] < longest:
            ends = band_ends(longest, percent)
        rank = pa.array([int(s[0] >> np.uint64(1)) if len(s) else 0 for s in sets], pa.int64())
        need = pa.array([common_signs(s, percent, ends) if len(s) else 1 for s in sets], pa.int64())
        columns = [batch.column("doc_id"), *_digest(sets), rank, need, pa.array([sketch(s) for s in sets], pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "low", "high", "least", "need", "sketch"])


def _sign(batches, width, percent):
    ends = band_ends(1, percent)
    seen: set[tuple[int, int]] = set()
    signs, owners, held = [], [], 0

    def flush():
        counts = [len(s) for s in signs]
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(signs).view(np.int64)), pa.array(np.repeat(np.array(owners, np.int64), counts))], ["sign", "doc_id"])

    for batch in pieces(batches):
        for doc, own in zip(batch.column("doc_id").to_pylist(), shingle_sets(batch.column("text"), width)):
            if not len(own) or doc is None:
                continue
            digest = (int(own.sum(dtype=np.uint64)), len(own))
            if digest in seen:
                continue  # an equal set of this task has signed already; both are of one class
            if len(seen) < 200_000:
                seen.add(digest)
            if ends[-2] < len(own):
                ends = band_ends(len(own), percent)
            found = signatures(own, percent, ends)
            if len(found):
                signs.append(found)
                owners.append(doc)
                held += len(found)
                if held > _ROWS:
                    yield flush()
                    signs, owners, held = [], [], 0
    if signs:
        yield flush()


def sketch(shingles: np.ndarray) -> bytes:
    """Per cell of a fixed partition of the domain whether it holds an odd number of shingles. Two sets that differ in k shingles differ in at most k cells."""
    cell = (mix(shingles ^ _SEEDS[3]) % np.uint64(SKETCH)).astype(np.int64)
    return np.packbits(np.bincount(cell, minlength=SKETCH) & 1).tobytes()


def common_signs(shingles: np.ndarray, percent: int, ends: list[int]) -> int:
    """How many signatures, at least, a set has in common with any other that links to it."""
    home = int(np.searchsorted(ends, len(shingles)))
    spread = mix(shingles ^ _SEEDS[0]) >> np.uint64(32)
    least = []
    for band in (home, home + 1):
        k = allowed(ends[band], percent)
        parts = k // 2 + 1 + spare(k)
        cell = ((spread * np.uint64(parts * CELLS)) >> np.uint64(32)).astype(np.int64)
        filled = (np.bincount(cell, minlength=parts * CELLS) > 0).reshape(parts, CELLS)
        empty = int((filled.sum(axis=1) < 2).sum())
        least.append(1 + spare(k) - empty if empty <= spare(k) else 1)
    return min(least)


def _sets(batches, width):
    seen: set[tuple[int, int, int]] = set()
    for batch in pieces(batches):
        sets = shingle_sets(batch.column("text"), width)
        out = pa.RecordBatch.from_arrays([batch.column("doc_id"), *_digest(sets), pa.array([s.tobytes() for s in sets], pa.binary())], ["doc_id", "size", "low", "high", "shingles"])
        new = []
        for row in zip(*(out.column(c).to_pylist() for c in ("doc_id", "low", "high"))):
            new.append(row not in seen)  # a repeated row is told once
            if len(seen) < 200_000:
                seen.add(row)
        yield out.filter(pa.array(new, pa.bool_()))


def pack_block(sets: list[np.ndarray]) -> bytes:
    """Sorted sets of a block: their sizes, the distinct shingles, and the sets as steps in those, which are small where sets are alike."""
    sizes = np.array([len(s) for s in sets], np.int32)
    known, place = np.unique(np.concatenate(sets), return_inverse=True)
    steps = np.diff(place.astype(np.int32), prepend=np.int32(0))
    head = np.array([len(sizes), len(known)], np.int32)
    return head.tobytes() + sizes.tobytes() + known.tobytes() + zlib.compress(steps.tobytes(), 1)


def unpack_block(data: bytes) -> list[np.ndarray]:
    docs, count = np.frombuffer(data, np.int32, 2).tolist()
    sizes = np.frombuffer(data, np.int32, docs, 8)
    known = np.frombuffer(data, np.uint64, count, 8 + 4 * docs)
    place = np.cumsum(np.frombuffer(zlib.decompress(data[8 + 4 * docs + 8 * count :]), np.int32))
    return np.split(known[place], np.cumsum(sizes)[:-1])


def _rank(batches):
    """The same rows with their part, and the documents and shingles before each in its part."""
    part, docs, held = TaskContext.get().partitionId(), 0, 0
    for batch in batches:
        size = batch.column("size").to_numpy()
        before = [np.full(len(size), part), docs + np.arange(len(size)), held + np.cumsum(size) - size]
        docs, held = docs + len(size), held + int(size.sum())
        yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in before), *batch.columns], ["part", "docs", "held", *batch.schema.names])


def _block(key, table):
    """The row of one block, from its sets."""
    kept = {}
    for doc, low, high, data in zip(*(table.column(c).to_pylist() for c in ("doc_id", "low", "high", "shingles"))):
        kept[doc, low, high] = np.frombuffer(data, np.uint64)
    docs = pa.array([[doc for doc, _, _ in kept]], pa.list_(pa.int64()))
    return pa.table({"block": pa.array([key[0].as_py()], pa.int64()), "docs": docs, "sets": pa.array([pack_block(list(kept.values()))], pa.binary())})


def _meet(batches, percent):
    """Pairs of documents of one signature and different groups that may link, from rows sorted by signature and group.

    A pair is ruled out if its blocks have been compared, by sizes, or if its sketches differ in more cells than it may differ in shingles;
    and it must be met under ``need`` signatures in all.
    """
    names = ["sign", "doc_id", "group", "size", "need", "block", "partner"]
    out = pa.schema([(c, pa.int64()) for c in ("a", "b", "need")])

    def pairs(rows):
        sign, doc, group, size, need, block, partner = (rows.column(c).to_numpy() for c in names)
        cells = np.frombuffer(b"".join(rows.column("sketch").to_pylist()), np.uint64).reshape(len(sign), SKETCH // 64)
        # Each row meets those of its signature behind its group's rows: no two of a group.
        new = sign[1:] != sign[:-1]
        last = np.append(np.flatnonzero(new) + 1, len(sign))
        ends = np.append(np.flatnonzero(new | (group[1:] != group[:-1])) + 1, len(sign))
        at = np.arange(len(sign))
        behind = ends[np.searchsorted(ends, at, side="right")]
        count = last[np.searchsorted(last, at, side="right")] - behind
        total = np.cumsum(count)
        for begin in range(0, int(total[-1]) if len(total) else 0, _PAIRS):
            pair = np.arange(begin, min(begin + _PAIRS, int(total[-1])))
            x = np.searchsorted(total, pair, side="right")
            y = behind[x] + pair - (total[x] - count[x])
            small, large = np.minimum(size[x], size[y]), np.maximum(size[x], size[y])
            ok = (100 * small >= percent * large) & (block[x] != block[y]) & (block[x] != partner[y]) & (partner[x] != block[y])
            x, y = x[ok], y[ok]
            most = (size[x] + size[y]) * (100 - percent) // (100 + percent)
            ok = np.bitwise_count(cells[x] ^ cells[y]).sum(axis=1, dtype=np.int64) <= most
            x, y = x[ok], y[ok]
            asked = np.maximum(need[x], need[y])
            if len(x):
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(doc[x], doc[y])), pa.array(np.maximum(doc[x], doc[y])), pa.array(asked)], schema=out)

    held = []
    for batch in batches:
        sign = batch.column("sign").to_numpy()
        last = int(np.searchsorted(sign, sign[-1])) if len(sign) else 0
        if last:  # signatures before the last one are complete
            held.append(batch.slice(0, last))
            yield from pairs(pa.Table.from_batches(held).combine_chunks())
            held = [batch.slice(last)]
        elif len(sign):
            if held and held[0].column("sign")[0].as_py() != sign[0]:
                yield from pairs(pa.Table.from_batches(held).combine_chunks())
                held = []
            held.append(batch)
    if held:
        yield from pairs(pa.Table.from_batches(held).combine_chunks())


def _verify(key, table, percent):
    first, second = key[0].as_py(), key[1].as_py()
    sets = [(doc, np.frombuffer(data, np.uint64)) for doc, data in zip(table.column("doc_id").to_pylist(), table.column("shingles").to_pylist())]

    def linked(x, y):
        common = len(np.intersect1d(x, y, assume_unique=True))
        return 100 * common >= percent * (len(x) + len(y) - common)

    found = any(linked(x, y) for a, x in sets if a == first for b, y in sets if b == second)
    return pa.table({"a": pa.array([first] * found, pa.int64()), "b": pa.array([second] * found, pa.int64())})


def _compare(key, table, percent):
    """Links within a block or between two: each linked document with the smallest one it reaches here."""
    sets = [own for data in table.column("sets") for own in unpack_block(data.as_buffer())]
    held = table.column("docs").to_pylist()
    docs, block = np.array(sum(held, []), np.int64), np.repeat(table.column("block").to_numpy(), [len(h) for h in held])
    size = np.array([len(s) for s in sets])
    first, second = key[0].as_py(), key[1].as_py()
    rows, others = np.flatnonzero(block == first), np.flatnonzero(block == second)
    common = np.zeros((len(rows), len(others)), np.float32)
    bounds = np.arange(1, RANGES, dtype=np.uint64) * np.uint64((1 << 64) // RANGES)
    cuts = np.array([[0, *np.searchsorted(s, bounds).tolist(), len(s)] for s in sets]).T
    for lows, highs in zip(cuts[:-1], cuts[1:]):
        owner = np.repeat(np.arange(len(sets), dtype=np.int32), highs - lows)
        shingles = np.concatenate([s[low:high] for s, low, high in zip(sets, lows.tolist(), highs.tolist())])
        order = np.argsort(shingles, kind="stable")
        owner, shingles = owner[order], shingles[order]
        again = shingles[1:] == shingles[:-1]
        shared = np.concatenate([[False], again]) | np.concatenate([again, [False]]) if len(again) else np.zeros(len(shingles), bool)
        owner, shingles = owner[shared], shingles[shared]
        if not len(owner):
            continue
        column = np.cumsum(np.concatenate([[0], shingles[1:] != shingles[:-1]]))
        for begin in range(0, int(column[-1]) + 1, COLUMNS):
            low, high = np.searchsorted(column, [begin, begin + COLUMNS])
            part = np.zeros((len(sets), min(COLUMNS, int(column[-1]) + 1 - begin)), np.float32)
            part[owner[low:high], column[low:high] - begin] = 1
            common += part[rows] @ part[others].T
    union = size[rows][:, None] + size[others][None] - common
    a, b = np.nonzero((100 * common >= percent * union) & (docs[rows][:, None] != docs[others][None]))
    rank = np.argsort(np.argsort(docs, kind="stable"), kind="stable")
    order = np.argsort(docs, kind="stable")
    root = order[smallest_reached(rank[rows[a]], rank[others[b]], len(docs))[rank]]
    told = root != np.arange(len(docs))
    return pa.table({"a": docs[told], "b": docs[root[told]]})


def jaccard_components(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """Per row of ``docs`` (doc_id, text; further columns are ignored): doc_id, n_shingles, component_id, class_id.

    Two documents link when 100 * intersection >= percent * union of their
    ``width``-word shingle sets; component_id is the smallest doc_id reachable by links,
    class_id the smallest doc_id with an equal set. Texts that are null or without words have
    n_shingles 0 and link with nothing. Rows that repeat a doc_id are one document with several sets; a null doc_id is kept
    and links with nothing. An empty table gives no rows.

    Copies are one class before any signing. Documents that share as many signatures as a link ensures are put into blocks of bounded size,
    candidates of each other side by side. Blocks are compared as a whole, by products of their incidence matrices: each with itself, and with the one
    it shares most signatures with across groups of linked documents, which makes large groups whole. Documents of one group need no
    other comparison; those of different groups that share a signature are compared by sketches where they meet, and only pairs that
    may link are told and compared as whole sets.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    fields = "doc_id long, n_shingles long, low long, high long, least long, need long, sketch binary"
    digests = materialize(docs.mapInArrow(partial(_digests, width=width, percent=percent), fields))
    classes = digests.where("n_shingles > 0").groupBy("n_shingles", "low", "high").agg(F.min("doc_id").alias("class_id"))
    members = materialize(
        digests.select("doc_id", "n_shingles", "low", "high").join(classes.where("class_id is not null"), ["n_shingles", "low", "high"], "left")
        .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("class_id")).alias("class_id"))
        .withColumn("class_id", F.coalesce("class_id", "doc_id"))
    )
    of = members.where("n_shingles > 0 and doc_id is not null")
    moved = small(materialize(of.where("doc_id <> class_id").select("doc_id", "class_id").distinct()))
    signs = docs.mapInArrow(partial(_sign, width=width, percent=percent), "sign long, doc_id long")
    bucket = Window.partitionBy("sign")
    shared = signs.withColumn("least", F.min("doc_id").over(bucket)).withColumn("most", F.max("doc_id").over(bucket)).where("least < most").select("sign", "doc_id")
    shared = shared.join(moved, "doc_id", "left").select("sign", F.coalesce("class_id", "doc_id").alias("doc_id"))
    shared = materialize(shared.distinct())
    # A document that links to another one lies under ``need`` signatures with it; one under fewer that are shared at all is no candidate.
    known = digests.where("n_shingles > 0 and doc_id is not null").select("doc_id", F.col("n_shingles").alias("size"), "low", "high", "least", "need", "sketch")
    asked = known.groupBy("doc_id").agg(F.min("need").alias("asked"))
    able = small(materialize(shared.groupBy("doc_id").count().join(asked, "doc_id").where("count >= asked").select("doc_id")))
    shared = shared.join(able, "doc_id", "left_semi")
    first = shared.groupBy("sign").agg(F.min("doc_id").alias("a"))
    candidates = components(shared.join(first, "sign").select("a", F.col("doc_id").alias("b")))
    near = small(materialize(candidates.withColumnRenamed("node", "doc_id").withColumnRenamed("component", "near")))
    # Candidates of each other lie side by side, those with the same smallest hash closest, so that most links are within blocks. Only
    # what a document needs to find its place is sorted; its set goes straight to its block.
    order = ["near", "least", "doc_id", "low"]
    spread = known.join(near, "doc_id").dropDuplicates(["doc_id", "size", "low", "high"]).repartitionByRange(*order).sortWithinPartitions(*order)
    spread = spread.select("doc_id", "size", "low", "high", "need", "sketch")
    ranked = materialize(spread.mapInArrow(_rank, "part long, docs long, held long, doc_id long, size long, low long, high long, need long, sketch binary"))
    # Both counts of what lies before a document only grow, so each pair of their steps is a block: blocks are full, however the rows are dealt.
    parts = ranked.groupBy("part").agg(F.count("*").alias("n"), F.sum("size").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per part
    parts = materialize(parts.select("part", *(F.coalesce(F.sum(c).over(before), F.lit(0)).alias(c) for c in ("n", "total"))))
    step = F.floor((F.col("docs") + F.col("n")) / BLOCK_DOCS) + F.floor((F.col("held") + F.col("total")) / BLOCK_SHINGLES)
    placed = materialize(ranked.join(small(parts), "part").select(step.alias("block"), "doc_id", "size", "low", "high", "need", "sketch"))
    at = small(materialize(placed.select("doc_id", "block").distinct()))
    fields = "doc_id long, size long, low long, high long, shingles binary"
    sets = docs.join(near.select("doc_id"), "doc_id").mapInArrow(partial(_sets, width=width), fields)
    spots = small(placed.select("doc_id", "size", "low", "high", "block"))
    sets = sets.join(spots, ["doc_id", "size", "low", "high"]).select("block", "doc_id", "low", "high", "shingles")
    blocks = materialize(sets.groupBy("block").applyInArrow(_block, "block long, docs array<long>, sets binary"))

    def compared(tasks: DataFrame) -> DataFrame:
        held = tasks.select("first", "second", F.explode(F.array_distinct(F.array("first", "second"))).alias("block")).join(blocks.select("block", "docs", "sets"), "block")
        return materialize(held.groupBy("first", "second").applyInArrow(partial(_compare, percent=percent), "a long, b long"))

    def apart(links: DataFrame) -> DataFrame:
        """(sign, doc_id, block, group) of the signatures that still lie in several groups of linked documents, and in several blocks."""
        groups = small(materialize(components(links).select(F.col("node").alias("doc_id"), F.col("component").alias("group"))))
        lying = shared.join(at, "doc_id").join(groups, "doc_id", "left").select("sign", "doc_id", "block", F.coalesce("group", "doc_id").alias("group"))
        ends = {f"{f.__name__}_{c}": f(c).over(bucket) for f in (F.min, F.max) for c in ("group", "block")}
        mixed = lying.withColumns(ends).where("min_group < max_group and min_block < max_block")
        return materialize(mixed.select("sign", "doc_id", "block", "group"))

    links = compared(blocks.select(F.col("block").alias("first"), F.col("block").alias("second")))
    # Blocks of one large group meet first, each with one other: the group is whole after that, and its documents need no other comparison.
    mixed = apart(links).select("sign", "block", "group").distinct()
    least = mixed.groupBy("sign").agg(F.min(F.struct("block", "group")).alias("one"))
    chosen = mixed.join(least, "sign").where((F.col("group") != F.col("one.group")) & (F.col("block") != F.col("one.block")))
    chosen = chosen.groupBy("block", F.col("one.block").alias("partner")).count().where(F.col("count") >= PARTNER_SIGNS)
    chosen = chosen.groupBy("block").agg(F.max_by("partner", F.struct("count", -F.col("partner"))).alias("partner"))
    chosen = materialize(chosen)
    tasks = chosen.select(F.col("partner").alias("first"), F.col("block").alias("second"))
    links = materialize(links.unionByName(compared(tasks)))
    left = apart(links)
    # A document that links to one of another group meets it under ``need`` of these signatures.
    busy = small(materialize(left.groupBy("doc_id").count().join(asked, "doc_id").where("count >= asked").select("doc_id")))
    told = placed.select("block", "doc_id", "size", "need", "sketch").dropDuplicates(["doc_id", "size", "sketch", "block"])
    told = small(materialize(told.join(busy, "doc_id", "left_semi").join(chosen, "block", "left").fillna(-1, "partner")))
    met = left.join(told, ["doc_id", "block"]).repartition("sign").sortWithinPartitions("sign", "group")
    met = met.mapInArrow(partial(_meet, percent=percent), "a long, b long, need long")
    pairs = materialize(met.groupBy("a", "b").agg(F.count("*").alias("n"), F.min("need").alias("need")).where("n >= need").select("a", "b"))
    wanted = pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id"))).distinct()
    texts = docs.join(small(materialize(wanted)), "doc_id")
    own = materialize(texts.mapInArrow(partial(_sets, width=width), fields).select("doc_id", "shingles").distinct())
    both = pairs.select("a", "b", F.explode(F.array("a", "b")).alias("doc_id")).join(own, "doc_id")
    links = materialize(links.unionByName(both.groupBy("a", "b").applyInArrow(partial(_verify, percent=percent), "a long, b long")))
    out = members.join(components(links).withColumnRenamed("node", "class_id"), "class_id", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component", "class_id").alias("component_id"), "class_id")
