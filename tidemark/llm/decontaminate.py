"""Benchmark decontamination with spaced seeds.

A seed is a mask over consecutive words; words under a 0 may differ. The benchmark's windows are hashed under
every mask, and so are the windows of every document; equal hashes give a diagonal of a document and an item, on which
words are compared one by one around the hit, so that replaced words do not hide a passage.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import pieces
from tidemark.llm.words import _SPACE, buffers, constants, mix, span_hashes, word_spans
from tidemark.session import materialize

# Any stretch of 13 to 30 words of which MATCH are equal agrees under one of these somewhere (tested exhaustively). A longer one can be cut
# into stretches of 13 to 25 words, one of which has as large a share.
MASKS = ("110110111", "1101001000111", "111010001011", "1001111011", "11100010100011", "10011000011101")
OVERLAP = 13
MATCH = 0.8
# Words of the benchmark that one pass over the documents holds; a larger benchmark takes more passes.
PASS_WORDS = 2_000_000

_BREAK = _SPACE.copy()
_BREAK[[b for b in range(33, 127) if not chr(b).isalnum()]] = True
_FACTOR = constants(64, 515)
_SIEVE_BITS = 22
# Equal windows that are looked at together, at most.
_LOT = 1 << 21


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, cut at white space and ASCII punctuation, A-Z lower-cased, and where each text begins."""
    data, offsets = buffers(column)
    begin, end, first = word_spans(data, offsets, _BREAK)
    return span_hashes(data, begin, end, seed=21), first


def window_hashes(words: np.ndarray, mask: str) -> np.ndarray:
    out = np.zeros(max(0, len(words) - len(mask) + 1), np.uint64)
    for j, bit in enumerate(mask):
        if bit == "1" and len(out):
            out += words[j : j + len(out)] * _FACTOR[j]
    return mix(out + np.uint64(hash_of_mask(mask)))


def hash_of_mask(mask: str) -> int:
    return int(mask, 2) * 64 + len(mask)


class Seeds:
    """The windows of a benchmark under all masks; items too short for the masks are one window of all their words."""

    def __init__(self, items: list[tuple[int, str]]):
        self.ids = np.array([i for i, _ in items], np.int64)
        self.words, self.first = tokens(pa.array([t for _, t in items], pa.string()))
        sizes = np.diff(self.first)
        self.owner = np.repeat(np.arange(len(items)), sizes)
        self.masks = list(MASKS) + ["1" * n for n in sorted(set(sizes[(sizes > 0) & (sizes < OVERLAP)].tolist()))]
        self.tables = []
        for number, mask in enumerate(self.masks):
            at = np.arange(max(0, len(self.words) - len(mask) + 1))
            whole = self.owner[at] == self.owner[at + len(mask) - 1] if len(at) else np.zeros(0, bool)
            if number >= len(MASKS):
                whole &= sizes[self.owner[at]] == len(mask)
            else:
                whole &= sizes[self.owner[at]] >= OVERLAP
            at = at[whole]
            hashes = window_hashes(self.words, mask)
            before = self._before(hashes, at, self.first[self.owner[at]])
            hashes = hashes[at]
            order = np.lexsort((before, hashes))
            both, begin, count = np.unique(_both(hashes, before)[order], return_index=True, return_counts=True)
            sieve = np.zeros(1 << _SIEVE_BITS, bool)
            sieve[(hashes & np.uint64((1 << _SIEVE_BITS) - 1)).astype(np.int64)] = True
            self.tables.append((hashes[order], at[order], sieve, both, begin, begin + count))

    @staticmethod
    def _before(hashes: np.ndarray, at: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """Hash of the window one word earlier, 0 where a text begins."""
        return np.where(at > begins, hashes[np.maximum(at - 1, 0)] | np.uint64(1), np.uint64(0))

    def diagonals(self, words: np.ndarray, first: np.ndarray):
        """(row, item, shift) of equal windows in arrays of bounded length, sorted and distinct within one.

        Windows that are equal because the ones before them are equal too lie on the same diagonal and are left out, so a passage
        counts once, and so does a word repeated without end in both texts.
        """
        for mask, (hashes, at, sieve, both, begin, end) in zip(self.masks, self.tables):
            own = window_hashes(words, mask)
            place = np.flatnonzero(sieve[(own & np.uint64((1 << _SIEVE_BITS) - 1)).astype(np.int64)])
            low, high = np.searchsorted(hashes, own[place], side="left"), np.searchsorted(hashes, own[place], side="right")
            place, low, high = place[high > low], low[high > low], high[high > low]
            if not len(place):
                continue
            row = np.searchsorted(first, place, side="right") - 1
            wanted = _both(own[place], self._before(own, place, first[row]))
            found = np.minimum(np.searchsorted(both, wanted), len(both) - 1)
            # A window at the beginning of an item or document has none before it.
            same = (both[found] == wanted) & (place > first[row])
            skip, go_on = np.where(same, begin[found], high), np.where(same, end[found], high)
            left = np.concatenate([skip - low, high - go_on])
            start, place, row = np.concatenate([low, go_on]), np.concatenate([place, place]), np.concatenate([row, row])
            for lot in _lots(left):
                many = left[lot]
                which = np.repeat(np.arange(lot.start, lot.stop), many)
                other = at[start[which] + np.arange(len(which)) - np.repeat(np.cumsum(many) - many, many)]
                item = self.owner[other]
                shift = place[which] - first[row[which]] - (other - self.first[item])
                yield np.unique(np.stack([row[which], item, shift], axis=1), axis=0)

    def overlap(self, words: np.ndarray, item: int, shift: int) -> int:
        """The longest stretch, in words, in which the document agrees well enough with the item laid at ``shift``."""
        own = self.words[self.first[item] : self.first[item + 1]]
        begin, end = max(0, -shift), min(len(own), len(words) - shift)
        same = own[begin:end] == words[begin + shift : end + shift]
        need = min(OVERLAP, len(own))
        if len(same) < need:
            return 0
        # The longest stretch with a share of MATCH: the farthest pair with a rising sum of same - MATCH.
        level = np.concatenate([[0.0], np.cumsum(same - (MATCH if len(own) >= OVERLAP else 1.0))])
        best_after = np.maximum.accumulate(level[::-1])
        last = len(level) - 1 - np.searchsorted(best_after, level - 1e-9, side="left")
        best = int((last - np.arange(len(level))).max())
        return best if best >= need else 0


def _both(hashes: np.ndarray, before: np.ndarray) -> np.ndarray:
    return mix(hashes * _FACTOR[0] + mix(before + _FACTOR[1]))


def _lots(sizes: np.ndarray):
    """Slices of ``sizes`` that add up to about ``_LOT`` at most."""
    total, begin = np.cumsum(sizes), 0
    while begin < len(sizes):
        base = total[begin] - sizes[begin]
        stop = max(begin + 1, int(np.searchsorted(total, base + _LOT, side="right")))
        yield slice(begin, stop)
        begin = stop


def _mark(batches, seeds):
    seeds = seeds.value
    for batch in pieces(batches):
        words, first = tokens(batch.column("text"))
        found: list[dict[int, int]] = [{} for _ in range(batch.num_rows)]
        for lot in seeds.diagonals(words, first):
            row, item, shift = lot.T
            size, own = np.diff(seeds.first)[item], np.diff(first)[row]
            # No stretch is longer than what the two have in common; the longest come first.
            most = np.minimum(size, own - shift) - np.maximum(0, -shift)
            order = np.lexsort((-most, item, row))
            for place in order[most[order] >= np.minimum(OVERLAP, size[order])]:
                key, known = int(seeds.ids[item[place]]), found[row[place]]
                if most[place] <= known.get(key, 0):
                    continue
                length = seeds.overlap(words[first[row[place]] : first[row[place] + 1]], item[place], int(shift[place]))
                if length > known.get(key, 0):
                    known[key] = length
        columns = {n: batch.column(n) for n in batch.schema.names}
        known = batch.column("leaked_items").to_pylist()
        columns["leaked_items"] = pa.array([sorted({*(k or []), *f}) for k, f in zip(known, found)], pa.list_(pa.int64()))
        columns["overlap"] = pa.array([max([o, *f.values()]) for o, f in zip(batch.column("overlap").to_pylist(), found)], pa.int64())
        yield pa.RecordBatch.from_pydict(columns)


def mark_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` with leaked_items (sorted item_ids found in the text), overlap (words of the longest passage) and contaminated.

    An item is found where a stretch of at least ``OVERLAP`` words (all words of a shorter item, exactly) lies in
    the document in order with at least ``MATCH`` of them equal. Null and empty texts hold nothing; items
    without words or id are left out; repeated items and documents are judged alike. An empty benchmark marks nothing, no documents
    give no rows. Columns of the three names are replaced.
    """
    spark = docs.sparkSession
    docs = docs.drop("leaked_items", "overlap", "contaminated")
    docs = docs.withColumns({"leaked_items": F.array().cast("array<long>"), "overlap": F.lit(0).cast("long")})
    items = benchmark.where("item_id is not null and text is not null").select(F.col("item_id").cast("long").alias("item_id"), "text")
    size = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    passes = size // (6 * PASS_WORDS) + 1
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    for n in range(passes):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == n).distinct().orderBy("item_id", "text").collect()  # one pass's words
        if rows:
            seeds = spark.sparkContext.broadcast(Seeds([tuple(r) for r in rows]))
            docs = docs.mapInArrow(partial(_mark, seeds=seeds), fields)
            if n + 1 < passes:  # no task holds the seeds of two passes
                docs = materialize(docs)
                seeds.destroy()
    return docs.withColumn("contaminated", F.size("leaked_items") > 0)
