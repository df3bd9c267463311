"""Language identification with bit-sliced Bloom filters over n-grams.

A slot of the filter holds one bit per language. An n-gram sets its language's bit in
its slots; reading the slots and AND-ing them returns all languages that may contain it. Per
language, the n-grams of a text that it contains are counted, corrected for the filter's false positives, and the largest share wins.
"""

from __future__ import annotations

import sys
from functools import cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import pieces
from tidemark.llm.words import constants, mix
from tidemark.session import materialize

SIZES = (2, 3, 4)
# Bounds of the fit: documents per language, n-grams kept per language, least share of a language's documents that hold one.
SAMPLE_DOCS = 3000
GRAMS = 20_000
SHARE = 0.002
PROBES = 3
# Filter slots per kept n-gram of all languages.
SLOTS = 16
_SEED = constants(max(SIZES) + 2, 31)
_PROBE = constants(PROBES, 63)


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


def grams(text: str) -> np.ndarray:
    """Hashes of the n-grams of the words of ``text``, lower-cased; letters only, with one blank at either end of a word."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    if not len(codes):
        return np.zeros(0, np.uint64)
    codes = np.where(_letters()[codes], codes, 0)
    codes = np.concatenate([[0], codes, [0]]).astype(np.uint64)
    alone = np.ones(len(codes), bool)
    alone[1:] = (codes[1:] != 0) | (codes[:-1] != 0)
    codes = codes[alone]
    found = []
    for size in SIZES:
        if len(codes) < size:
            continue
        count = len(codes) - size + 1
        value = np.full(count, size, np.uint64) * _SEED[-1]
        inner = np.zeros(count, bool)
        for j in range(size):
            part = codes[j : j + count]
            value += part * _SEED[j]
            if 0 < j < size - 1:
                inner |= part == 0
        found.append(value[~inner])
    return mix(np.concatenate(found)) if found else np.zeros(0, np.uint64)


def _count_grams(batches):
    for batch in pieces(batches):
        for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
            own = np.unique(grams(text or ""))
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(own), pa.string()), pa.array(own.view(np.int64))], ["lang", "gram"])


class Model:
    """Filter slots (one bit per language, in words of 64) and the false positive rate of each language."""

    def __init__(self, learned: dict[str, np.ndarray]):
        self.languages = sorted(learned)
        self.size = max(1024, SLOTS * sum(map(len, learned.values())))
        self.slots = np.zeros((self.size, max(1, -(-len(self.languages) // 64))), np.uint64)
        for n, lang in enumerate(self.languages):
            for slot in self._slots(learned[lang]):
                self.slots[slot, n // 64] |= np.uint64(1) << np.uint64(n % 64)
        fill = np.array([self._bits(self.slots, n).mean() for n in range(len(self.languages))])
        self.false = fill**PROBES

    def _slots(self, hashes):
        return [(mix(hashes ^ _PROBE[p]) % np.uint64(self.size)).astype(np.int64) for p in range(PROBES)]

    @staticmethod
    def _bits(masks, n):
        return (masks[:, n // 64] >> np.uint64(n % 64)) & np.uint64(1)

    def masks(self, hashes: np.ndarray) -> np.ndarray:
        """For each n-gram the bits of all languages that may contain it."""
        found = None
        for slot in self._slots(hashes):
            found = self.slots[slot] if found is None else found & self.slots[slot]
        return found

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.languages or not has_letter(text):
            return "und", 0.0
        masks = self.masks(grams(text))
        share = np.array([self._bits(masks, n).mean() for n in range(len(self.languages))])
        share = np.clip((share - self.false) / np.maximum(1e-9, 1 - self.false), 0, 1)
        best = int(np.argmax(share))
        return self.languages[best], float(share[best])


def fit(train: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Model:
    """A model of ``train`` (doc_id, text, lang); rows with a null lang or text are left out.

    Fitted on about ``sample_docs`` documents of each language, chosen by a hash of doc_id; for each language its
    ``GRAMS`` n-grams in most documents are kept, if in at least ``SHARE`` of them. No rows give a model that answers "und".
    """
    train = train.where("lang is not null and text is not null").select("doc_id", "text", "lang")
    sizes = {r["lang"]: r["count"] for r in train.groupBy("lang").count().collect()}  # a row per language
    if not sizes:
        return Model({})
    rate = F.create_map(*[x for lang, n in sizes.items() for x in (F.lit(lang), F.lit(min(1.0, sample_docs / n)))])
    chosen = train.where(F.pmod(F.xxhash64(F.lit("language"), "doc_id"), F.lit(1 << 20)) < F.element_at(rate, F.col("lang")) * (1 << 20))
    taken = {r["lang"]: r["count"] for r in chosen.groupBy("lang").count().collect()}
    counted = materialize(chosen.select("text", "lang").mapInArrow(_count_grams, "lang string, gram long").groupBy("lang", "gram").count())
    learned = {}
    for lang, n in sorted(taken.items()):
        best = counted.where((F.col("lang") == lang) & (F.col("count") >= min(n, max(2, SHARE * n))))
        rows = best.orderBy(F.desc("count"), "gram").limit(GRAMS).select("gram").collect()
        learned[lang] = np.array([r["gram"] for r in rows], np.int64).view(np.uint64)
    return Model(learned)


def _predict(batches, model):
    model = model.value
    for batch in pieces(batches):
        found = [model.predict(t) for t in batch.column("text").to_pylist()]
        columns = {n: batch.column(n) for n in batch.schema.names if n not in ("lang_pred", "score")}
        columns |= {"lang_pred": pa.array([f[0] for f in found], pa.string()), "score": pa.array([f[1] for f in found], pa.float64())}
        yield pa.RecordBatch.from_pydict(columns)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with lang_pred (a learned language, or "und" if text is null or has no letter) and score (0 to 1).

    Only the whole text is looked at. Columns of these names are replaced; no rows give no rows; equal
    shares go to the language that sorts first.
    """
    docs = docs.drop("lang_pred", "score")
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most SLOTS * GRAMS slots per language
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema]
    return docs.mapInArrow(partial(_predict, model=shared), ", ".join([*fields, "lang_pred string", "score double"]))


def held_out(doc_id: Column) -> Column:
    """True for the rows that the fit must not see."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))
