"""Encoder, packing and token files."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm.encode import Encoder
from tidemark.llm.packing import best_fit, best_fit_pack, plan, reduce_instance, token_pieces
from tidemark.llm.tokenfile import Reader, id_bits, pack, read_token_files, unpack, write_token_files

ODD = [
    "", "a", "  x", " a b", "a\n\nb", "it's  'll don't\nI'm", "a\x01b", "x\x00y z", "ÀÉ ǅ word́ a b", "12 34.5%", "a \x01 b",
    "日本 語\n。", "<|endoftext|> x", "a <|endoftext|>", "b<|endoftext|>c d", "<|ENDOFTEXT|> e", "f <|startoftext|> g\n<|endoftext|>", "<|endof text|> <", "İstanbul ΣΑΣ", "tab\there", "end \n", "naïve café­", "x" * 3000,
]
WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("path, style", [(WORD, "dropped"), (BYTE, "leading")])
def test_cached_words_give_the_tokenizer_s_ids(path, style):
    rng = random.Random(2)
    texts = ODD + [" ".join(rng.choice(["the", "of.", "Ünter", "thtionly,", "x1", "(a)"]) + rng.choice(["", "\n", "!!"]) for _ in range(60)) for _ in range(50)]
    encoder, plain = Encoder(path), Tokenizer.from_file(path)
    assert encoder.style == style
    for _ in range(2):
        for text, ids in zip(texts, encoder.encode(texts)):
            assert np.frombuffer(ids, "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids, text


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_blanks_at_ends_and_words_of_letters_give_the_tokenizer_s_ids(path):
    texts = [a + w + b for a in ("", " ", "\n", "\u3000", "\x85") for w in ("word", "It's", "a b", "don't x", "z9", "\x1c", "q\u2003r", "é") for b in ("", " ", "\n", "\u3000", " \n")]
    encoder, plain = Encoder(path), Tokenizer.from_file(path)
    for text, ids in zip(texts, encoder.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids, repr(text)


def test_words_of_letters_are_not_searched_for_pieces():
    # One piece as it stands; others are cut into a list.
    split = Encoder(BYTE).split
    assert split(" word") == (" word",) and split("it") == ("it",)
    assert split(" it's") == [" it", "'s"] and split(" é") == [" é"] and split(" ") == [" "]


def whole(patterns, capacity):
    counts = defaultdict(int)
    for times, pattern in patterns:
        assert times > 0 and sum(length * each for length, each in pattern) <= capacity
        for length, each in pattern:
            counts[length] += times * each
    return dict(counts), sum(times for times, _ in patterns)


def fewest(items, capacity):
    best = len(items)

    def place(rest, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if not rest:
            best = len(rooms)
            return
        for n in range(len(rooms)):
            if rooms[n] >= rest[0] and rooms[n] not in rooms[:n]:
                place(rest[1:], [*rooms[:n], rooms[n] - rest[0], *rooms[n + 1 :]])
        place(rest[1:], [*rooms, capacity - rest[0]])

    place(sorted(items, reverse=True), [])
    return best


def test_reduction_keeps_the_optimum_and_the_plan_holds_everything():
    rng = random.Random(6)
    fixed_any = 0
    for _ in range(150):
        capacity = rng.choice([10, 20, 37])
        items = [rng.randint(1, capacity) for _ in range(rng.randint(1, 9))]
        counts = np.bincount(items, minlength=capacity + 1)
        rest = counts.copy()
        fixed = reduce_instance(rest, capacity)
        left = [n for n in range(capacity + 1) for _ in range(rest[n])]
        assert sum(t for t, _ in fixed) + fewest(left, capacity) == fewest(items, capacity)
        fixed_any += len(fixed)
        histogram = {n: int(c) for n, c in enumerate(counts) if c}
        held, sequences = whole(plan(histogram, capacity), capacity)
        assert held == histogram and sequences >= fewest(items, capacity)
    assert fixed_any > 100


def test_best_fit_of_a_large_histogram_is_near_the_bound():
    rng = np.random.default_rng(1)
    counts = np.bincount(np.minimum(4096, rng.lognormal(6, 1, 200_000).astype(int) + 1), minlength=4097)
    total = int((counts * np.arange(4097)).sum())
    patterns = best_fit(counts, 4096)
    held, sequences = whole(patterns, 4096)
    assert held == {n: int(c) for n, c in enumerate(counts) if c}
    assert sequences <= -(-total // 4096) + 5 and len(patterns) < 20_000


def test_packed_rows_fill_sequences_without_gaps(spark):
    rng = random.Random(5)
    rows = [(n, rng.choice([1, 3, 40, 40, 64, 100]), "x") for n in range(500)] + [(1, 40, "x")] * 3
    got = best_fit_pack(spark.createDataFrame(rows, "doc_id long, length long, offset string"), 100).collect()
    assert sorted((r["doc_id"], r["length"]) for r in got) == sorted((a, b) for a, b, _ in rows)
    sequences = defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 100
    assert best_fit_pack(spark.createDataFrame([], "doc_id long, length long"), 100).count() == 0


def test_pieces_of_odd_documents(spark):
    rows = [(n, t, "z") for n, t in enumerate(ODD)] + [(100, None, None), (None, "a b", None), (3, ODD[3], "z"), (101, "word " * 9000, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, piece string")
    plain = Tokenizer.from_file(WORD)
    want = []
    for doc, text, _ in rows:
        ids = plain.encode(text or "", add_special_tokens=False).ids + [1]
        for n, begin in enumerate(range(0, len(ids), 4096)):
            part = ids[begin : begin + 4096]
            want.append((doc, n, begin, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    got = [tuple(r) for r in token_pieces(df, WORD, 1, 4096).collect()]
    key = lambda r: tuple(x if x is not None else -1 for x in r)
    assert sorted(got, key=key) == sorted(want, key=key)
    assert token_pieces(df.limit(0), WORD, 1, 4096).count() == 0


@pytest.mark.parametrize("bits", [1, 7, 8, 13, 16, 17, 31, 32])
def test_packed_ids_come_back(bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 1001).astype("<u4")
    data = pack(ids, bits)
    assert len(data) == -(-1001 * bits // 8) and (unpack(data, 1001, bits) == ids).all()
    assert id_bits(1 << bits) == bits and id_bits(1) == 1


def test_token_files_read_back_whole_and_at_random(spark, folder):
    rng = random.Random(1)
    rows = [(n, t, 0) for n, t in enumerate(ODD)] + [(50, None, 0), (None, "a b", 0), (None, None, 0), (3, ODD[3], 0)]
    rows += [(60 + n, " ".join(rng.choice(["alpha", "of", "12"]) for _ in range(rng.randint(0, 300))), 1) for n in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, start long").repartition(5)
    where, files = write_token_files(df, BYTE, 0, f"{folder}/tokens", block_ids=97)
    got = sorted(read_token_files(where, files).collect(), key=lambda r: r["start"])
    plain = Tokenizer.from_file(BYTE)
    start = 0
    for r, (doc, text, _) in zip(got, sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode())), strict=True):
        ids = plain.encode(text or "", add_special_tokens=False).ids + [0]
        assert tuple(r) == (doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    file = files.orderBy(F.desc("n_ids")).first()["file"]
    reader = Reader(f"{where}/{file}")
    every = reader.ids(0, reader.n_ids)
    for begin, count in ((0, 1), (96, 2), (97, 97), (50, 400), (reader.n_ids - 1, 1), (5, 0)):
        assert (reader.ids(begin, count) == every[begin : begin + count]).all()
    where, files = write_token_files(df.limit(0), BYTE, 0)
    assert read_token_files(where, files).count() == 0
