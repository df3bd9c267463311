"""Top-k search, filter audit and vector codes against brute force, with ties, copies, nulls and empty tables."""

import itertools
import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import topk
from tidemark.llm.compress import distances, product_codes, reassign, with_label_error
from tidemark.llm.interaction import filter_interactions, interaction_audit
from tidemark.llm.topk import NOTHING, search, top_k, upper_bounds

VECTORS = "vec_id long, embedding array<double>, label int, dim string, shard string, ints string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], VECTORS)


def sound(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def brute_top_k(rows, k, every, scale):
    ints = [(i, tuple(math.floor(scale * x) for x in v)) for i, v, _ in rows if i is not None and sound(v)]
    out = []
    for i, q in sorted(set(ints)):
        if i % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(q, c)), j) for j, c in ints if j != i and len(c) == len(q))
            out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scored[:k])]
    return sorted(out)


@pytest.mark.parametrize("block, shard", [(256, 256), (7, 2), (1, 3)])
def test_top_k_equals_brute_force(spark, monkeypatch, block, shard):
    monkeypatch.setattr(topk, "BLOCK_ROWS", block)
    monkeypatch.setattr(topk, "SHARD_BLOCKS", shard)
    monkeypatch.setattr(topk, "BATCH_ROWS", 5)
    monkeypatch.setattr(topk, "PACK_SHARDS", 3)
    rng = np.random.default_rng(3)
    centres = rng.normal(0, 1, (5, 6))
    rows = [(n, (centres[n % 5] + rng.normal(0, 0.2, 6)).round(2).tolist(), n % 3) for n in range(150)]
    rows += [(200 + n, rows[0][1], None) for n in range(60)]  # one vector held by many rows: ties
    rows += [(300, [0.0] * 6, 0), (-4, [1.0, -1.0, 0.5, 0.0, 0.0, 0.0], 0), (304, [1.0, 2.0], 1), (305, [2.0, 1.0], 1)]
    rows += [(400, None, 0), (404, [1.0, None, 0.0, 0.0, 0.0, 0.0], 0), (408, [math.nan] + [0.0] * 5, 0), (412, [math.inf] + [0.0] * 5, 0), (None, [1.0] * 6, 0), (416, [], 0)]
    rows += [(8, rows[8][1], 1), (9, rows[9][1], 1), (12, [0.25] * 6, 2)]  # repeated rows; one id with two vectors
    got = sorted(map(tuple, top_k(frame(spark, rows), k=7, every=4, scale=64).collect()))
    assert got == brute_top_k(rows, 7, 4, 64)


def test_top_k_of_little_and_of_too_large(spark):
    assert top_k(frame(spark, [])).count() == 0
    assert top_k(frame(spark, [(0, [1.0], 1)])).count() == 0
    two = top_k(frame(spark, [(0, [1.0], 1), (1, [2.0], 1)]), k=3).collect()
    assert [tuple(r) for r in two] == [(0, 1, 1, 64 * 128)]
    assert top_k(frame(spark, [(0, [100000.0], 1), (1, [-100000.0], 1)])).collect()[0]["score"] == -(6400000**2)
    with pytest.raises(ValueError):
        top_k(frame(spark, [(0, [1e9], 1)]))


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(1)
    blocks = [(np.arange(40) + 40 * n, (rng.normal(0, 3, (40, 8)) + 30 * np.eye(8)[n % 8]).astype(np.int64)) for n in range(12)]
    high, low = (np.array([f(x, axis=0) for _, x in blocks]) for f in (np.max, np.min))
    q = blocks[3][1][:5]
    exact = np.array([[(q[r] @ x.T).max() for _, x in blocks] for r in range(5)])
    assert (upper_bounds(q, high, low) >= exact).all()
    row, ids, score, scored = search(q, np.full(5, -1), np.full(5, NOTHING), blocks, high, low, 10)
    every = np.concatenate([x for _, x in blocks])
    for r in range(5):
        s = every @ q[r]
        best = np.lexsort((np.arange(len(s)), -s))[:10]
        assert ids[row == r].tolist() == best.tolist() and score[row == r].tolist() == s[best].tolist()
    assert scored < 5 * len(every) / 2  # blocks that point elsewhere are never scored


def brute_audit(docs, labels):
    words = {n: [w for w in re.split(r"[\x20\x09-\x0D]+", t or "") if w] for n, (_, t, _) in enumerate(docs)}
    smallest = {}
    for i, t, _ in docs:
        if i is not None:
            smallest[t or ""] = min(i, smallest.get(t or "", i))
    out = {}
    for n, (i, t, lang) in enumerate(docs):
        t, w = t or "", words[n]
        fails = ""
        fails += "A" * (len(w) < 100)
        fails += "B" * (100 * len(set(w)) < 80 * len(w))
        fails += "C" * (100 * len(re.findall("[A-Z]", t)) > 10 * len(t))
        fails += "D" * bool(re.search("[#$%&*|]", t))
        fails += "E" * (i is not None and i > smallest[t])
        good = any(j == i and i is not None and q == 1 for j, q, _ in labels)
        toxic = any(j == i and i is not None and x == 1 for j, _, x in labels)
        for order in map("".join, itertools.permutations("ABCDE")):
            alive = True
            for step, f in enumerate(order, 1):
                c = out.setdefault((lang or "", order, step), [0] * 6)
                lost = alive and f in fails
                c[0] += alive and f not in fails
                c[1] += lost
                c[2] += not alive and f in fails
                c[3] += fails == f
                c[4] += lost and good
                c[5] += lost and toxic
                alive = alive and f not in fails
    share = {}
    for (part, order, step), c in out.items():
        share[part, order[step - 1]] = share.get((part, order[step - 1]), 0) + c[1]
    return sorted((*key, *map(int, c), share[key[0], key[1][key[2] - 1]]) for key, c in out.items())


def test_filter_audit_equals_counting(spark):
    rng = np.random.default_rng(8)
    pool = ["alpha", "Beta", "GAMMA", "d", "e#", "ünï", "x|y", "𝒳"]
    docs = []
    for n in range(60):
        size = int(rng.choice([0, 3, 99, 100, 101, 160]))
        vocabulary = pool if n % 2 else [f"w{k}" for k in range(size or 1)]
        docs.append((n, " \t".join(rng.choice(vocabulary, size, replace=n % 2 == 1)), ["en", "de", None, ""][n % 4]))
    docs += [(100 + n, docs[7][1], "en") for n in range(20)] + [(3, docs[7][1], "fr"), (3, docs[7][1], "fr"), (90, None, "en"), (91, "", None), (None, docs[7][1], "en")]
    docs += [(95, "word " * 50_000, "long"), (None, None, None)]
    labels = [(n, int(n % 2), int(n % 3 == 0)) for n in range(0, 110, 2)] + [(3, 0, 1), (3, 1, None), (None, 1, 1), (999, 1, 1), (100, None, None)]
    d = spark.createDataFrame([(*r, "clash", 1) for r in docs], "doc_id long, text string, lang string, part string, n int")
    l = spark.createDataFrame([(*r, "clash") for r in labels], "doc_id long, quality int, toxic int, text string")
    rows = filter_interactions(d, l)
    assert rows.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert sorted(map(tuple, rows.collect())) == brute_audit(docs, labels)
    assert filter_interactions(d.limit(0), l).count() == 0
    assert filter_interactions(d, l.limit(0)).agg(F.sum("good_lost") + F.sum("toxic_lost")).first()[0] == 0


def test_audit_refuses_too_many_or_equal_filters(spark):
    cells = spark.createDataFrame([("p", 1, False, False, 3)], "part string, mask int, good boolean, toxic boolean, n long")
    assert [tuple(r)[1:6] for r in interaction_audit(cells, "XY").where("filter_order = 'XY'").orderBy("step").collect()] == [("XY", 1, 0, 3, 0), ("XY", 2, 0, 0, 0)]
    for filters in ("", "AA", "ABCDEFG"):
        with pytest.raises(ValueError):
            interaction_audit(cells, filters)


def brute_codes(rows, parts, entries, scale, rounds):
    kept = [(i, [math.floor(scale * x) for x in v], label) for i, v, label in rows if v and sound(v)]
    kept.sort(key=lambda r: (r[0] is None, r[0], r[1]))
    sub = len(kept[0][1]) // parts
    cut = [[tuple(v[p * sub : (p + 1) * sub]) for p in range(parts)] for _, v, _ in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), n) for n, e in enumerate(books[p]))

    for turn in range(rounds + 1):
        found = [[nearest(p, c[p]) for p in range(parts)] for c in cut]
        if turn < rounds:
            for p in range(parts):
                for n in range(len(books[p])):
                    own = [c[p] for c, f in zip(cut, found) if f[p][1] == n]
                    if own:
                        books[p][n] = tuple(sum(x) // len(own) for x in zip(*own))
    coded = [(i, "".join(f"{n:02x}" for _, n in f), sum(d for d, _ in f), label) for (i, _, label), f in zip(kept, found)]
    totals = {}
    for _, _, e, label in coded:
        totals[label] = totals.get(label, 0) + e
    return sorted(((i, c, e, totals[label]) for i, c, e, label in coded), key=str), books


@pytest.mark.parametrize("n, entries, scale", [(200, 16, 4096), (9, 16, 4096), (150, 5, 2)])
def test_codes_equal_plain_rounds(spark, n, entries, scale):
    rng = np.random.default_rng(n)
    rows = [(i * 3 - 20, rng.normal(0, 1, 16).round(1).tolist(), int(i % 4)) for i in range(n)]  # a small scale makes many ties
    rows += [(1000 + i, rows[5][1], None) for i in range(30)]
    rows += [(-20, rows[0][1], 9), (-20, rows[3][1], 9), (None, rows[2][1], 1)]
    rows += [(-90, None, 1), (-91, [], 1), (-92, [None] + [0.0] * 15, 1), (-93, [math.nan] + [0.0] * 15, 1), (-94, [math.inf] + [0.0] * 15, 2)]
    coded, books = product_codes(frame(spark, rows), entries=entries, scale=scale)
    got = [(r["vec_id"], bytes(r["code"]).hex(), r["error"], r["label_error"]) for r in with_label_error(coded).collect()]
    want, want_books = brute_codes(rows, 8, entries, scale, 6)
    assert books.tolist() == [[list(e) for e in b] for b in want_books]
    assert sorted(got, key=str) == want


def test_active_entries_give_what_a_full_scan_gives():
    rng = np.random.default_rng(4)
    x, old = rng.integers(-3, 4, (400, 3)), rng.integers(-3, 4, (12, 3))
    far = distances(x, old)
    for _ in range(20):
        new = old.copy()
        new[rng.random(12) < 0.4] += rng.integers(-1, 2, 3)
        moved = (new != old).any(axis=1)
        code, near = reassign(x, new, moved, far.argmin(axis=1), far.min(axis=1))
        old, far = new, distances(x, new)
        assert (code == far.argmin(axis=1)).all() and (near == far.min(axis=1)).all()


def test_codes_of_nothing_and_of_unfit_vectors(spark):
    coded, books = product_codes(frame(spark, []))
    assert with_label_error(coded).count() == 0 and books.size == 0
    for bad in ([(1, [1.0] * 8, 1), (2, [1.0] * 16, 1)], [(1, [1.0] * 9, 1)], [(1, [1e5] * 8, 1)]):
        with pytest.raises(ValueError):
            product_codes(frame(spark, bad))
