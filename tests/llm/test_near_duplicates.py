"""Embedding groups and the Jaccard join against brute force, with cells, blocks and copies."""

import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import embed, jaccard, shared
from tidemark.llm.embed import embedding_groups
from tidemark.llm.jaccard import allowed, band_ends, jaccard_components, signatures
from tidemark.llm.shared import components


def reach(ids, links):
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("one_task", [0, 1 << 19])
def test_components_of_chains_loops_and_nothing(spark, monkeypatch, one_task):
    monkeypatch.setattr(shared, "ONE_TASK_EDGES", one_task)
    edges = [(n, n + 1) for n in range(20)] + [(30, 31), (31, 30), (40, 40), (50, 52), (51, 52)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: 0 for n in range(21)} | {30: 30, 31: 30, 50: 50, 51: 50, 52: 50}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_embeddings(rows, threshold):
    def sound(row):
        vec_id, v, label = row
        return vec_id is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    links = []
    for n, a in enumerate(rows):
        for b in rows[n + 1 :]:
            if sound(a) and sound(b) and a[2] == b[2] and len(a[1]) == len(b[1]):
                x, y = np.array(a[1], np.float32).astype(float), np.array(b[1], np.float32).astype(float)
                if x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= threshold:
                    links.append((a[0], b[0]))
    return links


def test_embedding_groups_equal_brute_force_over_many_cells(spark, monkeypatch):
    monkeypatch.setattr(embed, "CELL_ROWS", 24)
    monkeypatch.setattr(embed, "BLOCK_ROWS", 16)
    rng = np.random.default_rng(5)
    rows = []
    for n in range(240):
        if n % 3 and n > 3:
            v = np.array(rows[int(rng.integers(len(rows)))][1]) + rng.normal(0, 0.13, 6)
        else:
            v = rng.normal(size=6)
        rows.append((1000 - n, [float(np.float32(x)) for x in v], int(n % 2)))
    rows += [(2000 + n, rows[7][1], rows[7][2]) for n in range(30)]
    links = brute_embeddings(rows, 0.93)
    want = reach([r[0] for r in rows], links)
    got = {r["vec_id"]: r for r in embedding_groups(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()}
    assert len(got) == len(rows)
    assert {i: r["component_id"] for i, r in got.items()} == want
    assert {i: r["n_links"] for i, r in got.items()} == {i: sum(i in pair for pair in links) for i in want}
    assert all(r["kept"] == (i == r["component_id"]) for i, r in got.items())
    assert len(links) > 500 and len(set(want.values())) > 40


def test_vectors_that_cannot_be_compared_stand_alone(spark):
    good = [1.0, 2.0]
    rows = [(1, good, 1), (2, good, None), (3, None, 1), (4, [0.0, 0.0], 1), (5, [1.0, None], 1), (6, [1.0, float("nan")], 1), (7, [], 1), (8, [1.0, 2.0, 0.0], 1), (9, good, 1), (9, good, 1), (None, good, 1)]
    df = spark.createDataFrame([(*r, 0, "x") for r in rows], "vec_id long, embedding array<float>, label int, node long, links string")
    got = sorted((r["vec_id"] or 0, r["n_links"], r["component_id"], r["kept"]) for r in embedding_groups(df).collect())
    alone = [(i, 0, i, True) for i in (2, 3, 4, 5, 6, 7, 8)]
    assert got == sorted([(1, 2, 1, True), (9, 2, 1, False), (9, 2, 1, False), (0, 0, None, True), *alone])
    assert embedding_groups(df.limit(0)).count() == 0


def sets_of(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return set()
    return {tuple(words)} if len(words) < width else {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def corpus(seed, docs):
    rng = random.Random(seed)
    texts = []
    for _ in range(docs):
        if texts and rng.random() < 0.6:
            words = rng.choice(texts).split()
            for _ in range(rng.choice([0, 1, 1, 2, 4])):
                if words:
                    words[rng.randrange(len(words))] = rng.choice("abcdefgh") + str(rng.randrange(99))
            texts.append(" ".join(words))
        else:
            texts.append(" ".join(rng.choice("abcdefgh") + str(rng.randrange(60)) for _ in range(rng.choice([1, 3, 4, 8, 30, 90, 260]))))
    return texts


@pytest.mark.parametrize("width, percent", [(4, 85), (5, 80)])
def test_jaccard_components_equal_brute_force(spark, width, percent):
    texts = corpus(width, 330)
    rows = [(7 * n % 1009, t) for n, t in enumerate(texts)] + [(2000, None), (2001, ""), (2002, " \t\n"), (2003, texts[0].upper()), (2003, texts[0].upper())]
    sets = [(i, sets_of(t, width)) for i, t in rows]
    links = [(a, b) for n, (a, x) in enumerate(sets) for b, y in sets[n + 1 :] if x and y and 100 * len(x & y) >= percent * len(x | y)]
    want = reach([i for i, _ in rows], links)
    df = spark.createDataFrame([(*r, "c", 5) for r in rows], "doc_id long, text string, component string, n_shingles int")
    got = jaccard_components(df, width, percent).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == sorted((i, len(s), want[i]) for i, s in sets)
    assert len(set(want.values())) < len(rows) - 40


def test_jaccard_of_an_empty_table_and_a_null_id(spark):
    schema = "doc_id long, text string"
    assert jaccard_components(spark.createDataFrame([], schema)).count() == 0
    rows = [(None, "a b c d e f"), (3, "a b c d e f"), (4, "a b c d e f")]
    got = jaccard_components(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r["doc_id"] or 0, r["component_id"] or 0) for r in got) == [(0, 0), (3, 3), (4, 3)]


def test_similar_sets_always_share_a_signature():
    rng = random.Random(9)
    ends = band_ends(5000, 85)
    for _ in range(400):
        size = rng.choice([7, 9, 13, 25, 60, 200, 700])
        base = [rng.getrandbits(64) for _ in range(size)]
        differ = allowed(size, 85) // 2
        other = base[differ:] + [rng.getrandbits(64) for _ in range(rng.randint(0, differ))]
        common, union = len(set(base) & set(other)), len(set(base) | set(other))
        if 100 * common >= 85 * union:
            x, y = (signatures(np.unique(np.array(s, np.uint64)), 85, ends) for s in (base, other))
            assert set(x.tolist()) & set(y.tolist()) or sorted(base) == sorted(other), (size, differ)


def test_documents_of_compared_blocks_make_no_candidate_pairs(spark, monkeypatch):
    made = []
    store = jaccard.materialize

    def counted(df):
        out = store(df)
        if out.columns == ["a", "b"]:
            made.append(out.count())
        return out

    monkeypatch.setattr(jaccard, "materialize", counted)
    rng = random.Random(3)
    base = [f"w{n}" for n in range(300)]
    texts = []
    for n in range(60):  # seven words of its own each: two share about four fifths of their shingles
        words = list(base)
        for at in rng.sample(range(0, 300, 5), 7):
            words[at] = f"own{n}x{at}"
        texts.append(" ".join(words))
    sets = [sets_of(t, 4) for t in texts]
    links = [(a, b) for a, x in enumerate(sets) for b, y in enumerate(sets[:a]) if 100 * len(x & y) >= 85 * len(x | y)]
    got = jaccard_components(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1), 4, 85).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == reach(range(60), links)
    assert sum(made) < 3 * len(texts), made


def test_candidates_meet_across_blocks_only_and_once_per_signature():
    cells = np.zeros(jaccard.SKETCH // 8, np.uint8)
    far = np.full(jaccard.SKETCH // 8, 255, np.uint8)
    rows = [  # sign, doc, group, block, partner, sketch
        (1, 10, 10, 0, -1, cells), (1, 11, 11, 0, -1, cells), (1, 12, 12, 1, 0, cells), (1, 13, 13, 2, -1, cells), (1, 14, 13, 2, -1, cells), (1, 15, 15, 3, -1, far),
        (2, 11, 11, 0, -1, cells), (2, 13, 13, 2, -1, cells),
    ]
    sign, doc, group, block, partner, sketches = zip(*rows)
    columns = {"sign": sign, "doc_id": doc, "group": group, "size": [100] * 8, "need": [1] * 8, "block": block, "partner": partner}
    batch = pa.RecordBatch.from_pydict({k: pa.array(v, pa.int64()) for k, v in columns.items()} | {"sketch": pa.array([s.tobytes() for s in sketches], pa.binary())})
    got = sorted((r["a"], r["b"]) for b in jaccard._meet([batch.slice(0, 3), batch.slice(3)], 85) for r in b.to_pylist())
    assert got == [(10, 13), (10, 14), (11, 13), (11, 13), (11, 14), (12, 13), (12, 14)]


def test_sketches_differ_in_no_more_cells_than_sets_in_shingles():
    rng = np.random.default_rng(2)
    for size, gone, new in [(1, 0, 1), (7, 1, 0), (300, 40, 33), (5000, 300, 700), (40, 40, 40)]:
        x = np.unique(rng.integers(0, 1 << 63, size, np.int64).view(np.uint64))
        y = np.unique(np.concatenate([x[gone:], rng.integers(0, 1 << 63, new, np.int64).view(np.uint64)]))
        a, b = (np.unpackbits(np.frombuffer(jaccard.sketch(s), np.uint8)) for s in (x, y))
        assert len(a) == jaccard.SKETCH and (a != b).sum() <= len(np.setxor1d(x, y))
    # Two sets of 300 that differ in 90 shingles, over the 73 that 85 % allows, are told apart.
    x = rng.integers(0, 1 << 63, 345, np.int64).view(np.uint64)
    a, b = (np.unpackbits(np.frombuffer(jaccard.sketch(s), np.uint8)) for s in (x[:300], x[45:]))
    assert (a != b).sum() > 73


def test_blocks_of_many_ranges_compare_whole_sets():
    rng = np.random.default_rng(4)
    base = np.unique(rng.integers(0, 1 << 63, 400, np.int64).view(np.uint64) * np.uint64(2))
    sets = [base, base[20:], base[40:], np.sort(rng.integers(0, 1 << 63, 9, np.int64).view(np.uint64)), base[:1], base[:1]]
    docs = [7, 3, 5, 1, 9, 8]
    table = pa.table({"block": [1, 2], "docs": pa.array([docs[:3], docs[3:]], pa.list_(pa.int64())), "sets": pa.array([jaccard.pack_block(sets[:3]), jaccard.pack_block(sets[3:])], pa.binary())})

    def links(first, second):
        part = table if first != second else table.slice(first - 1, 1)
        return sorted(zip(*jaccard._compare((pa.scalar(first), pa.scalar(second)), part, 94).to_pydict().values()))

    assert links(1, 1) == [(5, 3), (7, 3)] and links(2, 2) == [(9, 8)] and links(1, 2) == []


def stages_of(monkeypatch):
    """The columns, rows and plan of every stage that the join stores from now on."""
    made = []
    store = jaccard.materialize

    def told(df):
        out = store(df)
        made.append((out.columns, out.count(), df._jdf.queryExecution().optimizedPlan().toString()))
        return out

    monkeypatch.setattr(jaccard, "materialize", told)
    return made


def test_documents_under_too_few_shared_signatures_are_no_candidates(spark, monkeypatch):
    made = stages_of(monkeypatch)
    texts = []
    for n in range(60):  # each two share 53 % of their words in one passage, too little for a link and enough for a signature
        texts.append(" ".join([f"both{n // 2}x{i}" for i in range(160)] + [f"own{n}x{i}" for i in range(140)]))
    got = jaccard_components(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), 4, 85).collect()
    assert all(r["component_id"] == r["doc_id"] for r in got) and len(got) == 60
    signed = max(n for columns, n, _ in made if columns == ["sign", "doc_id"])
    placed = max(n for columns, n, _ in made if {"block", "doc_id", "size"} <= {*columns})
    assert signed > 40 and placed < 10, made


def test_blocks_are_full_and_sets_and_signatures_are_not_sorted_or_joined_whole(spark, monkeypatch):
    made = stages_of(monkeypatch)
    base = [f"w{n}" for n in range(300)]
    texts = [" ".join([*base[:n], f"new{n}", *base[n:]]) for n in range(0, 300, 5)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = jaccard_components(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), 4, 85).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert {r["component_id"] for r in got} == {0} and len(got) == 60
    assert [n for columns, n, _ in made if "sets" in columns] == [1]
    assert not [plan for *_, plan in made if "RepartitionByExpression" in plan and re.search(r"(?<!n_)shingles#", plan)]
    assert not [plan for *_, plan in made if re.search(r"Join LeftSemi, \(sign#", plan)]
