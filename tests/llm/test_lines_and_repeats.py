"""Line removal, byte removal and the structures below them against brute force."""

import random
import re

import numpy as np

from tidemark.llm import lines, repeats
from tidemark.llm.gsaca import suffix_arrays
from tidemark.llm.lines import build_index, dedup_lines, probe
from tidemark.llm.repeats import remove_repeats



def test_perfect_hash_is_minimal_and_refuses_strangers():
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 2**63, 3000).astype(np.uint64), rng.integers(0, 2**63, 3000).astype(np.uint64)
    a[10] = a[11]  # equal first halves: told apart by the second ones
    index = build_index(a, b, np.arange(3000), np.ones(3000, np.int64))
    at = probe(index, a, b)
    assert sorted(at.tolist()) == list(range(3000))
    assert index["keeper"][at].tolist() == list(range(3000))
    assert (probe(index, a, b + np.uint64(1)) == -1).all() and (probe(index, a + np.uint64(1), b + np.uint64(1)) == -1).all()
    empty = build_index(a[:0], b[:0], np.zeros(0, np.int64), np.zeros(0, np.int64))
    assert (probe(empty, a, b) == -1).all()


def brute_lines(rows, least=10):
    def key(line):
        return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\v\f\r"))

    where = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= least and doc is not None:
                where.setdefault(key(line), set()).add(doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if doc is None or len(where.get(key(x), ())) < 2 or min(where[key(x)]) == doc]
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def test_line_dedup_equals_brute_force(spark):
    rng = random.Random(4)
    lines = [" Shared Line %d\t" % n for n in range(40)] + ["short", "", " ", "exactly 10", "ninechars", "öäüöäüöäüö", "ÉCOLE NORMALE", "école normale"]
    rows = [(n * 37 % 501, "\n".join(rng.choice(lines).swapcase() if rng.random() < 0.2 else rng.choice(lines) for _ in range(rng.randint(1, 9)))) for n in range(200)]
    rows += [(900, None), (901, ""), (902, "\n\n"), (903, "x" * 200_000 + "\n Shared Line 1"), (904, "shared line 1"), (904, "shared line 1"), (None, "shared line 2\nshared line 3")]
    df = spark.createDataFrame([(*r, 1, "g") for r in rows], "doc_id long, text string, n_lines int, gone string")
    got = dedup_lines(df).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[3])
    assert sorted(((r["doc_id"], r["n_lines"], r["n_dropped"], r["text"]) for r in got), key=key) == sorted(brute_lines(rows), key=key)
    assert dedup_lines(df.limit(0)).count() == 0


def test_suffix_arrays_equal_sorting():
    rng = random.Random(3)
    for _ in range(120):
        strings = [[rng.randint(1, rng.choice([1, 2, 3, 200])) for _ in range(rng.randint(0, rng.choice([3, 12, 60])))] + [0] for _ in range(rng.randint(1, 8))]
        got = suffix_arrays(np.array(sum(strings, []), np.int64), np.array([len(s) for s in strings]))
        begin = 0
        for s in strings:
            assert (got[begin : begin + len(s)] - begin).tolist() == sorted(range(len(s)), key=lambda i: s[i:])
            begin += len(s)


def brute_repeats(rows, span=50):
    least = {}
    data = [(doc, (text or "").encode()) for doc, text in rows]
    for doc, b in data:
        for i in range(len(b) - span + 1 if doc is not None else 0):
            s = b[i : i + span]
            least[s] = min(doc, least.get(s, doc))
    out = []
    for doc, b in data:
        gone = bytearray(len(b))
        for i in range(len(b) - span + 1 if doc is not None else 0):
            if least[b[i : i + span]] < doc:
                gone[i : i + span] = b"\1" * span
        spans = len(re.findall(b"\1+", bytes(gone)))
        out.append((doc, len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone) if not g)))
    return out


def test_repeat_removal_equals_brute_force(spark):
    rng = random.Random(8)

    def noise(n):
        return "".join(rng.choice("abcdé \n") for _ in range(n))

    passages = [noise(n) for n in (49, 50, 51, 60, 120, 400)]
    rows = []
    for n in range(300):
        parts = [noise(rng.randint(0, 80))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            cut = rng.randint(0, 20)
            parts += [p[cut:] if rng.random() < 0.5 else p[: len(p) - cut], noise(rng.randint(0, 60))]
        rows.append((n * 53 % 997, "".join(parts)))
    rows += [(2000 + n, rows[5][1]) for n in range(5)] + [(3000, None), (3001, ""), (3002, "x" * 49), (3003, "!" * 500), (3004, "!" * 300), (3005, "ab" * 200), (3006, "ba" * 200), (3003, "!" * 500), (None, passages[4])]
    # One passage in over 200 documents: its anchors are refined.
    rows += [(4000 + n, noise(9) + passages[3] + noise(9)) for n in range(230)]
    df = spark.createDataFrame([(*r, "c", 2) for r in rows], "doc_id long, text string, copy string, hit int")
    got = [(r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in remove_repeats(df).collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[4])
    assert sorted(got, key=key) == sorted(brute_repeats(rows), key=key)
    assert remove_repeats(df.limit(0)).count() == 0


def test_lines_of_a_clean_corpus_do_not_meet_in_one_group(spark, monkeypatch):
    look_up = lines._look_up

    def counted(left, right):
        assert left.num_rows < 6000, left.num_rows
        return look_up(left, right)

    monkeypatch.setattr(lines, "_look_up", counted)
    rows = [(n, "\n".join(f"line {n} of its own, number {k}" for k in range(10))) for n in range(1000)]
    rows += [(5000, "the only repeated line\nand another one"), (5001, "the only repeated line")]
    rows += [(6000, "\n".join(f"a long document's line {k}" for k in range(10_000)))]
    got = {r["doc_id"]: r["n_dropped"] for r in lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got.pop(5001) == 1 and not any(got.values())


def test_suffix_arrays_see_only_windows_that_several_documents_have(monkeypatch):
    built = []
    monkeypatch.setattr(repeats, "suffix_arrays", lambda data, sizes, own=repeats.suffix_arrays: (built.append(len(data)), own(data, sizes))[1])
    rng = random.Random(4)
    anchor = b"one anchor gram!"

    def noise(n):
        return bytes(rng.choices(b"abcdefgh", k=n))

    def spans(rows):
        groups = repeats.Groups()
        for key, content, doc in sorted(rows):
            groups.add(key, doc, [1000], len(content) - repeats.SPAN + 1, content)
        groups.close()
        return groups.spans

    # By chance in one place: no window is that of another document.
    assert spans([(n % 5, noise(34) + anchor + noise(34), n) for n in range(300)]) == [] and built == []

    rows = []
    for n in range(90):
        whole = random.Random(n % 4).randbytes(34).replace(b"\0", b"x") + anchor + random.Random(n % 3).randbytes(34)
        begin, end = rng.randrange(0, 20), rng.randrange(0, 20)
        content = noise(begin) + whole[begin : 84 - end] + noise(end) if n % 2 else whole[begin : 84 - end]
        if len(content) >= repeats.SPAN:
            rows.append((n % 2, content, rng.randrange(60)))
    least = {}
    for key, content, doc in rows:
        for at in range(len(content) - repeats.SPAN + 1):
            window = key, content[at : at + repeats.SPAN]
            least[window] = min(doc, least.get(window, doc))
    want = {(doc, 1000 + at) for key, content, doc in rows for at in range(len(content) - repeats.SPAN + 1) if least[key, content[at : at + repeats.SPAN]] < doc}
    assert {(doc, at) for doc, begin, end in spans(rows) for at in range(begin, end - repeats.SPAN + 1)} == want
    assert len(want) > 300 and 0 < sum(built) < sum(len(r[1]) for r in rows)


def test_lots_share_suffix_arrays_and_an_anchor_goes_on_over_lots(monkeypatch):
    import pyarrow as pa

    built = []
    monkeypatch.setattr(repeats, "suffix_arrays", lambda data, sizes, own=repeats.suffix_arrays: (built.append(len(sizes)), own(data, sizes))[1])
    monkeypatch.setattr(repeats, "GATHERED", 4_000)
    rng = random.Random(12)

    def noise(n):
        return bytes(rng.choices(b"abcdefgh", k=n))

    rows = []
    for anchor in range(60):
        whole = noise(70)
        for doc in rng.sample(range(1_000), 30 if anchor == 7 else 4):
            begin = rng.randrange(0, 20)
            content = whole[begin:] if rng.random() < 0.5 else whole[begin:] + noise(rng.randrange(1, 9))
            rows.append((anchor, content, doc))
            if rng.random() < 0.1:
                rows.append((anchor, content, doc))  # a document whose rows repeat
    rows.sort()
    kinds = (pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.int32(), pa.binary())
    batches = []
    for n in range(0, len(rows), 10):
        columns = zip(*((anchor, doc, [100, 2_000], len(content) - repeats.SPAN + 1, content) for anchor, content, doc in rows[n : n + 10]))
        batches.append(pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds)], ["anchor", "doc_id", "at", "length", "bytes"]))
    windows = [(anchor, content[at : at + repeats.SPAN], doc, at) for anchor, content, doc in rows for at in range(len(content) - repeats.SPAN + 1)]
    least = {}
    for anchor, window, doc, _ in windows:
        least[anchor, window] = min(doc, least.get((anchor, window), doc))
    want = {(doc, base + at) for anchor, window, doc, at in windows if least[anchor, window] < doc for base in (100, 2_000)}
    got = {(d, at) for b in repeats._match(iter(batches)) for d, begin, end in zip(*(c.to_pylist() for c in b.columns)) for at in range(begin, end - repeats.SPAN + 1)}
    assert got == want and len(want) > 300
    assert len(built) == 1 and built[0] > 20
    assert sum(b.num_rows for b in repeats._match(iter([]))) == 0
