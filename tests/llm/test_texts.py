"""Language identification, decontamination, surrogates and secrets on small texts."""

import math
import random
import re
import time
from itertools import combinations

import numpy as np
import pyarrow as pa

from tidemark.llm import decontaminate, langid, privacy, secrets

WORDS = {"en": "the of and with thing there other", "de": "und der nicht schein über zeit ach", "fr": "le la est qui eau été même"}


def prose(rng, lang, n):
    return " ".join(rng.choice(WORDS[lang].split()) for _ in range(n))


def test_language_is_told_on_held_out_texts_and_odd_ones(spark):
    rng = random.Random(3)
    rows = [(n, prose(rng, lang, rng.randint(3, 60)), lang, "s") for n in range(300) for lang in [rng.choice(sorted(WORDS))]]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string").withColumn("out", langid.held_out(langid.F.col("doc_id")))
    model = langid.fit(df.where("not out"))
    assert model.languages == sorted(WORDS)
    got = langid.predict(df, model).collect()
    assert len(got) == 300 and all(r["lang_pred"] == r["lang"] and 0 <= r["score"] <= 1 for r in got)
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "12 !? \n"), (4, "日本"), (5, "x"), (None, "the of")], "doc_id long, text string")
    told = {r["doc_id"]: r["lang_pred"] for r in langid.predict(odd, model).collect()}
    assert told[1] == told[2] == told[3] == "und" and told[4] in WORDS and told[None] == "en"
    assert langid.predict(odd.limit(0), model).count() == 0
    assert langid.predict(odd, langid.fit(df.limit(0))).where("lang_pred <> 'und'").count() == 0


def test_bloom_filter_never_loses_a_language():
    rng = np.random.default_rng(2)
    learned = {f"l{n}": rng.integers(0, 2**63, 500).astype(np.uint64) for n in range(70)}  # more than one word of bits
    model = langid.Model(learned)
    for n, lang in enumerate(model.languages):
        assert (model._bits(model.masks(learned[lang]), n) == 1).all()
    strange = model.masks(rng.integers(0, 2**63, 20_000).astype(np.uint64))
    rates = np.array([model._bits(strange, n).mean() for n in range(70)])
    assert np.abs(rates - model.false).max() < 0.01


def test_seeds_find_every_passage_with_two_replaced_words():
    for out in combinations(range(decontaminate.OVERLAP), 2):
        same = [n not in out for n in range(decontaminate.OVERLAP)]
        assert any(all(same[at + j] for j, bit in enumerate(mask) if bit == "1") for mask in decontaminate.MASKS for at in range(len(same) - len(mask) + 1)), out


def test_seeds_find_every_passage_that_the_rule_allows():
    for size in range(decontaminate.OVERLAP, 31):
        out = int(size * (1 - decontaminate.MATCH) + 1e-9)
        places = np.array(list(combinations(range(size), out)))
        differs = (np.int64(1) << places).sum(axis=1)
        for mask in decontaminate.MASKS:
            seed = sum(1 << j for j, bit in enumerate(mask) if bit == "1")
            for at in range(size - len(mask) + 1):
                differs = differs[(differs & (seed << at)) != 0]
        assert not len(differs), (size, out, len(differs))


def brute_overlap(doc, item, least, match):
    best = 0
    need, share = (min(least, len(item)), match if len(item) >= least else 1.0)
    for shift in range(-len(item), len(doc)):
        same = [0 <= n + shift < len(doc) and doc[n + shift] == item[n] for n in range(len(item))]
        inside = [n for n in range(len(item)) if 0 <= n + shift < len(doc)]
        for b in range(len(inside)):
            for e in range(b + need - 1, len(inside)):
                if sum(same[n] for n in inside[b : e + 1]) >= share * (e + 1 - b) - 1e-9:
                    best = max(best, e + 1 - b)
    return best


def test_leaks_equal_brute_force(spark):
    rng = random.Random(12)
    items = [(n, " ".join(f"{rng.choice('abcdefgh')}{rng.randrange(50)}" for _ in range(rng.choice([4, 12, 13, 20, 30])))) for n in range(12)]
    docs = []
    for n in range(120):
        words = [f"{rng.choice('abcdefgh')}{rng.randrange(50)}" for _ in range(rng.randint(0, 40))]
        if n % 2:
            part = rng.choice(items)[1].split()
            part = part[rng.choice([0, 0, 3]) :]
            for _ in range(rng.choice([0, 0, 1, 2, 6])):
                part[rng.randrange(len(part))] = "zz"
            at = rng.randint(0, len(words))
            words[at:at] = part
        docs.append((n, rng.choice([" ", ", "]).join(words).upper()))
    docs += [(500, None), (501, ""), (502, items[3][1]), (502, items[3][1]), (None, items[4][1])]
    bench = spark.createDataFrame([*items, items[0], (None, "a"), (98, None), (99, "...")], "item_id long, text string")
    df = spark.createDataFrame([(*d, "o") for d in docs], "doc_id long, text string, overlap string")
    got = sorted(((r["doc_id"] or -1, r["leaked_items"], r["overlap"], r["contaminated"]) for r in decontaminate.mark_leaks(df, bench).collect()))
    want = []
    for doc, text in docs:
        words = re.findall(r"[^\s!-/:-@\[-`{-~]+", (text or "").lower())
        found = {i: o for i, t in items if (o := brute_overlap(words, t.split(), decontaminate.OVERLAP, decontaminate.MATCH))}
        want.append((doc or -1, sorted(found), max(found.values(), default=0), bool(found)))
    assert [g[1] for g in got] and sum(bool(w[1]) for w in want) > 30
    assert got == sorted(want)
    assert decontaminate.mark_leaks(df, bench.limit(0)).where("contaminated").count() == 0
    assert decontaminate.mark_leaks(df.limit(0), bench).count() == 0


def test_leaks_of_long_repeats_equal_brute_force(spark):
    rng = random.Random(5)
    items = [(1, " ".join(["x"] * 30)), (2, " ".join(["x", "y"] * 12)), (3, " ".join(f"k{n}" for n in range(15)) + " x" * 15)]
    texts = [" ".join(["x"] * 60), " ".join(["y", "x", "x"] * 20), " ".join(rng.choice("xxxy") for _ in range(70)), "x " * 8 + " ".join(f"k{n}" for n in range(15)), "x y " * 6]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r["doc_id"]: (r["leaked_items"], r["overlap"]) for r in decontaminate.mark_leaks(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), bench).collect()}
    for n, text in enumerate(texts):
        found = {i: o for i, t in items if (o := brute_overlap(text.split(), t.split(), decontaminate.OVERLAP, decontaminate.MATCH))}
        assert got[n] == (sorted(found), max(found.values(), default=0))


def test_a_word_repeated_without_end_is_marked_soon():
    seeds = decontaminate.Seeds([(7, "x " * 2000), (8, "a b " * 1000)])
    column = pa.array(["x " * 100_000, "b a " * 50_000, "c " * 100_000])
    words, first = decontaminate.tokens(column)
    assert sum(len(lot) for lot in seeds.diagonals(words, first)) < 2_000_000
    holder = type("Held", (), {"value": seeds})
    batch = pa.RecordBatch.from_pydict({"text": column, "leaked_items": pa.array([[], [], []], pa.list_(pa.int64())), "overlap": pa.array([0, 0, 0], pa.int64())})
    begun = time.monotonic()
    out = pa.Table.from_batches(decontaminate._mark([batch], holder))
    assert out.column("leaked_items").to_pylist() == [[7], [8], []] and out.column("overlap").to_pylist() == [2000, 2000, 0]
    assert time.monotonic() - begun < 30


def test_window_hashes_ignore_what_the_mask_leaves_out():
    words, first = decontaminate.tokens(pa.array(["a b, c", "A x c"]))
    assert first.tolist() == [0, 3, 6]
    hashes = decontaminate.window_hashes(words, "101")
    assert hashes[0] == hashes[3] and decontaminate.window_hashes(words, "111")[0] != decontaminate.window_hashes(words, "111")[3]


def test_surrogates_keep_shape_distinctness_and_coreference(spark):
    text = "Mail Ann.Lee7@Mail.example.com or ann.lee7@mail.example.com, +1 (504) 555-2652, 0810992847249404, 10.1.2.3 and 242.198.241.87. Frau Schmidt met Herr Karl Schmidt, г-жа Иванова."
    rows = [(1, text, 3), (2, "card 0810-9928-4724-9404 again", 3), (3, None, 3), (4, "", 3), (5, "nothing, v1.2.3.4.5 or 12345", 3), (2, "card 0810-9928-4724-9404 again", 3), (None, "ip 242.198.241.87", 3)]
    rows += [(100 + n, f"user{n}@mail.example.com 555-01-{n:04d}", 0) for n in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_entities int")
    out = privacy.replace_private(df, "k")
    assert out.columns == ["doc_id", "text", "n_entities"]
    got = {}
    for r in out.collect():
        got.setdefault(r["doc_id"], []).append(r)
    assert len(got[2]) == 2 and got[3][0]["text"] is None and got[4][0]["text"] == "" and got[5][0]["text"] == rows[4][1] and got[5][0]["n_entities"] == 0
    new = got[1][0]["text"]
    assert got[1][0]["n_entities"] == 9
    shape = r"Mail ([a-z]{3}\.[a-z]{3}\d@[a-z]{4}\.[a-z]{7}\.com) or ([a-z]{3}\.[a-z]{3}\d@[a-z]{4}\.[a-z]{7}\.com), \+1 \(\d{3}\) \d{3}-\d{4}, (\d{16}), (10\.\d+\.\d+\.\d+) and (\d+(?:\.\d+){3})\. Frau (\w+) met Herr (\w+) (\w+), г-жа ([А-Я][а-я]+)\."
    found = re.fullmatch(shape, new)
    assert found, new
    assert found[1] == found[2] and found[5] in got[None][0]["text"]
    assert re.search(r"card (\d{4}-\d{4}-\d{4}-\d{4}) again", got[2][0]["text"])[1].replace("-", "") == found[3]
    assert not any(x in new for x in ("Ann.Lee", "0810992847249404", "242.198.241.87", "Schmidt", "Иванова", "555-2652"))
    users = [got[100 + n][0]["text"].split() for n in range(300)]
    assert len({u[0] for u in users}) == 300 and len({u[1] for u in users}) == 300
    assert len({u[0].split("@")[1] for u in users}) == 1
    assert privacy.replace_private(df.limit(0), "k").count() == 0


def test_people_of_one_surname_stay_distinct(spark):
    names = ["John", "Adam", "Karl", "Otto", "Paul", "Hans", "Max", "Kurt", "Erik"]
    rows = [(n, f"Mr. {name} Smith and Mr. SMITH") for n, name in enumerate(names)]
    rows += [(20, "so Mr. JOHN SMITH, Ms. John Smith"), (21, "Mr. John Miller"), (22, "г-н Иван Петров, г-н Олег Петров")]
    got = {r["doc_id"]: (r["text"], r["n_entities"]) for r in privacy.replace_private(spark.createDataFrame(rows, "doc_id long, text string"), "k").collect()}
    people = [re.fullmatch(r"Mr\. ([A-Z][a-z]+) ([A-Z][a-z]+) and Mr\. ([A-Z]+)", got[n][0]).groups() for n in range(len(names))]
    assert len({p[0] for p in people}) == len(names) and len({p[1] for p in people}) == 1 and all(p[2] == p[1].upper() for p in people)
    assert not {p[0] for p in people} & set(names)
    again = re.fullmatch(r"so Mr\. (\w+) (\w+), Ms\. (\w+) (\w+)", got[20][0])
    assert (again[1], again[2]) == (people[0][0].upper(), people[0][1].upper()) and (again[3], again[4]) != people[0][:2]
    assert got[21][0].split()[1] == people[0][0] and got[21][0].split()[2] != people[0][1]
    first, second = re.fullmatch(r"г-н ([А-Я][а-я]+ [А-Я][а-я]+), г-н ([А-Я][а-я]+ [А-Я][а-я]+)", got[22][0]).groups()
    assert first != second and first.split()[1] == second.split()[1]
    assert all(got[n][1] == 2 for n in [*range(len(names)), 20, 22]) and got[21][1] == 1


def test_colliding_proposals_are_drawn_anew(spark):
    entities = spark.createDataFrame([("phone", f"{n}") for n in range(6)], "kind string, entity string")
    narrow = privacy.surrogates(entities.where("entity < 4"), "k").collect()  # ten one-digit surrogates, four of them real
    assert len({r["surrogate"] for r in narrow}) == 4 and not {r["surrogate"] for r in narrow} & set("0123")


def test_a_full_host_gets_longer_local_parts(spark):
    locals_ = [a + b for a in "abcdefghijklmnopqrstuvwxyz" for b in "abcdefghijklmnopqrstuvwxyz"] + list("0123456789")
    entities = spark.createDataFrame([("email", f"{local}@mail.com") for local in locals_], "kind string, entity string")
    got = {r["entity"]: r["surrogate"] for r in privacy.surrogates(entities, "k").collect()}
    assert len(got) == len(locals_) == len(set(got.values())) and not set(got) & set(got.values())
    assert len({s.split("@")[1] for s in got.values()}) == 1 and any(len(s) > len(e) for e, s in got.items())
    assert all(re.fullmatch(r"[a-z0-9]{1,12}@[a-z]{4}\.com", s) for s in got.values())


def test_hosts_stay_distinct_and_none_is_a_real_one(spark):
    hosts = [a + b + ".com" for a in "abcdefghij" for b in "abcdefghijklmnopqrstuvwxyz"]
    rows = [(n, f"to u{n}@{host} and v@{host.upper()}") for n, host in enumerate(hosts)]
    got = {r["doc_id"]: r["text"].split() for r in privacy.replace_private(spark.createDataFrame(rows, "doc_id long, text string"), "k").collect()}
    new = [{w.split("@")[1].lower() for w in got[n] if "@" in w} for n in range(len(hosts))]
    assert all(len(h) == 1 for h in new)
    new = [h.pop() for h in new]
    assert len(set(new)) == len(hosts) and not set(new) & set(hosts) and all(h.endswith(".com") for h in new)


def test_names_without_titles_follow_those_with_one(spark):
    text = "Mr. John Smith called. Later John Smith and SMITH came, not Smithson; mail john@x.org. Dr. Anna Weber too, and Weber's car; Prof. Dr. O'Hara, O'Hara. The End"
    rows = [(1, text), (2, "John Smith is nobody here"), (2, "Call tel 5045552652 or tel: 5045552653"), (3, "Mr. Smith and Mrs. Smith, then Smith"), (None, text)]
    out = privacy.replace_private(spark.createDataFrame(rows, "doc_id long, text string"), "k").collect()
    by = {(r["doc_id"], r["text"][:4]): r for r in out}
    new = next(r for r in out if r["doc_id"] == 1)
    shape = r"Mr\. (\w+) (\w+) called\. Later (\w+) (\w+) and (\w+) came, not Smithson; mail (\w{4})@\w\.org\. Dr\. (\w+) (\w+) too, and (\w+)'s car; Prof\. Dr\. (\S+), (\S+)\. The End"
    f = re.fullmatch(shape, new["text"])
    assert f, new["text"]
    assert f[1] == f[3] and f[2] == f[4] and f[5] == f[2].upper() and f[10] == f[11]
    assert not {"John", "Smith", "SMITH", "Anna", "Weber", "O'Hara"} & set(re.findall(r"[\w']+", new["text"]))
    assert new["n_entities"] == 8 and next(r for r in out if r["doc_id"] is None)["text"] == new["text"]
    assert ("John Smith is nobody here", 0) in [(r["text"], r["n_entities"]) for r in out]
    assert re.fullmatch(r"Call tel (?!5045552652)\d{10} or tel: (?!5045552653)\d{10}", by[2, "Call"]["text"])
    first, second, bare = re.fullmatch(r"Mr\. (\w+) and Mrs\. (\w+), then (\w+)", by[3, "Mr. "]["text"]).groups()
    assert first == bare != second


def luhn(number):
    digits = [int(d) for d in reversed(number)]
    return sum(d if n % 2 == 0 else sum(divmod(2 * d, 10)) for n, d in enumerate(digits)) % 10


def test_card_numbers_keep_passing_their_check_or_failing_it(spark):
    rng = random.Random(4)
    numbers = ["".join(rng.choice("0123456789") for _ in range(16)) for _ in range(80)]
    numbers = [n[:-1] + str((int(n[-1]) - luhn(n)) % 10) if k % 2 else n for k, n in enumerate(numbers)]
    got = privacy.surrogates(spark.createDataFrame([("card", n) for n in numbers], "kind string, entity string"), "k").collect()
    assert len(got) == len(set(numbers)) == len({r["surrogate"] for r in got})
    assert sum(luhn(r["entity"]) == 0 for r in got) >= 40 and all((luhn(r["entity"]) == 0) == (luhn(r["surrogate"]) == 0) and len(r["surrogate"]) == 16 for r in got)


def brute_base(text):
    out = []
    for m in re.finditer(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 12:
            out.append((m.start(), 0, "assign", m.end()))
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return [(k, s, e) for s, _, k, e in sorted(out)]


def test_base_secrets_equal_brute_force(spark):
    rng = random.Random(7)
    bits = ["password", "PassWd: ", "secret", " = ", ":", "'", '"', "token=", "api_key", "apikey:", "AKIA", "AKIAKIA", "ABCDEFGH1234567", "deadbeef", "0123456789abcdef", "é日", " ", "\n", "x.y-z_w", "abc"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 25))) for _ in range(300)] + ["", None, "secret: token: abcdefghijklmnop", "é" * 30 + "AKIA" + "A1" * 9]
    df = spark.createDataFrame([(n // 2, t, 1) for n, t in enumerate(texts)] + [(None, "AKIA" + "B" * 20, 1)], "doc_id long, text string, row int")
    got = sorted((r["doc_id"] if r["doc_id"] is not None else -1, [(s["kind"], s["start"], s["end"]) for s in r["base"]]) for r in secrets.find_secrets(df).collect())
    assert got == sorted([(n // 2, brute_base(t or "")) for n, t in enumerate(texts)] + [(-1, [("access", 0, 24)])])
    assert secrets.find_secrets(df.limit(0)).count() == 0


def test_very_long_tokens_and_many_matches_end_soon(spark):
    rng = random.Random(31)
    long = "".join(rng.choice(secrets.UPPER + secrets.LOWER + secrets.DIGITS) for _ in range(1_000_000))
    many = " ".join("0123456789abcdef" for _ in range(50_000))
    begun = time.monotonic()
    got = {r["doc_id"]: r for r in secrets.find_secrets(spark.createDataFrame([(1, f"é {long} y"), (2, many)], "doc_id long, text string")).collect()}
    assert time.monotonic() - begun < 60
    assert got[1]["base"] == [] or all(s["kind"] == "access" for s in got[1]["base"])
    assert [(s["start"], s["end"]) for s in got[2]["base"]] == [(17 * n, 17 * n + 16) for n in range(50_000)]


def test_battery_equals_a_plain_one(spark):
    rng = random.Random(9)
    values = ["".join(rng.choice(letters) for _ in range(rng.randint(20, 70))) for _, _, letters in secrets.ENCODINGS for _ in range(15)] + ["A" * 24, "ab" * 12 + "==", "abc_defghi/jklmnopqrst"]
    got = secrets.battery(spark.createDataFrame([(v,) for v in values], "value string")).collect()
    for r in got:
        fits = [(name, letters) for name, form, letters in secrets.ENCODINGS if re.match(form, r["value"])]
        if not fits:
            assert r["encoding"] is None and r["p"] == 0
            continue
        name, letters = fits[0]
        codes = np.array([letters.index(c) for c in r["value"].rstrip("=")], float)
        n, a, high = len(codes), len(letters), codes >= len(letters) / 2
        chi = (np.bincount(codes.astype(int), minlength=a) ** 2).sum() * a / n - n
        zs = [(chi - (a - 1)) / math.sqrt(2 * (a - 1) * (n - 1) / n), 99.0, 99.0]
        both = 2 * high.sum() * (n - high.sum())
        if both > n:
            zs[1] = (1 + (high[1:] != high[:-1]).sum() - 1 - both / n) / math.sqrt(both * (both - n) / (n * n * (n - 1)))
        off = codes - codes.mean()
        if (off**2).sum() > 0:
            zs[2] = ((off[1:] * off[:-1]).sum() / (off**2).sum() + 1 / (n - 1)) * math.sqrt(n)
        assert r["encoding"] == name and abs(r["p"] - min(1, 3 * min(math.erfc(abs(z) / math.sqrt(2)) for z in zs))) < 1e-5, (r, zs)


def test_random_tokens_are_found_and_ordinary_ones_are_not(spark):
    rng = random.Random(17)
    keys = ["".join(rng.choice("0123456789abcdef") for _ in range(40)) for _ in range(60)] + ["".join(rng.choice(secrets.UPPER + secrets.LOWER + secrets.DIGITS) for _ in range(32)) for _ in range(60)]
    plain = ["the" * 8 + "ation" * 2, "releasenotes_2024_version_two_final", "aaaaaaaaaaaaaaaaaaaaaaaa1", "0123456789abcdef0123456789abcdef", "thingsandotherthingsinonelongword7"]
    df = spark.createDataFrame([(n, f"x {t} y") for n, t in enumerate(keys + plain * 20)], "doc_id long, text string")
    found = {r["doc_id"] for r in secrets.find_secrets(df).collect() if any(s["kind"] == "random" and (s["start"], s["end"]) == (2, 2 + len((keys + plain * 20)[r["doc_id"]])) for s in r["spans"])}
    assert len(found & set(range(120))) >= 110 and not found - set(range(120))


def test_ordinary_words_do_not_shut_out_other_encodings_nor_letters(spark):
    rng = random.Random(23)
    words = sorted({"".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(rng.randint(2, 4))) for _ in range(150)})
    prose = [" ".join(rng.choice(words) for _ in range(60)) for _ in range(60)]
    joined = []
    while len(joined) < 400:
        token, sign = rng.choice(words), rng.choice(["", "_", "/"])
        while len(token) < 20:
            token += sign + rng.choice(words)
        joined.append(token if rng.random() < 0.8 else token + "7")
    hexes = ["".join(rng.choice("0123456789abcdef") for _ in range(20)) for _ in range(40)]
    letters = ["".join(rng.choice(secrets.LOWER + secrets.UPPER) for _ in range(44)) for _ in range(40)]
    tokens = hexes + letters + joined
    texts = [f"x {t} y" for t in tokens] + prose
    found = {r["doc_id"] for r in secrets.find_secrets(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect() if any(s["kind"] == "random" for s in r["spans"])}
    assert len(found & set(range(40))) >= 36 and len(found & set(range(40, 80))) >= 30
    assert len(found - set(range(80))) <= 2
