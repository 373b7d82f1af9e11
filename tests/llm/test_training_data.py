import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedloom import storage
from feedloom.llm import boilerplate, capping, history, keys, mixing, neardup, packing, proportions, subjects, tokens


# p1
@pytest.mark.parametrize(("limit", "ties"), [(3, 2), (0, 3)])
def test_capping_equals_sorting(spark, limit, ties):
    rng = random.Random(limit)
    rows = [(rng.choice(["big"] * 6 + ["b", None]), rng.randrange(ties), rng.randrange(ties), f"id{i:03d}" + "x" * (i % 9), "extra") for i in range(150)]
    rows += [("one", None, 5, "z", "e"), ("one", 1, None, "y", "e")]
    df = spark.createDataFrame(rows, "g string, s int, t int, i string, cut string")
    got = capping.cap_contributors(df, ["g"], {"s": F.col("s"), "t": F.col("t")}, "i", limit).collect()
    want = Counter()
    low = -(2**62)
    for g in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == g), key=lambda r: (-(low if r[1] is None else r[1]), -(low if r[2] is None else r[2]), r[3]))
        want += Counter(mine[:limit])
    assert Counter(map(tuple, got)) == want


def test_capping_by_long_identifiers(spark):
    """Ties are told apart late in long ids, by length alone, or never (rows that are equal stay together)."""
    deep = "x" * 30
    ids = [deep + c for c in "dcba"] + [deep, deep + "\0", "y" * 20_000, "ü", None]
    df = spark.createDataFrame([("g", 1, i) for i in [*ids, ids[0]]], "g string, s int, i string")
    for limit in (1, 3, 6, 8):
        got = capping.cap_contributors(df, ["g"], {"s": F.col("s")}, "i", limit).collect()
        want = sorted((i for i in ids if i is not None), key=str.encode) + [None]
        assert Counter(r.i for r in got) == Counter(i for i in [*ids, ids[0]] if i in want[:limit])


def test_capping_share_and_empty(spark):
    df = spark.createDataFrame([("a", i, f"i{i}") for i in range(10)], "g string, s int, i string")
    assert capping.cap_contributors(df, ["g"], {"s": F.col("s")}, "i", F.ceil(F.col("__n") * 0.3)).count() == 3
    assert capping.cap_contributors(df.limit(0), ["g"], {"s": F.col("s")}, "i", 2).count() == 0


# p2
def test_near_duplicates_equal_brute_force(spark):
    rng = random.Random(2)
    vocab = [f"w{i}" for i in range(400)]
    base = [[rng.choice(vocab) for _ in range(80)] for _ in range(25)]
    rows = []
    for b, text in enumerate(base):
        for k in range(3):
            t = list(text)
            for _ in range(k * 4):
                t[rng.randrange(len(t))] = rng.choice(vocab)
            rows.append((f"{b}-{k}", " ".join(t)))
    rows += [("copy1", rows[0][1].upper()), ("copy2", rows[0][1] + "."), ("copy1", rows[0][1].upper()), ("none", None), ("blank", " "), ("short", "a b c"), (None, rows[0][1]), ("long", " ".join(rng.choice(vocab) for _ in range(30_000)))]
    got = {tuple(r) for r in neardup.every_pair(*neardup.linked_classes(spark.createDataFrame(rows, "item_id string, content_text string"))).collect()}
    sets = {i: {tuple(w[j : j + 3]) for j in range(len(w) - 2)} for i, t in rows if i and t and len(w := neardup.words(t)) >= 40}
    want = {(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.5 * len(sets[a] | sets[b])}
    near = {(a, b) for a, b in want if len(sets[a] & sets[b]) >= 0.65 * len(sets[a] | sets[b])}
    assert len(near) > 30 and got <= want and near <= got and len(got) >= 0.9 * len(want)
    assert neardup.every_pair(*neardup.linked_classes(spark.createDataFrame([], "item_id string, content_text string"))).count() == 0


def test_fingerprints_only_disprove(spark):
    rng = np.random.default_rng(3)
    for _ in range(50):
        a = rng.integers(0, 2**63, 200, dtype=np.uint64)
        b = np.unique(np.concatenate([a[: rng.integers(100, 200)], rng.integers(0, 2**63, rng.integers(1, 80), dtype=np.uint64)]))
        a = np.unique(a)
        apart = len(np.setxor1d(a, b))
        x, y = neardup.fingerprint(a), neardup.fingerprint(b)
        hamming = int((x != y).sum())
        table = int(np.abs(neardup.pivot_row(x).astype(int) - neardup.pivot_row(y)).max())
        assert table <= hamming <= apart


def test_every_pair_of_large_linked_classes(spark):
    sizes = {1: 69, 2: 9, 3: 8, 4: 1, 5: 2 * neardup.CHUNK + 40}
    rows = [(f"{c}-{i:03d}", c) for c, n in sizes.items() for i in range(n)]
    rows += [("1-000", 2), ("2-000", 3), ("both", 3), ("both", 5)]  # ids with several texts
    links = {(1, 4), (2, 3), (3, 5)}
    got = [tuple(r) for r in neardup.every_pair(spark.createDataFrame(rows, "item_id string, cls long"), spark.createDataFrame(sorted(links), "a long, b long")).collect()]
    of = {c: {i for i, k in rows if k == c} for c in sizes}
    want = {(min(p, q), max(p, q)) for a, b in links | {(c, c) for c in sizes} for p in of[a] for q in of[b] if p != q}
    assert len(got) == len(set(got)) and set(got) == want


def test_p2_found_writes_out_all_copies(spark, tmp_path):
    rng = random.Random(4)
    words = [f"w{rng.randrange(10**6)}" for _ in range(60)]
    texts = {"a": (9, " ".join(words)), "b": (8, " ".join([*words[:-4], "other", "end", "of", "it"]))}
    rows = [(f"{k}{i}", t.upper() if i % 2 else t) for k, (n, t) in texts.items() for i in range(n)]
    spark.createDataFrame(rows, "item_id string, content_text string").write.parquet(str(tmp_path / "items.parquet"))
    got = [tuple(r) for r in neardup.p2_found(spark, str(tmp_path)).collect()]
    ids = sorted(i for i, _ in rows)
    assert sorted(got) == [(p, q) for p in ids for q in ids if p < q]


def test_groups_carry_their_classes(spark, tmp_path):
    text = [" ".join(f"w{i * 100 + k}" for k in range(50)) for i in range(2)]
    rows = [("a", text[0]), ("b", text[0].upper()), ("c", text[0] + " more"), ("d", text[1]), ("d", text[1]), ("e", "short"), (None, text[0])]
    spark.createDataFrame(rows, "item_id string, content_text string").write.parquet(str(tmp_path / "items.parquet"))
    got = {r.item_id: r for r in neardup.p2_groups(spark, str(tmp_path)).collect()}
    assert got.keys() == set("abcd") and got["a"].cls == got["b"].cls != got["c"].cls
    assert got["a"].group_id == got["c"].group_id != got["d"].group_id and [got[i].n_links for i in "abcd"] == [1, 1, 1, 0]


def test_components(spark):
    nodes = spark.createDataFrame([(i,) for i in range(12)], "cls long")
    edges = spark.createDataFrame([(i, i + 1) for i in range(8)] + [(9, 10)], "a long, b long")
    got = {r.cls: r.group for r in neardup.components(nodes, edges).collect()}
    assert got == {**{i: 0 for i in range(9)}, 9: 9, 10: 9, 11: 11}


# p3
def test_page_furniture(spark):
    who = ["nurse", "judge", "coach", "clerk", "tutor", "baker", "miner", "pilot"]
    body = ["The {0} hedged an invoice. It paid off for the {0}. Nobody noticed it then.", "The banner about cookies cost the {0} a week, so each {0} went first."]
    rows = []
    for i in range(8):
        text = "\n".join(["Home | About | Shop", "", body[0].format(who[i]), "Keep reading", f"What every nurse gets wrong about {i}", "A title that goes on… ", body[1].format(who[i]), f"- one {who[i]} more", "© 2020 Some Paper. All rights reserved."])
        rows.append(("f", f"p{i}", "https://www.host.example/p/x", text))
    rows += [rows[0], ("f", "null", None, None), ("f", "empty", None, ""), ("f", "stub", "https://host.example/", "New episode is out.")]
    pages = boilerplate.distinct_pages(spark.createDataFrame(rows, "field string, item_id string, url string, text string"))
    out = boilerplate.furniture(storage.cut(pages)).where("outside").join(pages, "page").select("item_id", "line_no").collect()
    assert Counter(map(tuple, out)) == Counter((f"p{i}", n) for i in range(8) for n in (1, 4, 5, 6, 9))
    assert boilerplate.furniture(pages.limit(0)).count() == 0


def test_slots_without_cues_are_furniture(spark):
    towns = ["Oslo", "Bergen", "Lima", "Quito", "Turin", "Malmo"]
    rows = []
    for i, t in enumerate(towns):
        lines = [f"Now brewing in {t} for our regulars only", f"A walk through {t}", f"The mill of {t} was closed early. Nobody from {t} minded that.", f"- take the bus from {t} to the sea", f"The tram to {t} ran late on that day."]
        rows.append(("f", f"p{i}", "https://host.example/p/x", "\n".join(lines)))
    # Lines of one page are no slot, and starts with ever other ends are headings.
    rows.append(("f", "one", "https://host.example/p/y", "Pick red for the win\nPick blue for the win\nPick green for the win"))
    pages = storage.cut(boilerplate.distinct_pages(spark.createDataFrame(rows, "field string, item_id string, url string, text string")))
    out = boilerplate.furniture(pages).where("outside").join(pages, "page").select("item_id", "line_no").collect()
    assert Counter(map(tuple, out)) == Counter((f"p{i}", 1) for i in range(len(towns)))


def test_long_notices_are_furniture(spark):
    notice = "This paper keeps a few facts on its readers. " * 8
    rows = [("f", f"p{i}", "https://host.example/p/x", f"{notice.strip()}\nThe mill number {w} was closed early.\n{w} long line. " + f"Nobody from {w} minded that at all. " * 9) for i, w in enumerate(["one", "two", "red", "blue"])]
    pages = storage.cut(boilerplate.distinct_pages(spark.createDataFrame(rows, "field string, item_id string, url string, text string")))
    out = boilerplate.furniture(pages).where("outside").join(pages, "page").select("item_id", "line_no").collect()
    assert len(notice) > boilerplate.LONGEST and Counter(map(tuple, out)) == Counter((f"p{i}", 1) for i in range(4))


def test_long_lines_have_cues_and_slots(spark):
    filler = "and the mill beside the long river has its own small paper " * 5
    rows = []
    for i, t in enumerate(["Oslo", "Bergen", "Lima", "Quito", "Turin", "Malmo"]):
        # A slot between both ends of a long line, an article's long line, and once a long line with a cue.
        lines = [f"Now brewing {filler}in {t} {filler}for our regulars only", f"The mill of {t} was closed early. Nobody from {t} minded that. {t} {filler}is calm."]
        rows.append(("f", f"p{i}", "https://host.example/p/x", "\n".join(lines + [f"© 2020 Some Paper {filler}"] * (i == 0))))
    pages = storage.cut(boilerplate.distinct_pages(spark.createDataFrame(rows, "field string, item_id string, url string, text string")))
    out = boilerplate.furniture(pages).where("outside").join(pages, "page").select("item_id", "line_no").collect()
    assert len(filler) > boilerplate.LONGEST and Counter(map(tuple, out)) == Counter([*((f"p{i}", 1) for i in range(6)), ("p0", 3)])


def test_every_cue_holds_one_of_its_parts():
    def texts(seq):
        """Shortest texts that match, one for each way through the alternatives."""
        out = [""]
        for op, arg in seq:
            if str(op) == "BRANCH":
                own = [t for s in arg[1] for t in texts(s)]
            elif str(op) == "SUBPATTERN":
                own = texts(arg[3])
            elif str(op) == "MAX_REPEAT":
                own = [t * arg[0] for t in texts(arg[2])] if arg[0] else [""]
            else:
                own = [chr(arg) if str(op) == "LITERAL" else "" if str(op) == "AT" else "~"]
            out = [a + b for a in out for b in dict.fromkeys(own)]
        return out

    cues = texts(re._parser.parse(boilerplate.CUES))
    assert len(cues) > 100
    assert [c for c in cues if not any(p in c for p in boilerplate.CUE_PARTS)] == []


# p4
def test_pivotal_keeps_sums_and_probabilities():
    p = np.array([0.2, 0.5, 0.9, 1.0, 0.0, 0.4] * 5)
    hits = np.zeros(len(p))
    for s in range(800):
        chosen, at, mass = proportions.pivotal(p, np.random.default_rng(s))
        assert abs(chosen.sum() + mass - p.sum()) < 1e-6 and (at >= 0) == (mass > 0)
        if at >= 0 and np.random.default_rng(10_000 + s).random() < mass:
            chosen[at] = True
        hits += chosen
    assert np.abs(hits / 800 - p).max() < 0.08 and not hits[p == 0].any() and (hits[p == 1] == 800).all()


def test_sample_meets_targets_floors_and_gaps(spark):
    rows = [(f"a{i}", "t", "a") for i in range(300)] + [(f"b{i}", "t", "b") for i in range(100)] + [("c0", "t", "c")] + [(f"a{i}", "t", "b") for i in range(20)]
    items = spark.createDataFrame(rows, "item_id string, source_type string, source_id string")
    targets = spark.createDataFrame([("t", "a", 700000, 0, 100), ("t", "b", 250000, 0, 100), ("t", "c", 20000, 3, 100), ("t", "d", 30000, None, 100)], "source_type string, source_id string, target_ppm int, min_count int, sample_size int")
    drawn, report = proportions.sample(items, targets, ["source_type", "source_id"])
    r = {x.source_id: x for x in report.collect()}
    assert (r["c"].short, r["c"].sampled, r["d"].short, r["d"].supply, r["a"].short) == (True, 1, True, 0, False)
    assert abs(r["a"].sampled - r["a"].goal) <= 3 and abs(r["b"].sampled - r["b"].goal) <= 3
    assert drawn.select("item_id", "source_id").distinct().count() == drawn.count() == sum(x.sampled for x in r.values())
    none = items.limit(0)
    assert {x.supply for x in proportions.gaps(none, targets, ["source_type", "source_id"]).collect()} == {0}


def test_p4_found_is_of_the_drawn_sample(spark, monkeypatch):
    items = spark.createDataFrame([(f"a{i}", "t", "a") for i in range(30)] + [("b0", "t", "b")], "item_id string, source_type string, source_id string")
    targets = spark.createDataFrame([("t", "a", 500000, 0, 20), ("t", "b", 500000, 2, 20)], "source_type string, source_id string, target_ppm int, min_count int, sample_size int")
    dealt, draw = [], proportions.draw
    monkeypatch.setattr(proportions, "members", lambda *_: items)
    monkeypatch.setattr(storage, "table", lambda *_: targets)
    monkeypatch.setattr(proportions, "draw", lambda *x: dealt.append(1) or draw(*x))
    assert [tuple(r) for r in proportions.p4_found(spark, "").collect()] == [("t", "b")] and dealt


# p5
SOURCES = [("tidal_ops_1",), ("vt_lab_1",)]


def key_rows(spark, rows):
    src = spark.createDataFrame(SOURCES, "source_id string")
    df = spark.createDataFrame(rows, "raw_id long, batch_id int, source_id string, external_id string, url string")
    return history.entry_keys(df, src, "source_id", "external_id", "url")


def test_spellings(spark):
    same = [
        ("https://www.host.example/p/a-b/?utm_source=x&b=2&a=1#top", "http://HOST.example:80/p/a%2Db?a=1&b=2&ref=q"),
        ("https://vidtube.example/watch?x=1&v=aBcDeFgHiJk", " https://vdtu.example/aBcDeFgHiJk/\n"),
    ]
    rows = [(2 * i + j, 1, None, None, u) for i, pair in enumerate(same) for j, u in enumerate(pair)] + [(9, 1, None, None, "https://host.example/p/A-b?a=1&b=2"), (10, 1, None, None, "  ")]
    got = {r.raw_id: r.key for r in key_rows(spark, rows).collect()}
    assert got[0] == got[1] and got[2] == got[3] == "u:video:aBcDeFgHiJk" and got[9] != got[0] and 10 not in got
    ids = ["{1E4B9F52-7A63-8163-9F52-0123456789AB}", "urn:uuid:1e4b9f52-7a63-8163-9f52-0123456789ab", "00123", "#123", "post-123", "vt:video:aBcDeFgHiJk", "VT:aBcDeFgHiJk", "TAG:Host.Example,2018:7", "tag:host.example,2018:7"]
    got = [r.key for r in key_rows(spark, [(i, 1, "Tidal-Ops 1 ", x, None) for i, x in enumerate(ids)]).orderBy("raw_id").collect()]
    assert len(set(got)) == 4 and got[0] == got[1] and got[2] == got[3] == got[4] and got[5] == got[6] and got[7] == got[8]
    assert [r.s for r in keys.spelled_source(spark.createDataFrame([("vt.Lab_1\t",), ("tidal_ops_11",), (None,)], "x string"), "x", spark.createDataFrame(SOURCES, "source_id string"), "s").collect()] == ["vt_lab_1", None, None]


def test_batches_one_by_one_equal_all_at_once_and_brute_force(spark):
    rng = random.Random(5)
    rows = [(i, i // 20, rng.choice(["tidal_ops_1", "other", None]), rng.choice([None, "", *map(str, range(12))]), rng.choice([None, *[f"https://h.example/{k}" for k in range(25)]])) for i in range(80)]
    seen = [(None, None, "tidal_ops_1", "3", None), (None, None, None, None, "http://h.example/7/")]
    known = {k.key for k in key_rows(spark, seen).collect()}
    by = {}
    for r in key_rows(spark, rows).collect():
        by.setdefault(r.raw_id, set()).add(r.key)
    want, have = set(), set(known)
    for i in range(80):
        if by.get(i, set()) & have:
            want.add(i)
        have |= by.get(i, set())
    start = lambda: history.CellIndex.create(key_rows(spark, seen).select("key").distinct(), storage.scratch(spark, "t"), cells=4)
    at_once = history.repeated_records(start(), key_rows(spark, rows)).where("repeated")
    assert {r.raw_id for r in at_once.collect()} == want
    index = start()
    got = history.batch_by_batch(index, storage.cut(key_rows(spark, rows))).where("repeated")
    assert {r.raw_id for r in got.collect()} == want
    assert history.CellIndex.open(spark, index.path).stored().count() == len(have)
    assert history.batch_by_batch(index, key_rows(spark, rows[:1]).limit(0)).count() == 0


@pytest.mark.parametrize("block", [7, 10_000])
def test_probing_by_bounds_finds_the_nearest(spark, monkeypatch, block):
    monkeypatch.setattr(history, "BLOCK_STORED", block)
    monkeypatch.setattr(history, "BLOCK_QUERIES", block)
    rng = random.Random(6)
    texts = sorted({"".join(rng.choice("abcdef") for _ in range(rng.randrange(4, 14))) for _ in range(200)} | {"é" * 400, ""})
    stored, asked = texts[::2], texts[:60]
    index = history.CellIndex.create(spark.createDataFrame([(t,) for t in stored], "key string"), storage.scratch(spark, "t"), cells=8)
    got = {r.key: (r.stored, r.distance) for r in index.nearest(spark.createDataFrame([(t,) for t in asked], "key string")).collect()}
    v = {t: history.pair_counts([t])[0].astype(float) for t in texts}
    want = {q: min((np.linalg.norm(v[q] - v[t]), t) for t in stored) for q in asked}
    assert got.keys() == want.keys() and all(abs(got[q][1] - want[q][0]) < 1e-6 and got[q][0] == want[q][1] for q in asked)
    none = history.CellIndex.create(spark.createDataFrame([], "key string"), storage.scratch(spark, "t"))
    assert none.nearest(spark.createDataFrame([("a",)], "key string")).count() == 0


def test_small_batches_share_a_reading_of_history(spark, monkeypatch):
    asked = []
    known = history.CellIndex.known
    monkeypatch.setattr(history.CellIndex, "known", lambda self, placed: asked.append(placed.count()) or known(self, placed))
    index = history.CellIndex.create(spark.createDataFrame([(f"u:{i}",) for i in range(100)], "key string"), storage.scratch(spark, "t"), cells=4)
    # Batches of one row, nulls first; records 30 to 39 and 41 on repeat history or an earlier batch.
    rows = [(i, None if i < 5 else i, f"u:{90 + i % 40 if i < 40 else 200 + i // 42}") for i in range(44)]
    want, have = set(), {f"u:{i}" for i in range(100)}
    for raw, _, key in rows:
        if key in have:
            want.add(raw)
        have.add(key)
    got = history.batch_by_batch(index, storage.cut(spark.createDataFrame(rows, "raw_id long, batch_id int, key string"))).where("repeated")
    assert {r.raw_id for r in got.collect()} == want and index.stored().count() == len(have)
    assert len(asked) <= 5
    assert len(history.rounds({i: 10 for i in range(3_600)}, 100_000)) <= 4
    # Large batches are asked alone.
    assert history.rounds({2: 50, None: 60, 1: 40}, 100) == [[None], [1], [2]]


def test_known_compares_whole_vectors_where_bounds_lead(spark):
    same = ["aaba", "abaa", "zz"]
    assert (history.pair_counts([same[0]]) == history.pair_counts([same[1]])).all()
    index = history.CellIndex.create(spark.createDataFrame([(k,) for k in [same[0], "zz", *map(str, range(50))]], "key string"), storage.scratch(spark, "t"), cells=4)
    placed = index.placed(spark.createDataFrame([(k,) for k in [*same, "q" * 300]], "key string"))
    # Keys of one vector are told apart by themselves; what no cell's bounds allow is never looked up.
    assert {r.key for r in index.known(placed).collect()} == {same[0], "zz"}
    assert "q" * 300 not in {r.key for r in index.probes(placed).collect()}
    # A posting whose vector is another one is no match, whatever its key.
    wrong = placed.where("key = 'abaa'").withColumn("vec", F.unhex(F.lit("00" * history.DIM)))
    index.append(wrong.select("key", "cell", "ring", "vec"))
    assert {r.key for r in index.known(placed).collect()} == {same[0], "zz"}
    # Cell and ring don't depend on the rows placed along.
    texts = [f"u:h{i % 7}.example/{i * i}" for i in range(300)]
    v = history.pair_counts(texts)
    c = history.fit_centroids(v, 9)
    assert (history.distances(v, c) == np.vstack([history.distances(v[i : i + 1], c) for i in range(len(v))])).all()


# p6
def test_packing_places_each_once_and_never_overfills(spark):
    rng = random.Random(7)
    rows = [(i, rng.choice([1, 3, 7, 50, 99, 100, 101, 250, 200, 0])) for i in range(400)] + [(5, 7), (5, 7)]
    df = spark.createDataFrame(rows, "doc_id long, tokens long")
    out = packing.pack(df, spark.createDataFrame([("c", 100), ("w", 250), ("bad", None)], "container string, capacity_tokens int")).collect()
    for name, cap in (("c", 100), ("w", 250)):
        mine = [r for r in out if r.container == name]
        load = Counter()
        for r in mine:
            if r.container_no is not None:
                load[r.container_no] += r.tokens
        assert max(load.values()) <= cap and sum(load.values()) == sum(t for _, t in rows)
        assert len(mine) == sum(max(1, -(-t // cap)) for _, t in rows)
        assert sum(load.values()) > 0.9 * cap * len(load)
    assert packing.pack(df.limit(0), spark.createDataFrame([("c", 100)], "container string, capacity_tokens int")).count() == 0


def test_token_counts_of_long_and_odd_texts(spark):
    path = f"{tokens.FOLDER}/{tokens.VOCABULARY}"
    long = "word and another " * 40_000
    assert tokens.count(long, path) == len(tokens.encoding(path).encode_ordinary(long)) and tokens.count(None, path) == tokens.count("", path) == 0
    assert "".join(tokens.pieces("a b  c " * 50, 7)) == "a b  c " * 50
    solid = "wörterkette" * 60
    assert list(tokens.pieces(solid, 50)) == [solid]
    odd = "x  y\n z.  \n\n w's 12 " * 300
    assert sum(len(tokens.encoding(path).encode_ordinary(p)) for p in tokens.pieces(odd, 11)) == tokens.count(odd, path)


# p7
@pytest.mark.parametrize(("mean", "most"), [(0.3, 1), (0.9, 1), (1.4, 2), (2.9, 3), (3, 3), (0, 4), (0.05, 4), (900, 1000)])
def test_poisson_means(mean, most):
    p = mixing.cut_poisson(mean, most)
    assert len(p) == most and abs(sum(1 - x for x in p) - min(mean, most)) < 1e-6


def test_mixture_follows_weights_and_caps(spark):
    rows = [(i, "a", 10, i) for i in range(2000)] + [(5000 + i, "b", 20, i) for i in range(300)] + [(9000, "c", 5, 0)]
    df = spark.createDataFrame(rows, "doc_id long, source string, tokens long, __row long")
    t = spark.createDataFrame([("a", 0.5, 1, 16000), ("b", 0.5, 3, 16000), ("d", 0.0, 2, 16000), ("e", None, None, 16000)], "source string, weight double, max_repeats int, budget_tokens long")
    mix, report = mixing.mixture(df, t)
    r = {x.source: x for x in report.collect()}
    assert 7840 <= r["a"].used <= 8000 and 7840 <= r["b"].used <= 8000 and not r["a"].short and not r["d"].short
    uses = Counter(x.doc_id for x in mix.collect())
    assert max(n for d, n in uses.items() if d < 5000) == 1 and max(uses.values()) <= 3 and 9000 not in uses


def test_mixture_meets_targets_in_spite_of_heavy_tails(spark):
    rng = random.Random(9)
    rows = [(i, f"s{i % 3}", int(20 * rng.paretovariate(0.9)), i) for i in range(3000)]
    total = Counter()
    for _, s, n, _ in rows:
        total[s] += n
    budget = 4 * min(total.values())
    targets = spark.createDataFrame([("s0", 0.1, 2, budget), ("s1", 0.02, 1, budget), ("s2", 0.3, 3, budget)], "source string, weight double, max_repeats int, budget_tokens long")
    _, report = mixing.mixture(spark.createDataFrame(rows, "doc_id long, source string, tokens long, __row long"), targets)
    assert all(0.98 * r.wanted <= r.used <= r.wanted for r in report.collect())
    _, report = mixing.mixture(spark.createDataFrame([], "doc_id long, source string, tokens long, __row long"), targets)
    assert all(r.used == 0 and r.short for r in report.collect())
    mix, report = mixing.mixture(spark.createDataFrame(rows, "doc_id long, source string, tokens long, __row long"), targets.limit(0))
    assert mix.count() == report.count() == 0


def test_p7_found_is_of_the_dealt_mixture(spark, monkeypatch):
    sized = spark.createDataFrame([(i, "a", 10, i) for i in range(50)] + [(99, "b", 10, 99)], "doc_id long, source string, tokens long, __row long")
    targets = spark.createDataFrame([("a", 0.5, 2, 400), ("b", 0.5, 2, 400)], "source string, weight double, max_repeats int, budget_tokens long")
    dealt, counts = [], mixing.cut_poisson
    monkeypatch.setattr(mixing, "sized_by_source", lambda *_: sized)
    monkeypatch.setattr(storage, "table", lambda *_: targets)
    monkeypatch.setattr(mixing, "cut_poisson", lambda *x: dealt.append(1) or counts(*x))
    assert [r.source for r in mixing.p7_found(spark, "").collect()] == ["b"] and dealt


# p8
def test_subjects_spread_to_unlabelled_texts(spark):
    law, sport = ["the barrister filed the statute", "a judge read the statute aloud", "the barrister met a judge"], ["the striker scored a goal", "a goal by the keeper", "the keeper saw the striker"]
    docs = [(i, ". ".join([law, sport][i % 2] * 2)) for i in range(40)] + [(100, law[0] + ". " + sport[0]), (101, "nothing to see"), (102, None), (103, ""), (104, "the judge " * 5000)]
    labels = [(i, ["law", "sport"][i % 2], x) for i in range(12) for x in ("a", "b")] + [(0, "law", "a"), (2, "sport", "c"), (101, None, "a"), (None, "law", "a"), (3, "unknown", "z")]
    out = subjects.assign_subjects(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([("law",), ("sport",)], "subject string"), spark.createDataFrame(labels, "doc_id long, subject string, labeller string"))
    got = {}
    for r in out.collect():
        got.setdefault(r.doc_id, set()).add(r.subject)
    assert all(got[i] == {["law", "sport"][i % 2]} for i in range(40)) and got[100] == {"law", "sport"} and got[104] == {"law"}
    assert not {101, 102, 103} & set(got)


def test_subjects_of_nothing(spark):
    docs = spark.createDataFrame([(1, "the judge", "x", 5, 0), (None, "the judge", "y", 5, 0)], "doc_id long, text string, subject string, rid int, given int")
    areas = spark.createDataFrame([("law",), (None,), ("law",)], "subject string")
    labels = spark.createDataFrame([(1, "law", "a")], "doc_id long, subject string, labeller string")
    for d, a, x in ((docs.limit(0), areas, labels), (docs, areas.limit(0), labels), (docs, areas, labels.limit(0))):
        assert subjects.assign_subjects(d, a, x).count() == 0
    # Labels that are trusted hold even without words; clashing columns do not matter.
    both = labels.unionByName(spark.createDataFrame([(1, "law", "b")], labels.schema))
    assert {(r.doc_id, r.subject) for r in subjects.assign_subjects(docs.withColumn("text", F.lit(None).cast("string")), areas, both).collect()} == {(1, "law")}


def test_clashing_and_extra_columns(spark):
    sized = spark.createDataFrame([(i, 30, "x", 1, 2, "s", i) for i in range(9)], "doc_id long, tokens long, container string, rest int, whole int, source string, __row long")
    assert packing.pack(sized, spark.createDataFrame([("c", 100, 7)], "container string, capacity_tokens int, tokens int")).count() == 9
    targets = spark.createDataFrame([("s", 1.0, 1, 100, 3.0, "u")], "source string, weight double, max_repeats int, budget_tokens long, copies double, available string")
    assert [r.used for r in mixing.mixture(sized.withColumnRenamed("whole", "copies"), targets)[1].collect()] == [90]
    items = spark.createDataFrame([(f"i{k}", "a", 9, k) for k in range(20)], "item_id string, source_type string, i int, pattern int")
    goal = spark.createDataFrame([("a", 1_000_000, 0, 5, 1)], "source_type string, target_ppm int, min_count int, sample_size int, sampled int")
    assert [r.sampled for r in proportions.sample(items, goal, ["source_type"])[1].collect()] == [5]


def test_least_squares_places_most_pieces():
    rng = np.random.default_rng(1)
    have = Counter(int(x) for x in np.minimum(4000, 20 + rng.pareto(1.1, 20_000) * 60))
    for cap in (512, 4096):
        lengths, placed = Counter(), []
        for n, c in have.items():
            lengths[n if n <= cap else n % cap or cap] += c
        runs = packing.plan(lengths, cap, placed)
        load, taken = Counter(), Counter()
        for n, at, many, first in runs:
            assert at == taken[n]
            taken[n] += many
            for k in range(many):
                load[first + k] += n
        assert taken == lengths and max(load.values()) <= cap and sum(load.values()) > 0.99 * cap * len(load)
        assert sum(placed) > 0.5 * sum(lengths.values())
