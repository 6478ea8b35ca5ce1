"""Phrases, benchmark decontamination and whitening against brute force, on small awkward frames."""

import hashlib
import os
import re
import sys
from collections import Counter

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from trend_engine.llm import decontaminate, phrases, whitening  # noqa: E402
from trend_engine.llm.queries import with_package  # noqa: E402
from trend_engine.session import build_session  # noqa: E402

# Columns that the operators use as names of their own.
CLASH = "grp string, k int, data string, segment int, key string, x int, f int"


@pytest.fixture(scope="module")
def spark():
    s = build_session("local[4]", shuffle_partitions=4, app_name="llm-tests")
    with_package(s)
    return s


def documents(spark, rows):
    schema = f"doc_id long, text string, lang string, {CLASH}"
    return spark.createDataFrame([(*r, "?", 0, "?", 0, "?", 0, 0) for r in rows], schema)


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


# ---- phrases ------------------------------------------------------------------------------------

def brute_phrases(rows, least, top):
    counts, total = {}, Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lower(text)):
            w = re.findall("[^ \t]+", piece)
            total[lang] += len(w)
            for n in range(1, 6):
                for i in range(len(w) - n + 1):
                    c = counts.setdefault(lang, Counter())
                    c[tuple(w[i : i + n])] += 1
    out = []
    for lang, c in counts.items():
        often = {p: a for p, a in c.items() if a >= least and len(p) > 1}
        found = []
        for p, a in often.items():
            if any(len(q) > len(p) and b >= a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in often.items()):
                continue
            s, k = min((1000 * a * total[lang] // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
            found.append((-s, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        for r, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, r, p.decode(), -a, left, right, total[lang], -s))
    return sorted(out)


def text_rows():
    rng = np.random.default_rng(11)
    words = ["The", "of", "straße", "data", "x1", "Ünder", "a", "b", "\x00z", "日本"]
    rows = [(i, " ".join(rng.choice(words, 30, p=[.3, .2] + [.0625] * 8)) + rng.choice([". ", ",\t", "\n"]) + "hot pair of words here",
             rng.choice(["en", "de us"])) for i in range(60)]
    rows += [(7, "hot pair of words here", "en")] * 40 + [(None, None, None), (90, "", "en"), (91, " \t.;", None), (92, "one", None)]
    return rows + [(93, "long run " * 3000, None)]


@pytest.mark.parametrize("small", [False, True])
def test_phrases_against_brute_force(spark, monkeypatch, small):
    rows = text_rows()
    if small:
        # Many shards, ranges, transducers and batches give the same result.
        for name, value in {"SHARD": 400, "RANGE": 300, "PHRASES": 40, "BATCH": 16}.items():
            monkeypatch.setattr(phrases, name, value)
    df = documents(spark, rows).repartition(5)
    got = phrases.collocations(df, least=12, top=25)
    assert sorted(map(tuple, got.collect())) == brute_phrases(rows, 12, 25)


def test_phrases_of_an_empty_table(spark):
    assert phrases.collocations(documents(spark, [])).collect() == []
    assert phrases.collocations(documents(spark, [(1, "rare words only", "en")])).collect() == []


def test_transducers_add_up_and_compose():
    rng = np.random.default_rng(3)
    rows = [tuple(rng.integers(0, 5, rng.integers(1, 4))) for _ in range(300)]
    words = [bytes([97 + i]) for i in range(5)]

    def of(part):
        grid = np.array([[*r, *[phrases.END] * (4 - len(r))] for r in part])
        return phrases.build(words, list(grid.T))

    parts = [of(rows[:100]), of(rows[100:150]), of(rows[150:])]
    whole, want = phrases.union(parts), Counter(rows)
    assert [whole.path(i) for i in range(len(whole.parent[-1]))] == sorted(tuple(words[x] for x in r) for r in want)
    assert {whole.path(i): int(n) for i, n in enumerate(whole.weight[-1])} == {tuple(words[x] for x in r): n for r, n in want.items()}
    again = phrases.Transducer.unpack(whole.pack())
    assert again.words == whole.words and all((a == b).all() for a, b in zip(again.weight, whole.weight, strict=True))
    paths = [whole.path(i) for i in range(len(whole.parent[-1]))]
    for bound in [(b"",), (b"b",), (b"b", b"c"), (b"bb",), (b"c", b"a", b"e"), (b"z",)]:
        assert whole.find(bound) == sum(p < bound for p in paths), bound
    cut = whole.find((b"b", b"c"))
    left, right = whole.piece(0, cut), whole.piece(cut, len(paths))
    both = phrases.union([right, left])
    assert [both.path(i) for i in range(len(paths))] == paths and (both.weight[-1] == whole.weight[-1]).all()
    asked = [(0, 1), (4,), (3, 3, 3), (2, 2, 2), (1, 4)]
    ask = of(asked)
    assert phrases.compose(ask, whole).tolist() == [want[r] for r in sorted(asked)]


# ---- decontamination ------------------------------------------------------------------------------

def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def brute_hits(docs, items):
    out = []
    for doc_id, text, _ in docs:
        w, hit, found = words_of(text), set(), set()
        for item, t in items:
            q = words_of(t)
            n = min(len(q), 10)
            grams = {tuple(q[i : i + n]) for i in range(len(q) - n + 1)} if q else set()
            at = [i for i in range(len(w) - n + 1) if tuple(w[i : i + n]) in grams]
            hit.update(p for i in at for p in range(i, i + n))
            if at and item is not None:
                found.add(str(item))
        names = ",".join(sorted(found))
        out.append((doc_id, len(w), len(hit), len(found), hashlib.sha256(names.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def hit_rows():
    rng = np.random.default_rng(5)
    vocabulary = [f"w{i}" for i in range(40)] + ["the"] * 30
    items = [(i, " ".join(rng.choice(vocabulary, int(n)))) for i, n in enumerate([40, 12, 10, 9, 3, 25, 10])]
    items += [(100, "The the THE the the, the the the the the the"), (101, None), (102, " -- "), (None, "secret tail words"),
              (0, "second row of the same item zero with ten words here"), (103, " ".join(f"long{i}" for i in range(60)))]
    docs = []
    for i in range(60):
        body = [str(x) for x in rng.choice(vocabulary, int(rng.integers(0, 60)))]
        if i % 3 == 0:
            words = words_of(items[i % 7][1])
            a = int(rng.integers(0, max(1, len(words) - 9)))
            body[len(body) // 2 : len(body) // 2] = words[a : a + int(rng.integers(8, 20))]
        docs.append((i, rng.choice([" ", "-", "\n"]).join(body).upper() if i % 2 else " ".join(body), "en"))
    docs += [(60, "the " * 500, "en"), (60, "the " * 500, "en"), (None, items[0][1], "en"), (61, None, "en"), (62, "", "en"),
             (63, "half " + " ".join(words_of(items[0][1])[:5]), "en"), (64, " ".join(words_of(items[0][1])[5:]), "en"),
             (65, "x " * 30000 + "secret tail words " + " ".join(f"long{i}" for i in range(60)), "en")]
    return docs, items


@pytest.mark.parametrize("small", [False, True])
def test_contaminated_against_brute_force(spark, monkeypatch, small):
    docs, items = hit_rows()
    if small:
        for name, value in {"SEGMENT": 2000, "PART": 25, "PARTS": 3, "CANDIDATES": 50}.items():
            monkeypatch.setattr(decontaminate, name, value)
    monkeypatch.setattr(decontaminate.build_index, "__defaults__", ("text", "doc_id", decontaminate.SEGMENT))
    bench = spark.createDataFrame([(*r, "?") for r in items], "item_id long, text string, segment string")
    got = decontaminate.contaminated(documents(spark, docs).repartition(3), bench)
    assert sorted(map(tuple, got.collect()), key=repr) == brute_hits(docs, items)


def test_contaminated_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    docs, items = documents(spark, [(1, "some words", "en")]), spark.createDataFrame([(1, "some words")], "item_id long, text string")
    assert [tuple(r)[:4] for r in decontaminate.contaminated(docs, none).collect()] == [(1, 2, 0, 0)]
    assert decontaminate.contaminated(documents(spark, []), items).collect() == []


def test_phrase_matches_keep_their_places(spark):
    docs = [(1, "zero one two three four five", "en"), (2, "four five", "en")]
    items = spark.createDataFrame([("q", "Two, three FOUR")], "item_id string, text string")
    got = decontaminate.phrase_matches(decontaminate.build_index(documents(spark, docs)), items).collect()
    assert [(r.doc_id, r.item_id, r.start, r.length) for r in got] == [(1, "q", 2, 3)]


def test_proximity_matches_against_brute_force(spark):
    rng = np.random.default_rng(9)
    docs = [(i, " ".join(rng.choice([f"w{j}" for j in range(12)], 40)), "en") for i in range(30)]
    queries = [("a", "w1 w2 w3"), ("b", "w4 w4 w5"), ("c", "w6 nowhere"), ("d", "w7")]
    want = set()
    for doc, text, _ in docs:
        w = text.split()
        for q, t in queries:
            terms = set(t.split())
            n = sum(w[i] in terms and terms <= set(w[i : i + 6]) for i in range(len(w)))
            if n:
                want.add((doc, q, n))
    index = decontaminate.build_index(documents(spark, docs).coalesce(1))
    got = decontaminate.proximity_matches(index, spark.createDataFrame(queries, "item_id string, text string"), 6)
    assert {tuple(r) for r in got.collect()} == want


# ---- whitening --------------------------------------------------------------------------------------

def vectors(spark, rows):
    return spark.createDataFrame([(*r, 1, "?") for r in rows], "vec_id long, embedding array<float>, n int, component string")


def test_whitening_against_numpy(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(0, 0.3, (200, 6)) @ np.diag([3, 2, 1, 1, 0.5, 0.2])
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(base)]
    rows += [(i, rows[0][1]) for i in range(300, 360)] + [(None, rows[1][1])]
    bad = [(400, None), (401, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (402, [float("nan")] * 6), (403, [float("inf")] + [0.0] * 5), (404, []),
           (405, [3e38] + [0.0] * 5)]
    got = whitening.whiten(vectors(spark, rows + bad), most=5).toPandas()
    x = np.floor(64 * np.array([np.float32(v) for _, v in rows], float)).astype(int) + 1000000
    once = np.unique(x, axis=0)
    n, s = len(once), once.sum(0)
    c = (n * once - s) / n
    w, q = np.linalg.eigh(c.T @ c / n)
    w, q = w[::-1][:5], q[:, ::-1][:, :5]
    assert len(got) == 5 * len(rows) and set(got["n"]) == {n} and got["identity_error"].max() < 1e-9
    want = {tuple(v): ((n * v - s) / n @ q / np.sqrt(w), int(((n * v - s) ** 2).sum())) for v in x}
    for (i, _), v in list(zip(rows, x, strict=True))[:80]:
        mine = got[got["vec_id"] == i].sort_values("component")
        z, deviation = want[tuple(v)]
        assert np.allclose(np.abs(mine["whitened"]), np.abs(z), atol=1e-9) and set(mine["deviation"]) == {deviation}
        assert np.allclose(mine["explained"], w / np.trace(c.T @ c / n), rtol=1e-9)


def test_whitening_of_poor_ranks(spark):
    assert whitening.whiten(vectors(spark, [])).collect() == []
    assert whitening.whiten(vectors(spark, [(1, [0.5, 0.5])] * 3)).collect() == []
    # Two equal eigenvalues and one of zero.
    rows = [(0, [1.0, 0.0, 0.0]), (1, [-1.0, 0.0, 0.0]), (2, [0.0, 1.0, 0.0]), (3, [0.0, -1.0, 0.0])]
    got = whitening.whiten(vectors(spark, rows)).toPandas()
    assert sorted(set(got["component"])) == [1, 2] and got["identity_error"].max() < 1e-12
    with pytest.raises(ValueError, match="lengths"):
        whitening.whiten(vectors(spark, [(1, [1.0]), (2, [1.0, 2.0])]))


def test_whitening_of_huge_entries(spark):
    rows = [(i, [float(2.0 ** 50 * a), float(b)]) for i, (a, b) in enumerate([(1, 2), (-1, 5), (3, 1), (2, 2)])]
    got = whitening.whiten(vectors(spark, rows)).toPandas()
    assert got["deviation"].isna().all() and got["identity_error"].max() < 1e-4


def test_characteristic_polynomial_is_exact(spark):
    # Roots 1, 2 (twice), 5 and 0, in a rotated integer basis: 9 I-like blocks keep them whole.
    m = [[2, 0, 0, 0, 0], [0, 3, 2, 0, 0], [0, 2, 3, 0, 0], [0, 0, 0, 2, 0], [0, 0, 0, 0, 0]]
    poly = whitening.characteristic(spark, m)
    want = np.poly([1, 2, 2, 5, 0])[::-1].round().astype(int).tolist()
    assert poly == want
    found = [((a + b) / 2 / 2 ** s, n) for a, b, s, n in whitening.largest_roots(poly, 5)]
    assert [n for _, n in found] == [1, 2, 1] and np.allclose([r for r, _ in found], [5, 2, 1])
    assert [whitening.roots_beyond(poly, v, 0) for v in (0, 1, 2, 4, 5)] == [4, 3, 1, 1, 0]
