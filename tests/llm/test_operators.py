"""Operators of trend_engine.llm against brute force, on small frames with awkward rows."""

import gc
import hashlib
import os
import re
import sys
import weakref
import zlib
from collections import Counter

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from pyspark.sql import functions as F  # noqa: E402

from trend_engine.llm import fingerprint, licence, lm_score, mixing, near_dedup, packing, topk, toxicity  # noqa: E402
from trend_engine.llm import line_dedup as line_dedup_  # noqa: E402
from trend_engine.llm.line_dedup import line_dedup  # noqa: E402
from trend_engine.llm.near_dedup import M, SEEN, estimate, near_duplicates, registers  # noqa: E402
from trend_engine.llm.queries import with_package  # noqa: E402
from trend_engine.session import build_session  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _size int"
WORDS = [f"w{i}" for i in range(60)]


@pytest.fixture(scope="module")
def spark():
    s = build_session("local[4]", shuffle_partitions=4, app_name="llm-tests")
    with_package(s)
    return s


def frame(spark, texts, source="a"):
    rows = [(i, t, "en", source if isinstance(source, str) else source[i], None, 1) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def test_near_duplicates_against_all_pairs(spark):
    rng = np.random.default_rng(3)
    base = [" ".join(rng.choice(WORDS, 60)) for _ in range(6)]
    texts = [None, "", " \t", "one two", "one two", *base]
    for b in base:
        for _ in range(4):
            words = b.split()
            words[rng.integers(len(words))] = "x"
            texts.append(" ".join(words))
    docs = frame(spark, texts)
    got = {r.doc_id: r for r in near_duplicates(docs).collect()}
    # Tiles of three members make many tiles and find the same.
    with pytest.MonkeyPatch.context() as m:
        m.setattr(near_dedup, "TILE", 3)
        assert {r.doc_id: r for r in near_duplicates(docs).collect()} == got
    sets = []
    for t in texts:
        w = (t or "").lower().split()
        sets.append({tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    top = list(range(len(texts)))
    for _ in texts:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if a and b and 100 * len(a & b) >= 80 * len(a | b):
                    top[i] = top[j] = min(top[i], top[j])
    assert [got[i].component_id for i in range(len(texts))] == top
    assert [got[i].n_shingles for i in range(len(texts))] == [len(s) for s in sets]


def test_estimate_is_near_the_true_similarity_and_sketches_merge():
    rng = np.random.default_rng(5)
    for both, own in ((400, 50), (300, 200), (0, 300), (200, 0)):
        v = rng.integers(0, 2**63, both + 2 * own, dtype=np.uint64) * np.uint64(2)
        x, y = v[: both + own], np.concatenate([v[:both], v[both + own :]])
        a, b, n = registers(x), registers(y), np.array([float(both + own)])
        assert a.shape == (M,)
        j = both / (both + 2 * own)
        assert abs(estimate(a[None, :SEEN], b[None, :SEEN], n, n)[0] - j) < 0.02 + 5 * (j * (1 - j) / SEEN) ** 0.5
        assert (registers(np.concatenate([x, y])) == np.maximum(a, b)).all()


def test_network_step_against_word_by_word():
    rng = np.random.default_rng(6)
    net = lm_score.start([3, 2, 1], 5)
    net = {k: v + rng.normal(0, 0.3, v.shape).astype(np.float32) for k, v in net.items()}
    texts = [[], [5], *(rng.integers(0, lm_score.SIZE, n).tolist() for n in (2, 40, 7))]

    def loss(net):
        out = []
        for t in texts:
            padded = [lm_score._PAD] * 2 + t + [lm_score._PAD] * 2
            for i, c in enumerate(t):
                around = [padded[i + 2 + d] for d in (-2, -1, 1, 2)]
                h = np.tanh(sum(net["embedding"][a].astype(float) * net["gate"][k] for k, a in enumerate(around)))
                x = h @ net["high"] + net["high_bias"]
                y = h @ net["low"] + net["low_bias"][c // lm_score.BASE]
                out.append(x[c // lm_score.BASE] - np.log(np.exp(x).sum()) + y[c % lm_score.BASE] - np.log(np.exp(y).sum()))
        return np.array(out)

    want, (line, at) = loss(net), lm_score.windows(texts)
    got = np.concatenate([lm_score.log_probabilities(net, *s) for s in lm_score.steps(line, at, 9)])
    assert np.allclose(got, want, atol=1e-4)
    # After one step from no history, the sums of squares are those of the gradient.
    new, past = {k: v.copy() for k, v in net.items()}, {k: np.zeros_like(v) for k, v in net.items()}
    lm_score.train(new, past, line, at)
    used = [t[0] for t in texts if t]
    for name, cell in (("high", (3, 4)), ("low", (0, 9)), ("gate", (1, 5)), ("gate", (3, 2)), ("embedding", (used[0], 1)),
                       ("embedding", (texts[3][5], 7)), ("embedding", (lm_score._PAD, 3)), ("low_bias", (texts[3][0] // 32, 6))):
        up, down = ({k: v.astype(float) for k, v in net.items()} for _ in range(2))
        up[name][cell] += 1e-4
        down[name][cell] -= 1e-4
        slope = (loss(up).mean() - loss(down).mean()) / 2e-4
        assert np.isclose(past[name][cell] ** 0.5, abs(slope), rtol=2e-2, atol=2e-5), (name, cell)


def test_near_duplicates_names_large_buckets(spark):
    # Eight buckets of 100,000 nodes, and two more with the nodes of the first one.
    rows = spark.range(1_000_000).select(F.when(F.col("id") < 800_000, F.col("id")).otherwise(F.col("id") % 100_000).alias("node"),
                                         F.floor(F.col("id") / 100_000).alias("key"))
    got = near_dedup._buckets(rows).groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("size").alias("size")).collect()
    assert sorted(map(tuple, got)) == [(k, 100_000, 100_000) for k in range(8)]


def test_line_dedup_keeps_the_first_of_each_group(spark):
    line = " ".join(WORDS[:40])
    near = line.replace("w7 ", "w8 ")
    texts = [line + "\nshort", "own line of five words here\n" + line.upper(), None, "", near, "short"]
    out = {r.doc_id: (r.text, r["_removed"]) for r in line_dedup(frame(spark, texts).drop("_size")).collect()}
    assert out[0] == (texts[0], 0) and out[1] == ("own line of five words here", 1)
    assert out[2] == (None, 0) and out[3] == ("", 0) and out[5] == ("short", 0)


def test_line_dedup_finds_one_changed_letter(spark):
    # Lines of 5 to 60 words, each followed by a copy with one letter changed, and the fuzzy row above.
    rng = np.random.default_rng(7)
    texts = []
    for n in [5, 6, 8, 10, 12, 14, 20, 30, 60] * 4:
        line = " ".join("".join(rng.choice(list("abcdefghij"), 6)) for _ in range(n))
        at = 7 * int(rng.integers(n)) + int(rng.integers(6))
        texts += [line, line[:at] + "z" + line[at + 1:]]
    line = " ".join(WORDS[:40])
    texts += [line, line.replace("w7 ", "w8 ")]
    out = {r.doc_id: r["_removed"] for r in line_dedup(frame(spark, texts).drop("_size")).collect()}
    assert [out[i] for i in range(len(texts))] == [0, 1] * (len(texts) // 2)


def test_line_codes_at_any_length(spark):
    # One word put in front shifts all others; the lines are just below and above 32,767 words.
    words = [f"{chr(97 + k % 26)}{k % 977}" for k in range(32_767)]
    rows = spark.createDataFrame([(0, words), (1, ["z", *words]), (2, words * 3), (3, ["z", *words * 3])], "i int, _words array<string>")
    codes = {r.i: r.code % 2**64 for r in line_dedup_.coded(rows).collect()}
    assert (codes[0] ^ codes[1]).bit_count() <= 3 and codes[0] == codes[2] and (codes[2] ^ codes[3]).bit_count() <= 3


def test_line_keys_move_packed_and_none_is_lost(spark):
    rng = np.random.default_rng(8)
    rows = [(int(n), int(k)) for n, k in {(n, k) for n, k in zip(rng.integers(0, 900, 4000), rng.integers(-2**63, 2**63, 4000))}]
    rows += [(901, rows[0][1]), (902, rows[0][1]), (903, rows[1][1]), (901, rows[2][1] | 1), (902, rows[2][1] | 1), (7, 2**63 - 1), (8, 2**63 - 1), (7, -2), (8, -2)]
    shared = line_dedup_.shared_keys(spark.createDataFrame(rows, "number long, key long"), 10)
    got = {}
    for r in shared.collect():
        got.setdefault((r.range, r.key, r.band), []).append(r.number)
    want = {}
    for n, k in set(rows):
        want.setdefault(k, []).append(n)
    assert sorted((b, sorted(v)) for (_, _, b), v in got.items()) == sorted((k % 2 == 1, sorted(v)) for k, v in want.items() if len(v) > 1)
    # Before the keys move, those of a range are one row.
    plan = shared._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_collect_list" in plan[plan.index("Exchange"):]


def test_line_dedup_finds_letters_changed_all_over_short_lines(spark):
    # Lines of 6 to 9 words, each followed by a copy with one letter to a tenth of them changed.
    rng = np.random.default_rng(9)
    texts = []
    for n in [6, 7, 8, 9] * 75:
        line = " ".join("".join(rng.choice(list("abcdefghij"), int(rng.integers(4, 9)))) for _ in range(n))
        at = rng.choice([i for i, c in enumerate(line) if c != " "], int(rng.integers(1, len(line) // 10 + 1)), replace=False)
        texts += [line, "".join("z" if i in at else c for i, c in enumerate(line))]
    out = {r.doc_id: r["_removed"] for r in line_dedup(frame(spark, texts).drop("_size")).collect()}
    assert sum(out[i] for i in range(0, len(texts), 2)) == 0
    assert sum(out[i] for i in range(1, len(texts), 2)) >= 0.85 * len(texts) / 2


def test_line_dedup_with_rows_that_come_twice(spark):
    # Lines of 10 words; the documents of every other copy with a changed word come three times.
    rng = np.random.default_rng(10)
    texts = []
    for _ in range(12):
        words = ["".join(rng.choice(list("abcdefghij"), 6)) for _ in range(10)]
        texts += [" ".join(words), " ".join([*words[:-1], words[-1][:3] + "xyz"])]
    docs = frame(spark, texts).drop("_size")
    docs = docs.unionByName(docs.where("doc_id % 4 = 1")).unionByName(docs.where("doc_id % 4 = 1"))
    out = [(r.doc_id, r["_removed"]) for r in line_dedup(docs).collect()]
    assert sorted(out) == sorted((i, i % 2) for i in range(24) for _ in range(3 if i % 4 == 1 else 1))


def test_line_hashes_are_the_same_in_small_counters(spark):
    rng = np.random.default_rng(11)
    lines = [[f"{chr(97 + k % 26)}{k}" for k in rng.integers(0, 900, n)] for n in (1, 5, 13, 64, 510, 511)]
    rows = spark.createDataFrame(list(enumerate(lines)), "i int, _words array<string>")
    small = {r.i: r.code for r in line_dedup_.briefly_coded(rows).collect()}
    assert small == {r.i: r.code for r in line_dedup_.coded(rows, 0).collect()} and len(small) == len(lines)


def test_long_lines_have_few_keys_and_share_one_with_their_copies(spark):
    # Lines of 17 to 400 words; the copies have a word more in front, a word less at the end, or a letter in fifty changed.
    rng = np.random.default_rng(12)
    rows = []
    for i in range(60):
        line = ["".join(rng.choice(list("abcdefghij"), int(rng.integers(2, 9)))) for _ in range(int(rng.choice([17, 30, 90, 400])))]
        letters = ["".join("z" if rng.random() < 0.02 else c for c in w) for w in line]
        rows += [(4 * i + k, len(w), w) for k, w in enumerate((line, ["new", *line], line[:-1], letters))]
    lines = spark.createDataFrame(rows, "number long, words int, _words array<string>")
    keys = {}
    for r in line_dedup_.shingle_keys(lines).collect():
        keys.setdefault(r.number, set()).add(r.key)
    assert all(keys[4 * i] & keys[4 * i + k] for i in range(60) for k in (1, 2, 3))
    assert sum(map(len, keys.values())) / len(rows) < 30


def test_edit_similarity_against_brute_force(spark):
    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, last = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
        return row[-1]

    rng = np.random.default_rng(13)
    names, rows = ["ab", "a", "abc", "ba", "cab", "é"], []
    for i in range(600):
        one = [str(w) for w in rng.choice(names, int(rng.integers(1, 12)))]
        other = list(one)
        for _ in range(int(rng.integers(0, 4))):
            at, what = int(rng.integers(len(other) + 1)), int(rng.integers(3))
            other[at:at + (what < 2)] = [str(rng.choice(names))] if what else []
        rows.append((i, " ".join(one), " ".join(other)))
    rows = [r for r in rows if r[2]]
    pairs = spark.createDataFrame(rows, "i int, x string, y string")
    for similarity in (0.9, 0.7):
        want = {i for i, x, y in rows if distance(x, y) <= int((1 - similarity) * max(len(x), len(y)) + 1e-9)}
        assert {r.i for r in line_dedup_.edit_similar(pairs, "x", "y", similarity).collect()} == want and want


def test_mixing_reaches_targets(spark):
    texts = ["a b c"] * 40 + ["x y"] * 40 + [None, ""] + ["q " * 9] * 40
    source = ["a"] * 40 + ["b"] * 40 + ["b", None] + ["c"] * 40
    rows = mixing.taken(frame(spark, texts, source)).collect()
    sizes = [len((t or "").split()) for t in texts]
    assert len(rows) == len(texts) and sorted(r.size for r in rows) == sorted(sizes)
    assert all(0 <= r.taken <= 2 * r.size for r in rows)
    per = {}
    for r in rows:
        s = source[r.doc_id]
        per.setdefault(s, [r.target, 0, max(sizes)])[1] += r.taken
    assert abs(sum(t for t, _, _ in per.values()) - 1.5 * sum(sizes)) < 1e-6
    assert all(abs(t - got) <= 9 for t, got, _ in per.values())
    assert mixing.taken(frame(spark, [])).count() == 0


CLASH = ["_source", "_hash", "_copy", "_row", "_blocks", "_text", "_id", "_h", "lines", "_removed", "a.b"]


def clashing(spark, texts):
    docs = frame(spark, texts)
    return docs.select(*docs.columns, *[F.concat(F.lit(f"{c}-"), F.col("doc_id")).alias(c) for c in CLASH])


def test_clashing_names_pass_through(spark):
    line = " ".join(WORDS[:30])
    docs = clashing(spark, [line, f"own words of the second one\n{line}", None])
    out = {r.doc_id: r.asDict() for r in line_dedup(docs).collect()}
    assert out[0]["text"] == line and out[1]["text"] == "own words of the second one" and out[2]["text"] is None
    assert all(r[c] == f"{c}-{d}" for d, r in out.items() for c in CLASH)
    mixed = mixing.mix(clashing(spark, ["a b c"] * 10))
    assert mixed.columns == [*docs.columns, "_shard", "_position"]
    rows = mixed.collect()
    assert len(rows) == 15 and all(r[c] == f"{c}-{r.doc_id}" for r in rows for c in CLASH)


def test_mixing_meets_blocks_on_equal_keys(spark):
    docs = frame(spark, ["a b c"] * 40 + ["x y"] * 40, ["a"] * 40 + [None] * 40)
    for df in (mixing.mix(docs, block_docs=8), mixing.taken(docs, block_docs=8)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        joins = [x for x in plan.splitlines() if "Join" in x]
        assert any("_at" in x and "_block" in x for x in joins), joins


def test_mixing_takes_as_many_copies_as_asked(spark):
    rows = mixing.taken(frame(spark, [f"w{i} a b" for i in range(30)]), share=3.0, most=3).collect()
    assert sum(r.taken for r in rows) == 3 * sum(r["size"] for r in rows) and {r.taken for r in rows} == {9}


def test_hypergeometric_has_the_right_mean(spark):
    u = (F.col("id") + 0.5) / 2000
    mean = spark.range(2000).select(F.avg(mixing.hypergeometric(F.lit(30), F.lit(70), F.lit(20), u))).first()[0]
    assert abs(mean - 6.0) < 0.05


def test_hypergeometric_stands_in_a_plan_of_bounded_size(spark):
    # Each intermediate value stands there once; the plans of the splitting tree had filled the driver's memory.
    u = (F.col("id") + 0.5) / 2000
    df = spark.range(2000).select(mixing.hypergeometric(F.col("id"), F.col("id") + 1, F.col("id") + 2, u).alias("n"))
    assert len(df._jdf.queryExecution().optimizedPlan().toString()) < 20_000


def test_packing_round_trip():
    lengths = np.random.default_rng(0).integers(1, 3000, 500)
    doc, start, size, seq, offset = packing.assign(lengths)
    assert np.bincount(doc, size).astype(int).tolist() == lengths.tolist()
    for s in range(seq.max() + 1):
        at = seq == s
        order = np.argsort(offset[at])
        n = size[at][order]
        assert (offset[at][order] == np.cumsum(n) - n).all() and n.sum() <= 1024 and n.sum() & (n.sum() - 1) == 0
    for d in range(len(lengths)):
        at = doc == d
        order = np.argsort(start[at])
        n = size[at][order]
        assert (start[at][order] == np.cumsum(n) - n).all()


def test_a_process_holds_one_operators_table():
    words = packing._words_of(packing.tokenizer_path())
    assert packing._words_of(packing.tokenizer_path()) is words
    gone = weakref.ref(words)
    del words
    assert toxicity._matcher(("ab",)) is toxicity._matcher(("ab",))
    gc.collect()
    assert gone() is None


def test_word_table_gives_the_tokenizers_ids():
    words = packing.Words(packing.tokenizer_path())
    texts = ["", " a", "a  b   c\n\n d\t x", "x\n y \n\nz ", "it's 'sx a 's", "<|endoftext|>", "é ü b\x1cb", "a\0b c", "the cat.\nThe end!!"]
    assert words.ids(texts) == words.encode(texts)
    texts = ["\nabc", "abc\n", "\n", "a\n\nb", "\n\n", " ", "  ", "a ", "\n a", "a \n b", "日本 語。\n次", "x\ry z\tw", "I'll go. (Now) 12,5 a-b\u00a0c"]
    assert words.ids(texts) == words.encode(texts)
    assert words.ids([None, "a b", None]) == [b"", *words.encode(["a b"]), b""]


def test_pack_gives_the_tokenizers_ids(spark):
    rng = np.random.default_rng(4)
    names = ["alpha", "Beta,", "gamma.", "d", "épsilon", "(zeta)", "12", "it's"]
    rows = [(i, " ".join(rng.choice(names, int(rng.integers(1, 900)))), "en") for i in range(40)]
    rows += [(None, "no id here", "en"), (3, rows[3][1], "en"), (50, None, "en"), (51, "", "en"), (52, "long text\n" * 20_000, "en"), (53, "a  b\n\n c", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string").repartition(3)
    pieces = packing.pack(docs).collect()
    model = packing.Words(packing.tokenizer_path())
    want = sorted(i + bytes(4) for i in model.encode([t or "" for _, t, _ in rows]))
    # pieces of a sequence lie side by side; those of a document join to its ids
    whole, at = [], {}
    for p in sorted(pieces, key=lambda p: (p.doc_id is None, p.doc_id or 0, p.doc_tokens, p.start)):
        assert len(p.ids) == 4 * p.length and p.start + p.length <= p.doc_tokens
        at.setdefault(p.sequence_id, []).append((p.offset, p.length))
        whole.append(p)
    for parts in at.values():
        ends = np.cumsum([n for _, n in sorted(parts)])
        assert [o for o, _ in sorted(parts)] == [0, *ends[:-1].tolist()]
        assert ends[-1] <= 1024 and int(ends[-1]) & int(ends[-1] - 1) == 0
    by_id = {}
    for p in whole:
        by_id.setdefault((p.doc_id, p.start), []).append(bytes(p.ids))
    assert sum(map(len, want)) == sum(len(p.ids) for p in whole)
    for d, t, _ in rows:
        ids, start = model.encode([t or ""])[0] + bytes(4), 0
        while start < len(ids) // 4:
            piece = next(x for x in by_id[(d, start)] if ids[4 * start : 4 * start + len(x)] == x)
            by_id[(d, start)].remove(piece)
            start += len(piece) // 4
    assert not any(by_id.values())
    assert packing.pack(docs.limit(0)).collect() == []


def test_fingerprints(spark):
    texts = ["a b c\nd e f", "d e f\na b c", "", None, "z y x w", "a b c\nd e f"]
    rows = {r.doc_id: r for r in fingerprint.with_edits(frame(spark, texts)).collect()}
    full = [t or "" for t in texts]
    for i, t in enumerate(full):
        after = full[i - 1]
        edited = t[: len(t) - len(t) // 3] + after[: len(t) // 3]
        assert rows[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
    assert rows[0].fingerprint == rows[1].fingerprint == rows[5].fingerprint and rows[2].fingerprint == rows[3].fingerprint
    assert rows[0].fingerprint != rows[4].fingerprint
    one = fingerprint.vectors(["a b"])
    both = fingerprint.insert(one[0][0], one[1][0], ["c d"])
    whole = fingerprint.vectors(["a b\nc d"])
    assert (both[0] == whole[0][0]).all() and (both[1] == whole[1][0]).all()
    back = fingerprint.insert(*both, ["c d"], times=-1)
    assert (back[0] == one[0][0]).all() and (back[1] == one[1][0]).all()


def test_top_k_is_exact(spark):
    rng = np.random.default_rng(1)
    x = np.floor(rng.normal(0, 20, (90, 8)))
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, vector array<double>")
    got = {}
    for r in topk.top_k(rows, F.col("vec_id") % 10 == 0, k=5, block=32, query_block=4).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    for q in range(0, 90, 10):
        score = x @ x[q]
        order = [i for i in sorted(range(90), key=lambda i: (-score[i], i)) if i != q][:5]
        assert got[q] == [(i, int(score[i])) for i in order]


def test_toxicity_catches_misspelled_terms(spark):
    rng = np.random.default_rng(2)
    texts = [" ".join(rng.choice(WORDS, 30)) for _ in range(300)]
    toxic = [i % 6 == 0 for i in range(300)]
    texts = [f"{t} horribleword {' '.join(rng.choice(WORDS, 3))} horribleword" if bad else t for t, bad in zip(texts, toxic)]
    labels = spark.createDataFrame([(i, 1, int(b)) for i, b in enumerate(toxic)], "doc_id long, quality int, toxic int")
    rows = {r.doc_id: r for r in toxicity.toxicity(frame(spark, [*texts, None, ""]), labels).collect()}
    assert all(rows[i].predicted == toxic[i] for i in range(300))
    assert all(rows[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i in rows)
    assert rows[300].predicted == 0 and rows[301].predicted == 0
    assert toxicity.Matcher(["horribleword"]).find("horibleword") == (2, "horribleword")
    assert toxicity.Matcher(["lowei*"]).find("loweischaft") == (1, "lowei*")


def test_licence_and_scores(spark):
    texts = ["x y z\nReleased under the MIT License.", None, "", "Licensed under CC BY-NC 4.0."]
    rows = {r.doc_id: r for r in licence.scan(frame(spark, texts)).collect()}
    assert rows[0].licence == "MIT" and rows[0].line == 1 and rows[1].licence is None and rows[2].licence is None
    assert rows[3].licence == "CC-BY-NC-4.0"
    docs = frame(spark, [*texts, "a b a b a b " * 200])
    scored = {r.doc_id: r for r in lm_score.scores(docs, *lm_score.fit(docs)).collect()}
    assert scored[1].n_words == 0 and scored[1].mean_log_probability is None
    assert scored[4].mean_log_probability > scored[0].mean_log_probability


def test_scores_tell_words_of_one_code_apart(spark):
    # 768 frequent words take the codes of their own; of two others in one bucket one is ten times as frequent.
    first: dict[int, str] = {}
    for i in range(1000):
        bucket = zlib.crc32(f"r{i}".encode()) % 256
        if bucket in first:
            break
        first[bucket] = f"r{i}"
    common, rare = first[bucket], f"r{i}"
    docs = frame(spark, [" ".join(f"k{j}" for j in range(768))] * 20 + [common] * 10 + [rare, f"k1 {common} k2 {rare} {rare}"])
    words, net, counts = lm_score.fit(docs)
    got = {r.doc_id: r for r in lm_score.scores(docs, words, net, counts).collect()}
    assert len(words) == 768 and counts.count() == 770 and got[29].n_words == 1
    # Counts 11 and 3: the network gives both the same, their shares of the code the rest.
    assert abs(got[29].log_probability - got[30].log_probability - np.log(11 / 3)) < 1e-3
    assert {got[i].log_probability for i in range(20, 30)} == {got[29].log_probability}


def test_whole_scores_against_plain_python(spark):
    rng = np.random.default_rng(3)
    texts = [None, "", " \t\n", "Alone", *(" ".join(f"v{int(x)}" for x in rng.zipf(1.3, n) % 3000) for n in rng.integers(1, 400, 60)),
             "ÉTÉ été\x1fété\u00a0b", "v1 V1\nv2 " * 70_000]
    texts += [texts[5], texts[5]]
    docs = frame(spark, texts)
    words, net, counts = lm_score.fit(docs)
    cut = [[w for w in re.split(r"[\x20\x09-\x0d\x1c-\x1f]+", (t or "").lower()) if w] for t in texts]
    n = Counter(w for t in cut for w in t)
    assert {r.w: r.n for r in counts.collect()} == n
    assert list(words) == sorted(n, key=lambda w: (-n[w], w.encode()))[: lm_score.SIZE * 3 // 4] and len(n) > len(words)
    code = {w: i for i, w in enumerate(words)} | {w: len(words) + zlib.crc32(w.encode()) % (lm_score.SIZE - len(words)) for w in n if w not in words}
    total = Counter()
    for w in set(n) - set(words):
        total[code[w]] += n[w]
    base, pad = lm_score.BASE, lm_score._PAD
    own = lm_score.scored_by_own(docs).collect()
    assert sorted(own) == sorted(lm_score.scores(docs, words, net, counts).collect())
    for r in own:
        t = cut[r.doc_id]
        assert r.n_words == len(t)
        if len(t) > 1000:
            continue
        line, want = [pad, pad, *(code[w] for w in t), pad, pad], 0.0
        for i, w in enumerate(t):
            h = np.tanh(sum(net["embedding"][line[i + 2 + d]].astype(float) * net["gate"][k] for k, d in enumerate((-2, -1, 1, 2))))
            x, y = h @ net["high"] + net["high_bias"], h @ net["low"] + net["low_bias"][code[w] // base]
            want += x[code[w] // base] - np.log(np.exp(x).sum()) + y[code[w] % base] - np.log(np.exp(y).sum())
            want += 0 if w in words else np.log(n[w] / total[code[w]])
        assert abs(r.log_probability - want) < 1e-3 + 1e-5 * abs(want), r


def test_scores_of_no_rows_and_of_other_words(spark):
    docs = frame(spark, ["a b a", "c"])
    assert lm_score.scored_by_own(docs.where("false")).collect() == []
    words, net, counts = lm_score.fit(docs)
    (got,) = lm_score.scores(frame(spark, ["new words"]), words, net, counts).collect()
    assert got.n_words == 2 and got.log_probability < 0


def test_the_network_grows_with_the_vocabulary():
    assert [lm_score.base_for(n) for n in (0, 1000, 1 << 20, (1 << 20) + 1, 10**9)] == [32, 32, 32, 33, 178]
    net = lm_score.start([3, 2, 1], 5, 40)
    assert net["embedding"].shape == (1601, lm_score.WIDTH) and np.isclose(np.exp(net["high_bias"]).sum(), 1)
    line, at = lm_score.windows([[1599, 3], [], [7]], 1600)
    got = lm_score.log_probabilities(net, line, at)
    assert got.shape == (3,) and (got < 0).all()


def test_word_numbers_travel_as_one_value_per_document(spark):
    rows = [[], [1, 255, 256, 2**31 - 1], [], [70_000], list(range(0, 2**24, 54_321)), []]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    values = lm_score.packed(np.array([x for r in rows for x in r]), offsets)
    assert [len(v) for v in values.to_pylist()] == [4 * len(r) for r in rows]
    for a, b in ((0, 6), (1, 4), (2, 3), (5, 6), (3, 3)):
        numbers, ends = lm_score.unpacked(values.slice(a, b - a))
        assert numbers.tolist() == [x for r in rows[a:b] for x in r] and ends.tolist() == (offsets[a : b + 1] - offsets[a]).tolist()
    segs = lm_score.segments(frame(spark, ["b a b", None, ""]))
    assert dict(segs.dtypes)["ids"] == "binary"
    words = {w: n for r in segs.where("words is not null").collect() for w, n in zip(r.words, r["counts"])}
    assert words == {"a": 1, "b": 2} and segs.where("ids is not null").count() == 3
