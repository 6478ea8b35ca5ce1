"""WARC archives against brute force and their own bytes; the pipeline's stages against plain versions."""

import glob
import gzip
import hashlib
import os
import re
import sys
from collections import Counter

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline  # noqa: E402
from trend_engine.llm import toxicity, warc  # noqa: E402
from trend_engine.llm.queries import with_package  # noqa: E402
from trend_engine.session import build_session, scratch_dir  # noqa: E402


@pytest.fixture(scope="module")
def spark():
    s = build_session("local[4]", shuffle_partitions=4, app_name="llm-tests")
    with_package(s)
    return s


LONG = "<p>same é\r\n\r\n</p>" * 80
PAGES = [(1, "http://a/1", "<html>one</html>"), (2, "http://a/2", None), (3, None, ""), (4, "http://a/\r\nX: y", "line\r\n\r\nend"),
         (5, "http://a/5", LONG), (6, "http://a/6", LONG), (9, "http://a/9", LONG), (9, "http://a/9", LONG), (None, "http://a/n", LONG),
         (None, "http://a/n", "short"), (10, "u", "x" * 999), (11, "u", "x" * 999), (12, "u", "x" * 1000), (13, "u", "x" * 1000),
         (14, "u", "é" * 500), (15, "u", "é" * 500), (16, "u", "é" * 499 + "a"), (17, "u", "é" * 499 + "a"), (18, "u", "日本 \U0001f600" * 9)]


def brute_records(pages):
    payloads = [(p, (h or "").encode()) for p, _, h in pages]
    times = Counter(b for _, b in payloads if len(b) >= 1000)
    last = {}
    for p, b in payloads:
        if times[b] > 1 and p is not None:
            last[b] = max(last.get(b, p), p)
    out, seen = [], set()
    for p, b in payloads:
        again = b in last and (p != last[b] or (p, b) in seen)
        seen.add((p, b))
        out.append((p, len(b), hashlib.sha1(b).hexdigest(), "revisit" if again else "response", last[b] if again else None))
    return sorted(out, key=repr)


def pages_frame(spark, pages=PAGES):
    return spark.createDataFrame([(*p, "?", 0) for p in pages], "page_id long, url string, html string, _digest string, _own int")


def written(spark, pages, **how):
    root = f"file://{scratch_dir(spark, 'warc-test')}"
    warc.write(pages, root, **how)
    return root


def test_archives_read_back(spark):
    root = written(spark, pages_frame(spark).repartition(3), roll_bytes=900, partition_bytes=2000)
    rows = warc.read(spark, root).collect()
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows]
    assert sorted(got, key=repr) == brute_records(PAGES)
    texts = Counter((r.page_id, r.payload) for r in rows if r.record_type == "response")
    assert all((p, t) in {(p, h or "") for p, _, h in PAGES} for p, t in texts)
    manifest = spark.read.parquet(f"{root}/manifest").collect()
    assert len(manifest) > 3 and sum(m.records for m in manifest) == len(PAGES)
    # roll by compressed size: a file ends with the record that reaches it
    for m in manifest:
        data = open(f"{root[7:]}/{m['name']}", "rb").read()
        assert len(data) == m.bytes
        assert gzip.decompress(data).count(b"WARC/1.1\r\n") == m.records


def test_headers_hold_no_line_ends_of_the_url(spark):
    root = written(spark, pages_frame(spark, [PAGES[3]]))
    data = gzip.decompress(open(glob.glob(f"{root[7:]}/*.warc.gz")[0], "rb").read())
    head = data.split(b"\r\n\r\n")[0].decode()
    assert "WARC-Target-URI: http://a/  X: y" in head.split("\r\n")
    assert not any(x.startswith("X: y") for x in head.split("\r\n"))


def test_a_rerun_gives_the_same_bytes(spark):
    def files(root):
        return {os.path.basename(f): open(f, "rb").read() for f in glob.glob(f"{root[7:]}/*.warc.gz")}

    a = files(written(spark, pages_frame(spark).repartition(5), roll_bytes=900, partition_bytes=2000))
    b = files(written(spark, pages_frame(spark, PAGES[::-1]).repartition(2), roll_bytes=900, partition_bytes=2000))
    assert a.keys() == b.keys() and a == b


def test_what_a_lost_attempt_left_is_not_read(spark):
    root = written(spark, pages_frame(spark), roll_bytes=900, partition_bytes=2000)
    before = sorted(map(tuple, warc.read(spark, root).collect()), key=repr)
    name = os.path.basename(glob.glob(f"{root[7:]}/*.warc.gz")[0])
    for stray in (f"temporary/{name}.99", "pages-000099-000000.warc.gz"):
        with open(f"{root[7:]}/{stray}", "wb") as f:
            f.write(b"half a record")
    assert sorted(map(tuple, warc.read(spark, root).collect()), key=repr) == before


def test_damage_is_noticed(spark):
    root = written(spark, pages_frame(spark, [(1, "u", "payload " * 50)]))
    path = glob.glob(f"{root[7:]}/*.warc.gz")[0]
    raw = gzip.decompress(open(path, "rb").read()).replace(b"payload", b"PAYLOAD", 1)
    with open(path, "wb") as f:
        f.write(gzip.compress(raw))
    with pytest.raises(Exception, match="digest"):
        warc.read(spark, root).collect()


def test_no_pages(spark):
    root = written(spark, pages_frame(spark, []))
    assert warc.read(spark, root).collect() == []


# ---- pipeline ------------------------------------------------------------------------------------

SF = "/root/testdata/sf0.001"


def test_pipeline_stages(spark):
    """Each stage on the rows its predecessor kept, against a plain version of its contract."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    columns = docs.columns
    frames = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        path = scratch_dir(spark, f"stage-{name}")
        docs.write.parquet(path)
        docs = spark.read.parquet(path)
        frames[name] = docs.collect()
        if name != "packing":
            assert docs.columns == columns
    # toxicity: exactly the documents that score below one half stay, as they were
    scores = toxicity.op9_toxicity(spark, SF).collect()
    assert {r.doc_id: r for r in frames["toxicity"]} == {r.doc_id: rows[r.doc_id] for r in scores if not r.predicted}
    # line dedup: lines only go; of equal long lines over all documents one stays
    norm = lambda x: " ".join(w for w in re.split(r"[\W_]+", x.lower()) if w)
    before = Counter(norm(x) for r in frames["toxicity"] for x in r.text.split("\n"))
    after = Counter(norm(x) for r in frames["line_dedup"] for x in r.text.split("\n"))
    assert not after - before - Counter({"": 10 ** 9})
    assert all(n == 1 for x, n in after.items() if len(x.split()) >= 5)
    assert all(len(x.split()) >= 5 for x in before - after)
    assert {r.doc_id for r in frames["line_dedup"]} == {r.doc_id for r in frames["toxicity"]}
    assert all(r.n_chars == len(r.text) for r in frames["line_dedup"])
    # near dedup: the smallest doc_id of each group of shingle sets at 0.8 or more
    sets = {}
    for r in frames["line_dedup"]:
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r.text))
        sets[r.doc_id] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} if w else set()
    top = {d: d for d in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                if sets[a] and sets[b] and top[a] != top[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    top[a] = top[b] = min(top[a], top[b])
                    changed = True
    assert {r.doc_id for r in frames["near_dedup"]} == {d for d, t in top.items() if d == t}
    # mixing: whole documents, none more than twice
    kept = {r.doc_id: r for r in frames["near_dedup"]}
    drawn = Counter(r.doc_id for r in frames["mixing"])
    assert max(drawn.values()) <= 2 and all(r == kept[r.doc_id] for r in frames["mixing"])
    # packing: the pieces hold all of it
    tokens = Counter()
    for p in frames["packing"]:
        tokens[p.doc_id] += p.length
        assert p.length * 4 == len(p.ids) and p.offset + p.length <= 1024
    whole = {p.doc_id: p.doc_tokens for p in frames["packing"]}
    assert all(tokens[d] == whole[d] * drawn[d] for d in drawn) and set(tokens) == set(drawn)
