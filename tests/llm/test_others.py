import io
import random
import re

import numpy as np
import pytest
from helpers import empty_documents, odd_documents, sentence
from pyspark.sql import functions as F

from genoframe.llm import ann, quality, urls, warc

RULES = urls.RULES


# -- urls ---------------------------------------------------------------------------------------------------


def plain_judge(url):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in url or "")
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end])
        rest = rest[end:]
        path = rest[: min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])]
    best = None
    for verdict, rule in RULES:
        at, _, under = rule.partition("/")
        if (host == at or host.endswith("." + at)) and path.startswith("/" + under) and (best is None or len(rule) > len(best[1])):
            best = (verdict, rule)
    word = set("abcdefghijklmnopqrstuvwxyz0123456789")

    def has(t):
        at = low.find(t)
        while at >= 0:
            if (at == 0 or low[at - 1] not in word) and (at + len(t) == len(low) or low[at + len(t)] not in word):
                return True
            at = low.find(t, at + 1)
        return False

    strict, soft = sum(map(has, urls.STRICT_TERMS)), sum(map(has, urls.SOFT_TERMS))
    own = "block" if strict or soft >= urls.SOFT_LIMIT else "allow"
    return host, path, best and best[1], best[0] if best else own, strict, soft


def test_urls(spark):
    rng = random.Random(1)
    hosts = ["Example.com", "a.example.com", "xexample.com", "example.net", "b.example.net", "e.org", "net", "cheap-pills.info", "casino.io", "free.free.io", ""]
    paths = ["", "/", "/en/7", "/en/71", "/en", "/de/8", "/de/", "/es/1", "/free/win", "/FREE?bets#x", "?casino", "#a/b"]
    texts = [f"{rng.choice(['http', 'https', ''])}://{rng.choice(hosts)}{rng.choice(paths)}{rng.choice(['', '://x', '?a=win', 'spams', '-spam'])}" for _ in range(400)] + [None, "", "no scheme", "http:/x", "É://Ü.com/en/"]
    pages = spark.createDataFrame([(i, u, "allow", 1) for i, u in enumerate(texts)], "page_id long, url string, verdict string, low int")
    found = {r.page_id: tuple(r)[1:] for r in urls.judge(pages).collect()}
    assert found == {i: plain_judge(u) for i, u in enumerate(texts)}
    assert urls.judge(pages.limit(0)).count() == 0
    assert urls.judge(pages, rules=[], strict=[], soft=[]).where("verdict = 'block' or rule is not null").count() == 0


def test_terms_of_a_file(spark, tmp_path):
    (tmp_path / "terms").write_text("# terms\nCasino  strict\n\nbonus\tsoft\n x-y soft\n")
    assert urls.read_terms(spark, str(tmp_path / "terms")) == (["casino"], ["bonus", "x-y"])
    strict, soft = urls.read_terms(spark, str(tmp_path / "terms"))
    pages = spark.createDataFrame([(1, "http://x.io/x-y/bonus"), (2, "http://x.io/x-y"), (3, "http://CASINO.io")], "page_id long, url string")
    assert {r.page_id: r.verdict for r in urls.judge(pages, strict=strict, soft=soft).collect()} == {1: "block", 2: "allow", 3: "block"}
    with pytest.raises(ValueError):
        urls.read_terms(spark, str(tmp_path / "terms"), most=2)
    (tmp_path / "bad").write_text("casino maybe\n")
    with pytest.raises(ValueError):
        urls.read_terms(spark, str(tmp_path / "bad"))
    many = [f"term{k}" for k in range(20_000)]
    found = urls.judge(spark.createDataFrame([(1, "http://x.io/term19999/a"), (2, "http://x.io/term20000")], "page_id long, url string"), strict=many, soft=[])
    assert {r.page_id: r.verdict for r in found.collect()} == {1: "block", 2: "allow"}


# -- warc ---------------------------------------------------------------------------------------------------


def archive(n=6, pack=warc.member):
    return [pack(warc.record(i, f"http://x/{i}", b"payload %d" % i * (i + 1))) for i in range(n)]


def ids(data):
    reader = warc.SalvageReader(io.BytesIO(data))
    return [warc.page_of(r.headers["warc-record-id"]) for r in reader], reader.gaps


@pytest.mark.parametrize("pack", [warc.member, bytes])
def test_salvage(pack):
    parts = archive(pack=pack)
    whole = b"".join(parts)
    assert ids(whole) == ([0, 1, 2, 3, 4, 5], [])
    starts = np.cumsum([0, *map(len, parts)]).tolist()
    # A byte of the third is turned.
    for at in (starts[2], starts[2] + len(parts[2]) // 2, starts[3] - 6):
        broken = bytearray(whole)
        broken[at] ^= 0x55
        found, gaps = ids(bytes(broken))
        assert found == [0, 1, 3, 4, 5]
        assert [(g.start, g.length) for g in gaps] == [(starts[2], len(parts[2]))] and gaps[0].reason
    # Bytes are put in, one record is cut off, and the end is missing.
    found, gaps = ids(parts[0] + b"\x1f\x8b\x08 garbage WARC/1.1 no" + parts[1] + parts[2][:-9] + parts[3] + parts[4][:20])
    assert found == [0, 1, 3] and len(gaps) == 3
    assert ids(b"") == ([], []) and ids(b"nothing at all")[0] == []


def records(n=50):
    rng = random.Random(5)
    return [warc.record(i, f"http://x/{i}", rng.randbytes(1500).hex().encode()) for i in range(n)]


def test_salvage_inside_a_member():
    parts = records()
    good, bad = b"".join(parts), bytearray(b"".join(parts))
    starts = np.cumsum([0, *map(len, parts)]).tolist()
    # One record's block is damaged before packing: its digest differs, the others are read.
    bad[starts[20] + len(parts[20]) - 50] ^= 1
    found, gaps = ids(warc.member(bytes(bad)) + warc.member(parts[7]))
    assert found == [*range(20), *range(21, 50), 7]
    assert [(g.start, g.length, g.inner_start, g.inner_bytes) for g in gaps] == [(0, len(warc.member(bytes(bad))), starts[20], len(parts[20]))]
    # A packed byte is damaged: what comes before is read, and the next member.
    whole = bytearray(warc.member(good))
    for back in (2000, 40_000, len(whole) - 5000):
        broken = bytearray(whole)
        broken[-back] ^= 0x55
        found, gaps = ids(bytes(broken) + warc.member(parts[7]))
        before = int(50 * (1 - back / len(whole))) - 1
        assert found[-1] == 7 and found[:before] == list(range(before)) and found[:-1] == sorted(set(found[:-1])) and len(found) < 51
        assert {(g.start, g.length) for g in gaps} == {(0, len(whole))} and all(g.inner_start in starts for g in gaps)
    # The checksum alone is damaged: the last record is not believed.
    whole[-6] ^= 1
    assert ids(bytes(whole))[0] == list(range(49))
    # Records without a digest count only in a sound member.
    plain = re.sub(rb"WARC-Block-Digest: [^\r]*\r\n", b"", good)
    assert ids(warc.member(plain))[0] == list(range(50))
    torn = bytearray(warc.member(plain))
    torn[-2000] ^= 0x55
    assert ids(bytes(torn))[0] == []


@pytest.mark.parametrize("pack", [warc.member, bytes])
def test_long_headers_and_bad_lengths(pack):
    parts = [warc.record(0, "http://x/0", b"a"), warc.record(1, "http://x/" + "y" * 300_000, b"b"), warc.record(2, "http://x/2", b"c")]
    assert ids(b"".join(map(pack, parts))) == ([0, 1, 2], [])
    parts[1] = re.sub(rb"\r\nContent-Length: \d+\r\n\r\nHTTP", b"\r\nContent-Length: 1999999999\r\n\r\nHTTP", parts[1])
    found, gaps = ids(b"".join(map(pack, parts)))
    assert found == [0, 2] and gaps[0].reason == "bad length"
    folded = parts[0].replace(b"WARC-Date:", b"X-Note: a\r\n  folded: line\r\nWARC-Date:")
    assert ids(pack(folded)) == ([0], [])


def test_small_member_of_a_large_record():
    import tracemalloc

    data = warc.member(warc.record(1, "http://x", b"z" * (1 << 20)) + warc.record(2, "http://x", b"z" * 200_000_000, "response").replace(b"Content-Length: 2000", b"Content-Length: 2100", 1) + warc.record(3, "http://x", b"end"))
    tracemalloc.start()
    found, gaps = ids(data)
    assert found[0] == 1 and found[-1] == 3 and len(gaps) == 1
    assert tracemalloc.get_traced_memory()[1] < 100 << 20
    tracemalloc.stop()


def test_revisit_and_headers():
    r = next(iter(warc.SalvageReader(io.BytesIO(warc.record(3, "http://x/\r\nWARC-Type: evil", b"abc", "revisit", 9)))))
    assert r.headers["warc-type"] == "revisit" and r.payload == b"" and warc.page_of(r.headers["warc-refers-to"]) == 9
    assert r.headers["warc-payload-digest"] == "sha1:" + warc.digest_of(b"abc")


def test_archives(spark):
    pages = [(i, f"http://x/{i % 5}", f"<p>{i % 7}</p>" * (1 + i % 3)) for i in range(60)] + [(60, None, None), (61, "u", ""), (62, "u", "é\r\n\r\nWARC/1.1\r\n"), (None, "u", "<p>1</p>"), (None, "u", "only here"), (5, "u", "<p>5</p>")]
    df = spark.createDataFrame([(*p, "x") for p in pages], "page_id long, url string, html string, kind string")
    rows = warc.archived(spark, df).where("gap_start is null").collect()
    last = {}
    for i, _, h in pages:
        last[h or ""] = max(last.get(h or "", -1), -1 if i is None else i)
    want = []
    for i, _, h in pages:
        data = (h or "").encode()
        top = None if last[h or ""] < 0 else last[h or ""]
        again = i != top
        want.append((str(i), len(data), warc.digest_of(data), "revisit" if again else "response", top if again else None))
    assert sorted(map(str, want)) == sorted(str((str(r.page_id), r.payload_bytes, r.payload_digest, r.kind, r.refers_to)) for r in rows)
    assert warc.archived(spark, df.limit(0)).count() == 0
    assert warc.archived(spark, df, min_bytes=10**6).where("kind = 'revisit'").count() == 0


def test_gaps_are_rows(spark, tmp_path):
    (tmp_path / "a.warc.gz").write_bytes(b"".join(archive()[:2]) + b"rubbish" + archive()[3])
    rows = warc.read(spark.createDataFrame([(str(tmp_path / "a.warc.gz"), f"file://{tmp_path}")], "path string, folder string")).collect()
    assert sorted(r.page_id for r in rows if r.gap_start is None) == [0, 1, 3]
    assert [(r.gap_bytes) for r in rows if r.gap_start is not None] == [7]
    assert rows[1].payload == b"payload 1" * 2


# -- neighbours ---------------------------------------------------------------------------------------------


def vectors(n, dim, seed):
    return np.random.default_rng(seed).normal(size=(n, dim)).astype(np.float32)


@pytest.mark.parametrize("scaled", [False, True])
def test_recall(spark, scaled):
    v = vectors(1500, 24, 1)
    if scaled:
        v *= np.random.default_rng(2).uniform(0.2, 3, (len(v), 1)).astype(np.float32)
    rows = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<float>")
    usable = ann.usable(rows, "vec_id", "embedding")
    found = ann.search(ann.index(usable, 500), usable.where("vec_id % 20 = 0"), 20, block_rows=20).collect()
    exact = ann.nearest_exactly(rows, F.col("vec_id") % 20 == 0).collect()
    pairs = lambda x: {(r.query_id, r.vec_id) for r in x}
    assert len(found) == len(exact) == 75 * 20 == len(pairs(found))
    assert len(pairs(found) & pairs(exact)) >= 0.9 * len(exact)
    d = v.astype(np.float64)
    for r in found:
        assert abs(r.score - d[r.query_id] @ d[r.vec_id]) < 1e-9 and r.query_id != r.vec_id
    for q in {r.query_id for r in found}:
        own = sorted((r for r in found if r.query_id == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in own] == list(range(1, 21))
        assert [(-r.score, r.vec_id) for r in own] == sorted((-r.score, r.vec_id) for r in own)


def test_recall_with_very_long_vectors(spark):
    v = vectors(1500, 24, 1).astype(np.float64)
    v /= np.linalg.norm(v, axis=1)[:, None]
    for i, norm in ((3, 300.0), (333, 1e4), (700, 1e4), (1101, 1e9), (1200, 1e140)):
        v[i] *= norm
    rows = [(i, x.tolist()) for i, x in enumerate(v)]
    rows += [(0, (v[0] * 1e6 + 1e7).tolist()), (333, (v[333] * 0 + 2e4).tolist())]  # not the least vectors of their ids
    rows = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    usable = ann.usable(rows, "vec_id", "embedding")
    found = ann.search(ann.index(usable, 500), usable.where("vec_id % 20 = 0"), 20).collect()
    own = {(r.query_id, r.vec_id) for r in found}
    assert len(found) == len(own) == 75 * 20
    exact = set()
    for q in range(0, 1500, 20):
        scores = v @ v[q]
        scores[q] = -np.inf
        exact |= {(q, int(i)) for i in np.argsort(-scores, kind="stable")[:20]}
    assert len(own & exact) >= 0.9 * len(exact)


def test_rows_of_shards():
    assert ann.rows_for(50_000, 64, 100, 8192, 1 << 26) == 8192
    assert ann.rows_for(10**9, 64, 100, 8192, 1 << 26) == (1 << 26) // 512
    assert ann.rows_for(4_000_000, 64, 100, 8192, 1 << 26) == 40_000
    assert ann.rows_for(0, 1 << 30, 0, 8192, 1 << 26) == 1


def test_odd_vectors(spark):
    copies = [(i, [1.0, 0.0]) for i in range(40)]
    bad = [(100, None), (101, []), (102, [0.0, 0.0]), (103, [1.0, None]), (104, [float("nan"), 1.0]), (105, [float("inf"), 1.0]), (None, [1.0, 1.0])]
    other = [(120, [0.5, 0.5, 0.5]), (140, [1.0, 1.0, 1.0]), (160, [2.0])]
    df = spark.createDataFrame([(*r, 7) for r in [*copies, *copies[:3], *bad, *other]], "vec_id long, embedding array<double>, score int")
    found = ann.nearest(df, F.col("vec_id") % 20 == 0).collect()
    of = lambda q: [r.vec_id for r in sorted(found, key=lambda r: r["rank"]) if r.query_id == q]
    assert of(0) == list(range(1, 21)) and of(20) == list(range(20)) and of(120) == [140] and of(160) == []
    assert {r.query_id for r in found} == {0, 20, 120, 140}
    assert ann.nearest(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


# -- quality ------------------------------------------------------------------------------------------------


def graded(spark, n=400):
    rng = random.Random(3)
    rows = []
    for i in range(n):
        good = i % 4 != 0
        text = sentence(rng, 60)
        rows.append((i, text if good else text.upper().replace(" ", "!! "), int(good)))
    return spark.createDataFrame(rows, "doc_id long, text string, quality int")


def test_quality_held_out(spark):
    import zlib

    rows = graded(spark)
    docs, labels = rows.select("doc_id", "text"), rows.select("doc_id", "quality")
    truth = {r.doc_id: r.quality for r in labels.collect()}
    found = quality.judge(docs, labels).collect()
    assert len(found) == 400
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [r for r in found if r.held_out]
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.95 * len(held)
    # Held-out labels teach nothing.
    turned = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = {r.doc_id: r.score for r in quality.judge(docs, turned).collect()}
    assert all(abs(again[r.doc_id] - r.score) < 1e-9 for r in found)


def test_quality_of_odd_rows(spark):
    docs, labels = odd_documents(spark), graded(spark, 100).select("doc_id", "quality")
    found = quality.judge(docs, labels).collect()
    assert len(found) == docs.count() and all(0 <= r.score <= 1 for r in found)
    kept = quality.kept(docs, labels)
    assert kept.columns == docs.columns
    assert quality.judge(empty_documents(spark), labels).count() == 0
    none = labels.limit(0)
    assert {r.score for r in quality.judge(docs, none).collect()} == {0.5}
    assert quality.judge(docs, labels.withColumn("quality", F.lit(1))).where("score < 0.5").count() == 0
    assert quality.judge(docs, labels.withColumn("quality", F.lit(None).cast("int"))).count() == docs.count()


def test_dual_coordinate_descent_reaches_the_optimum():
    rng = np.random.default_rng(4)
    rows = [np.unique(rng.integers(0, 30, 8)).astype(np.int32) for _ in range(60)]
    labels = np.array([int(3 in r or 5 in r) for r in rows])
    scale = np.ones(quality.FEATURES)
    w = quality.dual_coordinate_descent(rows, labels, scale, 1.0, 500)
    sign = np.where(labels > 0, 1.0, -1.0)
    share = np.array([(labels == 0).mean(), (labels == 1).mean()])
    cost = np.where(labels > 0, 1 / (2 * share[1]), 1 / (2 * share[0]))

    def loss(w):
        return 0.5 * w @ w + sum(c * max(0.0, 1 - s * w[r].sum()) for c, s, r in zip(cost, sign, rows))

    best = loss(w)
    for _ in range(200):
        step = np.zeros_like(w)
        step[:30] = rng.normal(scale=0.05, size=30)
        assert loss(w + step) >= best - 1e-3


def test_features_do_not_depend_on_what_is_known():
    a, b = quality.Indicators(), quality.Indicators(most_known=3)
    for t in ("One two two THREE!!", "", None, "x " * 2000, "four five six seven eight nine"):
        assert a.of(t).tolist() == b.of(t).tolist()


def test_features_do_not_depend_on_parts():
    rng = random.Random(12)
    of = quality.Indicators()
    for t in ("good " * 3000, sentence(rng, 2000), "x" * 5000, f"{'y' * 3000} a a b {'z' * 3000} b", " \t a  a\n\na b ", "one two two three", "é  Ü\u2003word\u2003word"):
        assert all(of.of(t).tolist() == of.of(t, part).tolist() for part in (1, 7, 100, 4096)), t[:20]


def plain_model(texts, labels, cost=0.1):
    """The same model worked out plainly: all rows, dense arrays, a solver that takes the steepest way."""
    of = quality.Indicators()
    rows = [of.of(t) for t in texts]
    used = sorted({int(f) for r in rows for f in r})
    x = np.array([[float(f in set(r.tolist())) for f in used] for r in rows])
    y = np.array(labels)
    p, q = (1 + x[y == v].sum(axis=0) for v in (1, 0))
    ratio = np.log(p / (p.sum() + quality.FEATURES - len(used))) - np.log(q / (q.sum() + quality.FEATURES - len(used)))
    z, sign = x * ratio, np.where(y == 1, 1.0, -1.0)
    most = np.where(y == 1, cost / (2 * (y == 1).mean()), cost / (2 * (y == 0).mean()))
    gram, alpha = (z * sign[:, None]) @ (z * sign[:, None]).T, np.zeros(len(y))
    for _ in range(4000):  # projected gradient steps on the dual
        alpha = np.clip(alpha - (gram @ alpha - 1) / np.linalg.norm(gram, 2), 0, most)
    return dict(zip(used, ratio * (z.T @ (alpha * sign))))


def test_model_against_a_plain_fit():
    rng = random.Random(13)
    texts = [sentence(rng, 12) if k % 3 else sentence(rng, 12).upper() + " !!" for k in range(60)]
    labels = [int(k % 3 > 0) for k in range(60)]
    of = quality.Indicators()
    rows = [of.of(t) for t in texts]
    ratio = quality.log_count_ratio(rows, np.array(labels))
    own = quality.dual_coordinate_descent(rows, np.array(labels), ratio, 0.1, 2000) * ratio
    want = plain_model(texts, labels)
    margin = lambda w, r: sum(w[int(f)] for f in r)
    a, b = np.array([margin(own, r) for r in rows]), np.array([margin(want, r) for r in rows])
    assert np.abs(a - b).max() < 0.02 * np.abs(b).max()


def test_fit_is_bounded(spark):
    few = quality.bounded(((k % 3, k % 2, np.arange(k % 50 + 1, dtype=np.int32).tobytes()) for k in range(2000)), 100, 1500)
    again = quality.bounded(((k % 3, k % 2, np.arange(k % 50 + 1, dtype=np.int32).tobytes()) for k in reversed(range(2000))), 100, 1500)
    assert few == again and 0 < len(few) <= 100 and sum(len(f) // 4 for *_, f in few) <= 1500
    docs = graded(spark).withColumn("doc_id", F.when(F.col("doc_id") % 3 == 0, F.lit(7)).otherwise(F.col("doc_id")))
    labels = graded(spark).select("doc_id", "quality")
    labels = labels.unionByName(labels.where("doc_id = 7").crossJoin(spark.range(500)).drop("id"))
    model = quality.train(docs.select("doc_id", "text"), labels, fit_rows=40)
    assert np.isfinite(model.weights).all() and model.weights.any()
