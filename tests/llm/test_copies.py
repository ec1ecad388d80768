import hashlib
import random
import re
import unicodedata

import numpy as np
import pytest
import xxhash
from helpers import empty_documents, odd_documents, sentence
from pyspark.sql import functions as F

from genoframe.llm import fingerprints, nearcopies, simhash
from genoframe.operators.components import connected_components


def plain_fp(text, k=3):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", words)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles))


def classes(nodes, linked):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in linked:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def test_components(spark):
    rng = random.Random(5)
    pairs = [(rng.randrange(400), rng.randrange(400)) for _ in range(250)] + [(1000 + i, 1001 + i) for i in range(200)] + [(5000, 5001 + i) for i in range(300)]
    df = spark.createDataFrame([*pairs, (7, 7), (None, 3)], "a long, b long")
    found = {r.node: r.root for r in connected_components(df, "a", "b").collect()}
    want = classes({x for p in pairs for x in p}, pairs)
    assert found == {n: r for n, r in want.items() if n != r}
    assert connected_components(df.limit(0), "a", "b").count() == 0


def test_tree_finds_all_within_radius():
    rng = random.Random(6)
    base = [rng.getrandbits(64) for _ in range(40)]
    values = list({b ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(5))) for b in base for _ in range(6)})
    tree = simhash.BKTree()
    for v in values:
        tree.insert(v)
    for v in values:
        assert {tree.values[i] for i in tree.near(v, 3)} == {w for w in values if (v ^ w).bit_count() <= 3}


def test_links_join_what_is_within_radius(spark):
    rng = random.Random(7)
    values = {0}
    for _ in range(30):
        b = rng.getrandbits(64)
        for _ in range(25):
            b ^= 1 << rng.randrange(64) | 1 << rng.randrange(64)
            values.add(b)
    # A hot shard: one block of bits in common.
    values |= {rng.getrandbits(48) << 16 for _ in range(60)}
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    want = classes(signed, [(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 3])
    df = spark.createDataFrame([(v,) for v in signed], "fp long")
    for rows in (8, 1024):
        found = [(r.a, r.b) for r in simhash.links(df, 3, rows).collect()]
        assert classes(signed, found) == want


def test_near_duplicates(spark):
    docs = odd_documents(spark, 120)
    near = docs.where("text is not null").withColumns({"doc_id": F.col("doc_id") + 1, "text": F.concat("text", F.lit(" end"))})
    docs = docs.unionByName(near)
    rows = docs.collect()
    found = simhash.near_duplicates(docs).collect()
    assert len(found) == len(rows)
    fps = {r.text: plain_fp(r.text) for r in rows}
    assert sorted((str(r.doc_id), fps[r.text]) for r in rows) == sorted((str(r.doc_id), r.fp & (1 << 64) - 1) for r in found)
    distinct = sorted(set(fps.values()))
    of = classes(distinct, [(a, b) for a in distinct for b in distinct if a < b and (a ^ b).bit_count() <= 3])
    least = {}
    for r in rows:
        if r.doc_id is not None:
            c = of[fps[r.text]]
            least[c] = min(least.get(c, r.doc_id), r.doc_id)
    assert all(r.component_id == least.get(of[r.fp & (1 << 64) - 1]) for r in found)
    assert simhash.near_duplicates(empty_documents(spark)).count() == 0


def found_classes(texts, classes):
    """Of each distinct text's id the least id of its class."""
    ids = {r.node: r.id for r in texts.select("node", "id").collect()}
    root = {r.node: r.root for r in classes.collect()}
    least = {}
    for n, i in ids.items():
        c = root.get(n, n)
        least[c] = min(least.get(c, i), i)
    return {i: least[root.get(n, n)] for n, i in ids.items()}


@pytest.mark.parametrize("chunk", [3, 256])
def test_near_copies(spark, monkeypatch, chunk):
    monkeypatch.setattr(nearcopies, "CHUNK_TEXTS", chunk)
    rng = random.Random(8)
    texts = [sentence(rng, 80) for _ in range(15)]
    for t in list(texts):
        for _ in range(8):
            words = t.split()
            for _ in range(rng.randrange(0, 4)):
                words[rng.randrange(len(words))] = "changed"
            texts.append(" ".join(words).upper() if rng.random() < 0.3 else " ".join(words))
    texts += ["", None, " ", "one two", "one two"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    seen, sets = {}, {}
    for i, t in enumerate(texts):
        key = " ".join((t or "").lower().split())
        if key not in seen:
            seen[key] = i
            sets[i] = np.unique(nearcopies.shingle_hashes(key.encode(), 5))
    want = classes(sets, [(a, b) for a in sets for b in sets if a < b and len(sets[a]) and len(sets[b]) and nearcopies.likeness(sets[a], sets[b]) >= 0.8])
    distinct, found = nearcopies.near_copies(docs)
    assert sorted(r.id for r in distinct.select("id").collect()) == sorted(seen.values())
    assert found_classes(distinct, found) == want
    kept = nearcopies.first_of_each(docs)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(n for n, r in want.items() if n == r)


def test_near_copies_with_unequal_repetition(spark):
    rng = random.Random(21)
    texts = []
    for _ in range(12):
        start, line, end = sentence(rng, 60), sentence(rng, 9), sentence(rng, 40)
        texts += [f"{start} {line} {line} {end}", f"{start} {f'{line} ' * 40}{end}", f"{start} {f'{line} ' * 13}{end}"]
    for _ in range(12):
        start, end = sentence(rng, 60), sentence(rng, 40)
        texts += [f"{start} {'same ' * 5}{end}", f"{start} {'same ' * 25}{end}", f"{start} {'same ' * 300}{end}"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(r.doc_id for r in nearcopies.first_of_each(docs).collect()) == list(range(0, len(texts), 3))


def test_texts_with_much_in_common(spark, monkeypatch):
    """A passage that all texts hold lets them share bands without being near copies: nothing is joined by bands alone."""
    monkeypatch.setattr(nearcopies, "CHUNK_TEXTS", 8)
    rng = random.Random(31)
    common, texts = sentence(rng, 90), []
    for k in range(60):
        own = sentence(rng, 45)
        texts.append(f"{common} {own}")
        if k % 4 == 0:
            texts += [f"{common} {own} end", f"so {common} {own}"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = {i: np.unique(nearcopies.shingle_hashes(t.lower().encode(), 5)) for i, t in enumerate(texts)}
    want = classes(sets, [(a, b) for a in sets for b in sets if a < b and nearcopies.likeness(sets[a], sets[b]) >= 0.8])
    assert len(set(want.values())) == 60
    texts_, found = nearcopies.near_copies(docs)
    assert found_classes(texts_, found) == want


def test_first_of_ids_with_several_texts(spark):
    rng = random.Random(32)
    a, b, c = (sentence(rng, 60) for _ in range(3))
    rows = [(1, a, "z"), (1, b, "z"), (1, a, "y"), (2, a + " end", "z"), (None, b, "z"), (None, c, "z"), (None, c + " end", "z"), (3, None, "z"), (4, " ", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = [tuple(r) for r in nearcopies.first_of_each(docs).collect()]
    assert sorted(found, key=str)[:3] == sorted([(1, a, "y"), (1, b, "z"), (3, None, "z")], key=str)
    assert len(found) == 4 and found.count((None, c, "z")) + found.count((None, c + " end", "z")) == 1


def test_first_of_each_keeps_columns(spark):
    docs = odd_documents(spark)
    found = nearcopies.first_of_each(docs)
    assert found.columns == docs.columns
    ids = [r.doc_id for r in found.collect()]
    assert ids.count(None) == 1 and {i for i in ids if ids.count(i) > 1} == {6}  # two texts of one id
    assert nearcopies.first_of_each(empty_documents(spark)).count() == 0


#: ASCII white space, NEL, and the spaces and separators of Unicode.
SPACES = " \t\n\x0b\x0c\r\x85" + "".join(chr(c) for c in range(0x3001) if unicodedata.category(chr(c)) in ("Zs", "Zl", "Zp"))


def plain_canonical(text):
    text = unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", text or "").casefold())
    return " ".join(re.split(f"[{SPACES}]+", text)).strip(" ")


def test_canonical(spark):
    texts = ["É  Straße\n", "é STRASSE", "ﬁne", "ABC def", "x y　z", "", None, "İ", "ῼ", "가", "한"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", fingerprints.canonical(F.col("t")).alias("c")).orderBy("i").collect()
    assert [r.c for r in rows] == [plain_canonical(t) for t in texts]


def test_fingerprints(spark):
    docs = odd_documents(spark, 80).where("doc_id is not null").dropDuplicates(["doc_id"])
    rows = sorted(((r.doc_id, r.text or "") for r in docs.collect()), reverse=True)
    found = {r.doc_id: r for r in fingerprints.fingerprints(docs).collect()}
    assert len(found) == len(rows)
    fp = lambda t: "".join(f"{h:016x}" for h in (xxhash.xxh64_intdigest(t.encode(), 42), xxhash.xxh64_intdigest(t.encode(), xxhash.xxh64_intdigest(b"second half", 42))))
    for k, (doc_id, text) in enumerate(rows):
        nxt = rows[(k + 1) % len(rows)][1]
        edited = text[: len(text) - len(text) // 2] + nxt[: len(text) // 2]
        r = found[doc_id]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.fingerprint == fp(plain_canonical(text)) and r.edited_fingerprint == fp(plain_canonical(edited))
        assert r.near_edited == float(r.fingerprint == r.edited_fingerprint)
        assert r.near_next == float(r.fingerprint == fp(plain_canonical(nxt)))
        same = [i for i, t in rows if plain_canonical(t) == plain_canonical(text)]
        assert (r.group_id, r.group_rows) == (min(same), len(same))


def test_fingerprints_of_odd_rows(spark):
    docs = odd_documents(spark)
    assert fingerprints.fingerprints(docs).count() == docs.count()
    assert fingerprints.fingerprints(docs.limit(1)).collect()[0].near_next == 1.0
    assert fingerprints.fingerprints(empty_documents(spark)).count() == 0


def test_equal_fingerprints_of_other_texts(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "digest", lambda c: F.substring(c, 1, 1))
    docs = spark.createDataFrame([(1, "ab"), (2, "ac"), (3, "AB"), (4, "x")], "doc_id long, text string")
    assert {r.doc_id: (r.group_id, r.group_rows) for r in fingerprints.fingerprints(docs).collect()} == {1: (1, 2), 2: (2, 1), 3: (1, 2), 4: (4, 1)}
