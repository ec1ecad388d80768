"""The stages and the registered queries."""

import glob
import hashlib
import os
import random

import duckdb
import numpy as np
import public_tokenizers
from helpers import sentence
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from genoframe.llm import entry, nearcopies, quality

SF = "/root/testdata/sf0.001"


def write_tables(spark, at):
    rng, rows = random.Random(9), []
    for i in range(160):
        text = sentence(rng, 50)
        if i % 5 == 1:
            text = rows[-1][1] + " and more"
        if i % 7 == 2:
            text = rows[0][1].upper()
        if i % 6 == 5:
            text = text.upper().replace(" ", "!! ")
        rows.append((i, text, "en", f"src{i % 3}", len(text)))
    rows[11] = (11, None, "en", None, 0)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.coalesce(2).write.parquet(f"{at}/documents.parquet")
    labels = spark.createDataFrame([(i, int(i % 6 != 5), 0) for i in range(160)], "doc_id long, quality int, toxic int")
    labels.coalesce(1).write.parquet(f"{at}/labels.parquet")
    return rows


def test_stages_against_a_plain_version(spark, tmp_path):
    at = f"file://{tmp_path}"
    rows = {r[0]: r for r in write_tables(spark, at)}
    docs = spark.read.parquet(f"{at}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near-duplicates", "mixing", "BPE"]

    model = quality.train(docs, spark.read.parquet(f"{at}/labels.parquet"))
    of = quality.Indicators()
    kept = [i for i, r in rows.items() if model.score(of.of(r[1])) >= 0.5]
    first = corpus_pipeline.keep_quality(spark, docs, at)
    assert first.columns == docs.columns and sorted(r.doc_id for r in first.collect()) == kept
    assert not [i for i in kept if i % 6 == 5 and i % 7 != 2 and i % 5 != 1 and i != 11]

    seen, sets = {}, {}
    for i in kept:
        key = " ".join((rows[i][1] or "").lower().split())
        if key not in seen:
            seen[key] = i
            sets[i] = np.unique(nearcopies.shingle_hashes(key.encode(), 5))
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and len(sets[a]) and nearcopies.likeness(sets[a], sets[b]) >= 0.8:
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    left = sorted(i for i in sets if root(i) == i)
    second = corpus_pipeline.drop_near_duplicates(spark, first, at)
    assert second.columns == docs.columns and sorted(r.doc_id for r in second.collect()) == left

    third = corpus_pipeline.mix_sources(spark, second, at)
    assert third.columns == docs.columns and sorted(r.doc_id for r in third.collect()) == left
    order = [r.source for r in third.collect()]
    assert order[:32] == ["src0"] * min(32, order.count("src0")) + order[order.count("src0") : 32]

    other = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {}
    for i in left:
        ids = other.encode(rows[i][1] or "", add_special_tokens=False).ids
        want[i] = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((rows[i][1] or "").encode()).hexdigest())
    found = corpus_pipeline.run(spark, at).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in found} == want and len(found) == len(want)


def test_stages_on_no_rows(spark, tmp_path):
    at = f"file://{tmp_path}"
    write_tables(spark, at)
    docs = spark.read.parquet(f"{at}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, at).count() == 0


def test_queries(spark):
    assert [n.split("_")[0] for n in entry.queries()] == [f"op{k}" for k in range(1, 11)]
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from read_parquet('{f}')")
    for name, sql in entry.oracle_sql().items():
        own = entry.queries()[name](spark, SF)
        result = con.execute(sql)
        columns = [d[0] for d in result.description]
        assert sorted(own.columns) == sorted(columns)
        text = lambda row: str(tuple(row))
        assert sorted(text(r) for r in own.select(columns).collect()) == sorted(text(r) for r in result.fetchall())
    n = {"documents": spark.read.parquet(f"{SF}/documents.parquet").count(), "pages": spark.read.parquet(f"{SF}/pages.parquet").count()}
    for name, f in entry.queries().items():
        if not name.startswith("op3_"):
            found = f(spark, SF)
            assert found.count() == n["pages" if name.startswith(("op8_", "op10_")) else "documents"], name


def test_neighbours_of_the_table(spark):
    from genoframe.llm import ann

    rows = spark.read.parquet(f"{SF}/embeddings.parquet")
    exact = {(r.query_id, r.vec_id) for r in ann.nearest_exactly(rows, F.col("vec_id") % 20 == 0).collect()}
    found = {(r.query_id, r.vec_id) for r in entry.op3_neighbours(spark, SF).collect()}
    assert len(found & exact) >= 0.9 * len(exact)
