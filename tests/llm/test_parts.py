"""Texts are sent and dealt once, and worked on in parts of a batch."""

import pyarrow as pa
from pyspark.sql import functions as F

from genoframe.llm import nearcopies, quality, shared


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_parts_of_batches():
    batch = pa.RecordBatch.from_pydict({"doc": [{"text": str(k)} for k in range(600)]})
    found = list(shared.parts([batch, batch.slice(0, 0), batch.slice(100, 3)]))
    assert [b.num_rows for b in found] == [256, 256, 88, 3]
    assert [t for b in found for t in b.column(0).field(0).to_pylist()] == [str(k) for k in [*range(600), 100, 101, 102]]


def test_scored_sends_a_text_once(spark):
    docs = spark.createDataFrame([(k, None if k % 7 == 0 else "good " * k, "en") for k in range(600)], "doc_id long, text string, lang string")
    weights = quality.np.linspace(-1, 1, quality.FEATURES).astype("float32")
    model, of = quality.Model(weights), quality.Indicators()
    found = quality.scored(docs, model)
    assert "AS text" not in plan(found)
    assert {r.doc.doc_id: r.score for r in found.collect()} == {r.doc_id: model.score(of.of(r.text)) for r in docs.collect()}
    other = quality.scored(docs, model, "TEXT", 0.5).collect()
    assert sorted(r.doc.doc_id for r in other) == sorted(r.doc.doc_id for r in found.collect() if r.score >= 0.5)


def test_first_of_each_deals_a_document_once(spark):
    rows = [(1, "a b c d e f", "x"), (1, "a b c d e f", "w"), (2, "A b c d e f", None), (3, None, "z"), (None, "", "y"), (4, "other words than those of the first", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = nearcopies.first_of_each(docs)
    assert "min_by" not in plan(found)
    assert sorted(map(tuple, found.collect())) == [(1, "a b c d e f", "w"), (3, None, "z"), (4, "other words than those of the first", None)]
    # Columns without an order still stay.
    mapped = nearcopies.first_of_each(docs.withColumn("m", F.create_map("doc_id", "text")).where("doc_id is not null"))
    assert sorted(r.doc_id for r in mapped.collect()) == [1, 3, 4]
