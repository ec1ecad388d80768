"""Scores of the language model against plain counting and the smoothing's formula."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from helpers import empty_documents, odd_documents, sentence
from pyspark.sql import functions as F

from genoframe.llm import lm

BEGIN, END = object(), object()


def tokens_of(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x20\x09-\x0d]+", lower) + [END]


def is_train(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 10 != 0


class Plain:
    """P(w | h) by recursion over dictionaries of counts."""

    def __init__(self, texts, order, strengths):
        self.order, self.strengths, self.counts = order, strengths, Counter()
        for text in texts:
            seq = [BEGIN, *tokens_of(text)]
            for i in range(len(seq)):
                for size in range(1, order + 1):
                    if i - size + 1 >= 0:
                        self.counts[tuple(seq[i - size + 1 : i + 1])] += 1
        self.n = sum(c for g, c in self.counts.items() if len(g) == 1 and g[0] is not BEGIN)
        self.kinds = len({g for g in self.counts if len(g) == 1 and g[0] is not BEGIN})

    def base(self, word):
        return (self.counts[word,] + 0.1) / (self.n + 0.1 * (self.kinds + 1))

    def chance(self, history, word):
        if not history:
            return self.base(word)
        s = self.strengths[min(len(history) - 1, len(self.strengths) - 1)]
        return (self.counts[*history, word] + s * self.chance(history[1:], word)) / (self.counts[history] + s)

    def row(self, text):
        own = tokens_of(text)
        seq = [BEGIN, *own]
        score = sum(math.log10(self.chance(tuple(seq[max(0, i - self.order + 1) : i]), seq[i])) for i in range(1, len(seq)))
        return len(own), sum(self.counts[w,] > 0 for w in own), self.n, sum(math.log10(self.base(w)) for w in own), score


def check(docs, found, order, strengths, learn):
    rows = docs.collect()
    plain = Plain([r.text for r in rows if learn(r)], order, strengths)
    want = sorted((str(r.doc_id), not learn(r), *plain.row(r.text)) for r in rows)
    found = sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in found.collect())
    assert [f[:5] for f in found] == [w[:5] for w in want]
    assert [x for f in found for x in f[5:]] == pytest.approx([x for w in want for x in w[5:]], rel=1e-9)
    return plain


@pytest.mark.parametrize(("order", "strengths"), [(3, lm.STRENGTHS), (1, (1.0,)), (2, (0.5,)), (4, (10.0, 1.0))])
def test_scores(spark, order, strengths):
    docs = odd_documents(spark)
    check(docs, lm.scored(docs, order=order, strengths=strengths), order, strengths, lambda r: is_train(r.doc_id))


def test_blocks_parts_and_ranges_change_nothing(spark, monkeypatch):
    for name, value in (("BLOCK_TOKENS", 300), ("PART_TOKENS", 7), ("RANGE_GRAMS", 200)):
        monkeypatch.setattr(lm, name, value)
    docs = odd_documents(spark, 80, 9).where("length(text) < 5000 or text is null")
    learn = (F.col("doc_id") % 2 == 0) & F.col("source").isNotNull()
    check(docs, lm.scored(docs, learn), 3, lm.STRENGTHS, lambda r: r.doc_id is not None and r.doc_id % 2 == 0 and r.source is not None)


def test_no_rows_no_training_and_bad_parameters(spark):
    assert lm.scored(empty_documents(spark)).count() == 0
    docs = odd_documents(spark, 12)
    found = lm.scored(docs, F.lit(False)).collect()
    assert len(found) == docs.count() and all(r.score == r.base_score == 0.0 and r.train_tokens == r.n_known == 0 and r.held_out for r in found)
    only = lm.scored(docs.where("text is null"), F.lit(True)).collect()
    assert only and all(r.n_tokens == r.n_known == 1 and r.train_tokens == len(only) for r in only)
    with pytest.raises(ValueError):
        lm.scored(docs, strengths=(0.0,))
    text_ids = docs.withColumn("doc_id", F.concat(F.lit("d"), F.col("doc_id")))
    assert dict(lm.scored(text_ids).dtypes)["doc_id"] == "string"


def test_chances_sum_to_one():
    plain = Plain(["a b a b c", "b a", "c c c a"], 3, (2.0, 1.0))
    for history in [(), ("a",), ("a", "b"), ("z", "b"), (BEGIN,), ("c", "c")]:
        known = [g[0] for g in plain.counts if len(g) == 1 and g[0] is not BEGIN]
        assert sum(plain.chance(history, w) for w in [*known, "never seen"]) == pytest.approx(1.0)


def test_held_out_texts_are_likelier_than_by_words_alone(spark):
    rng = random.Random(2)
    follow = {w: rng.sample(range(40), 3) for w in range(40)}

    def text():
        at, out = rng.randrange(40), []
        for _ in range(60):
            at = rng.choice(follow[at])
            out.append(f"w{at}")
        return " ".join(out)

    docs = spark.createDataFrame([(i, text()) for i in range(400)], "doc_id long, text string")
    held = [r for r in lm.scored(docs).collect() if r.held_out]
    assert len(held) > 20 and all(r.score > 0.5 * r.base_score for r in held)


def test_automaton_walks_a_long_text_in_parts():
    rng = random.Random(4)
    text = sentence(rng, 3000)
    words, sizes = lm.words_of(pa.array([text, text[:4000], "", None, " \t x\x0b\x0cY\x1f\x85É  "]))
    assert words.to_pylist()[-2:] == ["x", "y\x1f\x85É"]
    assert sizes.tolist()[2:] == [0, 0, 2]
    row = lm._block_row(0, [(pa.array(range(5)), np.array([True, False, True, False, False]), words, sizes)])
    grams = lm._block(row.to_pylist()[0], 3)
    counts = [level.count for level in grams.levels]
    counts[0][grams.begin] = 2
    own = lm.Automaton(grams, counts, int(sum(counts[0][: grams.begin])) + 2, int((counts[0] > 0).sum()) - 1, lm.STRENGTHS)
    whole = own.scores(grams)
    for part in (1, 2, 5, 4000):
        lm.PART_TOKENS, before = part, lm.PART_TOKENS
        try:
            assert np.allclose(own.scores(grams), whole, rtol=1e-12)
        finally:
            lm.PART_TOKENS = before
    assert len(own.fail) == 1 + int((counts[0] > 0).sum()) + int((counts[1] > 0).sum())
