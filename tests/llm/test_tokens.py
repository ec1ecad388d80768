import hashlib
import math
import random

import numpy as np
import public_tokenizers
from helpers import empty_documents, odd_documents
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from genoframe.llm import bpe, tokencounts

PATH = public_tokenizers.path("byte_bpe_50k.json")
OTHER = Tokenizer.from_file(PATH)
VOCAB = bpe.Vocabulary(PATH)


def other(text):
    ids = OTHER.encode(text, add_special_tokens=False).ids
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return len(ids), digest(",".join(map(str, ids))), digest(OTHER.decode(ids, skip_special_tokens=False))


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=80) | st.text(alphabet=" \n\tab'sEl1<|endoftx>é", max_size=120))
def test_same_tokens(text):
    own = bpe.Encoder(VOCAB)
    ids = own.encode(text)
    assert ids == OTHER.encode(text, add_special_tokens=False).ids
    assert own.decode(ids) == text


def test_long_pretokens_and_texts():
    rng = random.Random(1)
    own = bpe.Encoder(VOCAB)
    for text in ("=" * 5000, "aAbB" * 900, "".join(rng.choice("abcdef") for _ in range(3000)), "x" * 128, "y" * 129):
        assert own.encode(text) == OTHER.encode(text, add_special_tokens=False).ids
        assert VOCAB.encode_long(text.encode()) == VOCAB.encode_many([text.encode()])[0]
    text = " ".join(rng.choice(["word", "  two", "x\n", "é"]) for _ in range(20_000))
    assert "".join(bpe.segments(text, 1000)) == text and len(list(bpe.segments(text, 1000))) > 10
    assert [i for part in bpe.segments(text, 1000) for i in own.encode(part)] == OTHER.encode(text, add_special_tokens=False).ids


def test_knowledge_is_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "HELD_TOKENS", 10)
    monkeypatch.setattr(bpe, "HELD_CHARS", 50)
    own = bpe.Encoder(VOCAB)
    texts = [f"one{i} two{i} three{i % 3}" for i in range(100)]
    found = [x for part in own.coded(texts) for x in part]
    assert [np.frombuffer(ids, np.int32).tolist() for ids, _ in found] == [OTHER.encode(t, add_special_tokens=False).ids for t in texts]
    assert [t for _, t in found] == texts
    assert len(own.known) < 100


def test_round_trip(spark):
    docs = odd_documents(spark)
    found = bpe.round_trip(docs, PATH).collect()
    want = sorted((str(r.doc_id), *other(r.text or "")) for r in docs.collect())
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in found) == want
    coded = {str(r.doc_id) + str(r.decoded): r.ids for r in bpe.coded(docs, PATH).collect()}
    assert all(coded[str(r.doc_id) + (r.text or "")] == OTHER.encode(r.text or "", add_special_tokens=False).ids for r in docs.collect())
    assert bpe.round_trip(empty_documents(spark), PATH).count() == 0


def plain_count(token, own):
    best = [(0.0, 0)]
    for i in range(1, len(token) + 1):
        size = len(token[i - 1].encode())
        options = [(best[i - 1][0] + size * own.unknown, best[i - 1][1] - size)]
        options += [(best[k][0] + own.scores[token[k:i]], best[k][1] - 1) for k in range(i) if token[k:i] in own.scores]
        best.append(max(options))
    return -best[-1][1]


def test_trie_against_each_token_alone():
    own = tokencounts.pieces(public_tokenizers.path("piece_bpe_32k.model"))
    rng, trie = random.Random(2), tokencounts.Trie(own)
    tokens = ["▁" + "".join(rng.choice("etaoinshé日") for _ in range(rng.randrange(0, 14))) for _ in range(300)] + ["▁the", "▁there", "▁therefore"]
    for t in tokens:
        assert trie.insert(t) == plain_count(t, own)
    assert len(trie.children) < 1 + sum(map(len, tokens))


def test_small_vocabulary():
    own = tokencounts.Pieces({"a": math.log(0.4), "b": math.log(0.4), "ab": math.log(0.2)})
    trie = tokencounts.Trie(own)
    assert [trie.insert(t) for t in ("ab", "aab", "b", "", "éa")] == [1, 2, 1, 0, 3]


def test_token_counts(spark, monkeypatch):
    path = public_tokenizers.path("piece_bpe_32k.model")
    own = tokencounts.pieces(path)
    docs = odd_documents(spark)
    found = tokencounts.token_counts(docs, path).collect()
    seen = {}
    for r in docs.collect():
        words = (r.text or "").split()
        for w in set(words) - set(seen):
            seen[w] = plain_count("▁" + w, own)
    want = sorted((str(r.doc_id), sum(seen[w] for w in (r.text or "").split()), len((r.text or "").split())) for r in docs.collect())
    assert sorted((str(r.doc_id), r.n_tokens, r.n_pretokens) for r in found) == want
    assert tokencounts.token_counts(empty_documents(spark), path).count() == 0


def test_counter_in_parts():
    own = tokencounts.pieces(public_tokenizers.path("piece_bpe_32k.model"))
    text = "some words of a text " * 50
    assert tokencounts.Counter(own).count(text, part=7) == tokencounts.Counter(own).count(text)
