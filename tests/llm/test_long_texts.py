"""Texts of five megabytes, with spaces and without: whole results in bounded memory."""

import io
import json
import random
import resource
import subprocess
import sys
from pathlib import Path

import public_tokenizers
import pytest

import corpus_pipeline
from genoframe.llm import entry

CHARS = 5_000_000
BPE, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def text_of(kind: str, chars: int = CHARS) -> str:
    rng = random.Random(1)
    if kind == "unbroken":
        return "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=chars))
    return " ".join("".join(rng.choices("etaoinsh", k=rng.randrange(1, 9))) for _ in range(chars // 5))[:chars].rstrip()


def work(what: str, text: str):
    """A small result of one operator's work on the text."""
    if what == "op2":
        from genoframe.llm import tokencounts

        return tokencounts.Counter(tokencounts.pieces(PIECES)).count(text)
    if what == "op4":
        from genoframe.llm import bpe

        (ids, decoded), = [x for part in bpe.Encoder(bpe.Vocabulary(BPE)).coded([text]) for x in part]
        return len(ids) // 4, decoded == text
    if what == "op7":
        from genoframe.llm import quality

        return len(quality.Indicators().of(text))
    if what == "op8":
        from genoframe.llm import warc

        return [r.payload == text.encode() for r in warc.SalvageReader(io.BytesIO(warc.member(warc.record(1, "u", text.encode()))))]
    if what == "op9":
        from genoframe.llm import simhash

        return simhash.simhash(text.encode())
    if what == "op10":
        from genoframe.llm import urls

        return urls.hits(urls.automaton(dict.fromkeys(urls.STRICT_TERMS, True)), f"http://x.io/{text}/casino")
    import numpy as np

    from genoframe.llm import nearcopies

    sets = np.unique(nearcopies.shingle_hashes(text.encode(), 5))
    return len(nearcopies.wide_simhash(sets)), len(nearcopies.bands(sets)) if len(sets) else 0


@pytest.mark.parametrize("kind", ["unbroken", "spaced"])
@pytest.mark.parametrize("what", ["op2", "op4", "op7", "op8", "op9", "op10", "near"])
def test_memory(what, kind):
    ran = subprocess.run([sys.executable, __file__, what, kind], capture_output=True, text=True, timeout=300, cwd=Path(__file__).parents[2])
    assert not ran.returncode, ran.stderr[-500:]
    found, more = json.loads(ran.stdout)
    assert found and more < 500, (found, more)
    if what == "op4" and kind == "spaced":
        from tokenizers import Tokenizer

        ids = Tokenizer.from_file(BPE).encode(text_of(kind), add_special_tokens=False).ids
        assert found == [len(ids), True]
    if what == "op10":
        assert found == [1, 0]


def test_queries_and_stages(spark, tmp_path):
    long = [(1, text_of("unbroken", 400_000)), (2, text_of("spaced")), (3, text_of("spaced") + " and more"), (4, "short"), (5, text_of("unbroken", 400_000) + "z")]
    docs = spark.createDataFrame([(i, t, "en", f"src{i % 2}", len(t)) for i, t in long], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    pages = spark.createDataFrame([(i, f"http://a.io/{t}/casino", t) for i, t in long], "page_id long, url string, html string")
    pages.write.parquet(f"{tmp_path}/pages.parquet")
    spark.createDataFrame([(i, 1, 0) for i, _ in long], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    at = f"file://{tmp_path}"
    from tokenizers import Tokenizer

    other = Tokenizer.from_file(BPE)
    n_tokens = {i: len(other.encode(t, add_special_tokens=False).ids) for i, t in long}
    assert {r.doc_id: r.n_tokens for r in entry.op4_bpe(spark, at).collect()} == n_tokens
    for name in ("op1_rendezvous", "op2_token_counts", "op5_fingerprints", "op7_quality", "op9_simhash"):
        assert entry.queries()[name](spark, at).count() == len(long), name
    assert {r.page_id: (r.payload_bytes, r.record_type) for r in entry.op8_warc(spark, at).collect()} == {i: (len(t), "response") for i, t in long}
    assert {r.verdict for r in entry.op10_urls(spark, at).collect()} == {"block"}
    assert {r.doc_id: r.n_tokens for r in corpus_pipeline.run(spark, at).collect()} == {i: n for i, n in n_tokens.items() if i != 3}


if __name__ == "__main__":
    sys.path.insert(0, ".")
    own = text_of(sys.argv[2])
    import ahocorasick  # noqa: F401
    import numpy  # noqa: F401
    import pyarrow  # noqa: F401
    import pyspark.sql  # noqa: F401

    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    result = work(sys.argv[1], own)
    print(json.dumps((result, (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024)))
