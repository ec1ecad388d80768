"""Documents with all that tables can hold: nulls, empty and long texts, ties, repeated rows, columns of clashing names."""

import random

WORDS = "the of and to in is that it was for on are with as his they at be this from have or by one had not but what all were when we there can an your which".split()


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "s", "ed", "ing", ","]) for _ in range(n))


def odd_documents(spark, n=60, seed=4):
    """Rows (doc_id, text, lang, source, n_chars) and columns named as operators name theirs."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        text = sentence(rng, rng.randrange(1, 120))
        if i % 10 == 3:
            text = rows[0][1]
        if i % 10 == 4:
            text = None
        if i % 10 == 5:
            text = rng.choice(["", " ", "\n\t", "x", "É", "é", "<|endoftext|>", "日本語 テキスト", "\x85 a b"])
        if i == 7:
            text = sentence(rng, 30_000)
        rows.append((i * 3, text, "en", None if i % 9 == 0 else f"src{i % 4}"))
    rows += [rows[1], rows[1], (None, "no id at all", "en", "src1"), (rows[2][0], "same id, other text", "en", "src2")]
    full = [(*r, len(r[1] or ""), "a", "b", 1, 2) for r in rows]
    return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, slot string, score string, id long, fp long")


def empty_documents(spark):
    return odd_documents(spark, 10).limit(0)
