"""Exact document fingerprints: canonical form, wide hash, and groups of equal texts compared byte by byte.

Built-in functions only; Unicode normalisation and case folding are ICU's, called with java_method.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from genoframe.llm.shared import partitions
from genoframe.scratch import written

#: Most ranges of ids that documents are dealt into.
MOST_RANGES = 16384


def _icu(kind: str, method: str, text: Column) -> Column:
    return F.java_method(F.lit(f"com.ibm.icu.{kind}"), F.lit(method), text, F.lit(True))


def canonical(text: Column) -> Column:
    """NFKC, full case folding and NFKC again; each run of white space becomes one space, none at the ends.

    ASCII texts, the greater part, need lower() alone. Null is empty.
    """
    text = F.coalesce(text, F.lit(""))
    folded = _icu("text.Normalizer", "compose", _icu("lang.UCharacter", "foldCase", _icu("text.Normalizer", "compose", text)))
    folded = F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(folded)
    return F.trim(F.regexp_replace(folded, r"[\s\x85\p{Z}]+", " "))


def digest(canon: Column) -> Column:
    """128 bits as 32 hexadecimal digits: XXH64 twice, the second seeded by the hash of another string."""
    half = lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")
    return F.concat(half(F.xxhash64(canon)), half(F.xxhash64(F.lit("second half"), canon)))


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(fingerprint, group_id, group_rows, canon): a row for each canonical text.

    group_id: the smallest id of the rows whose canonical texts have the same bytes. canon is null unless other
    texts have the same fingerprint. Copies are taken together before anything is shuffled, and bytes are
    compared where they meet; a group's rows never do.
    """
    rows = docs.select(F.col(id_col).alias("id"), canonical(F.col(text_col)).alias("canon"))
    rows = rows.select("id", "canon", digest(F.col("canon")).alias("fingerprint"))
    texts = rows.groupBy("fingerprint", "canon").agg(F.min("id").alias("group_id"), F.count("*").alias("group_rows"))
    # One row for each fingerprint; those of several texts are told apart below.
    found = texts.groupBy("fingerprint").agg(F.min("group_id").alias("group_id"), F.sum("group_rows").alias("group_rows"), F.count("*").alias("texts"))
    found = written(found)
    plain = found.where("texts = 1").select("fingerprint", "group_id", "group_rows", F.lit(None).cast("string").alias("canon"))
    shared = found.where("texts > 1").select("fingerprint")
    if shared.isEmpty():
        return plain
    return plain.unionByName(texts.join(shared, "fingerprint", "left_semi").select("fingerprint", "group_id", "group_rows", "canon"))


def _range_of(value: Column, bounds: list) -> Column:
    """How many of the sorted bounds are at most the value, by binary search; 0 for null."""
    if not bounds:
        return F.lit(0)
    array, n = F.array(*[F.lit(b) for b in bounds]), len(bounds)
    steps = F.array(*[F.lit(1 << k) for k in range(n.bit_length() - 1, -1, -1)])
    fits = lambda at, step: (at + step <= n) & (F.element_at(array, F.least(at + step, F.lit(n))) <= value)
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(fits(at, step), at + step).otherwise(at))


def with_next(docs: DataFrame, columns: list[str], id_col: str = "doc_id", tie: str | None = None) -> DataFrame:
    """docs with next_<column> of the next row by descending id (after the last: the first; nulls last).

    Rows are dealt once, by ranges of ids; the first row of each range is dealt to the range above too, so no
    order over all rows is needed. Only the ranges' bounds and greatest ids reach the driver. Rows of one id
    are ordered by `tie`.
    """
    spark, own = docs.sparkSession, F.col(id_col)
    ids = docs.select(own.cast("long").alias("id"))
    count = max(1, min(MOST_RANGES, 4 * partitions(spark)))
    cuts = ids.approxQuantile("id", [k / count for k in range(1, count)], 0.2 / count)
    bounds = sorted({int(c) for c in cuts})
    tops = dict(ids.groupBy(_range_of(F.col("id"), bounds).alias("r")).agg(F.max("id")).collect())
    order = sorted(tops)
    if not order:
        return docs.select("*", *[F.col(c).alias(f"next_{c}") for c in columns])
    above = {r: order[(k + 1) % len(order)] for k, r in enumerate(order)}
    kind = docs.schema[id_col].dataType
    top = F.array(*[F.lit(tops.get(r)).cast("long") for r in range(len(bounds) + 1)])
    to = F.array(*[F.lit(above.get(r, -1)) for r in range(len(bounds) + 1)])
    r = F.col("_range")
    dealt = docs.withColumn("_range", _range_of(own.cast("long"), bounds))
    first = own.cast("long").eqNullSafe(F.element_at(top, r + 1))
    places = F.when(first, F.array(F.struct(r.alias("at"), F.lit(0).alias("extra")), F.struct(F.element_at(to, r + 1).alias("at"), F.lit(1).alias("extra")))).otherwise(F.array(F.struct(r.alias("at"), F.lit(0).alias("extra"))))
    dealt = dealt.withColumn("_place", F.explode(places)).withColumns({"_at": F.col("_place.at"), "_extra": F.col("_place.extra"), "_id": own.cast(kind)}).drop("_place", "_range")
    window = Window.partitionBy("_at").orderBy("_extra", F.desc_nulls_last("_id"), *([tie] if tie else []))
    return dealt.select("*", *[F.lead(c).over(window).alias(f"next_{c}") for c in columns]).where("_extra = 0").drop("_at", "_extra", "_id")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of docs: id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, group_id, group_rows.

    The edited text is the text with its last half (rounded down) replaced by as many first code points of the
    next document's, or all of them. An exact digest is alike (1.0) or not (0.0). group_id is the smallest id
    with the same canonical bytes. Null texts are empty; empty texts, and texts equal after folding, share a
    fingerprint; repeated rows stay; an empty table returns no rows; other columns are not looked at.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.length(text).cast("long").alias("n_chars"), canonical(text).alias("canon"))
    rows = rows.select("id", "text", "n_chars", digest(F.col("canon")).alias("fingerprint"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    rows = with_next(rows, ["text", "fingerprint"], "id", "fingerprint")
    rows = rows.withColumn("edited", F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - half), F.substring("next_text", F.lit(1), half)))
    rows = rows.select("id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", canonical(F.col("edited")).alias("canon"), "next_fingerprint", "text")
    rows = rows.withColumn("edited_fingerprint", digest(F.col("canon")))
    alike = lambda other: F.when(F.col("fingerprint") == F.col(other), 1.0).otherwise(0.0)
    rows = rows.select("id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", alike("edited_fingerprint").alias("near_edited"), alike("next_fingerprint").alias("near_next"), "text")
    found = groups(docs, id_col, text_col).select(F.col("fingerprint").alias("gf"), F.xxhash64("fingerprint").alias("gh"), "group_id", "group_rows", F.col("canon").alias("gc"))
    same = (F.col("fingerprint") == F.col("gf")) & (F.col("h") == F.col("gh"))
    if found.where("gc is not null").isEmpty():
        rows, found = rows.drop("text"), found.drop("gc")
    else:
        rows = rows.withColumn("canon", canonical(F.col("text"))).drop("text")
        same = same & (F.col("gc").isNull() | (F.col("gc") == F.col("canon")))
    joined = rows.withColumn("h", F.xxhash64("fingerprint")).join(found, same, "left")
    return joined.select(F.col("id").alias(id_col), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "group_id", "group_rows")
