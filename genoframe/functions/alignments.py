"""Columns over alignments: difference strings (cs), CIGARs (cg), tags, distances, sequences."""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

LOCUS = r"^(.+):(\d+)\.\.(\d+)$"
# What begins an operation of a difference string, by its published grammar (:length, *from-to, +in, -out, =same).
CS_MARKS = ":*+=-"
#: An operation: its mark, then all up to the next mark.
CS_OPERATION = f"([{CS_MARKS}])([^{CS_MARKS}]+)"


def total(values: Column) -> Column:
    """Sum of an array of longs."""
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, b: a + b)


def _numbers(text: Column, pattern: str) -> Column:
    return F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)), lambda x: x.cast("long"))


def bases_in(cg: Column, ops: str) -> Column:
    """Bases in a CIGAR's runs of those operations."""
    return total(_numbers(cg, rf"(\d+)[{ops}]"))


def matched_bases(cg: Column) -> Column:
    """Bases in the M runs of a CIGAR."""
    return bases_in(cg, "M")


def cs_tokens(cs: Column) -> Column:
    """Operations of a difference string: array of (op, val)."""
    ops, vals = (F.regexp_extract_all(cs, F.lit(CS_OPERATION), F.lit(k)) for k in (1, 2))
    return F.zip_with(ops, vals, lambda op, val: F.struct(op.alias("op"), val.alias("val")))


def cg_tokens(cg: Column) -> Column:
    """Operations of a CIGAR: array of (op, n)."""
    ns, ops = (F.regexp_extract_all(cg, F.lit(r"(\d+)([MIDNSHP=X])"), F.lit(k)) for k in (1, 2))
    return F.zip_with(ops, ns, lambda op, n: F.struct(op.alias("op"), n.cast("long").alias("n")))


def _is_transition(pair: Column) -> Column:
    return F.upper(pair).isin("AG", "GA", "CT", "TC")


def substitution_pairs(cs: Column) -> Column:
    """The two bases of each substitution."""
    return F.regexp_extract_all(cs, F.lit(f"\\*([^{CS_MARKS}]{{2}})(?![^{CS_MARKS}])"), F.lit(1))


def k2p(transitions: Column, transversions: Column, sites: Column) -> Column:
    """Kimura's two-parameter distance; null without sites or where a logarithm is not defined."""
    p, q = F.try_divide(transitions, sites), F.try_divide(transversions, sites)
    a, b = 1 - 2 * p - q, 1 - 2 * q
    return F.when((a > 0) & (b > 0), -0.5 * F.ln(a) - 0.25 * F.ln(b) + 0.0)


def k2p_bounded(transitions: Column, transversions: Column, sites: Column) -> Column:
    """The same from totals of a genome pair; null also where differences reach 0.75 of the sites."""
    p, q = F.try_divide(transitions, sites), F.try_divide(transversions, sites)
    a, b = 1 - 2 * p - q, 1 - 2 * q
    return F.when((p + q < 0.75) & (a > 0) & (b > 0), -0.5 * F.ln(a * F.sqrt(b)) + 0.0)


def transitions_in(pairs: Column) -> Column:
    return F.size(F.filter(pairs, _is_transition))


def variant_kind(ref: Column, query: Column) -> Column:
    """transition, transversion, or null where an allele is no base or both are equal."""
    pair, bases = F.upper(F.concat(ref, query)), ("A", "C", "G", "T")
    fine = F.upper(ref).isin(*bases) & F.upper(query).isin(*bases) & (F.upper(ref) != F.upper(query))
    return F.when(fine, F.when(_is_transition(pair), "transition").otherwise("transversion"))


def divergence_of(field: Column) -> Column:
    """Of de:f:0.1, or a bare number."""
    return F.element_at(F.split(field, ":"), -1).try_cast("double")


def trailing_decimal(field: Column) -> Column:
    """The decimal number at the end of a field; whole numbers and exponents do not count."""
    return F.nullif(F.regexp_extract(field, r"(\d+\.\d+)$", 1), F.lit("")).try_cast("double")


def tag(tags: Column, name: str) -> Column:
    return F.element_at(tags, name)


def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(seq, "ACGTacgt", "TGCAtgca"))


def _same(token: Column) -> Column:
    """Bases of a run of equal ones, short (:3) or long (=acg)."""
    return F.when(token["op"] == ":", token["val"].try_cast("long")).otherwise(F.length(token["val"]).cast("long"))


def target_of(cs: Column) -> Column:
    """The target's bases, from a difference string in the long form."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(cs, r"\+[^:*+=-]+", ""), r"\*(.)(.)", "$1"), "[=-]", "")


def query_of(cs: Column) -> Column:
    """The query's bases, likewise."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(cs, r"-[^:*+=-]+", ""), r"\*(.)(.)", "$2"), "[=+]", "")


def _values_of(cs: Column, mark: str) -> Column:
    """Bases in the operations of one mark: the text without the other operations and the mark itself."""
    others = "".join(m for m in CS_MARKS if m != mark)
    return F.length(F.replace(F.regexp_replace(cs, f"[{others}][^{CS_MARKS}]*|^[^{CS_MARKS}]+", ""), F.lit(mark), F.lit(""))).cast("long")


def cs_counts(cs: Column) -> Column:
    """Struct of matches, mismatches, inserted and deleted bases, and gap openings.

    Counted on the text; tokens, which are worked out anew wherever they are named, would be found for each count again.
    """
    # Every value as one letter, so an operation is its mark and x.
    shape = F.regexp_replace(cs, f"[^{CS_MARKS}]+", "x")
    of = lambda mark: F.shiftright(F.length(shape) - F.length(F.replace(shape, F.lit(f"{mark}x"), F.lit(""))), 1).cast("long")
    short = total(F.transform(F.regexp_extract_all(cs, F.lit(f":([^{CS_MARKS}]+)"), F.lit(1)), lambda x: x.try_cast("long")))
    long = F.when(~F.contains(cs, F.lit("=")), F.lit(0).cast("long")).otherwise(_values_of(cs, "="))
    return F.struct((short + long).alias("matches"), of("*").alias("mismatches"), _values_of(cs, "+").alias("inserted"), _values_of(cs, "-").alias("deleted"), (of("+") + of("-")).alias("gaps"))


def divergence_of_counts(counts: Column) -> Column:
    """Mismatches and gap openings over these and the matches, of cs_counts()."""
    other = counts["mismatches"] + counts["gaps"]
    return F.try_divide(other, counts["matches"] + other)


def gap_compressed_divergence(cs: Column) -> Column:
    return divergence_of_counts(cs_counts(cs))


def _joined(runs: Column) -> Column:
    """A CIGAR of runs (op, n), equal neighbours as one."""
    start = F.struct(F.lit("").alias("done"), F.lit("").alias("op"), F.lit(0).cast("long").alias("n"))
    shown = lambda a: F.when(a["n"] > 0, F.concat(a["done"], a["n"].cast("string"), a["op"])).otherwise(a["done"])
    grow = lambda a, x: F.when(a["op"] == x["op"], F.struct(a["done"].alias("done"), a["op"].alias("op"), (a["n"] + x["n"]).alias("n"))).otherwise(F.struct(shown(a).alias("done"), x["op"].alias("op"), x["n"].alias("n")))
    return F.aggregate(runs, start, grow, shown)


def cigar_of(cs: Column) -> Column:
    """The CIGAR of a difference string; runs of matches and mismatches become M."""
    size = lambda x: F.when(x["op"] == "*", F.lit(1).cast("long")).otherwise(_same(x))
    return _joined(F.transform(cs_tokens(cs), lambda x: F.struct(F.when(x["op"].isin(":", "=", "*"), "M").when(x["op"] == "+", "I").otherwise("D").alias("op"), size(x).alias("n"))))


def turned_cigar(cg: Column) -> Column:
    """A CIGAR whose I and D are meant the other way round, in this engine's sense; M is read as =."""
    return _joined(F.transform(cg_tokens(cg), lambda x: F.struct(F.when(x["op"] == "I", "D").when(x["op"] == "D", "I").when(x["op"] == "M", "=").otherwise(x["op"]).alias("op"), x["n"].alias("n"))))


def length_ratio(a: Column, b: Column) -> Column:
    return F.try_divide(F.greatest(a, b), F.least(a, b))


def locus(text: Column, clamp: bool = False, order: bool = False) -> Column:
    """Struct (name, start, end) of name:start..end. clamp: a start of 0 becomes 1. order: swap ends that are the wrong way round."""
    a, b = (F.regexp_extract(text, LOCUS, k).try_cast("long") for k in (2, 3))
    start, end = (F.least(a, b), F.greatest(a, b)) if order else (a, b)
    return F.struct(F.nullif(F.regexp_extract(text, LOCUS, 1), F.lit("")).alias("name"), (F.greatest(start, F.lit(1).cast("long")) if clamp else start).alias("start"), end.alias("end"))


def stored_segment_id(first: Column, second: Column, strand: Column) -> Column:
    """The ids that results of runs outside this engine carry: 48 bits of BLAKE2b, which is no built-in function."""

    @F.pandas_udf("string")
    def digest(keys: pd.Series) -> pd.Series:
        return keys.map(lambda k: None if k is None else hashlib.blake2b(k.encode(), digest_size=6).hexdigest())

    return digest(F.concat(first, F.lit("|"), second, F.lit("|"), strand))


def segment_id(first: Column, second: Column, strand: Column) -> Column:
    """Twelve hexadecimal digits that name a pair of intervals."""
    return F.substring(F.sha2(F.concat_ws("|", first, second, strand), 256), 1, 12)
