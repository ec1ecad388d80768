"""Variants, insertions and deletions told from difference strings and CIGARs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genoframe.functions import alignments as A
from genoframe.functions.names import Genomes, genome_of, listed
from genoframe.functions.walks import walk_cg, walk_cs


def substitutions(paf: DataFrame) -> DataFrame:
    """A row for each substitution; on '-' the query is walked from its end. Alleles are as in the alignment."""
    c = F.col
    rows = walk_cs(paf.select("q_name", "q_start", "q_end", "strand", "t_name", "t_start", "cs").where("cs is not null"), "*")
    at = F.when(c("strand") == "+", c("q_start") + c("w.q")).otherwise(c("q_end") - 1 - c("w.q"))
    ref = c("t_start") + c("w.t")
    allele = lambda k: F.substring("w.val", k, 1)
    return rows.select(c("t_name").alias("ref_contig"), ref.alias("ref_start"), (ref + 1).alias("ref_end"), allele(1).alias("ref_allele"), allele(2).alias("query_allele"), c("q_name").alias("query_contig"), at.alias("query_start"), (at + 1).alias("query_end"))


def presence_absence(paf: DataFrame, least: int) -> DataFrame:
    """(kind, name, seq, start, end) of insertions on the query and deletions on the target; the strand is not looked at."""
    c = F.col
    rows = walk_cs(paf.select("q_name", "q_start", "t_name", "t_start", "cs").where("cs is not null"), "+-", least)
    ins = c("w.op") == "+"
    start = F.when(ins, c("q_start") + c("w.q")).otherwise(c("t_start") + c("w.t"))
    return rows.select(F.when(ins, "ins").otherwise("del").alias("kind"), F.when(ins, c("q_name")).otherwise(c("t_name")).alias("name"), c("w.val").alias("seq"), start.alias("start"), (start + c("w.n") - 1).alias("end"))


def indels(paf: DataFrame, least: int, strict: bool = False) -> DataFrame:
    """A row for each insertion or deletion of a CIGAR of at least that length.

    strict moves both axes at every operation, from the ends backwards on '-', and gives both intervals the
    indel's length. Else each axis moves where it has bases, the query backwards on '-', and the axis without
    bases gets an empty interval.
    """
    c = F.col
    back = c("strand") == "-"
    rows = walk_cg(paf.select("q_name", "q_start", "q_end", "strand", "t_name", "t_start", "t_end", "cg").where("cg is not null"), "ID", least, "strand" if strict else None, strict)
    n, op = c("w.n"), c("w.op")
    if strict:
        q_start, t_start = (F.when(back, c(f"{s}_end") - c(f"w.{s}") - n).otherwise(c(f"{s}_start") + c(f"w.{s}")) for s in ("q", "t"))
        q_n = t_n = n
    else:
        q_n, t_n = F.when(op == "I", n).otherwise(0), F.when(op == "D", n).otherwise(0)
        q_start, t_start = F.when(back, c("q_end") - c("w.q") - q_n).otherwise(c("q_start") + c("w.q")), c("t_start") + c("w.t")
    return rows.select(op.alias("op"), "q_name", q_start.alias("q_start"), (q_start + q_n).alias("q_end"), "t_name", t_start.alias("t_start"), (t_start + t_n).alias("t_end"), n.alias("length"))


def by_either_name(events: DataFrame) -> DataFrame:
    """Each indel under the names of both its sequences, once where they are the same."""
    return events.withColumn("chrom", F.explode(F.array_distinct(F.array("q_name", "t_name"))))


def substitution_counts(variants: DataFrame, genomes: Genomes) -> DataFrame:
    """(id1, id2, ti, tv) of each unordered genome pair; alleles that are no bases do not count."""
    rows = variants.withColumn("kind", A.variant_kind(F.col("ref_allele"), F.col("query_allele"))).where("kind is not null")
    genomes = listed(genomes)
    rows = genome_of(genome_of(rows, "ref_contig", genomes, "g1"), "query_contig", genomes, "g2")
    return rows.groupBy(F.least("g1", "g2").alias("id1"), F.greatest("g1", "g2").alias("id2")).agg(F.count_if(F.col("kind") == "transition").alias("ti"), F.count_if(F.col("kind") == "transversion").alias("tv"))


def counts_and_sizes(paf: DataFrame, genomes: Genomes) -> DataFrame:
    """(id1, id2, ti, tv, size) of each unordered genome pair: substitution_counts(), and aligned bases, in one pass over
    the records. Substitutions are counted within a record's difference string and never become rows."""
    count = lambda pair: F.coalesce(F.regexp_count("cs", F.lit(f"(?i)\\*{pair}(?![^{A.CS_MARKS}])")), F.lit(0))
    turned = count("(?:ag|ga|ct|tc)")
    rows = paf.select("q_name", "t_name", "alnlen", turned.alias("transition"), (count("(?!aa|cc|gg|tt)[acgt]{2}") - turned).alias("transversion"))
    genomes = listed(genomes)
    rows = rows.groupBy("q_name", "t_name").agg(F.sum("alnlen").alias("size"), F.sum("transition").alias("ti"), F.sum("transversion").alias("tv"))
    rows = genome_of(genome_of(rows, "q_name", genomes, "g1"), "t_name", genomes, "g2")
    return rows.groupBy(F.least("g1", "g2").alias("id1"), F.greatest("g1", "g2").alias("id2")).agg(F.sum("ti").alias("ti"), F.sum("tv").alias("tv"), F.sum("size").alias("size"))


def distances(counts: DataFrame, sizes: DataFrame) -> DataFrame:
    """(id1, id2, d) of genome pairs from their counts and (id1, id2, size); null where it is not defined."""
    joined = counts.join(sizes, ["id1", "id2"], "left")
    return joined.select("id1", "id2", F.when(F.col("size") > 0, A.k2p_bounded(F.col("ti"), F.col("tv"), F.col("size"))).alias("d"))


def breakpoints(paf: DataFrame, least: int = 100) -> DataFrame:
    """(rid, t, q): both ends of each indel of at least that length on forward records, where a pair can be cut in register."""
    c = F.col
    rows = walk_cg(paf.select("rid", "q_start", "t_start", "strand", "cg").where("strand = '+' and cg is not null"), "ID", least)
    t, q, on_t = c("t_start") + c("w.t"), c("q_start") + c("w.q"), c("w.op") == "D"
    ends = F.array(F.struct(t.alias("t"), q.alias("q")), F.struct((t + F.when(on_t, c("w.n")).otherwise(0)).alias("t"), (q + F.when(on_t, 0).otherwise(c("w.n"))).alias("q")))
    return rows.select("rid", F.explode(ends).alias("p")).select("rid", "p.*")
