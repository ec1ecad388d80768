"""Divergence of alignments, weighted up to chromosome and genome pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from genoframe.functions import alignments as A
from genoframe.functions.names import Genomes, genome_of, listed
from genoframe.functions.walks import kept_substitutions


def with_distance(paf: DataFrame, no_adjacent: bool = False, off_indels: int | None = None) -> DataFrame:
    """paf with msum (bases in M runs) and k2p; rows without a CIGAR go. Substitutions left out leave the sites too."""
    paf = paf.where("cg is not null").withColumn("msum", A.matched_bases(F.col("cg")))
    if no_adjacent or off_indels is not None:
        paf = paf.withColumn("_kept", kept_substitutions(F.col("cs"), no_adjacent, off_indels))
        paf = paf.withColumns({"ti": F.col("_kept.ti"), "tv": F.col("_kept.tv"), "sites": F.col("msum") - F.col("_kept.out")}).drop("_kept")
    else:
        pairs = A.substitution_pairs(F.col("cs"))
        paf = paf.withColumns({"ti": A.transitions_in(pairs), "tv": F.size(pairs) - A.transitions_in(pairs), "sites": F.col("msum")})
    return paf.withColumn("k2p", F.when(F.col("cs").isNotNull(), A.k2p(F.col("ti"), F.col("tv"), F.col("sites"))))


def adjust_lengths(paf: DataFrame, fai: DataFrame, genomes: Genomes) -> DataFrame:
    """paf with lengths from the index where it has them, and both genomes' whole lengths."""
    genomes = listed(genomes)
    sizes = genome_of(fai, "chrom", genomes, "genome").groupBy("genome").agg(F.sum("len").alias("genome_len"))
    for side in ("q", "t"):
        index = fai.select(F.col("chrom").alias(f"{side}_name"), F.col("len").alias("_len"))
        paf = paf.join(index, f"{side}_name", "left").withColumn(f"{side}_len", F.coalesce("_len", f"{side}_len")).drop("_len")
        paf = genome_of(paf, f"{side}_name", genomes, "_genome")
        paf = paf.join(sizes.select(F.col("genome").alias("_genome"), F.col("genome_len").alias(f"{side}_genome_len")), "_genome", "left").drop("_genome")
    return paf


def reference_bed(paf: DataFrame, reference: str, genomes: Genomes, strict: bool = False) -> DataFrame:
    """(other, chrom, start, end, de) on the reference's chromosomes, with the other genome's id.

    strict tests whether the reference's id occurs anywhere in a name, the query's first; else the resolved ids count.
    """
    genomes = listed(genomes)
    rows = genome_of(genome_of(paf, "q_name", genomes, "q_genome"), "t_name", genomes, "t_genome")
    on_q = F.col("q_name").contains(reference) if strict else F.col("q_genome") == reference
    on_t = F.col("t_name").contains(reference) if strict else F.col("t_genome") == reference
    pick = lambda a, b: F.when(on_q, F.col(a)).otherwise(F.col(b))
    return rows.where(on_q | on_t).select(pick("t_genome", "q_genome").alias("other"), pick("q_name", "t_name").alias("chrom"), pick("q_start", "t_start").alias("start"), pick("q_end", "t_end").alias("end"), "de")


def pair_weights(paf: DataFrame, genomes: Genomes, value: str = "de") -> DataFrame:
    """(id1, id2, weight, value): each record's share of the matched bases of its unordered genome pair."""
    genomes = listed(genomes)
    rows = genome_of(genome_of(paf.where("msum is not null"), "q_name", genomes, "g1"), "t_name", genomes, "g2")
    pair = F.struct(F.least("g1", "g2").alias("a"), F.greatest("g1", "g2").alias("b"))
    rows = rows.select(F.col("q_name").alias("id1"), F.col("t_name").alias("id2"), "msum", F.col(value).alias("value"), pair.alias("pair"))
    totals = rows.groupBy("pair").agg(F.sum("msum").alias("total"))
    return rows.join(totals, "pair").select("id1", "id2", F.try_divide("msum", "total").alias("weight"), "value")


def chromosome_averages(weights: DataFrame) -> DataFrame:
    """(id1, id2, weight, avg) of each unordered pair; rows without a value are left out, and weights of 0 give 0."""
    pairs = weights.where("value is not null").groupBy(F.least("id1", "id2").alias("id1"), F.greatest("id1", "id2").alias("id2"))
    sums = pairs.agg(F.sum("weight").alias("weight"), F.sum(F.col("weight") * F.col("value")).alias("wv"))
    return sums.select("id1", "id2", "weight", F.when(F.col("weight") == 0, 0.0).otherwise(F.col("wv") / F.col("weight")).alias("avg"))


def genome_averages(weights: DataFrame, genomes: Genomes) -> DataFrame:
    """chromosome_averages() of the genomes."""
    genomes = listed(genomes)
    rows = genome_of(genome_of(weights, "id1", genomes, "g1"), "id2", genomes, "g2")
    return chromosome_averages(rows.select(F.col("g1").alias("id1"), F.col("g2").alias("id2"), "weight", "value"))


def symmetric(pairs: DataFrame, value: str, missing: float | None = None) -> DataFrame:
    """Long (i, j, d) over all ids: 0 on the diagonal, `missing` for pairs without a value, of repeated pairs the last by `ord`.

    A matrix has a row for each genome of a study. Its rows are brought together for the list of ids, so that the
    pairs are worked out once.
    """
    both = pairs.select(F.col("id1").alias("i"), F.col("id2").alias("j"), F.col(value).alias("d"), "ord")
    both = both.withColumn("_way", F.explode(F.array(F.struct("i", "j"), F.struct(F.col("j").alias("i"), F.col("i").alias("j"))))).select("_way.i", "_way.j", "d", "ord")
    last = both.groupBy("i", "j").agg(F.max_by("d", "ord").alias("d"))
    rows = last.groupBy("i").agg(F.map_from_entries(F.collect_list(F.struct("j", "d"))).alias("row"))
    rows = rows.withColumn("_ids", F.collect_list("i").over(Window.partitionBy())).withColumn("j", F.explode("_ids"))
    d = F.coalesce(F.try_element_at("row", F.col("j")), F.lit(missing).cast("double"))
    return rows.select("i", "j", F.when(F.col("i") == F.col("j"), 0.0).otherwise(d).alias("d"))


def square(long: DataFrame, ids: list[str]) -> DataFrame:
    """A column for each id."""
    return long.groupBy("i").pivot("j", ids).agg(F.first("d"))


def identity_bed(paf: DataFrame) -> DataFrame:
    """(chrom, start, end, de) on the targets of records that state their divergence."""
    return paf.where("de is not null").select(F.col("t_name").alias("chrom"), F.col("t_start").alias("start"), F.col("t_end").alias("end"), "de")


def records_per_block(blocks: DataFrame, records: str = "n_records") -> DataFrame:
    """(blocks, records, per_block): how many records blocks have, and on average."""
    return blocks.agg(F.count("*").alias("blocks"), F.sum(records).alias("records"), F.avg(records).alias("per_block"))


def skip_reasons(skips: DataFrame) -> DataFrame:
    return skips.groupBy("reason").agg(F.count("*").alias("n"))


def block_n50(blocks: DataFrame, span: str = "ref_span") -> DataFrame:
    """(blocks, total, n50, largest). Spans are summed for each distinct value first, so few rows are ordered."""
    spans = blocks.groupBy(F.col(span).alias("span")).agg(F.sum(span).alias("bases"), F.count("*").alias("n"))
    ahead = Window.orderBy(F.desc("span")).rowsBetween(Window.unboundedPreceding, 0)
    sums = spans.withColumns({"_cum": F.sum("bases").over(ahead), "_total": F.sum("bases").over(Window.partitionBy())})
    return sums.agg(F.sum("n").alias("blocks"), F.sum("bases").alias("total"), F.max(F.when(F.col("_cum") >= F.col("_total") / 2, F.col("span"))).alias("n50"), F.max("span").alias("largest"))
