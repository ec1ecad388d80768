"""Windows along chromosomes, and values averaged over them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from genoframe.operators.intervals import overlap_join, prefixed


def make_windows(fai: DataFrame, size: int, slide: int) -> DataFrame:
    """Windows of each chromosome every `slide` bases; the last ones are cut at its end."""
    starts = fai.where("len > 0").withColumn("start", F.explode(F.sequence(F.lit(0).cast("long"), F.col("len") - 1, F.lit(slide).cast("long"))))
    return starts.select("chrom", "start", F.least(F.col("start") + size, F.col("len")).alias("end"))


def window_overlaps(windows: DataFrame, alignments: DataFrame, bin_size: int) -> DataFrame:
    """(chrom, start, end, fraction, de): each alignment that shares bases with a window, with the share of the window; windows without any once, with nulls.

    Each window is also a row of its own, which stays where it comes first: pairs come before it.
    """
    met = overlap_join(windows, prefixed(alignments), ["chrom"], bin_size)
    share = (F.least("end", "r_end") - F.greatest("start", "r_start")) / (F.col("end") - F.col("start"))
    met = met.select("chrom", "start", "end", share.alias("fraction"), F.col("r_de").alias("de"))
    none = F.lit(None).cast("double")
    rows = met.withColumn("_bare", F.lit(0)).unionByName(windows.select("chrom", "start", "end", none.alias("fraction"), none.alias("de"), F.lit(1).alias("_bare")))
    place = F.row_number().over(Window.partitionBy("chrom", "start", "end").orderBy("_bare"))
    return rows.withColumn("_place", place).where("_bare = 0 or _place = 1").drop("_bare", "_place")


def window_averages(windows: DataFrame, alignments: DataFrame, bin_size: int) -> DataFrame:
    """(chrom, start, end, n, avg_de): the average divergence of each window's alignments by the share of the window that each covers.

    Sums are made before windows are joined again, so only one row for each window is. Null without alignments, 0 where
    the weights add to 0.
    """
    met = overlap_join(windows, prefixed(alignments), ["chrom"], bin_size)
    weight = (F.least("end", "r_end") - F.greatest("start", "r_start")) / (F.col("end") - F.col("start"))
    sums = met.groupBy("chrom", "start", "end").agg(F.count("*").alias("n"), F.sum(weight).alias("w"), F.sum(weight * F.col("r_de")).alias("wv"))
    average = F.when(F.col("n").isNull(), None).when(F.col("w") == 0, 0.0).otherwise(F.col("wv") / F.col("w"))
    return windows.join(sums, ["chrom", "start", "end"], "left").select("chrom", "start", "end", F.coalesce("n", F.lit(0)).alias("n"), average.alias("avg_de"))


def window_averages_by(windows: DataFrame, alignments: DataFrame, bin_size: int) -> DataFrame:
    """(chrom, start, end, id, avg_de): window_averages() of each id of alignments(id, ...) in one pass; only windows with alignments."""
    met = overlap_join(windows, prefixed(alignments), ["chrom"], bin_size)
    weight = (F.least("end", "r_end") - F.greatest("start", "r_start")) / (F.col("end") - F.col("start"))
    sums = met.groupBy("chrom", "start", "end", F.col("r_id").alias("id")).agg(F.sum(weight).alias("w"), F.sum(weight * F.col("r_de")).alias("wv"))
    return sums.select("chrom", "start", "end", "id", F.when(F.col("w") == 0, 0.0).otherwise(F.col("wv") / F.col("w")).alias("avg_de"))


def snp_windows(windows: DataFrame, snps: DataFrame, size: int, slide: int, shift: int = 0) -> DataFrame:
    """(chrom, start, end, snps, fraction): variants whose position minus `shift` lies in each window.

    Of windows made with that size and slide the starts follow from a position, so a variant is sent to its windows
    without a range join. Positions are 1-based; with shift 0 they are compared with 0-based windows as they stand.
    """
    at = F.col("pos") - shift
    low, high = F.floor((at - size) / slide) + 1, F.floor(at / slide)
    own = snps.where(at >= 0).select("chrom", at.alias("at"), F.explode(F.sequence(F.greatest(low, F.lit(0).cast("long")), high)).alias("k"))
    own = own.select("chrom", "at", (F.col("k") * slide).alias("start"))
    counts = own.join(windows, ["chrom", "start"]).where(F.col("at") < F.col("end")).groupBy("chrom", "start", "end").agg(F.count("*").alias("snps"))
    found = windows.join(counts, ["chrom", "start", "end"], "left").withColumn("snps", F.coalesce("snps", F.lit(0)))
    return found.withColumn("fraction", F.bround(F.col("snps") / (F.col("end") - F.col("start")), 5))


def snp_report(fai: DataFrame, snps: DataFrame) -> DataFrame:
    """(chrom, fraction) of each chromosome, and of all as WholeGenome."""
    counts = snps.groupBy("chrom").agg(F.count("*").alias("n"))
    joined = fai.join(counts, "chrom", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    found = joined.rollup("chrom").agg(F.sum("n").alias("n"), F.sum("len").alias("len"), F.grouping("chrom").alias("all"))
    return found.select(F.when(F.col("all") == 1, "WholeGenome").otherwise(F.col("chrom")).alias("chrom"), F.bround(F.try_divide("n", "len"), 5).alias("fraction"))


def chromosome_report(fai: DataFrame, alignments: DataFrame) -> DataFrame:
    """(chrom, avg_de) of each chromosome and of all as WholeGenome; an alignment weighs its share of its chromosome.

    Alignments without a value still weigh.
    """
    joined = alignments.join(fai, "chrom").withColumn("w", F.try_divide(F.abs(F.col("end") - F.col("start")), "len"))
    found = joined.rollup("chrom").agg(F.sum("w").alias("w"), F.sum(F.col("w") * F.col("de")).alias("wv"), F.grouping("chrom").alias("all"))
    return found.select(F.when(F.col("all") == 1, "WholeGenome").otherwise(F.col("chrom")).alias("chrom"), F.try_divide("wv", "w").alias("avg_de"))


def merge_windows(averages: DataFrame, ids: list[str] | None = None) -> DataFrame:
    """Long (chrom, start, end, id, avg_de) as a column for each id, by default of all there are, sorted: one grouping in place of a full join for each."""
    if ids is None:
        ids = sorted(r["id"] for r in averages.select("id").where("id is not null").distinct().collect())
    return averages.groupBy("chrom", "start", "end").pivot("id", ids).agg(F.first("avg_de"))


def split_windows(wide: DataFrame, ids: list[str]) -> DataFrame:
    """The way back: (chrom, start, end, id, avg_de), with a row also where there is no value."""
    return wide.unpivot(["chrom", "start", "end"], ids, "id", "avg_de")
