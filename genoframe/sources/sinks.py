"""Writers of the text formats."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from genoframe.functions.alignments import cs_counts, gap_compressed_divergence

PAF_COLUMNS = ("q_name", "q_len", "q_start", "q_end", "strand", "t_name", "t_len", "t_start", "t_end", "nmatch", "alnlen", "mapq")


def paf_line(segment: Column | None = None) -> Column:
    """A PAF line of 24 columns, the divergence in the 21st; a segment's id comes last."""
    counts, de = cs_counts(F.col("cs")), F.format_string("%.4f", gap_compressed_divergence(F.col("cs")))
    same = counts["matches"].cast("string")
    edits = (counts["mismatches"] + counts["inserted"] + counts["deleted"]).cast("string")
    tags = [("NM:i:", edits), ("ms:i:", same), ("AS:i:", same), ("nn:i:", F.lit("0")), ("tp:A:", F.lit("P")), ("cm:i:", F.lit("0")), ("s1:i:", same), ("s2:i:", F.lit("0")), ("de:f:", de), ("rl:i:", F.lit("0")), ("cg:Z:", F.col("cg")), ("cs:Z:", F.col("cs"))]
    if segment is not None:
        tags.append(("sd:Z:", segment))
    return F.concat_ws("\t", *[F.col(c).cast("string") for c in PAF_COLUMNS], *[F.concat(F.lit(t), v) for t, v in tags])


def write_paf(paf: DataFrame, path: str, segment: Column | None = None) -> None:
    paf.select(paf_line(segment).alias("value")).write.text(path)


def write_table(rows: DataFrame, path: str, header: bool = True) -> None:
    """Tab-separated text, NA for null."""
    rows.write.csv(path, sep="\t", header=header, nullValue="NA", quote="")


def write_by_genome(bed: DataFrame, path: str) -> None:
    """A folder of tab-separated text for each other genome."""
    bed.write.partitionBy("other").csv(path, sep="\t", nullValue="NA")


def decimals(value: Column, places: int) -> Column:
    """Rounded half to even, as text."""
    return F.format_string(f"%.{places}f", F.bround(value, places) + 0.0)


def write_anchors(anchors: DataFrame, path: str) -> None:
    """anchors(block_id, ord, gene1, gene2) as text of two columns, ### before each block; blocks lie in order over the part files."""
    first = F.row_number().over(Window.partitionBy("block_id").orderBy("ord")) == 1
    line = F.concat(F.when(first, "###\n").otherwise(""), F.col("gene1"), F.lit("\t"), F.col("gene2"))
    anchors.select("block_id", "ord", line.alias("value")).repartitionByRange("block_id").sortWithinPartitions("block_id", "ord").select("value").write.text(path)


def locus_text(name: str, start: str, end: str) -> Column:
    """name:start..end"""
    return F.concat(F.col(name), F.lit(":"), F.col(start).cast("string"), F.lit(".."), F.col(end).cast("string"))


def write_coords(coords: DataFrame, path: str) -> None:
    """coords as lines of two loci, strand and block."""
    coords.select(F.concat_ws("\t", locus_text("t", "t_start", "t_end"), locus_text("q", "q_start", "q_end"), "strand", F.col("block").cast("string")).alias("value")).write.text(path)
