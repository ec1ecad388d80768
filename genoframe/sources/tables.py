"""Readers of the file formats, each to a relation of genoframe.schemas."""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from genoframe.functions.alignments import locus, trailing_decimal
from genoframe.functions.names import Genomes, genome_of, listed
from genoframe.sources.text import carried, counted, field, fields, is_there, lines

#: Fields of a rate table without a header.
RATE_COLUMNS = 22


def paf_of(rows: DataFrame, min_len: int = 0, both_sides: bool = False) -> DataFrame:
    """PAF lines: twelve columns, tags as a map, and de, cs and cg. Lines whose numbers are none are left out.

    min_len: least length on the target, or with both_sides on query and target.
    """
    parts = F.filter(F.transform(F.slice("f", 13, 1 << 20), lambda x: F.split(x, ":", 3)), lambda p: (F.size(p) == 3) & (p[0] != "") & (p[1] != ""))
    listed_tags = F.transform(parts, lambda p: F.struct(F.concat(p[0], F.lit(":"), p[1]).alias("k"), p[2].alias("v")))
    names = ("q_name", "q_len:bigint", "q_start:bigint", "q_end:bigint", "strand", "t_name", "t_len:bigint", "t_start:bigint", "t_end:bigint", "nmatch:bigint", "alnlen:bigint", "mapq:bigint")
    found = fields(rows).where(F.size("f") >= 12)
    found = found.select("file", "line_no", *[field(k, (n.split(":") + ["string"])[1]).alias(n.split(":")[0]) for k, n in enumerate(names, 1)], listed_tags.alias("tags"))
    for n in names:
        if ":" in n:
            found = found.where(F.col(n.split(":")[0]).isNotNull())
    if min_len:
        found = found.where((F.col("t_end") - F.col("t_start") >= min_len) & (F.lit(not both_sides) | (F.col("q_end") - F.col("q_start") >= min_len)))
    # Of repeated tags the last counts; lines without any are not searched for them.
    keys = F.transform("tags", lambda x: x["k"])
    once = F.array_distinct(keys)
    last = F.map_from_arrays(once, F.transform(once, lambda k: F.element_at(F.filter("tags", lambda x: x["k"] == k), -1)["v"]))
    found = found.withColumn("tags", F.when(F.size(once) == F.size("tags"), F.map_from_entries("tags")).otherwise(last))
    of = lambda k, kind="string": F.try_element_at(F.col("tags"), F.lit(k)).try_cast(kind)
    return found.withColumns({"de": F.regexp_extract(of("de:f"), r"^([^:]*?)(rl:i:.*)?$", 1).try_cast("double"), "cs": of("cs:Z"), "cg": of("cg:Z")})


def read_paf(spark: SparkSession, path: str, **options) -> DataFrame:
    return paf_of(lines(spark, path), **options)


def read_fai(spark: SparkSession, path: str) -> DataFrame:
    """(chrom, len); short lines are left out."""
    return fields(lines(spark, path)).where(F.size("f") >= 2).select(field(1).alias("chrom"), field(2, "bigint").alias("len"))


def read_genes(spark: SparkSession, path: str) -> DataFrame:
    """BED gene models with `ord`, their place in the file; track and browser lines are left out."""
    kept = fields(lines(spark, path)).where(~F.col("line").rlike(r"^(track|browser)\b") & (F.size("f") >= 4))
    return kept.select(field(1).alias("chrom"), field(2, "bigint").alias("start"), field(3, "bigint").alias("end"), field(4).alias("gene"), field(5).alias("score"), field(6).alias("strand"), F.col("line_no").alias("ord"))


def read_genes_if_there(spark: SparkSession, path: str) -> DataFrame:
    """read_genes(); without a file a warning and no rows."""
    if is_there(spark, path):
        return read_genes(spark, path)
    warnings.warn(f"no gene models at {path}", stacklevel=2)
    return spark.createDataFrame([], "chrom string, start long, end long, gene string, score string, strand string, ord long")


def read_scored_bed(spark: SparkSession, path: str) -> DataFrame:
    """(chrom, start, end, score) of lines with four columns, or with six of which the second and the sixth are left out."""
    rows = fields(lines(spark, path)).where(F.size("f").isin(4, 6)).withColumn("six", F.size("f") == 6)
    pick = lambda four, six, kind="string": F.when(F.col("six"), field(six, kind)).otherwise(field(four, kind))
    return rows.select(field(1).alias("chrom"), pick(2, 3, "bigint").alias("start"), pick(3, 4, "bigint").alias("end"), pick(4, 5).alias("score"))


def read_identity_bed(spark: SparkSession, path: str) -> DataFrame:
    """(chrom, start, end, de) with the decimal number at the end of the fourth column."""
    return fields(lines(spark, path)).select(field(1).alias("chrom"), field(2, "bigint").alias("start"), field(3, "bigint").alias("end"), trailing_decimal(field(4)).alias("de"))


def anchors_of(rows: DataFrame, exact: bool = False) -> DataFrame:
    """Anchor lines as (file, block_id, ord, gene1, gene2): blocks are parted by ### and numbered from 1, empty ones not.

    exact: lines that have not just two fields are left out.
    """
    rows = counted(rows.where(F.trim("line") != ""), F.trim("line") == "###", "_part")
    rows = rows.where(F.trim("line") != "###").withColumn("f", F.split(F.trim("line"), r"\s+"))
    rows = rows.where(F.size("f") == 2 if exact else F.size("f") >= 2)
    # Blocks without anchors have no number, so the blocks are ranked by themselves.
    blocks = rows.select(F.col("file").alias("_file"), F.col("_part").alias("_p")).distinct().withColumn("block_id", F.row_number().over(Window.partitionBy("_file").orderBy("_p")).cast("long"))
    rows = rows.join(blocks, (F.col("file") == F.col("_file")) & (F.col("_part") == F.col("_p")))
    return rows.select("file", "block_id", F.col("line_no").alias("ord"), field(1).alias("gene1"), field(2).alias("gene2"))


def read_anchors(spark: SparkSession, path: str, exact: bool = False) -> DataFrame:
    return anchors_of(lines(spark, path), exact)


def coords_of(rows: DataFrame, clamp: bool = False, order: bool = False) -> DataFrame:
    """Lines of two loci and a strand, perhaps with a block: coords with rid, the line's number."""
    rows = fields(rows).where(F.size("f") >= 3)
    rows = rows.select(F.col("line_no").alias("rid"), locus(field(1), clamp, order).alias("t"), locus(field(2), clamp, order).alias("q"), field(3).alias("strand"), field(4).alias("block"))
    rows = rows.select("rid", F.col("t.name").alias("t"), F.col("t.start").alias("t_start"), F.col("t.end").alias("t_end"), F.col("q.name").alias("q"), F.col("q.start").alias("q_start"), F.col("q.end").alias("q_end"), "strand", "block")
    return rows.where("t is not null and q is not null")


def read_coords(spark: SparkSession, path: str, clamp: bool = False, order: bool = False) -> DataFrame:
    return coords_of(lines(spark, path), clamp, order)


def between_two_genomes(coords: DataFrame, genomes: Genomes) -> DataFrame:
    """coords with both genomes; an error where a record does not join two."""
    genomes = listed(genomes)
    rows = genome_of(genome_of(coords, "t", genomes, "t_genome"), "q", genomes, "q_genome")
    guard = F.when(F.col("t_genome") == F.col("q_genome"), F.raise_error(F.concat(F.lit("one genome on both sides: "), F.col("t")))).otherwise(F.col("q_genome"))
    return rows.withColumn("q_genome", guard)


def read_vcf(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(variants(chrom, pos), contigs(chrom, len)) of a VCF."""
    rows = lines(spark, path)
    contigs = rows.where(F.col("line").startswith("##contig=")).select(F.regexp_extract("line", r"ID=([^,>]+)", 1).alias("chrom"), F.regexp_extract("line", r"length=(\d+)", 1).try_cast("bigint").alias("len"))
    return fields(rows).select(field(1).alias("chrom"), field(2, "bigint").alias("pos")), contigs


def read_windows(spark: SparkSession, path: str) -> DataFrame:
    return fields(lines(spark, path)).select(field(1).alias("chrom"), field(2, "bigint").alias("start"), field(3, "bigint").alias("end"))


def read_variants(spark: SparkSession, path: str) -> DataFrame:
    names = ("ref_contig", "ref_start:bigint", "ref_end:bigint", "ref_allele", "query_allele", "query_contig", "query_start:bigint", "query_end:bigint")
    return fields(lines(spark, path)).where(F.size("f") >= 8).select(*[field(k, (n.split(":") + ["string"])[1]).alias(n.split(":")[0]) for k, n in enumerate(names, 1)])


def read_sizes(spark: SparkSession, pattern: str) -> DataFrame:
    """(id1, id2, size) of files named id1.id2.bed.aln.size that hold one number."""
    rows = lines(spark, pattern).withColumn("name", F.regexp_replace("file", r"^.*/", ""))
    return rows.select(F.split_part("name", F.lit("."), F.lit(1)).alias("id1"), F.split_part("name", F.lit("."), F.lit(2)).alias("id2"), F.trim("line").try_cast("bigint").alias("size"))


def read_reports(spark: SparkSession, pattern: str) -> DataFrame:
    """(accession, chrom, value) of report files; the accession is the file's name up to its last dot."""
    rows = fields(lines(spark, pattern)).withColumn("accession", F.regexp_replace(F.regexp_replace("file", r"^.*/", ""), r"\.[^.]*$", ""))
    return rows.select("accession", field(1).alias("chrom"), field(2, "double").alias("value")).where("value is not null")


def mean_lines(reports: DataFrame) -> DataFrame:
    """(accession, chrom, value) of the chromosomes' own lines, without the whole genome's."""
    return reports.where("chrom <> 'WholeGenome'")


def with_means(windows: DataFrame, reports: DataFrame) -> DataFrame:
    """Long windows (chrom, start, end, id, avg_de) with the chromosome's mean of the report of that id."""
    own = mean_lines(reports).select(F.col("accession").alias("id"), "chrom", F.col("value").alias("mean"))
    return windows.join(own, ["id", "chrom"], "left")


def read_pairs(spark: SparkSession, path: str, exact: bool = False) -> DataFrame:
    """(id1, id2, ord); exact: a line that has not just two ids is an error."""
    rows = fields(lines(spark, path), r"\s+")
    if exact:
        rows = rows.withColumn("f", F.when(F.size("f") == 2, F.col("f")).otherwise(F.raise_error(F.concat(F.lit("not two ids: "), F.col("line")))))
    return rows.where(F.size("f") >= 2).select(field(1).alias("id1"), field(2).alias("id2"), F.col("line_no").alias("ord"))


def read_ks(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, pair, ks) of rate tables, each by its own first line; values that are no number are null.

    A first line with a field Ks is a header: its place says where the rates are, and lines that repeat it are left out. Without a
    header a table must have RATE_COLUMNS fields, of which Ks is the fourth. Any other layout is an error.
    """
    rows = fields(lines(spark, path))
    # The first line's place comes first: an aggregate over fields would sort all lines of a task.
    first = rows.groupBy(F.col("file").alias("_file")).agg(F.min("line_no").alias("_first"))
    heads = rows.join(F.broadcast(first), (F.col("file") == F.col("_file")) & (F.col("line_no") == F.col("_first"))).select("_file", F.col("f").alias("_head"))
    named = F.array_position("_head", "Ks").cast("int")
    wrong = F.raise_error(F.concat(F.lit("neither a Ks column nor the known number of columns: "), F.col("_file"))).cast("int")
    heads = heads.select("_file", F.when(named > 0, F.col("_head")).alias("_head"), F.when(named > 0, named).when(F.size("_head") == RATE_COLUMNS, F.lit(4)).otherwise(wrong).alias("_at"))
    # A row for each file goes to the lines, which stay where they are read: dealt by file, a file would be one task's.
    own = rows.join(F.broadcast(heads), F.col("file") == F.col("_file")).where(F.col("_head").isNull() | (F.col("f") != F.col("_head")))
    return own.select("file", field(1).alias("pair"), F.try_element_at("f", F.col("_at")).try_cast("double").alias("ks"))


def gff_of(rows: DataFrame) -> DataFrame:
    """GFF3 lines with attributes as a map, and sta and atn of the comment lines that precede them (atn cleaned)."""
    rows = carried(rows, F.when(F.col("line").startswith("##STA"), F.split_part("line", F.lit("\t"), F.lit(2))), "sta")
    rows = carried(rows, F.when(F.col("line").startswith("##ATN"), F.split_part("line", F.lit("\t"), F.lit(2))), "atn")
    clean = F.regexp_replace(F.regexp_replace(F.regexp_replace("atn", r"~[a-z]+~", ""), "-", ""), "[a-z]", "")
    pairs = F.filter(F.split(field(9), ";"), lambda x: x.contains("="))
    keys = F.array_distinct(F.transform(pairs, lambda x: F.trim(F.split_part(x, F.lit("="), F.lit(1)))))
    values = F.transform(keys, lambda k: F.regexp_replace(F.element_at(F.filter(pairs, lambda x: F.trim(F.split_part(x, F.lit("="), F.lit(1))) == k), -1), "^[^=]*=", ""))
    kept = fields(rows).where(F.size("f") >= 9)
    return kept.select("line_no", field(1).alias("chrom"), field(3).alias("type"), field(4, "bigint").alias("start"), field(5, "bigint").alias("end"), field(6).alias("score"), field(7).alias("strand"), field(8).alias("phase"), F.map_from_arrays(keys, values).alias("attrs"), "sta", clean.alias("atn"))


def read_annotations(spark: SparkSession, path: str) -> DataFrame:
    """(chrom, type, start, end, line) of the lines of a GFF with nine fields and whole numbers; starts are 0-based as intervals are here."""
    rows = fields(lines(spark, path)).where(F.size("f") >= 9)
    return rows.select(field(1).alias("chrom"), field(3).alias("type"), (field(4, "bigint") - 1).alias("start"), field(5, "bigint").alias("end"), "line").where("start is not null and end is not null")


def read_indels(spark: SparkSession, path: str) -> DataFrame:
    """Indels (op, q_name, q_start, q_end, t_name, t_start, t_end, length) of lines with at least five fields of which the third and fourth are whole numbers."""
    names = ("op", "q_name", "q_start:bigint", "q_end:bigint", "t_name", "t_start:bigint", "t_end:bigint", "length:bigint")
    rows = fields(lines(spark, path)).where(F.size("f") >= 5)
    return rows.select(*[field(k, (n.split(":") + ["string"])[1]).alias(n.split(":")[0]) for k, n in enumerate(names, 1)]).where("q_start is not null and q_end is not null")


def read_hits(spark: SparkSession, path: str) -> DataFrame:
    """(query, target, identity, length) of a tabular list of hits."""
    rows = lines(spark, path).where(F.trim("line") != "").withColumn("f", F.split("line", "\t"))
    return rows.select(F.trim(field(1)).alias("query"), field(2).alias("target"), field(3, "double").alias("identity"), field(4, "bigint").alias("length"))


def hit_ids(hits: DataFrame) -> DataFrame:
    """The ids that have a hit, once each."""
    return hits.select(F.col("query").alias("id")).distinct()


def read_matrix(spark: SparkSession, path: str) -> DataFrame:
    """Long (i, j, d) of a square table whose first line names the columns, with or without a field over the row names."""
    rows = lines(spark, path).where(F.trim("line") != "").withColumn("f", F.split("line", "\t"))
    first = rows.groupBy(F.col("file").alias("_file")).agg(F.min("line_no").alias("_first"), F.min_by("f", "line_no").alias("_names"))
    cells = rows.join(first, F.col("file") == F.col("_file")).where("line_no > _first")
    shift = F.size("f") - F.size("_names")  # 1 where nothing stands over the row names
    cells = cells.select(field(1).alias("i"), F.posexplode(F.slice("f", F.lit(2), F.size("f"))).alias("_k", "_d"), "_names", shift.alias("_shift"))
    return cells.select("i", F.try_element_at("_names", F.col("_k") + 2 - F.col("_shift")).alias("j"), F.col("_d").try_cast("double").alias("d")).where("j is not null")


def read_name_key(spark: SparkSession, path: str) -> DataFrame:
    """(name, label) of a name key."""
    return fields(lines(spark, path)).where(F.size("f") >= 2).select(field(1).alias("name"), field(2).alias("label"))


def read_genome_ids(spark: SparkSession, folder: str) -> DataFrame:
    """(genome) of a run's folder: of genome_list.txt, one to a line; else of jcvi_list.txt, all words; else the names of files *_mod.fa. The first that has any counts."""
    for name, words in (("genome_list.txt", F.array(F.trim("line"))), ("jcvi_list.txt", F.split(F.trim("line"), r"\s+"))):
        if is_there(spark, f"{folder}/{name}"):
            found = lines(spark, f"{folder}/{name}").where(F.trim("line") != "").select(F.explode(words).alias("genome")).distinct()
            if not found.isEmpty():
                return found
    if not is_there(spark, f"{folder}/*_mod.fa"):
        return spark.createDataFrame([], "genome string")
    files = spark.read.format("binaryFile").load(f"{folder}/*_mod.fa")
    return files.select(F.regexp_extract("path", r"([^/]*)_mod\.fa$", 1).alias("genome")).distinct()


def read_gff(spark: SparkSession, path: str) -> DataFrame:
    return gff_of(lines(spark, path))


def maf_of(rows: DataFrame) -> DataFrame:
    """Pairwise MAF lines: (block, names, starts, sizes, strands, texts) of each block, target first."""
    rows = counted(rows, F.col("line").rlike(r"^a\b"), "block").where(F.col("line").rlike(r"^s\s"))
    rows = rows.withColumn("f", F.split("line", r"\s+"))
    part = F.struct("line_no", field(2).alias("name"), field(3, "bigint").alias("start"), field(4, "bigint").alias("size"), field(5).alias("strand"), field(6, "bigint").alias("length"), field(7).alias("text"))
    return rows.groupBy("file", "block").agg(F.array_sort(F.collect_list(part)).alias("s")).where(F.size("s") >= 2).select("block", F.col("s")[0].alias("t"), F.col("s")[1].alias("q"))
