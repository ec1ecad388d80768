"""Queries that write a relation as a text format and read it back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from genoframe.operators import variants as V
from genoframe.operators.quantiles import quantile
from genoframe.plans.divergence import _CG, _GENOME_AVERAGES, _VARIANTS, distance_matrix, indels, variants
from genoframe.plans.registry import query
from genoframe.plans.views import fai, snps, view, with_views
from genoframe.scratch import new_path, written
from genoframe.sources import fasta, sinks, tables
from genoframe.sources.text import counted, lines

c = F.col


def _text(spark: SparkSession, *columns, rows: DataFrame) -> str:
    """Path of a new text file with the columns, joined by tabs."""
    path = new_path(spark, "text")
    rows.select(F.concat_ws("\t", *columns).alias("value")).write.text(path)
    return path


def _table(spark: SparkSession, rows: DataFrame, header: bool = False) -> str:
    path = new_path(spark, "table")
    sinks.write_table(rows, path, header)
    return path


@query(with_views("v_paf") + """
s as (select *, cast(regexp_extract(cs, '^:([0-9]+)', 1) as bigint) + cast(regexp_extract(cs, '^:[0-9]+\\*..:([0-9]+)', 1) as bigint) + cast(regexp_extract(cs, ':([0-9]+)-tt', 1) as bigint) + 9 as same from v_paf)
select rid, q_name, q_len, q_start, q_end, strand, t_name, t_len, t_start, t_end, nmatch, alnlen, cast(60 as bigint) as mapq, cast(7 as bigint) as nm, same as ms, cs, cg from s""")
def paf_file(spark, sf_dir):
    path = new_path(spark, "paf")
    sinks.write_paf(view(spark, sf_dir, "v_paf").withColumn("mapq", F.lit(60)), path, c("rid").cast("string"))
    tag = lambda k: c("tags")[k].cast("long")
    return tables.read_paf(spark, path).select(tag("sd:Z").alias("rid"), *sinks.PAF_COLUMNS, tag("NM:i").alias("nm"), tag("ms:i").alias("ms"), "cs", "cg")


@query(with_views("v_genes") + "r as (select 1) select chrom, start, \"end\", gene, '0' as score, strand from v_genes")
def genes_file(spark, sf_dir):
    rows = view(spark, sf_dir, "v_genes")
    return tables.read_genes(spark, _text(spark, "chrom", "start", "end", "gene", F.lit("0"), "strand", rows=rows)).drop("ord")


@query(with_views("v_paf", "v_fai") + "r as (select 1) select chrom, len from v_fai")
def index_file(spark, sf_dir):
    return tables.read_fai(spark, _text(spark, "chrom", "len", F.lit("9\t60\t61"), rows=fai(spark, sf_dir)))


@query(with_views("v_paf", "v_fai", "v_windows") + 'r as (select 1) select chrom, start, "end" from v_windows')
def windows_file(spark, sf_dir):
    from genoframe.plans.divergence import _windows

    return tables.read_windows(spark, _text(spark, "chrom", "start", "end", rows=_windows(spark, sf_dir)))


@query(with_views("v_paf") + "r as (select 1) select rid, t_name as chrom, t_start as start, t_end as \"end\", de from v_paf")
def scored_bed_file(spark, sf_dir):
    """Lines of four fields where the record is even, of six where it is odd."""
    from genoframe.functions.alignments import divergence_of

    rows = view(spark, sf_dir, "v_paf", "rid", "t_name", "t_start", "t_end", "de").withColumn("odd", c("rid") % 2 == 1)
    score = F.concat(F.lit("r"), c("rid").cast("string"), F.lit(":de:f:"), c("de").cast("string"))
    path = _text(spark, "t_name", F.when(c("odd"), "x"), "t_start", "t_end", score, F.when(c("odd"), "y"), rows=rows)
    found = tables.read_scored_bed(spark, path)
    return found.select(F.regexp_extract("score", r"^r(\d+):", 1).cast("long").alias("rid"), "chrom", "start", "end", divergence_of(c("score")).alias("de"))


@query(with_views("v_anchors") + "r as (select 1) select arg_min(gene1, ord) as gene1, arg_min(gene2, ord) as gene2, arg_max(gene2, ord) as last, count(*) as n from v_anchors group by block_id")
def anchors_file(spark, sf_dir):
    path = new_path(spark, "anchors")
    sinks.write_anchors(view(spark, sf_dir, "v_anchors"), path)
    blocks = tables.read_anchors(spark, path, exact=True).groupBy("file", "block_id")
    return blocks.agg(F.min_by("gene1", "ord").alias("gene1"), F.min_by("gene2", "ord").alias("gene2"), F.max_by("gene2", "ord").alias("last"), F.count("*").alias("n")).drop("file", "block_id")


@query(with_views("v_coords") + "r as (select 1) select t, greatest(t_start, 1) as t_start, t_end, q, greatest(q_start, 1) as q_start, q_end, strand, cast(block as varchar) as block from v_coords")
def coords_file(spark, sf_dir):
    path = new_path(spark, "coords")
    sinks.write_coords(view(spark, sf_dir, "v_coords"), path)
    return tables.read_coords(spark, path, clamp=True).drop("rid")


@query(with_views("v_paf", "v_fai", "v_snps") + "r as (select chrom, count(*) as n from v_snps group by 1) select chrom, len, n from v_fai join r using (chrom)")
def vcf_file(spark, sf_dir):
    heads = fai(spark, sf_dir).select(F.concat(F.lit("##contig=<ID="), "chrom", F.lit(",length="), c("len").cast("string"), F.lit(">")).alias("value"))
    rows = snps(spark, sf_dir).select(F.concat_ws("\t", "chrom", "pos", F.lit(".")).alias("value"))
    variants, contigs = tables.read_vcf(spark, _text(spark, "value", rows=heads.unionByName(rows)))
    return contigs.join(variants.groupBy("chrom").agg(F.count("*").alias("n")), "chrom")


@query(_VARIANTS + "select * from v")
def variants_file(spark, sf_dir):
    return tables.read_variants(spark, _table(spark, variants(spark, sf_dir)))


@query("with g as (select n_nationkey as ord, replace(n_name, ' ', '_') as genome from nation) select a.genome as id1, b.genome as id2 from g a join g b on a.ord < b.ord")
def pairs_file(spark, sf_dir):
    from genoframe.operators.assembly import pair_list

    genomes = spark.read.parquet(f"{sf_dir}/nation.parquet").select(c("n_nationkey").alias("ord"), F.replace("n_name", F.lit(" "), F.lit("_")).alias("genome"))
    return tables.read_pairs(spark, _text(spark, "id1", "id2", rows=pair_list(genomes)), exact=True).select("id1", "id2")


@query(with_views("v_coords") + """r as (select 1)
select t as chrom, t_start as start, t_end as "end", strand, 'm' || rid as id, q || ' 1 3' as target, 'MK' || rid as sta, 'ATG' as atn from v_coords""")
def gff_file(spark, sf_dir):
    """The comment lines before a record belong to it."""
    record = F.concat_ws("\t", "t", F.lit("m"), F.lit("mRNA"), "t_start", "t_end", F.lit("."), "strand", F.lit("."), F.concat(F.lit("ID=m"), c("rid").cast("string"), F.lit(";Target="), "q", F.lit(" 1 3")))
    value = F.concat(F.lit("##STA\tMK"), c("rid").cast("string"), F.lit("\n##ATN\tat~gg~A-TG\n"), record)
    found = tables.read_gff(spark, _text(spark, value, rows=view(spark, sf_dir, "v_coords")))
    return found.select("chrom", "start", "end", "strand", c("attrs")["ID"].alias("id"), c("attrs")["Target"].alias("target"), "sta", "atn")


@query(with_views("v_ks") + "r as (select 1) select id1 || '-' || id2 as pair, count(*) as n, median(ks) as median from v_ks group by 1")
def rates_file(spark, sf_dir):
    """Tables of three layouts: 22 columns without a header, and two with headers that have Ks at different places."""
    rows = view(spark, sf_dir, "v_ks").withColumn("pair", F.concat("id1", F.lit("-"), "id2"))
    pad = lambda n: [F.lit("0.5").alias(f"x{k}") for k in range(n)]
    layouts = (
        (c("id1") == "Zm", ["pair", F.lit("YN").alias("m"), F.lit("0.1").alias("a"), "ks", *pad(18)], False),
        (c("id1") == "Sb", [c("pair").alias("Sequence"), F.lit("YN").alias("Method"), F.lit("0.1").alias("Ka"), F.lit("0.2").alias("Ka/Ks"), c("ks").alias("Ks")], True),
        (~c("id1").isin("Zm", "Sb"), [c("pair").alias("Sequence"), c("ks").alias("Ks"), F.lit("9.9").alias("Ka"), *pad(2)], True),
    )
    paths = [_table(spark, rows.where(own).select(*columns), header) for own, columns, header in layouts]
    found = written(tables.read_ks(spark, paths).select("pair", "ks"))
    return found.groupBy("pair").agg(F.count("*").alias("n")).join(quantile(found, ["pair"], "ks", 0.5, "median"), "pair", "left")


@query(with_views("v_coords") + "r as (select 1) select t, t_start, q, q_start, strand, 'AC-GT' as t_text, 'ACTGT' as q_text from v_coords")
def maf_file(spark, sf_dir):
    side = lambda s, strand, text: F.concat_ws(" ", F.lit("s"), s, f"{s}_start", F.lit("4"), strand, F.lit("1000000"), F.lit(text))
    value = F.concat_ws("\n", F.lit("a score=1"), side("t", F.lit("+"), "AC-GT"), side("q", "strand", "ACTGT"), F.lit(""))
    found = tables.maf_of(lines(spark, _text(spark, value, rows=view(spark, sf_dir, "v_coords"))))
    return found.select(c("t.name").alias("t"), c("t.start").alias("t_start"), c("q.name").alias("q"), c("q.start").alias("q_start"), c("q.strand").alias("strand"), c("t.text").alias("t_text"), c("q.text").alias("q_text"))


@query(with_views("v_seq") + "s as (select cast(id as varchar) as seq_id, regexp_replace(raw, '[^acgt]', '', 'g') as seq from v_seq) select seq_id, length(seq) as length, md5(seq) as seq from s where seq <> ''")
def fasta_file(spark, sf_dir):
    path = new_path(spark, "fasta")
    rows = view(spark, sf_dir, "v_seq").select(c("id").cast("string").alias("seq_id"), F.regexp_replace("raw", "[^acgt]", "").alias("seq")).where("seq <> ''")
    fasta.write_fasta(rows, path)
    return fasta.read_fasta(spark, path).select("seq_id", "length", F.md5("seq").alias("seq"))


@query(_GENOME_AVERAGES + """, b as (select id1 as i, id2 as j, avg as d from a union all select id2, id1, avg from a union all select distinct id1, id1, 0.0 from (select id1 from a union select id2 from a))
select i, j, d from b""")
def matrix_file(spark, sf_dir):
    return tables.read_matrix(spark, _table(spark, distance_matrix(spark, sf_dir), header=True))


@query(with_views("v_paf") + _CG + """, e as (select q_name, t_name, 3 as n from p union all select q_name, t_name, 2 from p),
b as (select q_name as chrom, n from e union all select t_name, n from e where t_name <> q_name)
select chrom, count(*) as indels, sum(n) as bases from b group by 1""")
def indels_file(spark, sf_dir):
    """Every indel counts on both its sequences."""
    events = V.by_either_name(tables.read_indels(spark, _table(spark, indels(spark, sf_dir))))
    return events.groupBy("chrom").agg(F.count("*").alias("indels"), F.sum("length").alias("bases"))


@query(with_views("v_anchors") + "r as (select 1) select distinct gene1 as id from v_anchors")
def hits_file(spark, sf_dir):
    rows = view(spark, sf_dir, "v_anchors")
    return tables.hit_ids(tables.read_hits(spark, _text(spark, "gene1", "gene2", F.lit("99.5"), F.lit("120"), rows=rows)))


@query(with_views("v_paf") + """
p as (select q_name, q_start, t_name, t_start, cast(regexp_extract(cs, '^:([0-9]+)', 1) as bigint) as a, cast(regexp_extract(cs, '^:[0-9]+\\*..:([0-9]+)', 1) as bigint) as b, cast(regexp_extract(cs, ':([0-9]+)-tt', 1) as bigint) as c from v_paf),
e as (select 'acg' as seq, q_name as name, q_start + a + 1 + b as s, 2 as more from p union all select 'tt', t_name, t_start + a + 1 + b + 1 + c, 1 from p),
d as (select distinct name || ':' || s || '..' || (s + more) as seq_id, seq from e) select seq_id, seq from d""")
def presence_file(spark, sf_dir):
    """All records of the files, those whose name comes again too: a record is a name and the line after it."""
    path = new_path(spark, "fasta")
    events = V.presence_absence(view(spark, sf_dir, "v_paf", "q_name", "q_start", "t_name", "t_start", "cs"), 1)
    fasta.write_presence_absence(events.select("name", "start", "end", "seq").distinct(), path)
    named = c("line").startswith(">")
    rows = counted(fasta.fasta_lines(spark, path), named, "record").groupBy("file", "record")
    return rows.agg(F.max(F.when(named, F.substring("line", 2, 1 << 30))).alias("seq_id"), F.max(F.when(~named, c("line"))).alias("seq")).drop("file", "record")


@query(with_views("v_seq") + """
s as (select id, regexp_replace(raw, '[^acgt]', '', 'g') as seq from v_seq),
p as (select id, seq, unnest(range(0, length(seq), 700)) as start from s)
select cast(id as varchar) as seq_id, start, case when (start // 700) % 2 = 1 then reverse(translate(substring(seq, start + 1, 90 + id % 50), 'acgt', 'tgca')) else substring(seq, start + 1, 90 + id % 50) end as slice from p""")
def indexed_slices(spark, sf_dir):
    """Slices of every sequence, over its whole length, from FASTA files with indexes of which only the chunks asked for are read."""
    from genoframe.sources.indexed import read_slices, write_indexed

    seqs = view(spark, sf_dir, "v_seq").select("id", c("id").cast("string").alias("seq_id"), F.regexp_replace("raw", "[^acgt]", "").alias("seq")).where("seq <> ''")
    path = new_path(spark, "indexed")
    write_indexed(seqs, path, 70)
    starts = F.sequence(F.lit(0).cast("long"), F.length("seq").cast("long") - 1, F.lit(700).cast("long"))
    asked = seqs.select("id", "seq_id", F.explode(starts).alias("start"))
    asked = asked.select("seq_id", "start", (c("start") + 90 + c("id") % 50).alias("end"), F.when(F.floor(c("start") / 700) % 2 == 1, "-").otherwise("+").alias("strand"))
    return read_slices(spark, asked, path, "strand", 4096).select("seq_id", "start", c("seq").alias("slice"))


@query("""
with e as (select user_id, ts, case when ts - lag(ts) over (partition by user_id order by ts) <= interval 30 minutes then 0 else 1 end as new from events where ts is not null),
s as (select user_id, ts, sum(new) over (partition by user_id order by ts rows unbounded preceding) as session from e)
select user_id, epoch_us(min(ts)) as first, epoch_us(max(ts)) as last, count(*) as n from s group by user_id, session""")
def event_sessions(spark, sf_dir):
    """Sessions of users of the whole table, by the operator that also takes a stream."""
    from genoframe.streaming.sessions import sessions

    found = sessions(spark.read.parquet(f"{sf_dir}/events.parquet"), ["user_id"])
    micros = lambda x: F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {x})")
    return found.select("user_id", micros("first").alias("first"), micros("last").alias("last"), "n")
