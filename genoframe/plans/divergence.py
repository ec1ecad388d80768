"""Queries over alignments: windows, distances, averages, matrices, variants."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from genoframe.functions import alignments as A
from genoframe.functions.names import genome_of, natural_key
from genoframe.operators import divergence as D
from genoframe.operators import variants as V
from genoframe.operators import windows as W
from genoframe.operators.intervals import smaller_of_reciprocal
from genoframe.plans.registry import query
from genoframe.plans.views import GENOMES, fai, genome_sql, genomes, snps, view, with_views
from genoframe.sources.fasta import slices

SIZE = SLIDE = BIN = 100_000


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


def _windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.make_windows(fai(spark, sf_dir), SIZE, SLIDE)


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "v_paf", "t_name", "t_start", "t_end", "de").select(F.col("t_name").alias("chrom"), F.col("t_start").alias("start"), F.col("t_end").alias("end"), "de")


_PW = with_views("v_paf", "v_fai", "v_windows")
_MET = """
m as (select w.chrom, w.start, w."end", p.de, (least(w."end", p.t_end) - greatest(w.start, p.t_start)) / (w."end" - w.start) as fraction
  from v_windows w join v_paf p on p.t_name = w.chrom and p.t_start < w."end" and p.t_end > w.start)
"""


@query(_PW + _MET + """
select w.chrom, w.start, w."end", coalesce(s.n, 0) as n, round(case when s.n is null then null when s.w = 0 then 0 else s.wv / s.w end, 6) as avg_de
from v_windows w left join (select chrom, start, count(*) as n, sum(fraction) as w, sum(fraction * de) as wv from m group by chrom, start) s on s.chrom = w.chrom and s.start = w.start""")
def window_weighted_divergence(spark, sf_dir):
    return _rounded(W.window_averages(_windows(spark, sf_dir), _scored(spark, sf_dir), BIN), "avg_de")


@query(_PW + "r as (select 1) select chrom, start, \"end\" from v_windows")
def window_generation(spark, sf_dir):
    return _windows(spark, sf_dir)


@query(with_views("v_paf", "v_fai") + """r as (select 1)
select chrom, s as start, least(s + 150000, len) as "end" from (select chrom, len, unnest(range(0, len, 40000)) as s from v_fai)""")
def sliding_windows(spark, sf_dir):
    return W.make_windows(fai(spark, sf_dir), 150_000, 40_000)


@query(_PW + _MET + """
select w.chrom, w.start, w."end", round(m.fraction, 6) as fraction, m.de from v_windows w left join m on m.chrom = w.chrom and m.start = w.start""")
def window_overlaps(spark, sf_dir):
    return _rounded(W.window_overlaps(_windows(spark, sf_dir), _scored(spark, sf_dir), BIN), "fraction")


@query(with_views("v_paf", "v_fai", "v_windows", "v_snps") + """
c as (select w.chrom, w.start, count(*) as snps from v_windows w join v_snps s on s.chrom = w.chrom and w.start <= s.pos and s.pos < w."end" group by 1, 2)
select w.chrom, w.start, w."end", coalesce(c.snps, 0) as snps, round_even(coalesce(c.snps, 0) / (w."end" - w.start), 5) as fraction
from v_windows w left join c on c.chrom = w.chrom and c.start = w.start""")
def snp_windows(spark, sf_dir):
    return W.snp_windows(_windows(spark, sf_dir), snps(spark, sf_dir), SIZE, SLIDE)


@query(with_views("v_paf", "v_fai", "v_snps") + """
w as (select chrom, s as start, least(s + 150000, len) as "end" from (select chrom, len, unnest(range(0, len, 40000)) as s from v_fai)),
c as (select w.chrom, w.start, count(*) as snps from w join v_snps s on s.chrom = w.chrom and w.start <= s.pos - 1 and s.pos - 1 < w."end" group by 1, 2)
select w.chrom, w.start, w."end", coalesce(c.snps, 0) as snps, round_even(coalesce(c.snps, 0) / (w."end" - w.start), 5) as fraction
from w left join c on c.chrom = w.chrom and c.start = w.start""")
def snp_sliding_windows_shifted(spark, sf_dir):
    return W.snp_windows(W.make_windows(fai(spark, sf_dir), 150_000, 40_000), snps(spark, sf_dir), 150_000, 40_000, shift=1)


@query(with_views("v_paf", "v_fai", "v_snps") + """
c as (select f.chrom, f.len, coalesce(s.n, 0) as n from v_fai f left join (select chrom, count(*) as n from v_snps group by 1) s using (chrom))
select chrom, round_even(n / len, 5) as fraction from c union all select 'WholeGenome', round_even(sum(n) / sum(len), 5) from c""")
def snp_report(spark, sf_dir):
    return W.snp_report(fai(spark, sf_dir), snps(spark, sf_dir))


@query(with_views("v_paf", "v_fai") + """
c as (select f.chrom, abs(p.t_end - p.t_start) / f.len as w, p.de from v_paf p join v_fai f on f.chrom = p.t_name)
select chrom, round(sum(w * de) / sum(w), 6) as avg_de from c group by chrom union all select 'WholeGenome', round(sum(w * de) / sum(w), 6) from c""")
def chromosome_report(spark, sf_dir):
    return _rounded(W.chromosome_report(fai(spark, sf_dir), _scored(spark, sf_dir)), "avg_de")


_OTHERS = ("Sb", "Sb_alt", "Os")
_MERGE = with_views("v_paf", "v_fai", "v_windows", "v_genomes") + f"""
p as (select t_name, t_start, t_end, de, {genome_sql('q_name')} as id from v_paf),
m as (select w.chrom, w.start, w."end", p.id, p.de, (least(w."end", p.t_end) - greatest(w.start, p.t_start)) / (w."end" - w.start) as f
  from v_windows w join p on p.t_name = w.chrom and p.t_start < w."end" and p.t_end > w.start where w.chrom like 'Zm%'),
a as (select chrom, start, "end", id, round(sum(f * de) / sum(f), 6) as avg_de from m group by all),
wide as (select chrom, start, "end", max(case when id = 'Sb' then avg_de end) as Sb, max(case when id = 'Sb_alt' then avg_de end) as Sb_alt, max(case when id = 'Os' then avg_de end) as Os from a group by 1, 2, 3)
"""


def _merged(spark, sf_dir):
    rows = genome_of(view(spark, sf_dir, "v_paf", "q_name", "t_name", "t_start", "t_end", "de"), "q_name", genomes(spark), "id")
    rows = rows.where(F.col("t_name").startswith("Zm")).select(F.col("t_name").alias("chrom"), F.col("t_start").alias("start"), F.col("t_end").alias("end"), "de", "id")
    long = W.window_averages_by(_windows(spark, sf_dir), rows, BIN)
    return W.merge_windows(_rounded(long, "avg_de"), list(_OTHERS))


@query(_MERGE + 'select chrom, start, "end", Sb, Sb_alt, Os from wide')
def window_merge(spark, sf_dir):
    return _merged(spark, sf_dir)


@query(_MERGE + """
select chrom, start, "end", 'Sb' as id, Sb as avg_de from wide union all select chrom, start, "end", 'Sb_alt', Sb_alt from wide union all select chrom, start, "end", 'Os', Os from wide""")
def window_unpivot(spark, sf_dir):
    return W.split_windows(_merged(spark, sf_dir), list(_OTHERS))


# -- distances ----------------------------------------------------------------------------------------------

#: Of the derived strings the parts are known, so SQL reads them by regular expressions of its own.
_TOKENS = """
n as (select *, list_sum(list_transform(regexp_extract_all(cg, '([0-9]+)M', 1), lambda x: cast(x as bigint))) as msum,
  regexp_extract_all(cs, '\\*([a-z]{2})', 1) as subs from v_paf),
k as (select *, len(list_filter(subs, lambda x: upper(x) in ('AG', 'GA', 'CT', 'TC'))) as ti, len(subs) as nsub from n)
"""
_K2P = """case when 1 - 2 * (ti / {n}) - ({tv} / {n}) > 0 and 1 - 2 * ({tv} / {n}) > 0 then -0.5 * ln(1 - 2 * (ti / {n}) - ({tv} / {n})) - 0.25 * ln(1 - 2 * ({tv} / {n})) end"""


def _distances(spark, sf_dir, *more):
    return D.with_distance(view(spark, sf_dir, "v_paf", "rid", "cs", "cg", *more))


@query(with_views("v_paf") + _TOKENS + f"select rid, msum, ti, nsub - ti as tv, round({_K2P.format(n='msum', tv='(nsub - ti)')}, 6) as k2p from k")
def k2p_distance(spark, sf_dir):
    return _rounded(_distances(spark, sf_dir).select("rid", "msum", "ti", "tv", "k2p"), "k2p")


#: Positions among aligned bases: :a *xx :b +acg *yy :c -tt :9 has substitutions at a and a + 1 + b, indels at a + 1 + b and a + b + c + 2.
_NEAR = """
p as (select *, cast(regexp_extract(cs, '^:([0-9]+)', 1) as bigint) as a, cast(regexp_extract(cs, '^:[0-9]+\\*..:([0-9]+)', 1) as bigint) as b,
  cast(regexp_extract(cs, ':([0-9]+)-tt', 1) as bigint) as c from k),
f as (select *, (b + 1 <= 1 or c < 0) as adjacent, 1 + b <= 20 as first_out, true as second_out from p),
g as (select *, (case when first_out then 0 else 1 end) as kept1 from f),
h as (select rid, msum, kept1, (case when kept1 = 1 and upper(subs[1]) in ('AG', 'GA', 'CT', 'TC') then 1 else 0 end) as ti, msum - (2 - kept1) as sites from g)
"""


@query(with_views("v_paf") + _TOKENS + "," + _NEAR + f"select rid, ti, kept1 - ti as tv, sites, round({_K2P.format(n='sites', tv='(kept1 - ti)')}, 6) as k2p from h")
def k2p_filtered(spark, sf_dir):
    found = D.with_distance(view(spark, sf_dir, "v_paf", "rid", "cs", "cg"), no_adjacent=True, off_indels=20)
    return _rounded(found.select("rid", "ti", "tv", "sites", "k2p"), "k2p")


@query(with_views("v_paf") + """
c as (select rid, cast(regexp_extract(cs, '^:([0-9]+)', 1) as bigint) + cast(regexp_extract(cs, '^:[0-9]+\\*..:([0-9]+)', 1) as bigint) + cast(regexp_extract(cs, ':([0-9]+)-tt', 1) as bigint) + 9 as same from v_paf)
select rid, same as matches, cast(2 as bigint) as mismatches, cast(3 as bigint) as inserted, cast(2 as bigint) as deleted, cast(2 as bigint) as gaps, round(4 / (same + 4), 6) as de from c""")
def gap_compressed_divergence(spark, sf_dir):
    rows = view(spark, sf_dir, "v_paf", "rid", "cs").select("rid", A.cs_counts(F.col("cs")).alias("c"))
    return rows.select("rid", "c.*", F.round(A.divergence_of_counts(F.col("c")), 6).alias("de"))


@query(with_views("v_paf") + "r as (select 1) select rid, cg from v_paf")
def cigar_from_difference(spark, sf_dir):
    return view(spark, sf_dir, "v_paf", "rid", "cs").select("rid", A.cigar_of(F.col("cs")).alias("cg"))


_WEIGHTS = with_views("v_paf", "v_genomes") + _TOKENS + f""",
g as (select q_name as id1, t_name as id2, msum, de, {genome_sql('q_name')} as g1, {genome_sql('t_name')} as g2 from k),
w as (select id1, id2, g1, g2, msum / sum(msum) over (partition by least(g1, g2), greatest(g1, g2)) as weight, de as value from g)
"""


def _weights(spark, sf_dir, value="de"):
    return D.pair_weights(_distances(spark, sf_dir, "q_name", "t_name", "de"), genomes(spark), value)


@query(_WEIGHTS + "select id1, id2, round(weight, 9) as weight, value from w")
def pair_weights(spark, sf_dir):
    return _weights(spark, sf_dir).withColumn("weight", F.round("weight", 9))


@query(_WEIGHTS + "select least(id1, id2) as id1, greatest(id1, id2) as id2, round(sum(weight), 6) as weight, round(sum(weight * value) / sum(weight), 6) as avg from w group by 1, 2")
def chromosome_pair_averages(spark, sf_dir):
    return _rounded(D.chromosome_averages(_weights(spark, sf_dir)), "weight", "avg")


_GENOME_AVERAGES = _WEIGHTS.rstrip() + ", a as (select least(g1, g2) as id1, greatest(g1, g2) as id2, round(sum(weight * value) / sum(weight), 6) as avg from w group by 1, 2)"


@query(_GENOME_AVERAGES + " select * from a")
def genome_pair_averages(spark, sf_dir):
    return _rounded(D.genome_averages(_weights(spark, sf_dir), genomes(spark)).select("id1", "id2", "avg"), "avg")


def _matrix(spark, sf_dir):
    pairs = _rounded(D.genome_averages(_weights(spark, sf_dir), genomes(spark)), "avg")
    return D.symmetric(pairs.withColumn("ord", F.lit(0)), "avg")


@query(_GENOME_AVERAGES + """, b as (select id1 as i, id2 as j, avg as d from a union all select id2, id1, avg from a union all select distinct id1, id1, 0.0 from (select id1 from a union select id2 from a))
select i, max(case when j = 'Os' then d end) as Os, max(case when j = 'Sb' then d end) as Sb, max(case when j = 'Sb_alt' then d end) as Sb_alt, max(case when j = 'Zm' then d end) as Zm from b group by i""")
def distance_matrix(spark, sf_dir):
    return D.square(_matrix(spark, sf_dir), sorted(GENOMES))


@query(with_views("v_paf", "v_fai", "v_genomes") + f"r as (select 1) select chrom, {genome_sql('chrom')} as genome from v_fai")
def genome_of_sequence(spark, sf_dir):
    return genome_of(fai(spark, sf_dir).select("chrom"), "chrom", genomes(spark), "genome")


@query(with_views("v_paf", "v_fai", "v_genomes") + f"""
z as (select {genome_sql('chrom')} as genome, sum(len) as genome_len from v_fai group by 1)
select p.rid, f.len as q_len, g.len as t_len, zq.genome_len as q_genome_len, zt.genome_len as t_genome_len
from v_paf p join v_fai f on f.chrom = p.q_name join v_fai g on g.chrom = p.t_name
join z zq on zq.genome = {genome_sql('p.q_name')} join z zt on zt.genome = {genome_sql('p.t_name')}""")
def adjusted_lengths(spark, sf_dir):
    found = D.adjust_lengths(view(spark, sf_dir, "v_paf", "rid", "q_name", "q_len", "t_name", "t_len"), fai(spark, sf_dir), genomes(spark))
    return found.select("rid", "q_len", "t_len", "q_genome_len", "t_genome_len")


@query(with_views("v_paf", "v_genomes") + f"""
g as (select *, {genome_sql('q_name')} as g1, {genome_sql('t_name')} as g2 from v_paf)
select case when g1 = 'Sb' then g2 else g1 end as other, case when g1 = 'Sb' then q_name else t_name end as chrom, case when g1 = 'Sb' then q_start else t_start end as start, case when g1 = 'Sb' then q_end else t_end end as "end", de
from g where g1 = 'Sb' or g2 = 'Sb'""")
def reference_subset(spark, sf_dir):
    return D.reference_bed(view(spark, sf_dir, "v_paf", "q_name", "q_start", "q_end", "t_name", "t_start", "t_end", "de"), "Sb", genomes(spark))


@query(with_views("v_paf", "v_genomes") + f"""
g as (select *, {genome_sql('q_name')} as g1, {genome_sql('t_name')} as g2, contains(q_name, 'Sb') as on_q from v_paf)
select case when on_q then g2 else g1 end as other, case when on_q then q_name else t_name end as chrom, case when on_q then q_start else t_start end as start, case when on_q then q_end else t_end end as "end", de
from g where on_q or contains(t_name, 'Sb')""")
def reference_subset_strict(spark, sf_dir):
    return D.reference_bed(view(spark, sf_dir, "v_paf", "q_name", "q_start", "q_end", "t_name", "t_start", "t_end", "de"), "Sb", genomes(spark), strict=True)


@query(with_views("v_paf") + """
s as (select q_name as id1, t_name as id2, sum(alnlen) as size from v_paf group by 1, 2)
select least(id1, id2) as id1, greatest(id1, id2) as id2, min(size) as size from s group by 1, 2""")
def reciprocal_sizes(spark, sf_dir):
    sizes = view(spark, sf_dir, "v_paf", "q_name", "t_name", "alnlen").groupBy(F.col("q_name").alias("id1"), F.col("t_name").alias("id2")).agg(F.sum("alnlen").alias("size"))
    return smaller_of_reciprocal(sizes)


@query(with_views("v_paf", "v_fai") + """
d as (select distinct regexp_replace(chrom, '[0-9]+$', '') as stem, cast(regexp_extract(chrom, '([0-9]+)$', 1) as bigint) as n, chrom from v_fai)
select chrom, row_number() over (order by lower(stem), n, stem) as place from d""")
def natural_order(spark, sf_dir):
    return fai(spark, sf_dir).select("chrom", F.row_number().over(Window.orderBy(natural_key(F.col("chrom")), "chrom")).alias("place"))


# -- variants -----------------------------------------------------------------------------------------------

_ABC = """
p as (select *, cast(regexp_extract(cs, '^:([0-9]+)', 1) as bigint) as a, cast(regexp_extract(cs, '^:[0-9]+\\*..:([0-9]+)', 1) as bigint) as b,
  cast(regexp_extract(cs, ':([0-9]+)-tt', 1) as bigint) as c, regexp_extract_all(cs, '\\*([a-z]{2})', 1) as subs from v_paf),
s as (select *, 1 as k, a as dt, a as dq from p union all select *, 2, a + 1 + b, a + 1 + b + 3 from p)
"""
_VARIANTS = with_views("v_paf", "v_genomes") + _ABC + """, v as (
select t_name as ref_contig, t_start + dt as ref_start, t_start + dt + 1 as ref_end, subs[k][1] as ref_allele, subs[k][2] as query_allele, q_name as query_contig,
  case when strand = '+' then q_start + dq else q_end - 1 - dq end as query_start, case when strand = '+' then q_start + dq else q_end - 1 - dq end + 1 as query_end from s)
"""


@query(_VARIANTS + "select * from v")
def variants(spark, sf_dir):
    return V.substitutions(view(spark, sf_dir, "v_paf", "q_name", "q_start", "q_end", "strand", "t_name", "t_start", "cs"))


_COUNTS = _VARIANTS.rstrip() + f""", t as (select least({genome_sql('ref_contig')}, {genome_sql('query_contig')}) as id1, greatest({genome_sql('ref_contig')}, {genome_sql('query_contig')}) as id2, upper(ref_allele || query_allele) as pair from v where upper(ref_allele) <> upper(query_allele)),
n as (select id1, id2, count(*) filter (where pair in ('AG', 'GA', 'CT', 'TC')) as ti, count(*) filter (where pair not in ('AG', 'GA', 'CT', 'TC')) as tv from t group by 1, 2)
"""


def _counts(spark, sf_dir):
    return V.substitution_counts(variants(spark, sf_dir), genomes(spark))


@query(_COUNTS + "select id1, id2, ti, tv from n")
def substitution_counts(spark, sf_dir):
    return _counts(spark, sf_dir)


@query(_COUNTS.rstrip() + f""", z as (select least({genome_sql('q_name')}, {genome_sql('t_name')}) as id1, greatest({genome_sql('q_name')}, {genome_sql('t_name')}) as id2, sum(alnlen) as size from v_paf group by 1, 2)
select n.id1, n.id2, round(case when ti / size + tv / size < 0.75 and 1 - 2 * (ti / size) - tv / size > 0 and 1 - 2 * (tv / size) > 0 then -0.5 * ln((1 - 2 * (ti / size) - tv / size) * sqrt(1 - 2 * (tv / size))) end, 6) as d from n join z on z.id1 = n.id1 and z.id2 = n.id2""")
def variant_distances(spark, sf_dir):
    found = V.counts_and_sizes(view(spark, sf_dir, "v_paf", "q_name", "t_name", "alnlen", "cs"), genomes(spark))
    return _rounded(V.distances(found.select("id1", "id2", "ti", "tv"), found.select("id1", "id2", "size")), "d")


@query(with_views("v_paf") + _ABC + """
select 'ins' as kind, q_name as name, 'acg' as seq, q_start + a + 1 + b as start, q_start + a + 1 + b + 2 as "end" from p
union all select 'del', t_name, 'tt', t_start + a + 1 + b + 1 + c, t_start + a + 1 + b + 1 + c + 1 from p""")
def presence_absence(spark, sf_dir):
    return V.presence_absence(view(spark, sf_dir, "v_paf", "q_name", "q_start", "t_name", "t_start", "cs"), 1)


_CG = """
p as (select *, cast(regexp_extract(cg, '^([0-9]+)M', 1) as bigint) as m1, cast(regexp_extract(cg, 'I([0-9]+)M', 1) as bigint) as m2 from v_paf)
"""


@query(with_views("v_paf") + _CG + """
select 'I' as op, q_name, case when strand = '-' then q_end - m1 - 3 else q_start + m1 end as q_start, case when strand = '-' then q_end - m1 else q_start + m1 + 3 end as q_end, t_name, t_start + m1 as t_start, t_start + m1 as t_end, cast(3 as bigint) as length from p
union all
select 'D', q_name, case when strand = '-' then q_end - m1 - 3 - m2 else q_start + m1 + 3 + m2 end, case when strand = '-' then q_end - m1 - 3 - m2 else q_start + m1 + 3 + m2 end, t_name, t_start + m1 + m2, t_start + m1 + m2 + 2, cast(2 as bigint) from p""")
def indels(spark, sf_dir):
    return V.indels(view(spark, sf_dir, "v_paf", "q_name", "q_start", "q_end", "strand", "t_name", "t_start", "t_end", "cg"), 1)


@query(with_views("v_paf") + _CG + """
select 'I' as op, q_name, case when strand = '-' then q_end - 9 - 2 - m2 - 3 else q_start + m1 end as q_start, case when strand = '-' then q_end - 9 - 2 - m2 else q_start + m1 + 3 end as q_end,
  t_name, case when strand = '-' then t_end - 9 - 2 - m2 - 3 else t_start + m1 end as t_start, case when strand = '-' then t_end - 9 - 2 - m2 else t_start + m1 + 3 end as t_end, cast(3 as bigint) as length from p""")
def indels_strict(spark, sf_dir):
    return V.indels(view(spark, sf_dir, "v_paf", "q_name", "q_start", "q_end", "strand", "t_name", "t_start", "t_end", "cg"), 3, strict=True)


@query(with_views("v_seq") + "r as (select 1) select id, reverse(translate(raw, 'ACGTacgt', 'TGCAtgca')) as rc from v_seq")
def reverse_complement(spark, sf_dir):
    return view(spark, sf_dir, "v_seq").select("id", A.reverse_complement(F.col("raw")).alias("rc"))


@query(with_views("v_seq") + """
s as (select id, raw, unnest(range(0, length(raw), 500)) as start from v_seq),
p as (select id, start, (start // 500) % 2 = 1 as turned, substring(raw, start + 1, 80) as part from s)
select id, start, case when turned then reverse(translate(part, 'ACGTacgt', 'TGCAtgca')) else part end as slice from p""")
def sequence_slices(spark, sf_dir):
    """Eighty bases of every five hundred of each sequence, every other slice of the other strand."""
    seqs = view(spark, sf_dir, "v_seq").select(F.col("id").alias("seq_id"), F.col("raw").alias("seq"))
    starts = F.sequence(F.lit(0).cast("long"), F.length("seq").cast("long") - 1, F.lit(500).cast("long"))
    asked = seqs.where("seq <> ''").select("seq_id", F.explode(starts).alias("start"))
    asked = asked.select("seq_id", "start", (F.col("start") + 80).alias("end"), F.when(F.floor(F.col("start") / 500) % 2 == 1, "-").otherwise("+").alias("strand"))
    return slices(asked, seqs, "strand").select(F.col("seq_id").alias("id"), "start", F.col("seq").alias("slice"))
