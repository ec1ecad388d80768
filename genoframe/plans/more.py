"""Queries over segments, labels and sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from genoframe.functions import alignments as A
from genoframe.functions.align import align_by_tiles
from genoframe.functions.codons import STANDARD
from genoframe.functions.names import genome_of
from genoframe.functions.wavefront import Costs
from genoframe.operators import chains, kaks, scene, seeds, sets, trees, variants
from genoframe.operators.subdivide import align_in_rounds
from genoframe.plans.divergence import _GENOME_AVERAGES, _matrix
from genoframe.plans.registry import query
from genoframe.plans.structure import _LAYOUT, _RUNS, _runs, ribbon_points
from genoframe.plans.views import genome_sql, genomes, view, with_views
from genoframe.scratch import written
from genoframe.sources.fasta import chunked


@query(with_views("v_coords") + "r as (select 1) select rid, substr(sha256(concat_ws('|', t, q, strand)), 1, 12) as segment_id from v_coords")
def segment_ids(spark, sf_dir):
    return view(spark, sf_dir, "v_coords", "rid", "t", "q", "strand").select("rid", A.segment_id(F.col("t"), F.col("q"), F.col("strand")).alias("segment_id"))


@query(with_views("v_paf") + "r as (select 1) select rid, regexp_replace(cg, '^([0-9]+)M3I([0-9]+)M2D9M$', '\\1=3D\\2=2I9=') as cg from v_paf")
def turned_cigars(spark, sf_dir):
    return view(spark, sf_dir, "v_paf", "rid", "cg").select("rid", A.turned_cigar(F.col("cg")).alias("cg"))


@query(with_views("v_paf") + """
p as (select rid, t_start as t, q_start as q, cast(regexp_extract(cg, '^([0-9]+)M', 1) as bigint) as m1, cast(regexp_extract(cg, 'I([0-9]+)M', 1) as bigint) as m2 from v_paf where strand = '+')
select rid, t + m1 as t, q + m1 as q from p union all select rid, t + m1, q + m1 + 3 from p union all select rid, t + m1 + m2, q + m1 + 3 + m2 from p union all select rid, t + m1 + m2 + 2, q + m1 + 3 + m2 from p""")
def breakpoints(spark, sf_dir):
    return variants.breakpoints(view(spark, sf_dir, "v_paf", "rid", "q_start", "strand", "t_start", "cg"), 2)


_PAIR = """
s as (select id, regexp_replace(raw, '[^acgt]', '', 'g') as target from v_seq),
p as (select id, target, regexp_replace(regexp_replace(target, '(.{37})', '\\1a', 'g'), 'ca', 'g', 'g') as query from s where target <> '')
"""


def _pairs(spark, sf_dir, tasks=None):
    """(id, target, query): each sequence and it with a base put in after every 37 and one base for each "ca"; as in _PAIR. tasks: that the texts are dealt into first."""
    rows = view(spark, sf_dir, "v_seq")
    rows = (rows.repartition(tasks, "id") if tasks else rows).select("id", F.regexp_replace("raw", "[^acgt]", "").alias("target"))
    # Conditions that are not worked out before rows are dealt as well as after.
    rows = rows.where(F.when(F.spark_partition_id() >= 0, F.col("target") != "") if tasks else "target <> ''")
    return rows.withColumn("query", F.regexp_replace(F.regexp_replace("target", "(.{37})", "$1a"), "ca", "g"))


@query(with_views("v_seq") + _PAIR + "select id, md5(target) as target, md5(query) as query, length(target) as t_len, length(query) as q_len, true as few from p where query <> ''")
def aligned_segments(spark, sf_dir):
    """Whole sequences, what both are by the alignment's difference string and its CIGAR, and whether it has no more edits than the changes made."""
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    put_in = F.floor(F.length("target") / 37)
    rows = _pairs(spark, sf_dir, tasks).withColumn("made", put_in + 2 * (F.length("target") + put_in - F.length("query")))
    found = align_by_tiles(rows, "id", long=True, keep=("made",))
    return found.select("id", F.md5(A.target_of(F.col("cs"))).alias("target"), F.md5(A.query_of(F.col("cs"))).alias("query"), A.bases_in(F.col("cg"), "MD").alias("t_len"), A.bases_in(F.col("cg"), "MI").alias("q_len"), (F.col("edits") <= F.col("made")).alias("few"))


@query(with_views("v_seq") + _PAIR + """,
n as (select id, target, query, length(regexp_replace(target, '(.{37})', '\\1a', 'g')) as longer from p where query <> '')
select cast(id as varchar) as segment_id, md5(target) as target, md5(query) as query, length(target) as t_len, length(query) as q_len, true as own_cost, true as cheap from n""")
def segments_in_rounds(spark, sf_dir):
    """Whole sequences aligned in rounds with affine gaps: what the pieces spell and cover, whether they cost what their paths do and no more than the changes made.

    A base put in costs a gap of one base, one base in place of two a gap and a difference.
    """
    c, costs = F.col, Costs()
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    pairs = written(_pairs(spark, sf_dir, tasks).where("query <> ''")).select(F.concat(F.lit(""), "id").alias("id"), "target", "query")
    side = lambda x, column: F.struct(F.concat(F.lit(x), "id").alias("seq_id"), c(column).alias("seq"))
    sides = pairs.select(F.explode(F.array(side("t", "target"), side("q", "query"))).alias("s")).select("s.*")
    length = lambda x: F.length(x).cast("long")
    one, longer = F.lit(1).cast("long"), length("target") + F.floor(length("target") / 37)
    segments = pairs.select(
        c("id").alias("segment_id"), F.concat(F.lit("t"), "id").alias("t"), one.alias("t_start"), length("target").alias("t_end"),
        F.concat(F.lit("q"), "id").alias("q"), one.alias("q_start"), length("query").alias("q_end"), F.lit("+").alias("strand"),
    )
    records, _ = align_in_rounds(segments, chunked(sides), 4000, piece=600, long=True)
    gaps = A.total(F.transform(F.filter(A.cg_tokens(c("cg")), lambda x: x["op"].isin("I", "D")), lambda x: F.least(costs.open1 + costs.extend1 * x["n"], costs.open2 + costs.extend2 * x["n"])))
    paid = gaps + costs.mismatch * F.regexp_count("cs", F.lit(r"\*"))
    parts = F.array_sort(F.collect_list(F.struct("t_start", "q_start", A.target_of(c("cs")).alias("t"), A.query_of(c("cs")).alias("q"))))
    whole = records.groupBy("segment_id").agg(parts.alias("p"), F.sum("score").alias("score"), F.bool_and(c("score") == paid).alias("own_cost"), F.sum(c("t_end") - c("t_start")).alias("t_len"), F.sum(c("q_end") - c("q_start")).alias("q_len"))
    made = pairs.select(c("id").alias("_id"), (costs.gap(1) * (longer - length("target")) + (costs.gap(1) + costs.mismatch) * (longer - length("query"))).alias("made"))
    spelled = lambda x: F.md5(F.concat_ws("", F.transform("p", lambda r: r[x])))
    return whole.join(made, c("segment_id") == c("_id")).select("segment_id", spelled("t").alias("target"), spelled("q").alias("query"), "t_len", "q_len", "own_cost", (c("score") <= c("made")).alias("cheap"))


@query()
def sequence_anchors(spark, sf_dir):
    """Anchors of each sequence and its changed copy, by minimizers; no SQL, as minimizers are chosen by hashes of words."""
    return seeds.anchors_of_pairs(_pairs(spark, sf_dir).select(F.col("id").cast("string").alias("pair"), "target", "query"))


@query(with_views("v_paf") + _RUNS.rstrip() + """,
n as (select concat(t_name, '|', q_name) as segment, t_start, t_end, q_start, q_end, row_number() over (partition by t_name, q_name order by t_start, q_start, t_end, q_end) as i from u),
f as (
  select distinct segment, cast(0 as bigint) as i, cast(0 as bigint) as t, cast(0 as bigint) as q, cast(0 as bigint) as pt, cast(0 as bigint) as pq, cast(0 as bigint) as ts, cast(0 as bigint) as te, cast(0 as bigint) as qs, cast(0 as bigint) as qe, false as took from n
  union all
  select n.segment, n.i, case when n.t_start < f.t or n.q_start < f.q then f.t else n.t_end end, case when n.t_start < f.t or n.q_start < f.q then f.q else n.q_end end, f.t, f.q, n.t_start, n.t_end, n.q_start, n.q_end, not (n.t_start < f.t or n.q_start < f.q)
  from f join n on n.segment = f.segment and n.i = f.i + 1)
select segment, pt as t_start, ts as t_end, pq as q_start, qs as q_end, false as seeded from f where took and (ts > pt or qs > pq)
union all select segment, ts, te, qs, qe, true from f where took and (te > ts or qe > qs)
union all select segment, t, 1000000, q, 1000000, false from (select * from f qualify row_number() over (partition by segment order by i desc) = 1) where t < 1000000 or q < 1000000""")
def covering_tiles(spark, sf_dir):
    runs = _runs(spark, sf_dir).select(F.concat_ws("|", "t_name", "q_name").alias("segment"), "t_start", "t_end", "q_start", "q_end")
    return chains.covering_tiles(runs.withColumns({"tl": F.lit(1_000_000).cast("long"), "ql": F.lit(1_000_000).cast("long")}), "segment", "tl", "ql")


@query(_GENOME_AVERAGES + """, b as (select id1 as i, id2 as j, avg as d from a union all select id2, id1, avg from a union all select distinct id1, id1, 0.0 from (select id1 from a union select id2 from a)),
labs as (select 'Zm' as name, 'maize' as label union all select 'Os', 'rice')
select coalesce(x.label, i) as i, coalesce(y.label, j) as j, d from b left join labs x on x.name = i left join labs y on y.name = j""")
def relabelled_matrix(spark, sf_dir):
    key = spark.createDataFrame([("Zm", "maize"), ("Os", "rice")], "name string, label string")
    return trees.relabelled(_matrix(spark, sf_dir), key).select("i", "j", "d")


def _segments(spark, sf_dir):
    rows = view(spark, sf_dir, "v_paf", "rid", "q_name", "q_start", "q_end", "t_name", "t_start", "t_end")
    return genome_of(genome_of(rows, "t_name", genomes(spark), "t_genome"), "q_name", genomes(spark), "q_genome")


_SEGMENTS = with_views("v_paf", "v_genomes") + f"s as (select *, {genome_sql('t_name')} as t_genome, {genome_sql('q_name')} as q_genome from v_paf)\n"


@query(_SEGMENTS + "select rid, 'pair' as kept from s where (t_genome = 'Zm' and q_genome = 'Os') or (t_genome = 'Os' and q_genome = 'Zm') union all select rid, 'one' from s where t_genome = 'Sb' or q_genome = 'Sb'")
def chosen_segments(spark, sf_dir):
    rows = _segments(spark, sf_dir)
    pick = lambda df, name: df.select("rid", F.lit(name).alias("kept"))
    return pick(sets.of_pair(rows, "Zm", "Os"), "pair").unionByName(pick(sets.of_one(rows, "Sb"), "one"))


@query(with_views("v_paf") + """
l as (select rid, t_end - t_start as t_len, (q_end - q_start) % 3000 as q_len from v_paf)
select rid, case when least(t_len, q_len) <= 0 then 'empty_span' when greatest(t_len, q_len) > 4.0 * least(t_len, q_len) then 'length_ratio' end as reason from l""")
def unusable_segments(spark, sf_dir):
    rows = view(spark, sf_dir, "v_paf", "rid", "t_start", "t_end", "q_start", "q_end").select("rid", (F.col("t_end") - F.col("t_start")).alias("t_len"), ((F.col("q_end") - F.col("q_start")) % 3000).alias("q_len"))
    return sets.usable_segments(rows, 4.0).select("rid", "reason")


@query(with_views("v_genes", "v_anchors") + "r as (select 1) select gene from v_genes where gene not in (select gene1 from v_anchors)")
def genes_without_anchor(spark, sf_dir):
    return sets.without(view(spark, sf_dir, "v_genes", "gene"), view(spark, sf_dir, "v_anchors", "gene1").select(F.col("gene1").alias("gene")), "gene")


@query(with_views("v_anchors") + "r as (select 1) select gene1, gene2, count(*) as n from v_anchors group by 1, 2 having count(*) > 1")
def repeated_anchors(spark, sf_dir):
    return sets.duplicates(view(spark, sf_dir, "v_anchors", "gene1", "gene2"), "gene1", "gene2")


@query(with_views("v_paf", "v_coords") + """
a as (select distinct t_name as chrom from v_paf), b as (select distinct t as chrom from v_coords)
select chrom, 'first' as side from a where chrom not in (select chrom from b) union all select chrom, 'second' from b where chrom not in (select chrom from a)""")
def chromosome_disagreement(spark, sf_dir):
    a = view(spark, sf_dir, "v_paf", "t_name").select(F.col("t_name").alias("chrom"))
    return sets.differences(a, view(spark, sf_dir, "v_coords", "t").select(F.col("t").alias("chrom")), "chrom")


@query(with_views("v_paf", "v_fai", "v_coords") + _LAYOUT.format(g="Zm", name="zm").rstrip() + """,
k as (select chrom, len, cast(right(chrom, 1) as bigint) as ord from v_fai where chrom like 'Sb\\_chr%' escape '\\'),
sb as (select *, coalesce(sum(len + 10000) over (order by ord rows between unbounded preceding and 1 preceding), 0) as "offset" from k),
p as (select rid as id, (zm."offset" + t_start) / 5000.0 as a1, (zm."offset" + t_end) / 5000.0 as a2, (sb."offset" + case when strand = '-' then q_end else q_start end) / 5000.0 as b1, (sb."offset" + case when strand = '-' then q_start else q_end end) / 5000.0 as b2
  from v_coords join zm on zm.chrom = t join sb on sb.chrom = q)
select id, printf('M%.4f,%.4f L%.4f,%.4f C%.4f,%.4f %.4f,%.4f %.4f,%.4f L%.4f,%.4f C%.4f,%.4f %.4f,%.4f %.4f,%.4f Z', a1, 0.0, a2, 0.0, a2, 100.0, b2, 100.0, b2, 200.0, b1, 200.0, b1, 100.0, a1, 100.0, a1, 0.0) as path from p""")
def ribbon_paths(spark, sf_dir):
    return scene.ribbon_paths(ribbon_points(spark, sf_dir), 1000.0, 200.0, 5_000_000.0)


_CODONS = f"""
x as (select unnest(['T', 'C', 'A', 'G']) as x, unnest([0, 1, 2, 3]) as i),
code as (select a.x || b.x || c.x as codon, substr('{STANDARD}', 1 + 16 * a.i + 4 * b.i + c.i, 1) as aa from x a, x b, x c),
sense as (select * from code where aa <> '*'),
places as (select unnest([1, 2, 3]) as p),
sites as (select s.codon, sum(case when n.aa = s.aa then 1 else 0 end) / 3.0 as s from sense s, places, x join code n on n.codon = substr(s.codon, 1, p - 1) || x.x || substr(s.codon, p + 1) where substr(s.codon, p, 1) <> x.x group by 1),
orders as (select a.p as p1, b.p as p2 from places a, places b where a.p <> b.p),
w as (select a.codon as a, b.codon as b, substr(a.codon, 1, p1 - 1) || substr(b.codon, p1, 1) || substr(a.codon, p1 + 1) as c1, p2 from sense a, sense b, orders),
v as (select a, b, c1, substr(c1, 1, p2 - 1) || substr(b, p2, 1) || substr(c1, p2 + 1) as c2 from w),
steps as (select a, b, (case when a <> c1 and ca.aa = c1a.aa then 1 else 0 end) + (case when c1 <> c2 and c1a.aa = c2a.aa then 1 else 0 end) + (case when c2 <> b and c2a.aa = cb.aa then 1 else 0 end) as same,
  (case when a <> c1 then 1 else 0 end) + (case when c1 <> c2 then 1 else 0 end) + (case when c2 <> b then 1 else 0 end) as n, c1a.aa = '*' or c2a.aa = '*' as stops
  from v join code ca on ca.codon = a join code cb on cb.codon = b join code c1a on c1a.codon = c1 join code c2a on c2a.codon = c2),
diffs as (select a, b, coalesce(avg(same) filter (where not stops), avg(same)) as syn, coalesce(avg(n - same) filter (where not stops), avg(n - same)) as other from steps group by 1, 2)
"""


@query(with_views("v_seq") + _CODONS.strip() + """,
o as (select id, upper(regexp_replace(raw, '[^acgt]', '', 'g')) as seq from v_seq),
q as (select id || '.' || cast(i // 900 as varchar) as id, substr(seq, i + 1, 900) as one from (select *, unnest(range(0, length(seq), 900)) as i from o)),
r as (select id, one, regexp_replace(one, '([ACGT]{22})[AC]', '\\1T', 'g') as two from q where length(one) >= 3),
k as (select id, substr(one, 3 * i + 1, 3) as a, substr(two, 3 * i + 1, 3) as b from (select *, unnest(range(0, length(one) // 3)) as i from r)),
t as (select k.id, count(*) as codons, sum((u.s + v.s) / 2) as s_sites, sum(syn) as s_diffs, sum(other) as n_diffs from k join sites u on u.codon = a join sites v on v.codon = b join diffs using (a, b) group by 1)
select r.id, coalesce(codons, 0) as codons, round(coalesce(s_diffs, 0), 6) as s_diffs, round(coalesce(n_diffs, 0), 6) as n_diffs,
  round(case when n_diffs / (3 * codons - s_sites) < 0.75 then 0 - 0.75 * ln(1 - 4 * n_diffs / (3 * codons - s_sites) / 3) end, 6) as ka, round(case when s_sites > 0 and s_diffs / s_sites < 0.75 then 0 - 0.75 * ln(1 - 4 * s_diffs / s_sites / 3) end, 6) as ks from r left join t using (id)""")
def ka_ks(spark, sf_dir):
    """All of each sequence, in parts as long as genes, read as codons against itself with bases changed; from the sequences on."""
    texts = view(spark, sf_dir, "v_seq").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "id")
    parts = texts.select("id", F.posexplode(F.regexp_extract_all(F.upper(F.regexp_replace("raw", "[^acgt]", "")), F.lit(".{1,900}"), F.lit(0))).alias("k", "one"))
    rows = parts.select(F.concat_ws(".", "id", "k").alias("id"), "one").where("length(one) >= 3")
    found = kaks.ka_ks(rows.withColumn("two", F.regexp_replace("one", "([ACGT]{22})[AC]", "$1T")), "id", "one", "two")
    return found.select("id", "codons", *[F.round(c, 6).alias(c) for c in ("s_diffs", "n_diffs", "ka", "ks")])
