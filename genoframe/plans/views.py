"""Genome-shaped relations worked out from the tables at hand, by expressions that Spark and the SQL checks share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_GENOME = "case {n} % 4 when 0 then 'Zm' when 1 then 'Sb' when 2 then 'Sb_alt' else 'Os' end"
_BASE = "case {n} % 4 when 0 then 'a' when 1 then 'c' when 2 then 'g' else 't' end"
_Q, _T = _GENOME.format(n="l_suppkey"), _GENOME.format(n="(l_suppkey + 1 + l_linenumber % 3)")
_TEXT = "cast({x} as {text})"


def _text(x: str) -> str:
    return _TEXT.replace("{x}", x)


GENOMES = ("Zm", "Sb", "Sb_alt", "Os")

#: Of each view: its table and its columns. {text} is the engine's type of strings.
VIEWS: dict[str, tuple[str, dict[str, str]]] = {
    "v_paf": (
        "lineitem",
        {
            "rid": "l_orderkey * 10 + l_linenumber",
            "q_name": f"concat({_Q}, '_chr', {_text('l_partkey % 5 + 1')})",
            "q_len": "cast(1000000 as bigint)",
            "q_start": "(l_orderkey * 131 + l_partkey * 17) % 900000",
            "q_end": "(l_orderkey * 131 + l_partkey * 17) % 900000 + cast(l_quantity as bigint) * 200",
            "strand": "case when l_returnflag = 'R' then '-' else '+' end",
            "t_name": f"concat({_T}, '_chr', {_text('l_orderkey % 5 + 1')})",
            "t_len": "cast(1000000 as bigint)",
            "t_start": "(l_orderkey * 137 + l_partkey * 11) % 900000",
            "t_end": "(l_orderkey * 137 + l_partkey * 11) % 900000 + cast(l_quantity as bigint) * 200",
            "nmatch": "cast(l_quantity as bigint) * (150 + l_partkey % 50)",
            "alnlen": "cast(l_quantity as bigint) * 200",
            "de": "l_discount",
            "cs": f"concat(':', {_text('l_partkey % 50 + 1')}, '*', ({_BASE.format(n='l_orderkey')}), ({_BASE.format(n='(l_orderkey + 1 + l_linenumber % 3)')}), ':', {_text('l_suppkey % 70 + 1')}, '+acg*', ({_BASE.format(n='l_partkey')}), ({_BASE.format(n='(l_partkey + 2)')}), ':', {_text('l_orderkey % 30 + 5')}, '-tt:9')",
            "cg": f"concat({_text('l_partkey % 50 + 1 + 1 + l_suppkey % 70 + 1')}, 'M3I', {_text('1 + l_orderkey % 30 + 5')}, 'M2D9M')",
        },
    ),
    "v_ks": ("lineitem", {"id1": _Q, "id2": _T, "ks": "cast((l_orderkey * 7919 + l_partkey * 31) % 25000 as double) / 10000"}),
    "v_coords": (
        "orders",
        {
            "rid": "o_orderkey",
            "t": f"concat('Zm_chr', {_text('o_custkey % 5 + 1')})",
            "t_start": "(o_orderkey * 97) % 500000",
            "t_end": "(o_orderkey * 97) % 500000 + 500 + (o_custkey * 13) % 9000",
            "q": f"concat('Sb_chr', {_text('o_orderkey % 5 + 1')})",
            "q_start": "(o_orderkey * 97) % 500000 + 300",
            "q_end": "(o_orderkey * 97) % 500000 + 800 + (o_custkey * 13) % 9000",
            "strand": "case when o_orderstatus = 'F' then '-' else '+' end",
            "block": "o_orderkey % 7 + 1",
        },
    ),
    "v_genes": (
        "part",
        {
            "gene": f"concat('g', {_text('p_partkey')})",
            "chrom": f"concat(case when p_partkey % 2 = 0 then 'Zm' else 'Sb' end, '_chr', {_text('(p_partkey // 40) % 3 + 1')})",
            "start": "p_partkey * 1000",
            "end": "p_partkey * 1000 + 200 + (p_partkey * 7) % 500",
            "strand": "case when p_partkey % 3 = 0 then '-' else '+' end",
            "ord": "p_partkey",
        },
    ),
    "v_anchors": ("orders", {"block_id": "o_orderkey // 8 + 1", "ord": "o_orderkey", "gene1": f"concat('g', {_text('((o_orderkey * 2) % 240)')})", "gene2": f"concat('g', {_text('((o_orderkey * 2 + o_custkey % 4 * 2 + 1) % 240)')})"}),
    "v_events": ("events", {"chrom": f"concat('Zm_chr', {_text('user_id % 5 + 1')})", "start": "(event_id * 7919) % 1000000", "end": "(event_id * 7919) % 1000000 + 1 + event_id % 300", "kind": "event_type", "event_id": "event_id"}),
    "v_seq": ("documents", {"id": "doc_id", "raw": "translate(lower(text), 'bdefhijklmnopqrsuvwxyz', 'acgtacgtacgtacgtacgtacgt')"}),
}


def view(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The view's columns, or those named; only what they need is read."""
    table, own = VIEWS[name]
    rows = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    exprs = {c: e.replace("{text}", "string").replace("//", "div") for c, e in own.items() if not columns or c in columns}
    return rows.selectExpr(*[f"{e} as `{c}`" for c, e in exprs.items()])


def with_views(*names: str) -> str:
    """The views' SQL as the beginning of a WITH clause; fai and windows come from v_paf."""
    parts = []
    for name in names:
        if name == "v_fai":
            parts.append("v_fai as (select chrom, cast(1000000 as bigint) as len from (select q_name as chrom from v_paf union select t_name from v_paf))")
        elif name == "v_windows":
            parts.append("v_windows as (select chrom, s as start, least(s + 100000, len) as \"end\" from (select chrom, len, unnest(range(0, len, 100000)) as s from v_fai))")
        elif name == "v_snps":
            parts.append("v_snps as (select t_name as chrom, t_start + 1 as pos from v_paf)")
        elif name == "v_genomes":
            parts.append("v_genomes as (select unnest(['Zm', 'Sb', 'Sb_alt', 'Os']) as genome)")
        else:
            table, own = VIEWS[name]
            columns = ", ".join(f'{e.replace("{text}", "varchar")} as "{c}"' for c, e in own.items())
            parts.append(f"{name} as (select {columns} from {table})")
    return "with recursive " + ",\n".join(parts) + ("," if names else "")


def fai(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = view(spark, sf_dir, "v_paf", "q_name", "t_name")
    names = rows.select(F.col("q_name").alias("chrom")).unionByName(rows.select(F.col("t_name").alias("chrom"))).distinct()
    return names.withColumn("len", F.lit(1000000).cast("long"))


def snps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "v_paf", "t_name", "t_start").select(F.col("t_name").alias("chrom"), (F.col("t_start") + 1).alias("pos"))


def genomes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(g,) for g in GENOMES], "genome string")


def genome_sql(name: str) -> str:
    """Longest known id that a name is or begins with, else what precedes the underscore."""
    return f"coalesce((select max_by(genome, length(genome)) from v_genomes where {name} = genome or starts_with({name}, genome || '_')), split_part({name}, '_', 1))"
