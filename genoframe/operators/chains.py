"""Collinear chains of alignments and anchors."""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from genoframe.operators.groups import over_groups
from genoframe.operators.intervals import in_stretches

#: Runs are found in so many times the tasks of a shuffle.
SPREAD = 4

BLOCKS = "ref_name string, ref_start long, ref_end long, qry_name string, qry_start long, qry_end long, strand string, n_records long, ref_span long, qry_span long, matched long, aln_len long"


def chain_blocks(paf: DataFrame, max_gap: int = 1_000_000, slack: int = 1000, gap_factor: float = 1.0, min_block: int = 0, min_share: float = 0.0) -> DataFrame:
    """Collinear blocks of each (target, query, strand), with `identity`.

    A record joins the block before it unless a gap on either axis is over max_gap, under -slack, or over
    gap_factor times what the block has aligned so far (0: no such limit). Records are taken by target and query
    start, then end and matches. What a block has aligned makes this a fold over the records in order; it keeps
    nothing but the block at hand. No block passes a gap over max_gap on the target, so each stretch without one is a fold of its own.
    """
    order = ["t_start", "q_start", "t_end", "q_end", "nmatch", "alnlen"]
    keys = ["t_name", "q_name", "strand"]

    def fold(key, records):
        t_name, q_name, strand, _ = key
        named = lambda b: (t_name, b[0], b[1], q_name, b[2], b[3], strand, b[4], b[1] - b[0], b[3] - b[2], b[5], b[6])
        block = None
        for *_, ts, qs, te, qe, matched, aligned in records:
            if block:
                gaps = (ts - block[1], qs - block[3] if strand == "+" else block[2] - qe)
                earned = gap_factor * block[6] if gap_factor > 0 else max_gap
                if max(gaps) > min(max_gap, earned) or min(gaps) < -slack:
                    yield named(block)
                    block = None
            if block:
                block = [min(block[0], ts), max(block[1], te), min(block[2], qs), max(block[3], qe), block[4] + 1, block[5] + matched, block[6] + aligned]
            else:
                block = [ts, te, qs, qe, 1, matched, aligned]
        yield named(block)

    rows = in_stretches(paf.select(*keys, *order), keys, "t_start", "t_end", max_gap)
    found = over_groups(rows, [*keys, "stretch"], order, fold, BLOCKS)
    kept = found.where((F.col("ref_span") >= min_block) & ((F.lit(min_share) <= 0) | (F.col("ref_span") <= 0) | (F.col("aln_len") >= min_share * F.col("ref_span"))))
    return kept.withColumn("identity", F.coalesce(F.try_divide("matched", "aln_len"), F.lit(0.0)))


def collinear_runs(anchors: DataFrame, keys: list[str], slack: int = 100, min_len: int = 0) -> DataFrame:
    """Maximal runs of anchors (t_start, t_end, q_start, q_end, strand) by target order: keys, run, strand, spans, n.

    A run ends at a change of strand, or where the query moves the wrong way by more than slack; both look at the
    anchor before alone. A task sorts its anchors and holds its runs, so keys are dealt over more tasks than a shuffle has.
    """
    order = ["t_start", "t_end", "q_start", "q_end", "strand"]
    w = Window.partitionBy(*keys).orderBy(*order)
    c, tasks = F.col, SPREAD * int(anchors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = anchors.select(*keys, *order).repartition(tasks, *keys).withColumns({f"_{x}": F.lag(x).over(w) for x in ("strand", "q_start", "q_end")})
    goes_on = (c("strand") == c("_strand")) & F.when(c("strand") == "+", c("q_start") >= c("_q_start") - slack).otherwise(c("q_end") <= c("_q_end") + slack)
    rows = rows.withColumn("run", F.sum(F.when(goes_on, 0).otherwise(1)).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    found = rows.groupBy(*keys, "run").agg(F.first("strand").alias("strand"), F.min("t_start").alias("t_start"), F.max("t_end").alias("t_end"), F.min("q_start").alias("q_start"), F.max("q_end").alias("q_end"), F.count("*").alias("n_anchors"))
    return found.where((c("t_end") - c("t_start") >= min_len) & (c("q_end") - c("q_start") >= min_len))


CHAIN = ("t_start", "t_end", "q_start", "q_end", "strand", "n_anchors")


class _Disjoint:
    """Spans that share no base, sorted, so that a new one is looked for among its neighbours."""

    def __init__(self):
        self.starts: list[int] = []
        self.ends: list[int] = []

    def meets(self, start: int, end: int) -> bool:
        k = bisect_right(self.ends, start)
        return k < len(self.starts) and self.starts[k] < end

    def add(self, start: int, end: int) -> None:
        k = bisect_right(self.starts, start)
        self.starts.insert(k, start)
        self.ends.insert(k, end)


def drop_overlaps(chains: DataFrame, key: str) -> DataFrame:
    """Of the chains of each key, longest first, those whose target and query spans meet no chain kept before.

    What is kept is disjoint on both axes, so a chain is looked for by binary search.
    """
    rows = chains.select(key, *CHAIN, (F.col("t_start") - F.col("t_end") + F.col("q_start") - F.col("q_end")).alias("_short"))

    def pick(own, group):
        on_t, on_q = _Disjoint(), _Disjoint()
        for row in group:
            ts, te, qs, qe = row[1:5]
            if not on_t.meets(ts, te) and not on_q.meets(qs, qe):
                on_t.add(ts, te)
                on_q.add(qs, qe)
                yield row[:-1]

    return over_groups(rows, [key], ["_short", "t_start", "q_start", "strand", "t_end", "q_end", "n_anchors"], pick, rows.drop("_short").schema)


def tile(chains: DataFrame, key: str, t_len: str, q_len: str) -> DataFrame:
    """Chains stretched to cover both axes: to the ends, and to the middle of each gap. A key whose query order differs stays as it is.

    A chain's new start is the middle before it and its end the middle after it, so neighbours are enough.
    """
    w = Window.partitionBy(key).orderBy("t_start", "q_start")
    every = Window.partitionBy(key)
    c = F.col
    rows = chains.withColumns({"_pt": F.lag("t_end").over(w), "_pq": F.lag("q_end").over(w), "_nt": F.lead("t_start").over(w), "_nq": F.lead("q_start").over(w), "_bad": F.when(F.lead("q_start").over(w) < c("q_start"), 1).otherwise(0)})
    rows = rows.withColumn("_bad", F.max("_bad").over(every))
    middle = lambda a, b: F.floor((a + b) / 2)
    stays = c("_bad") == 1
    new = {
        "t_start": F.when(stays, c("t_start")).when(c("_pt").isNull(), 0).otherwise(middle(c("_pt"), c("t_start"))),
        "q_start": F.when(stays, c("q_start")).when(c("_pq").isNull(), 0).otherwise(middle(c("_pq"), c("q_start"))),
        "t_end": F.when(stays, c("t_end")).when(c("_nt").isNull(), c(t_len)).otherwise(middle(c("t_end"), c("_nt"))),
        "q_end": F.when(stays, c("q_end")).when(c("_nq").isNull(), c(q_len)).otherwise(middle(c("q_end"), c("_nq"))),
    }
    return rows.select(*[new.get(x, c(x)).cast("long").alias(x) if x in new else c(x) for x in chains.columns])


def inversions(chains: DataFrame, keys: list[str]) -> DataFrame:
    """keys, inversions: how often neighbouring chains differ in strand."""
    w = Window.partitionBy(*keys).orderBy("t_start", "t_end", "q_start", "strand")
    turns = chains.withColumn("_turn", F.when(F.col("strand") != F.lag("strand").over(w), 1).otherwise(0))
    return turns.groupBy(*keys).agg(F.sum("_turn").alias("inversions"))


TILES = "t_start long, t_end long, q_start long, q_end long, seeded boolean"


def covering_tiles(chains: DataFrame, key: str, t_len: str, q_len: str) -> DataFrame:
    """key with the chains and the gaps around them that cover both axes without holes; chains that begin inside what is covered are left out.

    A fold over the chains in order that keeps the covered ends alone.
    """
    rows = chains.select(key, t_len, q_len, "t_start", "t_end", "q_start", "q_end")

    def cover(own, group):
        t = q = 0
        for _, t_all, q_all, ts, te, qs, qe in group:
            if ts < t or qs < q:
                continue
            if ts > t or qs > q:
                yield own[0], t, ts, q, qs, False
            if te > ts or qe > qs:
                yield own[0], ts, te, qs, qe, True
            t, q = te, qe
        if t < t_all or q < q_all:
            yield own[0], t, t_all, q, q_all, False

    return over_groups(rows, [key], ["t_start", "q_start", "t_end", "q_end"], cover, f"{key} {dict(rows.dtypes)[key]}, {TILES}")
