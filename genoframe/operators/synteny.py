"""Syntenic intervals from anchors: cut, cleaned, merged and stitched."""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections import deque
from heapq import heappop, heappush
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from genoframe.functions.wavefront import Costs
from genoframe.operators.groups import over_groups
from genoframe.operators.intervals import in_stretches, overlap_join, prefixed, without_contained
from genoframe.operators.subdivide import align_in_rounds
from genoframe.sources.fasta import chunked


def _orientation(a: str, b: str) -> Column:
    """Of two anchors with strands {a}_s1, {a}_s2, ...: '+' or '-' where they agree, else the first one's."""
    same = lambda x: F.when(F.col(f"{x}_s1") == F.col(f"{x}_s2"), "+").otherwise("-")
    return F.when(same(a) == same(b), same(a)).otherwise(same(a))


def straddles(a: str, b: str) -> Column:
    return (F.col(f"{a}_s1") == F.col(f"{a}_s2")) != (F.col(f"{b}_s1") == F.col(f"{b}_s2"))


def placed_anchors(anchors: DataFrame, genes: DataFrame) -> DataFrame:
    """anchors(block_id, ord, gene1, gene2) with c1, b1, e1, s1 and c2, ... of both genes; null where a gene has no model.

    Of repeated models the last by `ord` counts. A model without a strand is an error.
    """
    strand = F.when(F.col("strand").isin("+", "-"), F.col("strand")).otherwise(F.raise_error(F.concat(F.lit("no strand: "), F.col("gene"))))
    models = genes.groupBy("gene").agg(F.max_by(F.struct("chrom", "start", "end", strand.alias("strand")), "ord").alias("m"))
    for k in (1, 2):
        own = models.select(F.col("gene").alias(f"gene{k}"), F.col("m.chrom").alias(f"c{k}"), F.col("m.start").alias(f"b{k}"), F.col("m.end").alias(f"e{k}"), F.col("m.strand").alias(f"s{k}"))
        anchors = anchors.join(own, f"gene{k}", "left")
    return anchors


_PLACE = ("c1", "b1", "e1", "s1", "c2", "b2", "e2", "s2")


def _span(rows: DataFrame, a: str, b: str) -> DataFrame:
    c = F.col
    return rows.select(c(f"{a}_c1").alias("t"), F.least(f"{a}_b1", f"{b}_b1").alias("t_start"), F.greatest(f"{a}_e1", f"{b}_e1").alias("t_end"), c(f"{a}_c2").alias("q"), F.least(f"{a}_b2", f"{b}_b2").alias("q_start"), F.greatest(f"{a}_e2", f"{b}_e2").alias("q_end"), _orientation(a, b).alias("strand"), "block_id", straddles(a, b).alias("straddles"))


def anchor_pairs(placed: DataFrame) -> DataFrame:
    """An interval pair for each two neighbouring anchors of a block; pairs with a missing gene are left out."""
    w = Window.partitionBy("block_id").orderBy("ord")
    rows = placed.select("block_id", "ord", *[F.col(x).alias(f"a_{x}") for x in _PLACE], *[F.lead(x).over(w).alias(f"b_{x}") for x in _PLACE], F.lead("ord").over(w).alias("_next"))
    known = F.col("_next").isNotNull()
    for x in ("a_c1", "a_c2", "b_c1", "b_c2"):
        known = known & F.col(x).isNotNull()
    return _span(rows.where(known), "a", "b")


def block_ends(placed: DataFrame) -> DataFrame:
    """An interval pair for each block, from its first anchor to its last; left out if a gene is missing or the ends are on different sequences."""
    place = F.struct(*_PLACE)
    rows = placed.groupBy("block_id").agg(F.min_by(place, "ord").alias("a"), F.max_by(place, "ord").alias("b"))
    rows = rows.select("block_id", *[F.col(f"{s}.{x}").alias(f"{s}_{x}") for s in ("a", "b") for x in _PLACE])
    return _span(rows.where("a_c1 = b_c1 and a_c2 = b_c2"), "a", "b")


def transposed(anchors: DataFrame) -> DataFrame:
    """Anchors with those of the other direction: genes swapped."""
    return anchors.unionByName(anchors.select(*[F.col({"gene1": "gene2", "gene2": "gene1"}.get(c, c)).alias(c) for c in anchors.columns]))


ORDER = ["t_start", "q_start", "t_end", "q_end", "block", "rid"]


class Sorted:
    """Pairs in order, in blocks of bounded size, so that putting in and taking out stay cheap however many there are."""

    SIZE = 512

    def __init__(self):
        self.blocks: list[list[tuple[int, int]]] = [[]]
        self.firsts: list[tuple[int, int]] = [(-1 << 62, 0)]

    def _at(self, x: tuple[int, int]) -> int:
        return bisect_right(self.firsts, x) - 1

    def add(self, x: tuple[int, int]) -> None:
        k = self._at(x)
        insort(self.blocks[k], x)
        if len(self.blocks[k]) > 2 * self.SIZE:
            self.blocks[k : k + 1] = [self.blocks[k][: self.SIZE], self.blocks[k][self.SIZE :]]
            self.firsts.insert(k + 1, self.blocks[k + 1][0])

    def remove(self, x: tuple[int, int]) -> None:
        k = self._at(x)
        del self.blocks[k][bisect_left(self.blocks[k], x)]
        if not self.blocks[k] and k:
            del self.blocks[k], self.firsts[k]

    def about(self, low: tuple[int, int], high: tuple[int, int]) -> int:
        """How many lie between, to a block or so."""
        k, m = self._at(low), self._at(high)
        return (m - k) * self.SIZE + bisect_left(self.blocks[m], high) - bisect_left(self.blocks[k], low)

    def between(self, low: tuple[int, int], high: tuple[int, int]) -> list[int]:
        """Second members of the pairs from low on, before high."""
        k, m = self._at(low), self._at(high)
        parts = [self.blocks[i] for i in range(k, m + 1)]
        parts[-1] = parts[-1][: bisect_left(parts[-1], high)]
        parts[0] = parts[0][bisect_left(parts[0], low) :] if parts[0] else []
        return [n for part in parts for _, n in part]


def trim_overlaps(rows: DataFrame) -> DataFrame:
    """coords(rid, t, q, strand, ...) where a record that begins inside another one on both axes, and ends after it, begins at its end instead.

    Records act in ORDER, with starts as they have become by then. A sweep along the target: before a record acts, all
    that begin before its end are read; it leaves once those still to act begin no earlier. So only records about one
    place are held. A record finds those that begin inside it by their starts on the axis where there are fewer. None acts on one that it
    does not overlap on the target, so each stretch of overlapping records is a sweep of its own.
    """
    keys = ["t", "q", "strand"]
    names = [c for c in rows.columns if c not in keys]
    ts, te, qs, qe = (len(keys) + 1 + names.index(c) for c in ("t_start", "t_end", "q_start", "q_end"))

    def sweep(key, group):
        unread, count = chain(group, [None]), 0
        ahead = next(unread)
        held: dict[int, list] = {}
        on_t, on_q = Sorted(), Sorted()  # (start, number) of all that are held
        to_act: deque[tuple[int, int]] = deque()  # (number, start as it was read)
        acted: list[tuple[int, int]] = []  # heap of (start, number) of those that only wait to leave; a start may be out of date
        while to_act or ahead:
            number, _ = to_act.popleft() if to_act else (count, 0)
            end = held[number][te] if number in held else ahead[te]
            while ahead and (number == count or ahead[ts] < end):
                held[count] = list(ahead)
                on_t.add((ahead[ts], count))
                on_q.add((ahead[qs], count))
                if number != count:
                    to_act.append((count, ahead[ts]))
                ahead, count = next(unread), count + 1
            own = held[number]
            t_range, q_range = ((own[ts] + 1, -1), (end, -1)), ((own[qs] + 1, -1), (own[qe], -1))
            inside = on_t.between(*t_range) if on_t.about(*t_range) <= on_q.about(*q_range) else on_q.between(*q_range)
            for other in inside:
                o = held[other]
                if own[ts] < o[ts] < end < o[te] and own[qs] < o[qs] < own[qe] < o[qe]:
                    on_t.remove((o[ts], other))
                    on_q.remove((o[qs], other))
                    o[ts], o[qs] = end, own[qe]
                    on_t.add((o[ts], other))
                    on_q.add((o[qs], other))
            heappush(acted, (own[ts], number))
            left = to_act[0][1] if to_act else ahead[ts] if ahead else None
            while acted and (left is None or acted[0][0] <= left):
                start, other = heappop(acted)
                o = held[other]
                if o[ts] != start:
                    heappush(acted, (o[ts], other))
                    continue
                on_t.remove((o[ts], other))
                on_q.remove((o[qs], other))
                yield tuple(x for i, x in enumerate(held.pop(other)) if i != len(keys))

    dealt = in_stretches(rows.select(*keys, *names), keys, "t_start", "t_end").select(*keys, "stretch", *names)
    found = over_groups(dealt, [*keys, "stretch"], [c for c in ORDER if c in names], sweep, rows.select(*keys, *names).schema)
    return found.select(*rows.columns)


def polished(rows: DataFrame, bin_size: int) -> DataFrame:
    """Repeated and contained records go, then partial overlaps are trimmed, and both once more. Of equal records the one with the smallest rid stays."""
    keys = ["t", "q", "strand"]
    rows = rows.groupBy(*[c for c in rows.columns if c != "rid"]).agg(F.min("rid").alias("rid")).select(*rows.columns)
    for _ in range(2):
        rows = trim_overlaps(without_contained(rows, "rid", keys, bin_size))
    return rows


MERGED = "t string, t_start long, t_end long, q string, q_start long, q_end long, strand string, block long, status string"


def merge_small(rows: DataFrame, threshold: int) -> DataFrame:
    """coords of each (t, q, strand, block) where a record shorter than the threshold on either axis takes up the first later record that it touches on both.

    What it becomes stands in that record's place and goes on so until it is long enough. A sweep along the target:
    records are read as far as the one at hand reaches, and no more of them are held. Stretches of records that touch are swept apart.
    """
    keys = ["t", "q", "strand", "block"]
    order = ["t_start", "q_start", "t_end", "q_end"]

    def sweep(key, group):
        t, q, strand, block, _ = key
        spans = ({"t": (r[5], r[7]), "q": (r[6], r[8])} for r in group)
        unread, waiting = chain(spans, [None]), deque()
        ahead = next(unread)
        while waiting or ahead:
            if not waiting:
                waiting.append(ahead)
                ahead = next(unread)
            own = waiting.popleft()
            short = any(end - start < threshold for start, end in own.values())
            partner = None
            if short:
                while ahead and ahead["t"][0] <= own["t"][1]:
                    waiting.append(ahead)
                    ahead = next(unread)
                touches = lambda o: all(own[x][0] <= o[x][1] and o[x][0] <= own[x][1] for x in "qt")  # noqa: B023, E731
                partner = next(filter(touches, waiting), None)
            if partner:
                partner.update({x: (min(own[x][0], partner[x][0]), max(own[x][1], partner[x][1])) for x in "qt"})
            else:
                yield t, *own["t"], q, *own["q"], strand, block, "fail" if short else "pass"

    dealt = in_stretches(rows.select(*keys, *order), keys, "t_start", "t_end")
    return over_groups(dealt, [*keys, "stretch"], order, sweep, MERGED)


def stitched(rows: DataFrame, bin_size: int, max_ratio: float = 3.0, keys: tuple[str, ...] = ("t", "q", "strand", "block")) -> DataFrame:
    """The gap records between neighbours of coords(rid, ...): t, t_start, t_end, q, q_start, q_end, strand, block.

    Neighbours by target must be neighbours by query too, with a gap on both axes of which the larger is at most
    max_ratio times the smaller (0: no limit) and which no record of the other strand occupies on both.
    """
    by_t = Window.partitionBy(*keys).orderBy("t_start", "q_start", "rid")
    by_q = Window.partitionBy(*keys).orderBy("q_start", "t_start", "rid")
    c = F.col
    ranked = rows.withColumn("_r", F.row_number().over(by_q))
    gaps = ranked.select("rid", *keys, F.lead("rid").over(by_t).alias("next"), c("t_end").alias("t_start"), F.lead("t_start").over(by_t).alias("t_end"), c("q_end").alias("q_start"), F.lead("q_start").over(by_t).alias("q_end"), (F.lead("_r").over(by_t) - c("_r")).alias("step"))
    t_gap, q_gap = c("t_end") - c("t_start"), c("q_end") - c("q_start")
    gaps = gaps.where((t_gap > 0) & (q_gap > 0) & (F.abs("step") == 1))
    if max_ratio > 0:
        gaps = gaps.where(F.greatest(t_gap, q_gap) <= max_ratio * F.least(t_gap, q_gap))
    # Spans here hold both their ends.
    own = gaps.select("rid", "t", "q", "strand", "t_start", (c("t_end") + 1).alias("t_stop"), "q_start", "q_end")
    other = prefixed(rows.select("t", "q", "strand", "t_start", (c("t_end") + 1).alias("t_stop"), "q_start", "q_end"))
    met = overlap_join(own, other, ["t", "q"], bin_size, ("t_start", "r_t_start"), ("t_stop", "r_t_stop"), levels=2)
    taken = met.where((c("strand") != c("r_strand")) & (c("r_q_start") <= c("q_end")) & (c("r_q_end") >= c("q_start"))).select("rid").distinct()
    return gaps.join(taken, "rid", "left_anti").select("rid", "t", "t_start", "t_end", "q", "q_start", "q_end", "strand", *[k for k in keys if k not in ("t", "q", "strand")])


def halves(rows: DataFrame) -> DataFrame:
    """Each coords record (1-based, ends included) as two: cut in the middle of the target, in proportion on the query.

    On '-' the halves of the query change places. Records of under four bases on an axis are left out.
    """
    c = F.col
    t_n, q_n = c("t_end") - c("t_start") + 1, c("q_end") - c("q_start") + 1
    t_half = F.floor(t_n / 2)
    tm = c("t_start") + t_half
    qm = c("q_start") + F.greatest(F.lit(1), F.least(q_n - 1, F.floor(q_n * t_half / t_n)))
    back = c("strand") == "-"
    part = lambda k, ts, te, qs, qe: F.struct(F.lit(k).alias("half"), ts.alias("t_start"), te.alias("t_end"), qs.alias("q_start"), qe.alias("q_end"))
    first = part(1, c("t_start"), tm, F.when(back, qm + 1).otherwise(c("q_start")), F.when(back, c("q_end")).otherwise(qm))
    second = part(2, tm + 1, c("t_end"), F.when(back, c("q_start")).otherwise(qm + 1), F.when(back, qm).otherwise(c("q_end")))
    rest = [x for x in rows.columns if x not in ("t_start", "t_end", "q_start", "q_end")]
    return rows.where((t_n >= 4) & (q_n >= 4)).select(*rest, F.explode(F.array(first, second)).alias("_h")).select(*rest, "_h.*")


def align_segments(segments: DataFrame, sequences: DataFrame, most_edits: int, rounds: int = 4, max_ratio: float = 0.0) -> tuple[DataFrame, DataFrame]:
    """align_in_rounds() by fewest edits, of sequences(seq_id, seq): a piece of more than most_edits is cut in register and tried in the next round."""
    edits = Costs(mismatch=1, open1=0, extend1=1, open2=0, extend2=1)
    return align_in_rounds(segments, chunked(sequences), most_edits, rounds, max_ratio, edits)


def remaining(segments: DataFrame, done: DataFrame, skipped: DataFrame, id_col: str = "segment_id") -> DataFrame:
    """Segments that are neither aligned nor skipped yet."""
    return segments.join(done.select(id_col).unionByName(skipped.select(id_col)).distinct(), id_col, "left_anti")


def to_parent(records: DataFrame) -> DataFrame:
    """Alignments within segments in the coordinates of their sequences.

    records: q_start, q_end, t_start, t_end (0-based, half-open, within the segment), strand, and the segment's
    seg_t_start, seg_q_start, seg_q_end (1-based, ends included) and q_turned, whether its query was
    reverse-complemented: then query positions are mirrored and the strand changes.
    """
    c = F.col
    length = c("seg_q_end") - c("seg_q_start") + 1
    t, q = c("seg_t_start") - 1, c("seg_q_start") - 1
    return records.withColumns({
        "q_start": q + F.when(c("q_turned"), length - c("q_end")).otherwise(c("q_start")),
        "q_end": q + F.when(c("q_turned"), length - c("q_start")).otherwise(c("q_end")),
        "t_start": t + c("t_start"),
        "t_end": t + c("t_end"),
        "strand": F.when(c("q_turned"), F.when(c("strand") == "+", "-").otherwise("+")).otherwise(c("strand")),
    })


def best_strand(records: DataFrame, keys: list[str], order: str) -> DataFrame:
    """keys, strand of the record with most matches; of equals the first by `order`."""
    return records.groupBy(*keys).agg(F.min_by("strand", F.struct(-F.col("nmatch"), F.col(order))).alias("strand"))
