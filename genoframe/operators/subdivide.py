"""Alignment of long segments by rounds that cut what does not align in one piece.

A round takes its pieces' bases from the chunks that they lie in. Small pieces are aligned with affine gaps; those that cost too much, and large
ones, are cut in register: at exact words that both sides hold once and in the same order, so that a large indel comes to lie in
a piece of its own. Only where there are no such words a piece is halved. Very large pieces are cut first at anchors of minimizers, which are
found chunk by chunk.
"""

from __future__ import annotations

from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from genoframe.functions.align import cuts
from genoframe.functions.alignments import reverse_complement
from genoframe.functions.wavefront import Costs, affine_pairs
from genoframe.operators import seeds
from genoframe.scratch import written
from genoframe.sources.fasta import CHUNK, slices_of_chunks

c = F.col
PIECE = ["segment_id", "t", "t_start", "t_end", "q", "q_start", "q_end", "strand"]


def with_bases(pieces: DataFrame, chunks: DataFrame, size: int = CHUNK) -> DataFrame:
    """pieces with t_seq and q_seq, which is turned where the strand is '-'; null where there are no bases."""
    for side in "tq":
        named = pieces.withColumns({"seq_id": c(side), "start": c(f"{side}_start") - 1, "end": c(f"{side}_end")})
        pieces = slices_of_chunks(named, chunks, size).withColumnRenamed("seq", f"{side}_seq").drop("seq_id", "start", "end")
    return pieces.withColumn("q_seq", F.when(c("strand") == "-", reverse_complement(c("q_seq"))).otherwise(c("q_seq")))


def _parts(t_n: int, q_n: int, places: list[tuple[int, int]], strand: str) -> list[tuple[int, int, int, int]]:
    """(t_start, t_end, q_start, q_end) of the pieces between the places, relative to the piece, 0-based, half-open; query on its own strand."""
    ends = [(0, 0), *places, (t_n, q_n)]
    found = [(a, b, x, y) for (a, x), (b, y) in zip(ends, ends[1:])]
    return found if strand == "+" else [(a, b, q_n - y, q_n - x) for a, b, x, y in found]


def cut_pieces(rows: DataFrame, halve: bool) -> DataFrame:
    """The pieces (PIECE) that rows with bases are cut into: at exact words of both sides. Others stay as they are, with `whole` true, or if `halve` are cut in the middle of both.

    A part with bases on one side alone, such as a large insertion, keeps an end before its start on the other.
    """

    def run(batches):
        for batch in batches:
            out = []
            for *own, t, q in zip(*(col.to_pylist() for col in batch.columns)):
                piece = dict(zip(PIECE, own))
                places = list(cuts(t.upper(), q.upper()))
                whole = not places and not halve
                if not places and halve and min(len(t), len(q)) > 1:
                    places = [(len(t) // 2, max(1, min(len(q) - 1, len(q) * (len(t) // 2) // len(t))))]
                for a, b, x, y in _parts(len(t), len(q), places, piece["strand"]):
                    out.append((piece["segment_id"], piece["t"], piece["t_start"] + a, piece["t_start"] + b - 1, piece["q"], piece["q_start"] + x, piece["q_start"] + y - 1, piece["strand"], whole))
            kinds = [*(batch.schema.field(k).type for k in range(len(PIECE))), pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], t) for k, t in enumerate(kinds)], names=[*PIECE, "whole"])

    rows = rows.select(*PIECE, "t_seq", "q_seq")
    return rows.mapInArrow(run, rows.drop("t_seq", "q_seq").withColumn("whole", F.lit(True)).schema)


def cut_at_anchors(pieces: DataFrame, chunks: DataFrame, size: int = CHUNK, k: int = seeds.K, w: int = seeds.W, most: int = seeds.MOST, least: int = 3, every: int = 1 << 18) -> DataFrame:
    """The pieces (PIECE) that large ones are cut into: at the first and last words of anchors of their own strand that lie in order on both sides.

    Minimizers are found in the parts of the chunks that a piece covers, keyed by the piece, and joined within it. Anchors are taken by target; one that begins before
    the last one's end on either side is left out. A piece without anchors is halved. Anchors go on for about `every` bases, so a piece that is one long anchor is cut too.
    """
    named = pieces.withColumn("_piece", F.concat_ws("|", *PIECE))
    around = k + w

    def sketch(side: str) -> DataFrame:
        asked = named.select(c("_piece"), c(side).alias("_id"), (c(f"{side}_start") - 1).alias("_a"), c(f"{side}_end").alias("_b"))
        asked = asked.withColumn("_chunk", F.explode(F.sequence(F.floor(c("_a") / size), F.floor((c("_b") - 1) / size))))
        asked = asked.select("_piece", "_id", (F.greatest(c("_chunk") * size, c("_a"))).alias("own_a"), F.least((c("_chunk") + 1) * size, c("_b")).alias("own_b"), "_a", "_b")
        spans = asked.select("_piece", "own_a", "own_b", c("_id").alias("seq_id"), F.greatest(c("own_a") - around, c("_a")).alias("start"), F.least(c("own_b") + around, c("_b")).alias("end"))
        bases = slices_of_chunks(spans, chunks, size)
        return seeds.minimizers(bases.select(c("_piece").alias("seq_id"), c("own_a").alias("start"), c("own_b").alias("end"), c("start").alias("first"), c("seq").alias("bases")), k, w, most)

    found = seeds.seeds(sketch("t").withColumn("_piece", c("seq_id")), sketch("q").withColumn("_piece", c("seq_id")), most, ("_piece",))
    strands = named.select(c("_piece").alias("_own"), c("strand").alias("_strand"))
    found = found.join(strands, (c("_piece") == c("_own")) & (c("strand") == c("_strand"))).drop("_own", "_strand")
    found = seeds.anchors(found, k, least=least, keys=("_piece",), every=every)
    # On '-' the query is walked from its end: places are counted from there.
    along = named.join(found.select(c("_piece").alias("_own"), c("t_start").alias("at"), c("t_end").alias("at_end"), c("q_start").alias("qa"), c("q_end").alias("qb")), c("_piece") == c("_own"))
    t0, q0, q1 = c("t_start") - 1, c("q_start") - 1, c("q_end")
    along = along.select("_piece", (c("at") - t0).alias("a"), (c("at_end") - t0).alias("b"), F.when(c("strand") == "-", q1 - c("qb")).otherwise(c("qa") - q0).alias("x"), F.when(c("strand") == "-", q1 - c("qa")).otherwise(c("qb") - q0).alias("y"))
    ahead = Window.partitionBy("_piece").orderBy("a", "x", "b", "y").rowsBetween(Window.unboundedPreceding, -1)
    along = along.withColumns({"b": c("b") - k, "y": c("y") - k})
    along = along.withColumns({"_b": F.max("b").over(ahead), "_y": F.max("y").over(ahead)}).where("_b is null or (a >= _b and x >= _y)")
    places = F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.array(F.struct(c("a").alias("t"), c("x").alias("q")), F.struct(c("b").alias("t"), c("y").alias("q")))))))
    along = along.groupBy(c("_piece").alias("_own")).agg(places.alias("places"))
    t_n, q_n = c("t_end") - t0, q1 - q0
    zero, end = F.struct(F.lit(0).cast("long").alias("t"), F.lit(0).cast("long").alias("q")), F.struct(t_n.alias("t"), q_n.alias("q"))
    ends = F.array_distinct(F.concat(F.array(zero), F.coalesce("places", F.array().cast("array<struct<t:bigint,q:bigint>>")), F.array(end)))
    middle = F.struct(F.floor(t_n / 2).alias("t"), F.floor(q_n / 2).alias("q"))
    parts = named.join(along, c("_piece") == c("_own"), "left").withColumn("_ends", ends)
    parts = parts.withColumn("_ends", F.when(F.size("_ends") <= 2, F.array(zero, middle, end)).otherwise(c("_ends")))
    parts = parts.select(*PIECE, F.explode(F.transform(F.sequence(F.lit(1), F.size("_ends") - 1), lambda i: F.struct(F.element_at("_ends", i).alias("u"), F.element_at("_ends", i + 1).alias("v")))).alias("_p"))
    back = c("strand") == "-"
    new = {"t_start": t0 + c("_p.u.t") + 1, "t_end": t0 + c("_p.v.t"), "q_start": F.when(back, q1 - c("_p.v.q")).otherwise(q0 + c("_p.u.q")) + 1, "q_end": F.when(back, q1 - c("_p.u.q")).otherwise(q0 + c("_p.v.q"))}
    return parts.select(*[new.get(n, c(n)).alias(n) for n in PIECE])


def align_in_rounds(segments: DataFrame, chunks: DataFrame, most: int, rounds: int = 4, max_ratio: float = 0.0, costs: Costs = Costs(), piece: int = 50_000, large: int = 1_000_000, size: int = CHUNK, long: bool = False) -> tuple[DataFrame, DataFrame]:
    """(records, skips) of segments(segment_id, t, t_start, t_end, q, q_start, q_end, strand; 1-based, ends included) of chunks(seq_id, chunk, bases).

    Pieces of up to `piece` bases on both sides, and larger ones without words to cut at, are aligned if that costs at most `most`; others are cut and their parts tried in the
    next round, those over `large` bases at anchors. Only what costs too much and has no words to cut at is halved. What is left after the last round, or has no bases, is a skip with its reason; "gap" where one side alone has
    bases. max_ratio: segments, not pieces, whose sides differ by more are skips too (0: no limit). records: segment_id, t, q, strand, t_start, t_end, q_start, q_end (0-based, half-open, of the
    sequences), score, cg, cs (with the equal bases themselves, if long), nmatch, alnlen. Each round is a job whose result is written, so lineage does not grow.
    """
    chunks = written(chunks)  # every round asks for bases of both sides
    t_n, q_n = c("t_end") - c("t_start") + 1, c("q_end") - c("q_start") + 1
    least, longest = F.least(t_n, q_n), F.greatest(t_n, q_n)
    todo, records, skips = segments.select(*PIECE, F.lit(False).alias("whole")), [], []
    tasks = int(segments.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    skip = lambda rows, reason: skips.append(rows.select(*PIECE, reason.alias("reason")))
    for turn in range(rounds + 1):
        bad: Column = F.when(least <= 0, F.when((longest > 0) & F.lit(turn > 0), "gap").otherwise("empty_span"))
        if max_ratio > 0 and not turn:
            bad = bad.when(longest > max_ratio * least, "length_ratio")
        todo = todo.withColumn("reason", bad)
        skip(todo.where("reason is not null"), c("reason"))
        todo, parts = todo.where("reason is null").drop("reason"), []
        big = todo.where(longest > large)
        if turn < rounds and not big.isEmpty():
            parts.append(cut_at_anchors(big.drop("whole"), chunks, size, every=large // 4).withColumn("whole", F.lit(False)))
            todo = todo.where(longest <= large)
        # Pieces are small rows of much work: they are dealt into as many tasks as a shuffle has.
        rows = written(with_bases(todo, chunks, size).repartition(tasks, "segment_id", "t_start", "q_start"))
        known = c("t_seq").isNotNull() & c("q_seq").isNotNull()
        skip(rows.where(~known), F.lit("no_sequence"))
        small = c("whole") | (longest <= (piece if turn < rounds else large))
        tried = written(affine_pairs(rows.where(known & small), "t_seq", "q_seq", costs, most, long))
        done = tried.where("aln.reason is null")
        records.append(done.select("segment_id", "t", "q", "strand", (c("t_start") - 1).alias("t_start"), "t_end", (c("q_start") - 1).alias("q_start"), "q_end", "aln.score", "aln.cg", "aln.cs", "aln.nmatch", "aln.alnlen"))
        failed, large_ones = tried.where("aln.reason is not null").drop("aln"), rows.where(known & ~small)
        smaller = (t_n > 1) & (q_n > 1) if turn < rounds else F.lit(False)
        skip(failed.where(~smaller), F.lit("too costly"))
        parts.append(cut_pieces(failed.where(smaller), True))
        if turn < rounds:
            parts.append(cut_pieces(large_ones, False))
        else:
            skip(large_ones, F.lit("too costly"))
        todo = written(reduce(DataFrame.unionByName, parts))
        if todo.isEmpty():
            break
    union = lambda found: reduce(DataFrame.unionByName, found)
    return union(records), union(skips)
