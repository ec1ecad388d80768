"""Joins and folds over intervals.

Joins are on equality of bins. Folds along a chromosome are worked on range by range, with what earlier ranges have
reached carried over, so a chromosome is never one task's.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Bases of a range that is folded by itself.
RANGE = 1 << 20
#: A level's bins are so many times larger than those of the level below.
WIDER = 32
#: Bases from which pieces are summed up before stretches are told.
LEAST_PIECE = 1024
#: Bins of a level that the starts near an interval may spread over; beyond that it goes to the level above.
FEW_BINS = 16


def _bins(start: Column, end: Column, size: int) -> Column:
    return F.sequence(F.floor(start / size), F.floor(F.greatest(end - 1, start) / size))


def _level(length: Column, bin_size: int, levels: int) -> Column:
    """The lowest level whose bins are as long as an interval; the highest for all longer ones."""
    found = F.lit(levels - 1)
    for k in reversed(range(levels - 1)):
        found = F.when(length <= bin_size * WIDER**k, k).otherwise(found)
    return found


def _slots(start: Column, end: Column, bin_size: int, levels: int, own: int, above: tuple[int, int]) -> Column:
    """Numbers that name (bin, level, kind): an interval's bins on its own level, of kind `own`, and, as far as `above`
    = (first step, kind) says, on its own level or the ones above it."""
    level, found = _level(end - start, bin_size, levels), []
    for k in range(levels):
        bins = _bins(start, end, bin_size * WIDER**k)
        for kind, there in ((own, level == k), (above[1], level + above[0] <= k)):
            found.append(F.when(there, _added(bins, 2 * (k + kind * levels))).otherwise(F.array().cast("array<bigint>")))
    return F.concat(*found)


def _added(bins: Column, slot: int) -> Column:
    return F.transform(bins, lambda b: b * 64 + slot)


def overlap_join(left: DataFrame, right: DataFrame, keys: list[str], bin_size: int, starts: tuple[str, str] = ("start", "r_start"), ends: tuple[str, str] = ("end", "r_end"), levels: int = 1, many: bool = False) -> DataFrame:
    """Pairs of left and right rows with equal keys (`key` on the left, `r_key` on the right) whose intervals share a base.

    Both sides are dealt over bins of bin_size bases, so a chromosome is joined bin by bin and the join is on
    equality; a pair that meets in several bins is kept in the first alone. levels: of bins, each WIDER times as large
    as those below, for tables with long intervals: a pair then meets on the level of its longer interval, where neither
    has many bins. many: there are far more pairs than rows, so both sides are dealt into as many tasks as a shuffle has, however small they are.
    """
    (ls, rs), (le, re_) = (F.col(starts[0]), F.col(starts[1])), (F.col(ends[0]), F.col(ends[1]))
    if levels == 1:
        a, b = left.withColumn("_bin", F.explode(_bins(ls, le, bin_size))), right.withColumn("_r_bin", F.explode(_bins(rs, re_, bin_size)))
        number, size = F.col("_bin"), F.lit(bin_size)
    else:
        # Kind 0: the left interval is of this level and the right one of it or below; kind 1: the right one is, the left one is below.
        a = left.withColumn("_bin", F.explode(_slots(ls, le, bin_size, levels, 0, (1, 1))))
        b = right.withColumn("_r_bin", F.explode(_slots(rs, re_, bin_size, levels, 1, (0, 0))))
        number, step = F.floor(F.col("_bin") / 64), F.pmod(F.col("_bin"), F.lit(64)) / 2
        size = F.lit(bin_size) * F.pow(F.lit(WIDER), F.pmod(step, F.lit(levels))).cast("long")
    same = reduce(lambda x, y: x & y, [F.col(k) == F.col(f"r_{k}") for k in keys], F.col("_bin") == F.col("_r_bin"))
    first = number == F.greatest(F.floor(ls / size), F.floor(rs / size))
    if many:
        a, b = a.repartition(int(a.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys, "_bin"), b.hint("merge")
    return a.join(b, same & (ls < re_) & (le > rs) & first).drop("_bin", "_r_bin")


def prefixed(df: DataFrame, prefix: str = "r_") -> DataFrame:
    return df.select([F.col(c).alias(prefix + c) for c in df.columns])


def _near_starts(left: DataFrame, right: DataFrame, reach: Column) -> DataFrame:
    """right with `_low` and `_high`, between which the left starts lie that are near on both ends; rows that none can be near to are left out.

    A left end is its start and a length between the least and the greatest of the left side, so the ends bound the starts too.
    """
    c, length = F.col, F.col("end") - F.col("start")
    lengths = left.agg(F.min(length).alias("_least"), F.max(length).alias("_most"))
    low, high = F.greatest(c("r_start") - reach, c("r_end") - reach - c("_most")), F.least(c("r_start") + reach, c("r_end") + reach - c("_least"))
    return right.where(reach >= 0).crossJoin(F.broadcast(lengths)).withColumns({"_low": low, "_high": high}).where("_low <= _high").drop("_least", "_most")


def _near_pairs(a: DataFrame, b: DataFrame, keys: list[str], reach: Column) -> DataFrame:
    """Pairs of a (_bin) and b (_r_bin) with equal keys and bins that are within reach on both ends.

    Pairs are many more than rows, so both sides are dealt into as many tasks as a shuffle has, however small they are.
    """
    c, tasks = F.col, int(a.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    same = reduce(lambda x, y: x & y, [c(k) == c(f"r_{k}") for k in keys], c("_bin") == c("_r_bin"))
    near = (F.abs(c("start") - c("r_start")) <= reach) & (F.abs(c("end") - c("r_end")) <= reach)
    return a.repartition(tasks, *keys, "_bin").join(b.hint("merge"), same & near).drop("_bin", "_r_bin", "_low", "_high")


def near_join(left: DataFrame, right: DataFrame, keys: list[str], within: int) -> DataFrame:
    """Pairs whose starts and whose ends are at most `within` bases apart; right columns carry the prefix r_.

    Right rows go to the bins of the starts that can be near, three at most, so the join is on equality.
    """
    c, size, reach = F.col, max(1, within), F.lit(within)
    a = left.withColumn("_bin", F.floor(c("start") / size))
    b = _near_starts(left, right, reach).withColumn("_r_bin", F.explode(F.sequence(F.floor(c("_low") / size), F.floor(c("_high") / size))))
    return _near_pairs(a, b, keys, reach)


def near_join_by_share(left: DataFrame, right: DataFrame, keys: list[str], share: float, bin_size: int = 1024, levels: int = 5) -> DataFrame:
    """near_join() within a share of the right interval's length, however long that is.

    A right interval is dealt over the bins of the starts that can be near, on the lowest level where these are few; left
    starts go to their bin on each level.
    """
    c = F.col
    reach = share * (c("r_end") - c("r_start"))
    b = _near_starts(left, right, reach)
    level = _level(c("_high") - c("_low"), bin_size * FEW_BINS, levels)
    size = F.lit(bin_size) * F.pow(F.lit(WIDER), level).cast("long")
    bins = F.transform(F.sequence(F.floor(c("_low") / size), F.floor(c("_high") / size)), lambda b: b * levels + level)
    own = F.array(*[F.floor(c("start") / (bin_size * WIDER**k)) * levels + k for k in range(levels)])
    return _near_pairs(left.withColumn("_bin", F.explode(own)), b.withColumn("_r_bin", F.explode(bins)), keys, reach)


def _joined(rows: DataFrame, small: DataFrame, keys: list[str]) -> DataFrame:
    """rows with the other columns of small, a row for each value of the keys, nulls too."""
    same = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"_s_{k}")) for k in keys])
    return rows.join(small.withColumnsRenamed({k: f"_s_{k}" for k in keys}), same, "left").drop(*[f"_s_{k}" for k in keys])


def _reached(rows: DataFrame, keys: list[str], range_size: int | None) -> DataFrame:
    """rows with _range and _reached: the greatest end of the rows before by start and end; null for the first."""
    local = [*keys, "_range"]
    rows = rows.withColumn("_range", F.floor(F.col("start") / range_size) if range_size else F.lit(0).cast("long"))
    before = Window.partitionBy(*local).orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    if not range_size:
        return rows.withColumn("_reached", F.max("end").over(before))
    ahead = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    tops = rows.groupBy(*local).agg(F.max("end").alias("_top")).withColumn("_carried", F.max("_top").over(ahead)).drop("_top")
    return _joined(rows, tops, local).withColumn("_reached", F.greatest(F.max("end").over(before), "_carried")).drop("_carried")


def in_islands(rows: DataFrame, keys: list[str], range_size: int | None = RANGE) -> DataFrame:
    """rows with `island`, numbered from 1 along each key: intervals that touch or overlap, directly or over others, share one.

    range_size: bases that are numbered by themselves; None for keys of few rows each.
    """
    local = [*keys, "_range"]
    rows = _reached(rows, keys, range_size).withColumn("_new", F.when(F.col("start") <= F.col("_reached"), 0).otherwise(1)).drop("_reached")
    rows = rows.withColumn("island", F.sum("_new").over(Window.partitionBy(*local).orderBy("start", "end").rowsBetween(Window.unboundedPreceding, 0)))
    if range_size:
        ahead = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
        counts = rows.groupBy(*local).agg(F.sum("_new").alias("_n")).withColumn("_ahead", F.coalesce(F.sum("_n").over(ahead), F.lit(0))).drop("_n")
        rows = _joined(rows, counts, local).withColumn("island", F.col("island") + F.col("_ahead")).drop("_ahead")
    return rows.drop("_range", "_new")


def islands(rows: DataFrame, keys: list[str], range_size: int | None = RANGE) -> DataFrame:
    """Unions of intervals that touch or overlap: keys, island, start, end, n."""
    found = in_islands(rows.select(*keys, "start", "end"), keys, range_size)
    return found.groupBy(*keys, "island").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.count("*").alias("n"))


def in_stretches(rows: DataFrame, keys: list[str], start: str, end: str, beyond: int = 0) -> DataFrame:
    """rows with `stretch`: within the keys, rows of different stretches lie over `beyond` bases apart on start and end.

    What a fold carries from row to row, if it never passes such a gap, does not pass from stretch to stretch. So a key with any number of rows is as many groups.
    Starts of one piece of `beyond` bases are never so far apart, so the first start and last end of each piece tell the stretches; rows are not dealt for them.
    """
    if beyond < LEAST_PIECE:
        spans = rows.select(*keys, F.struct(*rows.columns).alias("_row"), F.col(start).alias("start"), (F.col(end) + beyond).alias("end"))
        return in_islands(spans, keys).select("_row.*", F.col("island").alias("stretch"))
    rows = rows.withColumn("_piece", F.floor(F.col(start) / beyond))
    spans = rows.groupBy(*keys, "_piece").agg(F.min(start).alias("start"), (F.max(end) + beyond).alias("end"))
    found = in_islands(spans, keys).select(*keys, "_piece", F.col("island").alias("stretch"))
    return _joined(rows, found, [*keys, "_piece"]).drop("_piece")


def covered_bases(rows: DataFrame, keys: list[str], range_size: int | None = RANGE) -> DataFrame:
    """keys, covered: bases in the union of the intervals. Each adds what it has beyond those before it."""
    found = _reached(rows.select(*keys, "start", "end"), keys, range_size)
    added = F.greatest(F.col("end") - F.greatest("start", "_reached"), F.lit(0))
    return found.groupBy(*keys).agg(F.sum(added).alias("covered"))


def uncovered_share(rows: DataFrame, cover: DataFrame, id_col: str, keys: list[str], bin_size: int) -> DataFrame:
    """rows with `uncovered`: the share of each interval that no interval of cover reaches (0 for empty ones).

    The cover is brought to its islands first, so an interval meets what parts of it are covered, not all that covers them.
    """
    longest = cover.where("start < end").groupBy(*keys, "start").agg(F.max("end").alias("end"))
    other = prefixed(islands(longest, keys).select(*keys, "start", "end"))
    met = overlap_join(rows.select(id_col, *keys, "start", "end"), other, keys, bin_size, levels=2)
    shared = F.greatest(F.least("end", "r_end") - F.greatest("start", "r_start"), F.lit(0))
    covered = met.groupBy(id_col).agg(F.sum(shared).alias("covered"))
    span = F.col("end") - F.col("start")
    share = F.when(span <= 0, 0.0).otherwise(F.greatest(F.lit(0.0), 1 - F.coalesce("covered", F.lit(0)) / span))
    return rows.join(covered, id_col, "left").withColumn("uncovered", share).drop("covered")


def contained(rows: DataFrame, id_col: str, keys: list[str], bin_size: int, first_of_equal: bool = True, levels: int = 3) -> DataFrame:
    """Ids of rows (t_start, t_end, q_start, q_end) that lie in another row of the same keys on both axes.

    Of equal rows the first (by id) stays; with first_of_equal off, all of them go, as each lies in the other. A
    container shares the bin of the row's start, on the level of its own length.
    """
    c = F.col
    own = F.array(*[F.floor(c("t_start") / (bin_size * WIDER**k)) * 8 + k for k in range(levels)])
    inner = rows.withColumn("_bin", F.explode(own))
    level = _level(c("r_t_end") - c("r_t_start"), bin_size, levels)
    size = F.lit(bin_size) * F.pow(F.lit(WIDER), level).cast("long")
    bins = F.transform(F.sequence(F.floor(c("r_t_start") / size), F.floor(c("r_t_end") / size)), lambda b: b * 8 + level)
    outer = prefixed(rows.select(id_col, *keys, "t_start", "t_end", "q_start", "q_end")).where("r_t_start <= r_t_end").withColumn("_r_bin", F.explode(bins))
    inside = (c("r_t_start") <= c("t_start")) & (c("t_end") <= c("r_t_end")) & (c("r_q_start") <= c("q_start")) & (c("q_end") <= c("r_q_end")) & (c("t_start") <= c("t_end")) & (c("q_start") <= c("q_end"))
    equal = (c("r_t_start") == c("t_start")) & (c("t_end") == c("r_t_end")) & (c("r_q_start") == c("q_start")) & (c("q_end") == c("r_q_end"))
    other = ~equal | (c(f"r_{id_col}") < c(id_col)) if first_of_equal else c(f"r_{id_col}") != c(id_col)
    same = c("_bin") == c("_r_bin")
    for k in keys:
        same = same & (c(k) == c(f"r_{k}"))
    return inner.join(outer, same & inside & other, "left_semi").select(id_col).distinct()


def without_contained(rows: DataFrame, id_col: str, keys: list[str], bin_size: int, first_of_equal: bool = True) -> DataFrame:
    return rows.join(contained(rows, id_col, keys, bin_size, first_of_equal), id_col, "left_anti")


def first_between(x: np.ndarray, y: np.ndarray, rank: np.ndarray, most_x: np.ndarray, least_y: np.ndarray) -> np.ndarray:
    """For each question the least rank of the points with x <= most_x and y >= least_y; len(x) where there is none. Ranks are 0 to len(x) - 1.

    Points sorted by x are halved again and again; the points up to most_x are a block of each size or none, and blocks are sorted by y.
    """
    n, order = len(x), np.argsort(x, kind="stable")
    found, upto = np.full(len(most_x), n), np.searchsorted(x[order], most_x, "right")
    levels = np.unique(y)
    place, wanted, span = np.searchsorted(levels, y[order]), np.searchsorted(levels, least_y), len(levels) + 1
    for k in range(n.bit_length()):
        asked = np.flatnonzero((upto >> k) & 1)
        if not len(asked):
            continue
        # Whole blocks of 2^k alone are asked for.
        whole = n >> k << k
        key = (np.arange(whole) >> k) * span + place[:whole]
        by_y = np.argsort(key, kind="stable")
        least = np.minimum.accumulate(rank[order][by_y].reshape(-1, 1 << k)[:, ::-1], axis=1)[:, ::-1].ravel()
        block = (upto[asked] >> k) - 1
        at = np.searchsorted(key[by_y], block * span + wanted[asked])
        has = at < (block + 1) << k
        found[asked[has]] = np.minimum(found[asked[has]], least[at[has]])
    return found


def most_shared(start: np.ndarray, end: np.ndarray, t_start: np.ndarray, t_end: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, shared): of each interval the one of the others (t_start, t_end) that shares most with it, ties to the least order; shared is 0 or less where none does.

    It is one that holds the interval, or the longest within it, or the one that begins before it and ends last, or that ends after it and begins first.
    """
    n, found = len(t_start), []
    by_order = np.argsort(order, kind="stable")
    by_length = np.lexsort((order, t_start - t_end))
    ranks = lambda by: (out := np.empty(n, np.int64), out.__setitem__(by, np.arange(n)))[0]
    padded = lambda by: np.append(by, -1)
    found.append(padded(by_order)[first_between(t_start, t_end, ranks(by_order), start, end)])
    found.append(padded(by_length)[first_between(-t_start, -t_end, ranks(by_length), -start, -end)])
    for a, b, of in ((t_start, t_end, start), (-t_end, -t_start, -end)):
        by = np.argsort(a, kind="stable")
        last = np.lexsort((-order, b))  # of equal ends the least order comes last
        best = np.maximum.accumulate(ranks(last)[by])
        upto = np.searchsorted(a[by], of, "right") - 1
        found.append(np.where(upto >= 0, last[best[upto]], -1))
    which, most = np.zeros(len(start), np.int64), np.zeros(len(start), np.int64)
    for index in found:
        shared = np.where(index >= 0, np.minimum(end, t_end[index]) - np.maximum(start, t_start[index]), 0)
        better = (shared > most) | ((shared == most) & (shared > 0) & (order[index] < order[which]))
        which, most = np.where(better, index, which), np.where(better, shared, most)
    return which, most


def _best_of_bins(rows: DataFrame, painted: DataFrame, keys: list[str], bin_size: int) -> DataFrame:
    """(_id, d, ord, ref), of each bin of an interval (_id, keys, start, end) the painted one (keys, start, end, ord, ref) that shares most with it; d is less what it shares."""
    dealt = lambda df: df.withColumn("_bin", F.explode(_bins(F.col("start"), F.col("end"), bin_size)))
    kind = dict(rows.dtypes)["_id"]

    def best(asked: pa.Table, there: pa.Table) -> pa.Table:
        if not len(asked) or not len(there):
            return pa.table([pa.array([], f.type) for f in (asked.schema.field("_id"), *(pa.field("", t) for t in (pa.int64(), pa.int64(), pa.string())))], names=["_id", "d", "ord", "ref"])
        a, b = ([t[c].to_numpy().astype(np.int64) for c in names] for t, names in ((asked, ("start", "end")), (there, ("start", "end", "ord"))))
        which, shared = most_shared(*a, *b)
        has = shared > 0
        at = pa.array(which[has])
        return pa.table([asked["_id"].filter(pa.array(has)), pa.array(-shared[has]), there["ord"].take(at), there["ref"].take(at)], names=["_id", "d", "ord", "ref"])

    on = [*keys, "_bin"]
    return dealt(rows).groupBy(*on).cogroup(dealt(painted).groupBy(*on)).applyInArrow(best, f"_id {kind}, d long, ord long, ref string")


def best_overlap(rows: DataFrame, painted: DataFrame, id_col: str, keys: list[str], bin_size: int) -> DataFrame:
    """rows with `ref` of the painted interval (ord, ref) that shares most bases, ties to the lower ord; else of the nearest one.

    The nearest are the last end before and the first start after an interval. They are looked for in the range of the
    interval's own end, with the last one of all ranges before carried over; ends after are the same on a turned axis. Overlaps are
    looked for bin by bin, by sorting, so that work grows with the intervals and not with their pairs.
    """
    c, row = F.col, F.struct("*").alias("row")
    none = F.lit(None)
    known = painted.select(*keys, "start", "end", c("ord").cast("long").alias("ord"), c("ref").cast("string").alias("ref"))
    sized = known.where("start < end").groupBy(*keys, "start", "end").agg(F.min(F.struct("ord", "ref")).alias("x")).select(*keys, "start", "end", "x.*")
    proper = _best_of_bins(rows.where("start < end").select(c(id_col).alias("_id"), *keys, "start", "end"), sized, keys, bin_size)
    # Empty intervals are met one by one.
    met = reduce(DataFrame.unionByName, [overlap_join(a.select(c(id_col).alias("_id"), *keys, "start", "end"), prefixed(b), keys, bin_size) for a, b in ((rows.where("start >= end"), known), (rows.where("start < end"), known.where("start >= end")))])
    less = F.greatest("start", "r_start") - F.least("end", "r_end")
    shared = proper.unionByName(met.select("_id", less.alias("d"), c("r_ord").alias("ord"), c("r_ref").alias("ref")))
    shared = shared.groupBy("_id").agg(F.min(F.struct("d", "ord", "ref")).alias("x"))
    empty = none.cast(rows.select(row).schema["row"].dataType).alias("row")
    shared = shared.select("_id", empty, F.lit(0).alias("far"), "x.d", "x.ord", "x.ref")

    # ask 1: an interval that looks back from `at`; ask 0: a painted one that ends there. Way 1 has the axis turned.
    both = lambda a, b: F.explode(F.array(F.struct(F.lit(0).alias("way"), a.alias("at")), F.struct(F.lit(1).alias("way"), (-b).alias("at"))))
    asks = rows.select(*keys, row, both(c("start"), c("end")).alias("_p")).select(*keys, "_p.*", F.lit(1).alias("ask"), "row", none.cast("long").alias("ord"), none.cast("string").alias("ref"))
    ends = known.select(*keys, both(c("end"), c("start")).alias("_p"), "ord", "ref").groupBy(*keys, "_p").agg(F.min(F.struct("ord", "ref")).alias("_x"))
    ends = ends.select(*keys, "_p.*", F.lit(0).alias("ask"), none.cast(rows.select(row).schema["row"].dataType).alias("row"), "_x.ord", "_x.ref")
    points = asks.unionByName(ends).withColumn("_range", F.floor(c("at") / RANGE))
    local = [*keys, "way", "_range"]
    end = F.when(c("ask") == 0, F.struct("at", (-c("ord")).alias("less"), "ref"))
    ahead = Window.partitionBy(*keys, "way").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carried = points.groupBy(*local).agg(F.max(end).alias("_last")).withColumn("_carried", F.last("_last", True).over(ahead)).drop("_last")
    look = Window.partitionBy(*local).orderBy("at", "ask", F.desc("ord")).rowsBetween(Window.unboundedPreceding, 0)
    near = _joined(points, carried, local).withColumn("_near", F.coalesce(F.last(end, True).over(look), "_carried")).where("ask = 1")
    # An interval without any painted one on its key stays, without a ref.
    near = near.select(c(f"row.{id_col}").alias("_id"), "row", F.when(c("_near").isNull(), 2).otherwise(1).alias("far"), (c("at") - c("_near.at")).alias("d"), (-c("_near.less")).alias("ord"), c("_near.ref").alias("ref"))
    found = shared.unionByName(near).groupBy("_id").agg(F.first("row", ignorenulls=True).alias("row"), F.min(F.struct("far", "d", "ord", "ref")).alias("x"))
    return found.select("row.*", "x.ref")


def smaller_of_reciprocal(sizes: DataFrame) -> DataFrame:
    """Of (id1, id2, size) in both directions: the smaller size of each unordered pair."""
    return sizes.groupBy(F.least("id1", "id2").alias("id1"), F.greatest("id1", "id2").alias("id2")).agg(F.min("size").alias("size"))
