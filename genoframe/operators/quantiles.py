"""Exact quantiles of groups of any size, by rounds of counted ranges."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from genoframe.scratch import written

#: Values that a task may sort for one quantile, and ranges that are counted in a round.
LEFT, RANGES = 1 << 17, 1024


def _with(rows: DataFrame, small: DataFrame, keys: list[str]) -> DataFrame:
    """rows with the other columns of small, for equal keys, nulls too."""
    named = small.withColumnsRenamed({k: f"_k_{k}" for k in keys})
    same = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys], F.lit(True))
    return rows.join(named, same).drop(*[f"_k_{k}" for k in keys])


def quantile(rows: DataFrame, keys: list[str], value: str, share: float, name: str = "q") -> DataFrame:
    """keys, name: the quantile of each group, interpolated between the two values about it, as percentile() does. Nulls and NaN are left out.

    Groups of up to LEFT values are sorted. For a larger one the two places looked for lie in its range of values; a round counts RANGES parts of
    it and goes on in that which holds the place, from its least to its greatest value, until few enough or one value alone are left. So no task ever holds a
    group's values, however many of them are distinct.
    """
    c = F.col
    rows = rows.select(*keys, c(value).cast("double").alias("_v")).where(c("_v").isNotNull() & ~F.isnan("_v"))
    sizes = written(rows.groupBy(*keys).agg(F.count("*").alias("_n"), F.min("_v").alias("_low"), F.max("_v").alias("_high")))
    large = sizes.where(c("_n") > LEFT)
    if large.isEmpty():
        return rows.groupBy(*keys).agg(F.percentile("_v", F.lit(share)).alias(name))
    few = _with(rows, sizes.where(c("_n") <= LEFT).select(*keys), keys).groupBy(*keys).agg(F.percentile("_v", F.lit(share)).alias(name))
    place = F.lit(share) * (c("_n") - 1)
    first = F.floor(place)
    wanted = large.withColumns({"_part": place - first, "_place": F.explode(F.array(first, F.least(first + 1, c("_n") - 1)))}).dropDuplicates([*keys, "_place"])
    wanted = wanted.select(*keys, "_place", "_part", "_low", "_high", F.lit(0).cast("long").alias("_before"), c("_n").alias("_left"))
    many = (c("_left") > LEFT) & (c("_low") < c("_high"))
    done, own = [], [*keys, "_place"]
    while not (open_ := wanted.where(many)).isEmpty():
        done.append(wanted.where(~many))
        met = _with(rows, open_, keys).where(c("_v").between(c("_low"), c("_high")))
        # Halves do not leave the range of doubles.
        part = F.least(F.floor((c("_v") / 2 - c("_low") / 2) / (c("_high") / 2 - c("_low") / 2) * RANGES), F.lit(RANGES - 1))
        counts = met.groupBy(*own, "_part", "_before", part.alias("_range")).agg(F.count("*").alias("_m"), F.min("_v").alias("_low"), F.max("_v").alias("_high"))
        up_to = c("_before") + F.sum("_m").over(Window.partitionBy(*own).orderBy("_range").rowsBetween(Window.unboundedPreceding, 0))
        counts = counts.withColumn("_up", up_to).where((c("_up") > c("_place")) & (c("_up") - c("_m") <= c("_place")))
        wanted = written(counts.select(*own, "_part", "_low", "_high", (c("_up") - c("_m")).alias("_before"), c("_m").alias("_left")))
    wanted = reduce(DataFrame.unionByName, done, wanted)
    alone = wanted.where(c("_low") == c("_high")).select(*own, "_part", c("_low").alias("_value"))
    met = _with(rows, wanted.where(c("_low") < c("_high")), keys).where(c("_v").between(c("_low"), c("_high")))
    sorted_ = met.groupBy(*own, "_part", "_before").agg(F.array_sort(F.collect_list("_v")).alias("_all")).select(*own, "_part", F.get("_all", c("_place") - c("_before")).alias("_value"))
    both = alone.unionByName(sorted_).groupBy(*keys).agg(F.min_by("_value", "_place").alias("_a"), F.max_by("_value", "_place").alias("_b"), F.first("_part").alias("_f"))
    return few.unionByName(both.select(*keys, (c("_a") + c("_f") * (c("_b") - c("_a"))).alias(name)))
