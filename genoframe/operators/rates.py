"""Synonymous rates of genome pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genoframe.operators.quantiles import quantile


def in_range(ks: DataFrame, most: float) -> DataFrame:
    """Rows with 0 < ks < most."""
    return ks.where((F.col("ks") > 0) & (F.col("ks") < most))


def medians(ks: DataFrame, most: float) -> DataFrame:
    """(id1, id2, n, median) of each pair, however many values it has."""
    kept = in_range(ks, most)
    counts = kept.groupBy("id1", "id2").agg(F.count("*").alias("n"))
    return counts.join(quantile(kept, ["id1", "id2"], "ks", 0.5, "median"), ["id1", "id2"])


def axis_limit(ks: DataFrame, keys: list[str], share: float = 0.995, step: float = 0.05, most: float | None = None) -> DataFrame:
    """keys, limit: the interpolated quantile rounded up to a step, at most `most`."""
    found = quantile(ks, keys, "ks", share)
    limit = F.ceil(F.col("q") / step) * step
    return found.select(*keys, (F.least(limit, F.lit(most)) if most is not None else limit).alias("limit"))


def histogram(ks: DataFrame, keys: list[str], width: float) -> DataFrame:
    """keys, bin, n, density."""
    counts = ks.groupBy(*keys, F.floor(F.col("ks") / width).alias("bin")).agg(F.count("*").alias("n"))
    totals = counts.groupBy(*keys).agg(F.sum("n").alias("total"))
    return counts.join(totals, keys).select(*keys, "bin", "n", (F.col("n") / (F.col("total") * width)).alias("density"))


def density(ks: DataFrame, keys: list[str], low: float, high: float, points: int, bandwidth: float, width: float = 0.001) -> DataFrame:
    """keys, x, density: a Gaussian kernel estimate at evenly spaced points.

    Values are first counted in bins of `width`, so the work grows with bins and points, not with rows; a bin is seen
    from points within four bandwidths alone.
    """
    bins = ks.groupBy(*keys, F.floor(F.col("ks") / width).alias("b")).agg(F.count("*").alias("n"))
    totals = bins.groupBy(*keys).agg(F.sum("n").alias("total"))
    step, mid = (high - low) / (points - 1), (F.col("b") + 0.5) * width
    first = F.greatest(F.lit(0), F.ceil((mid - 4 * bandwidth - low) / step))
    last = F.least(F.lit(points - 1), F.floor((mid + 4 * bandwidth - low) / step))
    seen = bins.where(first <= last).withColumn("k", F.explode(F.sequence(first.cast("long"), last.cast("long"))))
    z = (F.lit(low) + F.col("k") * step - mid) / bandwidth
    sums = seen.groupBy(*keys, "k").agg(F.sum(F.col("n") * F.exp(-0.5 * z * z)).alias("s"))
    return sums.join(totals, keys).select(*keys, (F.lit(low) + F.col("k") * step).alias("x"), (F.col("s") / (F.col("total") * bandwidth * (2 * 3.141592653589793) ** 0.5)).alias("density"))
