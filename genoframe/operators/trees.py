"""Trees of distance matrices. A matrix has a row for each genome of a study, so it is worked on by itself."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Most genomes of a matrix that is made into a tree.
MOST_TAXA = 500


def _average_linkage(names: list[str], d: dict[tuple[str, str], float]) -> str:
    clusters = {n: (n, 1, 0.0) for n in names}  # label to (text, size, height)
    get = lambda a, b: d[(a, b) if (a, b) in d else (b, a)]
    while len(clusters) > 1:
        keys = sorted(clusters)
        a, b = min(((x, y) for i, x in enumerate(keys) for y in keys[i + 1 :]), key=lambda p: (get(*p), p))
        (ta, na, ha), (tb, nb, hb) = clusters.pop(a), clusters.pop(b)
        height = get(a, b) / 2
        new = f"({a},{b})"
        for c in clusters:
            d[(new, c)] = (get(a, c) * na + get(b, c) * nb) / (na + nb)
        clusters[new] = (f"({ta}:{height - ha:.6g},{tb}:{height - hb:.6g})", na + nb, height)
    return next(iter(clusters.values()))[0] + ";"


def _neighbour_joining(names: list[str], d: dict[tuple[str, str], float]) -> str:
    text, live = {n: n for n in names}, sorted(names)
    get = lambda a, b: 0.0 if a == b else d[(a, b) if (a, b) in d else (b, a)]
    while len(live) > 2:
        n, sums = len(live), {a: sum(get(a, b) for b in live) for a in live}
        a, b = min(((x, y) for i, x in enumerate(live) for y in live[i + 1 :]), key=lambda p: ((n - 2) * get(*p) - sums[p[0]] - sums[p[1]], p))
        la = get(a, b) / 2 + (sums[a] - sums[b]) / (2 * (n - 2))
        new = f"({a},{b})"
        text[new] = f"({text[a]}:{la:.6g},{text[b]}:{get(a, b) - la:.6g})"
        for c in live:
            if c not in (a, b):
                d[(new, c)] = (get(a, c) + get(b, c) - get(a, b)) / 2
        live = sorted([c for c in live if c not in (a, b)] + [new])
    if len(live) == 1:
        return text[live[0]] + ";"
    a, b = live
    return f"({text[a]}:{get(a, b) / 2:.6g},{text[b]}:{get(a, b) / 2:.6g});"


def newick(matrix: DataFrame, method: str = "upgma", keys: tuple[str, ...] = ()) -> DataFrame:
    """keys, tree of the long matrices (i, j, d): average linkage, or neighbour joining with method "nj"."""
    build = {"upgma": _average_linkage, "nj": _neighbour_joining}[method]

    def tree(group: pd.DataFrame) -> pd.DataFrame:
        names = sorted(set(group.i))
        if len(names) > MOST_TAXA:
            raise ValueError(f"{len(names)} genomes; at most {MOST_TAXA} are made into a tree")
        d = {(r.i, r.j): float(r.d) for r in group.itertuples() if r.i < r.j}
        return pd.DataFrame([[*(group[k].iloc[0] for k in keys), build(names, d)]], columns=[*keys, "tree"])

    kinds = dict(matrix.dtypes)
    schema = ", ".join([*(f"{k} {kinds[k]}" for k in keys), "tree string"])
    return matrix.groupBy(*keys).applyInPandas(tree, schema) if keys else matrix.groupBy(F.lit(0).alias("_all")).applyInPandas(tree, schema)


def in_years(matrix: DataFrame, rate: float) -> DataFrame:
    """Distances as rounded times: distance over rate (average linkage halves them again)."""
    return matrix.withColumn("d", F.bround(F.col("d") / rate))


def without_decimals(tree: str) -> str:
    return re.sub(r"\.\d+", "", tree)


def relabelled(matrix: DataFrame, names: DataFrame) -> DataFrame:
    """(i, j, d) with the names(name, label) of a key; a name without a label stays."""
    for c in ("i", "j"):
        matrix = matrix.join(names.select(F.col("name").alias(c), F.col("label").alias("_label")), c, "left").withColumn(c, F.coalesce("_label", c)).drop("_label")
    return matrix
