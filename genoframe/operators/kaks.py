"""Synonymous and other substitutions of coding sequences, by counting sites and differences.

Pairs are aligned as proteins and laid out as pairs of codons; what two codons count for is a table of 61 x 61 rows, made from the genetic
code and joined, so the sums are an aggregation over pairs of codons. Repeated hits are corrected as for bases of one rate.
"""

from __future__ import annotations

from collections import Counter
from itertools import permutations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from genoframe.functions.codons import CODE, amino_acid
from genoframe.functions.wavefront import Costs, affine_paths
from genoframe.scratch import written

#: Of amino acids: what differs, and gaps.
PROTEIN = Costs(mismatch=4, open1=8, extend1=2, open2=40, extend2=1)
SENSE = [c for c, a in CODE.items() if a != "*"]


def synonymous_sites(codon: str) -> float:
    """Of the codon's three places, how much of them changes without changing the amino acid; changes to a stop do."""
    changed = [codon[:i] + x + codon[i + 1 :] for i in range(3) for x in "TCAG" if x != codon[i]]
    return sum(CODE[c] == CODE[codon] for c in changed) / 3


def differences(a: str, b: str) -> tuple[float, float]:
    """(synonymous, other) steps from codon to codon, a base at a time, as a mean over all orders; orders through a stop count only if there is no other."""
    found = []
    for order in permutations([i for i in range(3) if a[i] != b[i]]):
        at, same, through = a, 0, False
        for i in order:
            to = at[:i] + b[i] + at[i + 1 :]
            same += CODE[to] == CODE[at]
            through = through or CODE[to] == "*"
            at = to
        found.append((through, same, len(order) - same))
    kept = [f for f in found if not f[0]] or found
    return sum(f[1] for f in kept) / len(kept), sum(f[2] for f in kept) / len(kept)


def codon_pairs(spark: SparkSession) -> DataFrame:
    """(a, b, sites, syn, other) of all pairs of sense codons: synonymous sites, as a mean of both, and differences."""
    sites = {c: synonymous_sites(c) for c in SENSE}
    rows = [(a, b, (sites[a] + sites[b]) / 2, *differences(a, b)) for a in SENSE for b in SENSE]
    return spark.createDataFrame(rows, "a string, b string, sites double, syn double, other double")


def _codons(cds: str) -> list[str]:
    cds = cds.upper().replace("U", "T")
    return [cds[i : i + 3] for i in range(0, len(cds) - len(cds) % 3, 3)]


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.StringType()), T.StructField("n", T.LongType())])))
def aligned_codons(first: pd.Series, second: pd.Series) -> pd.Series:
    """Pairs of codons, counted, that the proteins' alignment of least cost puts together."""
    out = []
    pairs = [(_codons(x or ""), _codons(y or "")) for x, y in zip(first, second)]
    for (a, b), (_, path) in zip(pairs, affine_paths([("".join(map(amino_acid, a)), "".join(map(amino_acid, b))) for a, b in pairs], PROTEIN)):
        found, i, j = Counter(), 0, 0
        for op, n in path:
            if op in "=X":
                found.update(zip(a[i : i + n], b[j : j + n]))
            i, j = i + n * (op != "I"), j + n * (op != "D")
        out.append([{"a": p, "b": q, "n": n} for (p, q), n in found.items()])
    return pd.Series(out)


def corrected(p: Column) -> Column:
    """Substitutions a site for a share of differing sites; null from three quarters on."""
    return F.when(p < 0.75, 0 - 0.75 * F.ln(1 - 4 * p / 3))


def ka_ks(pairs: DataFrame, id_col: str, first: str, second: str) -> DataFrame:
    """(id, codons, s_sites, n_sites, s_diffs, n_diffs, ka, ks) of pairs of coding sequences in frame.

    Codons that hold other letters than bases, and stops, are left out, as are bases after the last whole codon. ka and ks are null without sites,
    or where so many differ that no number can be told. Null sequences are empty: no codons. Ids name pairs.
    """
    # Pairs are small rows of much work: they are dealt into as many tasks as a shuffle has.
    tasks = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = pairs.select(F.col(id_col).alias("id"), F.col(first).alias("x"), F.col(second).alias("y")).repartition(tasks, "id")
    rows = written(rows.select("id", aligned_codons("x", "y").alias("p")))
    met = rows.select("id", F.explode("p").alias("p")).select("id", "p.*").join(F.broadcast(codon_pairs(pairs.sparkSession)), ["a", "b"])
    total = lambda x: F.sum(F.col("n") * F.col(x))
    sums = met.groupBy("id").agg(F.sum("n").alias("codons"), total("sites").alias("s_sites"), total("syn").alias("s_diffs"), total("other").alias("n_diffs"))
    found = rows.select(F.col("id").alias("_id")).join(sums, F.col("id") == F.col("_id"), "left").drop("id").na.fill(0)
    share = lambda d, s: F.when(F.col(s) > 0, F.col(d) / F.col(s))
    found = found.withColumn("n_sites", 3 * F.col("codons") - F.col("s_sites"))
    return found.select(F.col("_id").alias(id_col), "codons", "s_sites", "n_sites", "s_diffs", "n_diffs", corrected(share("n_diffs", "n_sites")).alias("ka"), corrected(share("s_diffs", "s_sites")).alias("ks"))
