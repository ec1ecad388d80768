"""Sets of names: what agrees, what is left out, what occurs twice."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def without(rows: DataFrame, ids: DataFrame, id_col: str) -> DataFrame:
    """rows whose id is not in ids; all of them if there are none."""
    return rows.join(ids.select(id_col), id_col, "left_anti")


def duplicates(rows: DataFrame, *columns: str) -> DataFrame:
    return rows.groupBy(*columns).agg(F.count("*").alias("n")).where("n > 1")


def preflight(genomes: DataFrame) -> DataFrame:
    """(id, problem) of what is wrong with genomes(id, path): an id that comes twice, an empty one, a file of a kind that is not read."""
    twice = F.count("*").over(Window.partitionBy("id")) > 1
    kind = F.lower("path").rlike(r"\.(fasta|fa|fna|fas)(\.(gz|bgz|bgzf|bz2|xz|lzma))?$")
    problem = F.when(F.trim(F.coalesce("id", F.lit(""))) == "", "no id").when(twice, "id comes twice").when(~F.coalesce(kind, F.lit(False)), "unknown kind of file")
    return genomes.select("id", problem.alias("problem")).where("problem is not null").distinct()


def with_proteins(cds: DataFrame, proteins: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pairs, missing): (ord, id, cds, protein) of coding sequences(id, cds) and proteins(ord, id, protein), in the proteins'
    order, and the ids of proteins without a coding sequence."""
    joined = proteins.select("ord", "id", "protein").join(cds.select("id", "cds"), "id", "left")
    return joined.where("cds is not null").select("ord", "id", "cds", "protein").orderBy("ord"), joined.where("cds is null").select("ord", "id")


def differences(a: DataFrame, b: DataFrame, column: str) -> DataFrame:
    """(column, side) of values that only one side has; no rows if both agree."""
    both = a.select(column, F.lit(1).alias("a"), F.lit(0).alias("b")).unionByName(b.select(column, F.lit(0).alias("a"), F.lit(1).alias("b")))
    found = both.groupBy(column).agg(F.max("a").alias("a"), F.max("b").alias("b")).where("a <> b")
    return found.select(column, F.when(F.col("a") == 1, "first").otherwise("second").alias("side"))


def of_pair(segments: DataFrame, a: str, b: str, first: str = "t_genome", second: str = "q_genome") -> DataFrame:
    """Segments between the two genomes, either way round."""
    x, y = F.col(first), F.col(second)
    return segments.where(((x == a) & (y == b)) | ((x == b) & (y == a)))


def of_one(segments: DataFrame, genome: str, first: str = "t_genome", second: str = "q_genome") -> DataFrame:
    return segments.where((F.col(first) == genome) | (F.col(second) == genome))


def usable_segments(segments: DataFrame, max_ratio: float) -> DataFrame:
    """segments with `reason`: null, empty_span or length_ratio, by lengths t_len and q_len."""
    low, high = F.least("t_len", "q_len"), F.greatest("t_len", "q_len")
    return segments.withColumn("reason", F.when(low <= 0, "empty_span").when((F.lit(max_ratio) > 0) & (high > max_ratio * low), "length_ratio"))
