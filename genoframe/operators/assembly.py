"""Sequences of an assembly: names, classes, chromosomes."""

from __future__ import annotations

from collections.abc import Callable
from string import ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from genoframe.functions.names import letters, signature
from genoframe.operators.groups import numbered_by_range


def chromosome_of(header: Column) -> tuple[Column, Column]:
    """(number without leading zeros, upper-case letter or null) of headers such as chr01A; null where there is none."""
    pattern = r"(?i)chr(?:omosome)?[\s_]*0*(\d+)([a-z]?)\b"
    number = F.nullif(F.regexp_extract(header, pattern, 1), F.lit(""))
    return number, F.nullif(F.upper(F.regexp_extract(header, pattern, 2)), F.lit(""))


def name_chromosomes(headers: DataFrame, prefix: str, spelled: Callable[[Column], Column] = letters) -> DataFrame:
    """(ord, header, chrom, letter, new) of headers(ord, header) that name a chromosome.

    Within a number the first header of a letter keeps it. Where a number occurs more than once, those without a
    letter, and repeats of a letter, get the next free ones in order: after Z come AA, AB and so on. spelled: the names of numbers over 26.
    """
    number, letter = chromosome_of(F.col("header"))
    rows = headers.select(F.col("ord").cast("long"), "header", number.alias("chrom"), letter.alias("letter")).where("chrom is not null")
    c, every = F.col, Window.partitionBy("chrom")
    first = F.row_number().over(Window.partitionBy("chrom", "letter").orderBy("ord", "header")) == 1
    rows = rows.withColumns({"_own": F.when(first, c("letter")), "_kept": F.collect_set("letter").over(every), "_n": F.count("*").over(every)})
    place = F.row_number().over(Window.partitionBy("chrom", c("_own").isNull()).orderBy("ord", "header"))
    free = F.filter(F.array(*[F.lit(x) for x in ascii_uppercase]), lambda x: ~F.array_contains("_kept", x))
    rows = rows.withColumns({"_place": place, "_free": free})
    # Headers bring single letters only, so all longer names are free.
    given = F.when(c("_place") <= F.size("_free"), F.get("_free", c("_place") - 1)).otherwise(spelled(c("_place") - F.size("_free") + 26))
    rows = rows.withColumn("letter", F.coalesce("_own", F.when(c("_n") > 1, given)))
    return rows.select("ord", "header", "chrom", "letter", F.concat(F.lit(f"{prefix}_chr"), "chrom", F.coalesce("letter", F.lit(""))).alias("new"))


def name_scaffolds(scaffolds: DataFrame, prefix: str, most: int = 13) -> DataFrame:
    """(ord, header, new) of scaffolds(ord, header, length), longest first; names stop before one is over `most` characters.

    The letters left for a number say how many get a name. Scaffolds are numbered by ranges of their order.
    """
    named = max(0, 10 ** max(0, most - len(f"{prefix}_sca")) - 1)
    rows = numbered_by_range(scaffolds.select("ord", "header", "length"), [F.desc("length"), F.asc("ord")], "number").where(F.col("number") <= named)
    return rows.select("ord", "header", F.concat(F.lit(f"{prefix}_sca"), F.col("number").cast("string")).alias("new"))


def survives(headers: DataFrame, prefix: str, most: int = 13) -> DataFrame:
    """(records, chromosomes, ok): whether naming would leave any of headers(ord, header): a chromosome, or room for a scaffold's name."""
    room = len(f"{prefix}_sca1") <= most
    found = headers.agg(F.count("*").alias("records"), F.count_if(chromosome_of(F.col("header"))[0].isNotNull()).alias("chromosomes"))
    return found.withColumn("ok", (F.col("records") > 0) & (F.lit(room) | (F.col("chromosomes") > 0)))


def pair_list(genomes: DataFrame) -> DataFrame:
    """(id1, id2) of every two genomes(ord, genome) in order. The genomes of a study are few."""
    other = genomes.select(F.col("ord").alias("_o"), F.col("genome").alias("id2"))
    return genomes.join(F.broadcast(other), F.col("ord") < F.col("_o")).select(F.col("genome").alias("id1"), "id2")


def renamed_ids(rows: DataFrame, id_col: str, mapping: DataFrame) -> DataFrame:
    """rows whose id before the first colon is replaced by mapping(old, new) where it has one."""
    found = rows.withColumn("_old", F.split_part(F.col(id_col), F.lit(":"), F.lit(1))).join(mapping, F.col("_old") == F.col("old"), "left")
    new = F.when(F.col("new").isNotNull(), F.concat(F.col("new"), F.substring(id_col, F.length("_old") + 1, F.length(id_col)))).otherwise(F.col(id_col))
    return found.withColumn(id_col, new).drop("_old", "old", "new")


def unique_targets(rows: DataFrame, target: str = "target", id_col: str = "id") -> DataFrame:
    """rows(ord, ...) with new_id: of a target that occurs once its id, else the first's id and a running number."""
    w = Window.partitionBy(target)
    ordered = w.orderBy("ord")
    new = F.when(F.count("*").over(w) == 1, F.col(id_col)).otherwise(F.concat(F.first(id_col).over(ordered), F.lit("_"), F.row_number().over(ordered).cast("string")))
    return rows.withColumn("new_id", new)


def numbered(rows: DataFrame, order: list[str], prefix: str) -> DataFrame:
    """rows of a list that people read, with a running number: one task's work."""
    return rows.withColumn("number", F.concat(F.lit(prefix), F.row_number().over(Window.orderBy(*order)).cast("string")))


def lettered(rows: DataFrame, n: str) -> DataFrame:
    return rows.withColumn("letters", letters(F.col(n)))


def length_classes(fai: DataFrame, by_header: bool = True) -> DataFrame:
    """(class, n, mass, median, cum_n, cum_mass, total_n, total_mass, score, fold): classes of sequences, longest median first.

    score is Otsu's between-class variance of log10 of the medians if the classes down to this one are set apart from the
    rest, weighted by their numbers of sequences. Null for the last class. Classes are headers with digits as #, or
    single sequences.
    """
    rows = fai.withColumn("class", signature(F.col("chrom")) if by_header else F.col("chrom"))
    groups = rows.groupBy("class").agg(F.count("*").alias("n"), F.sum("len").alias("mass"), F.median("len").alias("median"), F.min("chrom").alias("_first"))
    weighted = F.col("n") * F.log10(F.greatest("median", F.lit(1.0)))
    ordered, every = Window.orderBy(F.desc("median"), "_first"), Window.partitionBy()
    ahead = ordered.rowsBetween(Window.unboundedPreceding, 0)
    sums = groups.withColumns({"cum_n": F.sum("n").over(ahead), "cum_mass": F.sum("mass").over(ahead), "_cx": F.sum(weighted).over(ahead), "_next": F.lead("median").over(ordered), "total_n": F.sum("n").over(every), "total_mass": F.sum("mass").over(every), "_tx": F.sum(weighted).over(every)})
    w1, w2 = F.col("cum_n"), F.col("total_n") - F.col("cum_n")
    apart = F.try_divide(F.col("_cx"), w1) - F.try_divide(F.col("_tx") - F.col("_cx"), w2)
    score = F.when(w2 > 0, w1 * w2 / (F.col("total_n") * F.col("total_n")) * apart * apart)
    return sums.select("class", "n", "mass", "median", "cum_n", "cum_mass", "total_n", "total_mass", score.alias("score"), F.when(F.col("_next") > 0, F.col("median") / F.col("_next")).alias("fold"))


def best_cut(classes: DataFrame, most: int, min_share: float, min_fold: float) -> float | None:
    """The least median above the best cut; None if no class is fit to be one.

    classes(n, mass, median): a cut sets at most `most` sequences apart, so no more classes than that are sorted; of
    all others only totals count.
    """
    weighted = F.col("n") * F.log10(F.greatest("median", F.lit(1.0)))
    total = classes.agg(F.sum("n").alias("n"), F.sum("mass").alias("mass"), F.sum(weighted).alias("x")).first()
    first = classes.orderBy(F.desc("median")).limit(most + 1).select("n", "mass", "median", weighted.alias("x")).collect()
    best, n, mass, x = None, 0, 0, 0.0
    for k, c in enumerate(first):
        n, mass, x = n + c["n"], mass + c["mass"], x + c["x"]
        after = first[k + 1]["median"] if k + 1 < len(first) else None
        # Nothing is left below the last class, and classes of one median are cut together.
        if n >= total["n"] or not 2 <= n <= most or after == c["median"]:
            continue
        if mass >= min_share * total["mass"] and (not after or c["median"] >= min_fold * after):
            apart = x / n - (total["x"] - x) / (total["n"] - n)
            score = n * (total["n"] - n) / total["n"] ** 2 * apart * apart
            if best is None or score > best[0]:
                best = (score, c["median"])
    return best and best[1]


def chromosomes(fai: DataFrame, most: int = 100, min_share: float = 0.5, min_fold: float = 2.0, pure: float = 0.1, pattern: str | None = None, min_len: int = 0) -> DataFrame:
    """(chrom, len, rule): all sequences if the shortest has `pure` of the longest's length, else the classes above the best cut.

    Headers' classes count before single lengths. No rows if the assembly has no chromosomes. pattern, or else min_len,
    says which sequences are chromosomes and overrides all that. `most` chromosomes at most are told apart.
    """
    ruled = lambda rows, rule: rows.select("chrom", "len", F.lit(rule).alias("rule"))
    if pattern or min_len:
        return ruled(fai.where(F.col("chrom").rlike(pattern)), "pattern") if pattern else ruled(fai.where(F.col("len") >= min_len), "min-length")
    whole = fai.agg(F.count("*").alias("n"), F.min("len").alias("low"), F.max("len").alias("high")).first()
    if 2 <= whole["n"] <= most and whole["low"] >= pure * whole["high"]:
        return ruled(fai, "pure-scale")
    named = fai.withColumn("_class", signature(F.col("chrom")))
    by_header = named.groupBy("_class").agg(F.count("*").alias("n"), F.sum("len").alias("mass"), F.median("len").alias("median"))
    if (cut := best_cut(by_header, most, min_share, min_fold)) is not None:
        return ruled(named.join(by_header.where(F.col("median") >= cut).select("_class"), "_class", "left_semi"), "header-class")
    by_length = fai.groupBy("len").agg(F.count("*").alias("n"), F.sum("len").alias("mass")).withColumn("median", F.col("len").cast("double"))
    cut = best_cut(by_length, most, min_share, min_fold)
    return ruled(fai.where(F.col("len") >= cut) if cut is not None else fai.limit(0), "length-cliff")
