"""Delimited text with the order of its lines.

Files are read in splits. What a line takes from the lines before it (a count, the last value of something) is worked out
part by part of the splits and carried on from one to the next, so neither a file nor a split is one task's.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, split, line_no, line) of text files, gz and bz2 ones too. line_no grows along a file; it is not gapless.

    split is the offset of the part of the file that a line was read with.
    """
    rows = spark.read.text(path).select(F.input_file_name().alias("file"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("_i"), F.col("value").alias("line"))
    return rows.select("file", "split", (F.col("split") * (1 << 20) + F.col("_i") % (1 << 33)).alias("line_no"), "line")


def is_there(spark: SparkSession, path: str) -> bool:
    """Whether Spark finds anything at the path."""
    try:
        spark.read.text(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def fields(rows: DataFrame, separator: str = "\t") -> DataFrame:
    """lines() with their fields as an array f; blank lines and comments (#) are left out."""
    kept = rows.where((F.trim("line") != "") & ~F.col("line").startswith("#"))
    return kept.withColumn("f", F.split(F.col("line"), separator))


def field(k: int, kind: str = "string") -> Column:
    """Field k (from 1) of fields(); null where there is none or it is not of that kind."""
    return F.try_element_at(F.col("f"), F.lit(k)).try_cast(kind)


#: Lines of a part, of a split, that are worked on together.
PART = 1 << 14


def _part() -> Column:
    """Number of a line's part of its split."""
    return F.floor((F.col("line_no") - F.col("split") * (1 << 20)) / PART)


def _with_earlier(rows: DataFrame, of_part: Column, of_all: Column) -> DataFrame:
    """rows(with _lines) with _earlier: of_all, over the parts before, of what of_part says of each of them."""
    parts = rows.groupBy("file", "split", "_lines").agg(of_part.alias("_of_part"))
    ahead = Window.partitionBy("file").orderBy("split", "_lines").rowsBetween(Window.unboundedPreceding, -1)
    earlier = parts.select(F.col("file").alias("_file"), F.col("split").alias("_split"), F.col("_lines").alias("_p"), of_all.over(ahead).alias("_earlier"))
    return rows.join(earlier, (F.col("file") == F.col("_file")) & (F.col("split") == F.col("_split")) & (F.col("_lines") == F.col("_p"))).drop("_file", "_split", "_p")


def _to_here():
    return Window.partitionBy("file", "split", "_lines").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)


def carried(rows: DataFrame, value: Column, as_col: str) -> DataFrame:
    """lines() with the last value that is not null at or before each line of its file."""
    rows = rows.withColumns({"_value": value, "_lines": _part()})
    last = F.max_by("_value", F.when(F.col("_value").isNotNull(), F.col("line_no")))
    rows = _with_earlier(rows, last, F.last("_of_part", ignorenulls=True))
    return rows.withColumn(as_col, F.coalesce(F.last("_value", ignorenulls=True).over(_to_here()), "_earlier")).drop("_value", "_earlier", "_lines")


def counted(rows: DataFrame, where: Column, as_col: str) -> DataFrame:
    """lines() with the number of lines of its file, up to and with each, for which that is true."""
    rows = rows.withColumns({"_one": F.when(where, 1).otherwise(0).cast("long"), "_lines": _part()})
    rows = _with_earlier(rows, F.sum("_one"), F.sum("_of_part"))
    return rows.withColumn(as_col, F.sum("_one").over(_to_here()) + F.coalesce("_earlier", F.lit(0))).drop("_one", "_earlier", "_lines")
