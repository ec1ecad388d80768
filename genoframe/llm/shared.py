"""What several operators of this subpackage use."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Rows of a batch that are worked on at a time.
PART_ROWS = 256


def parts(batches: Iterable[pa.RecordBatch], rows: int = PART_ROWS) -> Iterator[pa.RecordBatch]:
    """The batches in parts of so many rows at most, so that no task makes lists, or hands on results, of a whole batch of texts.

    In the end Arrow gives back what it keeps for other batches, as workers stay for other tasks.
    """
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
        del batch
    pa.default_memory_pool().release_unused()


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def gapless(df: DataFrame, group: str, order: list[Column], name: str, spread: Column, cells: int = 256) -> DataFrame:
    """Add `name`, the row's place (from 0, without gaps) within its group.

    A group may hold any share of all rows: its rows are first dealt over `cells` cells by `spread`,
    numbered within their cell, and shifted by the rows of the group's earlier cells. Only the cells'
    counts are gathered and broadcast: at most groups x cells rows, so the groups' number must be bounded
    (shards, classes). Rows of a cell are numbered by `order`.
    """
    dealt = df.withColumn("_cell", F.pmod(spread, F.lit(cells)).cast("int"))
    counts = dealt.groupBy(group, "_cell").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("_g").orderBy("_c").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(F.col(group).alias("_g"), F.col("_cell").alias("_c"), "_n").select("_g", "_c", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    numbered = dealt.withColumn("_i", F.row_number().over(Window.partitionBy(group, "_cell").orderBy(*order)) - 1)
    return (
        numbered.join(F.broadcast(starts), F.col(group).eqNullSafe(F.col("_g")) & (F.col("_cell") == F.col("_c")), "left")
        .withColumn(name, F.col("_i") + F.col("_start"))
        .drop("_cell", "_g", "_c", "_i", "_start")
    )
