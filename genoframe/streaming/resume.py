"""Segments worked through as they come, each once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from genoframe.operators.synteny import remaining


def work_through(segments: DataFrame, work: Callable[[DataFrame], DataFrame], results: str, checkpoint: str, id_col: str = "segment_id") -> StreamingQuery:
    """Run work(batch) on the streamed segments that have no result yet and add what it returns to the results.

    A batch writes to a partition of its own number and replaces what an attempt before it has left there, so a
    batch that is run again changes nothing. All that has come is worked through, then the query ends.
    """

    def batch(rows: DataFrame, number: int) -> None:
        spark = rows.sparkSession
        own = remaining(rows.dropDuplicates([id_col]), _others(spark, results, number, id_col, rows), rows.limit(0), id_col)
        work(own).write.mode("overwrite").parquet(f"{results}/batch={number}")

    return segments.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _others(spark: SparkSession, results: str, number: int, id_col: str, like: DataFrame) -> DataFrame:
    """Ids that other batches have results of."""
    try:
        return spark.read.parquet(results).where(F.col("batch") != number).select(id_col)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return like.select(id_col).limit(0)


def job_stream(spark: SparkSession, path: str) -> DataFrame:
    """Streamed (segment_id, target, query) of text files of three fields that come into a folder; other lines are left out."""
    parts = F.split("value", "\t")
    rows = spark.readStream.text(path).where(F.size(parts) == 3)
    return rows.select(parts[0].alias("segment_id"), parts[1].alias("target"), parts[2].alias("query"))


def reasons_so_far(skips: DataFrame) -> DataFrame:
    """Running counts of the streamed skips by reason, for a sink in complete mode."""
    return skips.groupBy("reason").agg(F.count("*").alias("n"))
