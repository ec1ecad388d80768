"""Order-dependent work on groups of rows, without a Python call for each group.

Rows are dealt by their keys and sorted within partitions; an Arrow function then passes over each partition once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import chain, groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.window import Window

from genoframe.scratch import written

#: Rows handed on at a time.
OUT_ROWS = 10_000


def _values(column: pa.Array) -> list:
    """The column as Python's own values; plain ones go by an array, as to_pylist() makes an object of Arrow's for each."""
    kind = column.type
    plain = pa.types.is_integer(kind) or pa.types.is_floating(kind) or pa.types.is_boolean(kind) or pa.types.is_string(kind)
    return column.to_numpy(zero_copy_only=False).tolist() if plain and not column.null_count else column.to_pylist()


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    return chain.from_iterable(zip(*map(_values, b.columns)) for b in batches)


def over_groups(rows: DataFrame, keys: list[str], order: list[str], work: Callable[[tuple, Iterator[tuple]], Iterable[tuple]], schema: T.StructType | str) -> DataFrame:
    """work(key, rows of the group in order) for every group of rows(keys, then the other columns as they stand).

    The group comes as an iterator, so work that keeps a state alone needs no memory for the group.
    """
    schema = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    rows = rows.select(*keys, *[c for c in rows.columns if c not in keys])
    n = len(keys)

    def run(batches):
        kind, out = to_arrow_schema(schema), []
        columns = lambda: zip(*out) if out else [()] * len(kind)
        table = lambda: pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns(), kind)], schema=kind)
        for key, group in groupby(_rows(batches), itemgetter(*range(n)) if n > 1 else lambda r: (r[0],)):
            for row in work(key, group):
                out.append(row)
                if len(out) >= OUT_ROWS:
                    yield table()
                    out = []
        yield table()

    return rows.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(run, schema)


def numbered_by_range(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """rows with `name`, their place from 1 in the order of all, which should leave no ties.

    Rows are dealt by ranges of the order and written, as ranges are sampled anew each time; each range is numbered by itself from the rows
    of those before it on. Only the ranges' counts come together.
    """
    ranged = written(rows.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    ahead = Window.orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    counts = ranged.groupBy(F.col("_range").alias("_r")).agg(F.count("*").alias("_n")).select("_r", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_before"))
    own = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return ranged.withColumn(name, own).join(counts, F.col("_range") == F.col("_r")).withColumn(name, F.col(name) + F.col("_before")).drop("_range", "_r", "_before")
