"""Helpers shared by the operators: mapping text columns in Arrow batches of bounded size."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of a batch that one step of an operator sees; a single longer text is a batch of its own.
STEP_BYTES = 4 << 20


def column(name: str) -> Column:
    """The column of that very name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def steps(batches: Iterator[pa.RecordBatch], max_bytes: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows of about max_bytes."""
    for batch in batches:
        if batch.num_rows:
            each = math.ceil(batch.num_rows / max(1, math.ceil(batch.nbytes / max_bytes)))
            for start in range(0, batch.num_rows, each):
                yield batch.slice(start, each)


def map_columns(
    df: DataFrame,
    keep: list[str],
    inputs: list[str],
    fields: list[T.StructField],
    start: Callable[[], Callable[..., list[pa.Array]]],
) -> DataFrame:
    """The kept columns, then the new fields computed from the input columns, row by row.

    `start` runs once in each task and returns a function from lists of values (one list for each input) to the new
    arrays. Columns travel by position, so names that clash with others don't matter.
    """
    n = len(keep)
    source = df.select(
        *[column(k).alias(f"k{i}") for i, k in enumerate(keep)], *[column(k).alias(f"i{i}") for i, k in enumerate(inputs)]
    )
    schema = T.StructType([*source.schema.fields[:n], *[T.StructField(f"n{i}", f.dataType) for i, f in enumerate(fields)]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apply = start()
        for batch in steps(batches):
            columns = batch.columns
            new = apply(*[c.to_pylist() for c in columns[n:]])
            yield pa.RecordBatch.from_arrays([*columns[:n], *new], names=schema.names)

    return source.mapInArrow(run, schema).toDF(*keep, *[f.name for f in fields])


def strings(values) -> pa.Array:
    return pa.array(values, pa.string())


def longs(values) -> pa.Array:
    return pa.array(values, pa.int64())


def doubles(values) -> pa.Array:
    return pa.array(values, pa.float64())
