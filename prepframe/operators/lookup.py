"""Tables that map a column's values to fitted figures, and how they are joined back.

A mapping of up to BROADCAST_ROWS rows and BROADCAST_BYTES of keys and values is held by the driver and broadcast. A
larger one is written once and joined by shuffle, except for its hot values: those with more than 1/HOT_SHARE of all
rows, of which there can be at most HOT_SHARE. They are broadcast, long ones as a digest, and their rows (like those
without a value) pass through the shuffle under a salt, so that no task receives them all.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prepframe.functions.columns import col
from prepframe.operators.rowid import ROW_ID, number_rows, with_weight_before
from prepframe.scratch import stored

BROADCAST_ROWS = 10_000
BROADCAST_BYTES = 16 << 20
HOT_SHARE = 10_000
HOT_LENGTH = 1_000
SALTS = 4_096
CODE = "code"
RANK = "rank"


@dataclass
class Lookups:
    """Per column: a table (key, n, values…), its number of rows, and the values common enough to be hot."""

    tables: dict[str, DataFrame]
    sizes: dict[str, int]
    hot: dict[str, DataFrame] = field(default_factory=dict)

    def attach(self, df: DataFrame, column: str, key: Column, names: dict[str, str]) -> DataFrame:
        """Left-join values onto `df`: `names` is {value column: new column}."""
        renamed = [col("key").alias("_key"), *[col(v).alias(n) for v, n in names.items()]]
        keyed = df.withColumn("_match", key)
        on = F.col("_match") == F.col("_key")
        if column not in self.hot:
            joined = keyed.join(F.broadcast(self.tables[column].select(*renamed)), on, "left")
            return joined.drop("_match", "_key")
        hot = self.hot[column].select(col("key").alias("_hot"), *[col(v).alias(f"_hot_{n}") for v, n in names.items()])
        placed = keyed.join(F.broadcast(hot), _short(F.col("_match"), self.tables[column]) == F.col("_hot"), "left")
        apart = F.col("_hot").isNotNull() | F.col("_match").isNull()
        salt = F.when(apart, F.pmod(F.spark_partition_id(), F.lit(SALTS)) + 1).otherwise(0)
        # n * 0 instead of a literal, which would be folded out of the join keys
        salted_table = self.tables[column].select(*renamed, (F.col("n") * 0).alias("_no_salt"))
        joined = placed.withColumn("_salt", salt.cast("long")).join(
            salted_table, on & (F.col("_salt") == F.col("_no_salt")), "left"
        )
        settled = {n: F.coalesce(col(f"_hot_{n}"), col(n)).alias(n) for n in names.values()}
        return joined.select(*[col(c) for c in df.columns], *settled.values())


def _in_order(value):
    """Sort key that puts missing parts first, as Spark's ascending order does, at any depth."""
    if value is None:
        return (False,)
    return (True, [_in_order(v) for v in value] if isinstance(value, tuple) else value)


def _short(key: Column, table: DataFrame) -> Column:
    """A text key of more than HOT_LENGTH bytes as its digest; others as they are."""
    if not isinstance(table.schema["key"].dataType, T.StringType):
        return key
    return F.when(F.octet_length(key) <= HOT_LENGTH, key).otherwise(F.concat(F.lit("\0sha256 "), F.sha2(key.cast("binary"), 256)))


def _bytes(schema: T.StructType) -> Column:
    """Bytes of all keys and values as text."""
    width = F.lit(0)
    for f in schema:
        if f.name not in ("column", "n"):
            width = width + F.coalesce(F.octet_length(F.to_json(F.struct(col(f.name)))), F.lit(0))
    return F.coalesce(F.sum(width), F.lit(0)).alias("bytes")


def fit_lookups(
    counted: DataFrame,
    cols: Sequence[str],
    order_by: str | None = None,
    broadcast_rows: int | None = None,
) -> Lookups:
    """Build lookups from one table (column, key, n, values…) that covers all columns.

    With `order_by`, every value also gets `code`, its 0-based place among its column's values, and `rank`, the
    average rank its n rows share.
    """
    spark = counted.sparkSession
    broadcast_rows = BROADCAST_ROWS if broadcast_rows is None else broadcast_rows
    counted = counted.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        rows, size = counted.limit(broadcast_rows + 1).agg(F.count(F.lit(1)), _bytes(counted.schema)).first()
        if rows <= broadcast_rows and size <= BROADCAST_BYTES:
            return _small(spark, counted.schema, counted.collect(), cols, order_by)
        return _large(counted, cols, order_by, broadcast_rows)
    finally:
        counted.unpersist()


def _small(spark, schema: T.StructType, rows: list, cols: Sequence[str], order_by: str | None) -> Lookups:
    if order_by:
        rows = sorted(rows, key=lambda r: _in_order(r[order_by]))
        schema = T.StructType([*schema.fields, T.StructField(CODE, T.LongType()), T.StructField(RANK, T.DoubleType())])
    tables, sizes = {}, {}
    for c in cols:
        mine = [tuple(r) for r in rows if r["column"] == c]
        if order_by:
            n_at, seen = schema.fieldNames().index("n"), 0
            for i, r in enumerate(mine):
                mine[i] = (*r, i, seen + (r[n_at] + 1) / 2.0)
                seen += r[n_at]
        tables[c] = spark.createDataFrame(mine, schema).drop("column")
        sizes[c] = len(mine)
    return Lookups(tables, sizes)


def _large(counted: DataFrame, cols: Sequence[str], order_by: str | None, broadcast_rows: int) -> Lookups:
    if order_by:
        table = with_weight_before(number_rows(counted, ["column", order_by]), "n", "_rows_before")
        table = table.withColumn(RANK, F.col("_rows_before") + (F.col("n") + 1) / 2.0)
        table = stored(table.withColumnRenamed(ROW_ID, CODE).drop("_rows_before"), "lookup")
    else:
        table = stored(counted, "lookup")
    per_column = table.groupBy("column").agg(F.count(F.lit(1)).alias("keys"), F.sum("n").alias("rows"), _bytes(table.schema)).collect()
    tables, sizes, hot, keys_before, rows_before = {}, {}, {}, 0, 0
    found = {r["column"]: r for r in per_column}
    for c in sorted(found):
        keys, rows = found[c]["keys"], found[c]["rows"]
        mine = table.where(F.col("column") == c).drop("column")
        if order_by:
            mine = mine.withColumn(CODE, F.col(CODE) - F.lit(keys_before)).withColumn(
                RANK, F.col(RANK) - F.lit(float(rows_before))
            )
        keys_before, rows_before = keys_before + keys, rows_before + rows
        if keys > broadcast_rows or found[c]["bytes"] > BROADCAST_BYTES:
            common = F.col("n") * HOT_SHARE > F.lit(rows)
            hot[c] = mine.where(common).withColumn("key", _short(F.col("key"), mine))
        tables[c], sizes[c] = mine, keys
    for c in cols:
        if c not in tables:
            tables[c], sizes[c] = table.where(F.lit(False)).drop("column"), 0
    return Lookups({c: tables[c] for c in cols}, {c: sizes[c] for c in cols}, hot)
