"""Removing and counting duplicates. Nulls equal each other in a key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prepframe.functions.columns import col
from prepframe.guards import as_list, require
from prepframe.operators.rowid import order_columns

_RANK = "_dup_rank"


def _first_of_each(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """`rank = 1` lets Spark cut every key to one row per task before the shuffle, so hot keys stay small."""
    rank = F.row_number().over(Window.partitionBy(*[col(k) for k in keys]).orderBy(*order))
    return df.withColumn(_RANK, rank).where(F.col(_RANK) == 1).drop(_RANK)


def drop_duplicates(
    df: DataFrame,
    keys: str | Sequence[str] | None = None,
    keep: str = "first",
    order_by: Sequence[str | Column] | str = (),
) -> DataFrame:
    """Keep the first or last row of each key in the caller's order, or (`none`) only keys that occur once."""
    if keep not in ("first", "last", "none"):
        raise ValueError("keep must be first, last or none")
    names = require(df, as_list(keys)) or df.columns
    if keep == "none":
        return _only_single(df, names)
    if set(names) == set(df.columns):
        return df.dropDuplicates()
    order = order_columns(order_by)
    if not order:
        raise ValueError("first and last need order_by: a table has no order of its own")
    return _first_of_each(df, names, order if keep == "first" else [o.desc() for o in order])


def _only_single(df: DataFrame, names: list[str]) -> DataFrame:
    """One grouping: a key's row count and any one of its rows, which is the row itself when the count is 1."""
    rest = [c for c in df.columns if c not in names]
    one_row = [F.any_value(F.struct(*[col(c) for c in rest])).alias("_row")] if rest else []
    single = df.groupBy(*[col(k) for k in names]).agg(F.count(F.lit(1)).alias("_n"), *one_row).where("_n = 1")
    return single.select(*[F.col("_row").getField(c).alias(c) if c in rest else col(c) for c in df.columns])


def duplicate_report(df: DataFrame, keys: str | Sequence[str] | None = None) -> DataFrame:
    """`members`: rows whose key is repeated. `surplus`: rows that keep-first or keep-last would remove."""
    names = require(df, as_list(keys)) or df.columns
    keyed = df.select(*[col(k).alias(f"k{i}") for i, k in enumerate(names)])
    repeated = keyed.groupBy(*keyed.columns).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return repeated.agg(
        F.count(F.lit(1)).alias("repeated_keys"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("members"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("surplus"),
    )
