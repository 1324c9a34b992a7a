"""Queries by key, each with the SQL it must agree with where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(key: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """All double columns rounded, as the SQL side rounds them."""
    return df.select(
        *[F.round(f.name, digits).alias(f.name) if f.dataType.simpleString() == "double" else f.name for f in df.schema]
    )


def every(name: str, n: int, *keys: str) -> Column:
    """The column with NULL wherever the keys' sum is a multiple of n."""
    total = F.col(keys[0])
    for k in keys[1:]:
        total = total + F.col(k)
    return F.when(total % n != 0, F.col(name)).alias(name)


def lineitem_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem with missing quantities, discounts and return flags."""
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        every("l_quantity", 7, "l_orderkey", "l_linenumber"),
        "l_extendedprice",
        every("l_discount", 5, "l_orderkey", "l_partkey"),
        "l_tax",
        every("l_returnflag", 11, "l_orderkey", "l_suppkey"),
        "l_linestatus",
    )


# The same table for the SQL side.
GAPS = """gaps AS (
  SELECT l_orderkey, l_partkey, l_linenumber,
         CASE WHEN (l_orderkey + l_linenumber) % 7 <> 0 THEN l_quantity END AS l_quantity,
         l_extendedprice,
         CASE WHEN (l_orderkey + l_partkey) % 5 <> 0 THEN l_discount END AS l_discount,
         l_tax,
         CASE WHEN (l_orderkey + l_suppkey) % 11 <> 0 THEN l_returnflag END AS l_returnflag,
         l_linestatus
  FROM lineitem)"""
