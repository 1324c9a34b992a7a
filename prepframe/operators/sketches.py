"""Small states of columns that can be stored by part or day and merged: quantiles, frequent values, distinct values.

A state holds a bounded number of figures whatever the number of rows, and merging states gives one for all their rows,
so that new rows don't need the old ones to be read again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prepframe.functions.columns import col, present
from prepframe.guards import chosen_numeric, require

#: Items that a level of a quantile state keeps, and the error of a rank, as a share of the rows, that this leaves with
#: a confidence of 99 %.
KLL_SIZE, RANK_ERROR = 400, 0.01
#: Buckets that a column's values are counted in.
BUCKETS = 1 << 14
#: Logarithm of the registers of a distinct state; the estimate is off by some 1.6 %.
HLL_SIZE = 12


def _long(df: DataFrame, names: Sequence[str], by: Sequence[str], kind: str) -> DataFrame:
    """(by …, column, value) of the present values."""
    chosen = df.select(*[col(b).alias(f"_by{i}") for i, b in enumerate(by)], *[present(df, c).cast(kind).alias(c) for c in names])
    long = chosen.unpivot([f"_by{i}" for i in range(len(by))], [col(c) for c in names], "column", "value").where("value IS NOT NULL")
    return long.withColumnsRenamed({f"_by{i}": b for i, b in enumerate(by)})


def quantile_states(df: DataFrame, cols: Sequence[str] | None = None, by: Sequence[str] = ()) -> DataFrame:
    """(by …, column, n, state) of numeric columns, one state for each group."""
    long = _long(df, chosen_numeric(df, cols), by, "double")
    return long.groupBy(*[col(b) for b in by], "column").agg(
        F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double("value", F.lit(KLL_SIZE)).alias("state")
    )


def merge_quantile_states(states: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by …, column, n, state): groups that agree in `by` as one."""
    return states.groupBy(*[col(b) for b in by], "column").agg(
        F.sum("n").alias("n"), F.kll_merge_agg_double("state", F.lit(KLL_SIZE)).alias("state")
    )


def state_quantiles(states: DataFrame, shares: Sequence[float]) -> DataFrame:
    """Each state's values at some shares of its rows, as (…, share, value)."""
    if not all(0 <= s <= 1 for s in shares):
        raise ValueError("shares must lie between 0 and 1")
    values = F.array(*[F.struct(F.lit(float(s)).alias("share"), F.kll_sketch_get_quantile_double("state", F.lit(float(s))).alias("value")) for s in shares])
    return states.select(*[col(c) for c in states.columns if c != "state"], F.inline(values))


def _bucket() -> Column:
    return F.pmod(F.xxhash64("column", "value"), F.lit(BUCKETS)).cast("int").alias("bucket")


def frequency_states(df: DataFrame, cols: str | Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by …, column, bucket, n): present values counted by a hash, at most BUCKETS rows for each group and column."""
    long = _long(df, require(df, cols), by, "string")
    return long.groupBy(*[col(b) for b in by], "column", _bucket()).agg(F.count(F.lit(1)).alias("n"))


def heavy_values(df: DataFrame, cols: str | Sequence[str], share: float, states: DataFrame | None = None) -> DataFrame:
    """(column, value, n): all values with more than `share` of their column's present values, exactly counted.

    A value that frequent makes its bucket that frequent. Such buckets are fewer than 1/share for each column; only
    values in them are counted, whatever the number of distinct values. `states` are those of `df`'s rows, merged or not.
    """
    if not 0 < share <= 1:
        raise ValueError("share must lie above 0 and not above 1")
    names = require(df, cols)
    if share * BUCKETS < 2:
        raise ValueError(f"share must be at least {2 / BUCKETS:.6f}")
    found = frequency_states(df, names) if states is None else states
    counts = found.groupBy("column", "bucket").agg(F.sum("n").alias("n"))
    totals = counts.groupBy("column").agg((F.sum("n") * share).alias("least"))
    heavy = counts.join(F.broadcast(totals), "column").where("n > least").select("column", "bucket", "least")
    long = _long(df, names, (), "string").select("column", "value", _bucket())
    some = long.join(F.broadcast(heavy), ["column", "bucket"])  # fewer than 1/share rows a column
    return some.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"), F.max("least").alias("least")).where("n > least").drop("least")


def distinct_states(df: DataFrame, cols: str | Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by …, column, state) of the present values."""
    long = _long(df, require(df, cols), by, "string")
    return long.groupBy(*[col(b) for b in by], "column").agg(F.hll_sketch_agg("value", F.lit(HLL_SIZE)).alias("state"))


def merge_distinct_states(states: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return states.groupBy(*[col(b) for b in by], "column").agg(F.hll_union_agg("state").alias("state"))


def distinct_counts(states: DataFrame) -> DataFrame:
    """Each state's estimate, as (…, distinct)."""
    return states.select(*[col(c) for c in states.columns if c != "state"], F.hll_sketch_estimate("state").alias("distinct"))
