"""Numeric and categorical profiles, value counts and modes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prepframe.functions.columns import col, is_numeric, present
from prepframe.guards import as_list, chosen_numeric, require
from prepframe.operators.quantile import finish_medians, sketch, whole_medians
from prepframe.scratch import stored


def numeric_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """One row per numeric column: mean, exact median, min, max, population deviation, count of present values.

    One aggregation gives everything but the median and brackets it; a second one settles the medians.
    """
    names = chosen_numeric(df, cols)
    aggs = []
    for i, c in enumerate(names):
        v = present(df, c).cast("double")
        aggs += [
            F.avg(v).alias(f"mean{i}"),
            F.min(v).alias(f"min{i}"),
            F.max(v).alias(f"max{i}"),
            F.stddev_pop(v).alias(f"std{i}"),
            F.count(v).alias(f"n{i}"),
            sketch(v).alias(f"sketch{i}"),
        ]
    row = df.agg(*aggs).first()
    medians = finish_medians(df, {c: (row[f"n{i}"], row[f"sketch{i}"]) for i, c in enumerate(names)})
    rows = [
        (c, row[f"mean{i}"], medians[c], row[f"min{i}"], row[f"max{i}"], row[f"std{i}"], row[f"n{i}"])
        for i, c in enumerate(names)
    ]
    return df.sparkSession.createDataFrame(
        rows,
        "column string, mean double, median double, min double, max double, std_pop double, count long",
    )


def whole_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """(column, median, min, max, count) of whole-number columns, exact beyond what a double tells apart."""
    names = [c for c in chosen_numeric(df, cols) if isinstance(df.schema[c].dataType, T.IntegralType)]
    if not names:
        raise ValueError("no whole-number columns among those chosen")
    row = df.agg(*[f(col(c)).alias(f"{t}{i}") for i, c in enumerate(names) for t, f in (("lo", F.min), ("hi", F.max), ("n", F.count))]).first()
    medians = whole_medians(df, names)
    rows = [(c, medians[c], row[f"lo{i}"], row[f"hi{i}"], row[f"n{i}"]) for i, c in enumerate(names)]
    return df.sparkSession.createDataFrame(rows, "column string, median decimal(21,1), min long, max long, count long")


def numeric_values_long(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """(column, value) for every present numeric value; chosen columns that are not numeric are left out."""
    names = chosen_numeric(df, cols)
    values = df.select(*[present(df, c).cast("double").alias(c) for c in names])
    return values.unpivot([], [col(c) for c in names], "column", "value").where("value IS NOT NULL")


def pooled_mean(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """The mean of all numeric cells together; 0 when there are none."""
    names = chosen_numeric(df, cols)
    cells = [present(df, c).cast("double") for c in names]
    total = sum((F.coalesce(F.sum(v), F.lit(0.0)) for v in cells), F.lit(0.0))
    count = sum((F.count(v) for v in cells), F.lit(0))
    return df.agg(F.coalesce(F.try_divide(total, count), F.lit(0.0)).alias("pooled_mean"))


def value_counts(df: DataFrame, cols: str | Sequence[str]) -> DataFrame:
    """(column, value, n) for the present values of all chosen columns, in one aggregation. Values are text."""
    names = require(df, cols)
    texts = df.select(*[present(df, c).cast("string").alias(c) for c in names])
    return (
        texts.unpivot([], [col(c) for c in names], "column", "value")
        .where("value IS NOT NULL")
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def modes(df: DataFrame, cols: str | Sequence[str]) -> dict[str, object]:
    """The commonest value of each column (ties: the smallest), None where nothing is present.

    Columns of one type are counted together, so that ties are compared as numbers, dates or text.
    """
    names = require(df, as_list(cols))
    families: dict[T.DataType, list[str]] = {}
    for c in names:
        dtype = df.schema[c].dataType
        if isinstance(dtype, T.IntegralType):
            dtype = T.LongType()
        elif isinstance(dtype, (T.FloatType, T.DoubleType)):
            dtype = T.DoubleType()
        families.setdefault(dtype, []).append(c)
    found: dict[str, object] = {c: None for c in names}
    for dtype, members in families.items():
        typed = df.select(*[present(df, c).cast(dtype).alias(f"c{i}") for i, c in enumerate(members)])
        counts = (
            typed.unpivot([], [f"c{i}" for i in range(len(members))], "name", "value")
            .where("value IS NOT NULL")
            .groupBy("name", "value")
            .agg(F.count(F.lit(1)).alias("n"))
        )
        best = counts.groupBy("name").agg(F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("value"))
        for r in best.collect():
            found[members[int(r["name"][1:])]] = r["value"]
    return found


#: Bytes of a text up to which it is counted as it is; longer ones are counted by their digest.
COUNTED_BYTES = 64
#: Digests of commonest texts up to which they are broadcast to find the text itself; a join by shuffle beyond.
BROADCAST_DIGESTS = 100_000


def _counting_key(value: Column) -> Column:
    return F.when(F.octet_length(value) <= COUNTED_BYTES, value).otherwise(F.concat(F.lit("\0sha256 "), F.sha2(value.cast("binary"), 256)))


def categorical_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """One row per non-numeric column that holds anything.

    count, distinct, mode (ties: smallest), top_share, fill_pct, and shortest, longest and mean text length.
    Every figure comes from one table of value counts, in which long texts stand as digests; the row total is counted in
    the same pass. A long text is looked for only where it is a column's commonest.
    """
    names = [c for c in (cols or df.columns) if c in df.columns and not is_numeric(df.schema[c].dataType)]
    if not names:
        raise ValueError("no non-numeric columns among those chosen")
    texts = df.select(F.lit("").alias("_all"), *[col(c).cast("string").alias(c) for c in names])
    long = texts.unpivot([], ["_all", *[col(c) for c in names]], "column", "value").where("value IS NOT NULL")
    key, length = _counting_key(F.col("value")).alias("key"), F.length("value").alias("length")
    counts = stored(long.select("column", key, length).groupBy("column", "key", "length").agg(F.count(F.lit(1)).alias("n")), "counts")
    per_column = counts.groupBy("column").agg(
        F.sum("n").alias("count"),
        F.count(F.lit(1)).alias("distinct"),
        F.max("n").alias("top"),
        F.min("length").cast("long").alias("length_min"),
        F.max("length").cast("long").alias("length_max"),
        F.sum(F.col("length") * F.col("n")).alias("length_sum"),
    )
    found = {r["column"]: r for r in per_column.collect()}
    chosen = _commonest(long, counts, {c: r["top"] for c, r in found.items()})
    total = found["_all"]["count"] if "_all" in found else 0
    rows = []
    for c in names:
        if c in found:
            r = found[c]
            n = r["count"]
            lengths = (r["length_min"], r["length_max"], r["length_sum"] / n)
            rows.append((c, n, r["distinct"], chosen[c], r["top"] / n, n / total * 100, *lengths))
    return df.sparkSession.createDataFrame(
        rows,
        "column string, count long, distinct long, mode string, top_share double, fill_pct double, "
        "length_min long, length_max long, length_mean double",
    )


def _commonest(long: DataFrame, counts: DataFrame, tops: dict[str, int]) -> dict[str, str]:
    """For each column the smallest of the texts that occur as often as any."""
    often = F.lit(False)
    for c, top in tops.items():
        often = often | ((F.col("column") == c) & (F.col("n") == top))
    best = counts.where(often).select("column", "key")
    by_digest = F.startswith("key", F.lit("\0sha256 "))
    found = {r["column"]: r["value"] for r in best.where(~by_digest).groupBy("column").agg(F.min("key").alias("value")).collect()}
    digests = best.where(by_digest)
    some = digests.select("column").distinct().collect()
    if some:
        wanted = F.broadcast(digests) if digests.limit(BROADCAST_DIGESTS + 1).count() <= BROADCAST_DIGESTS else digests
        here = long.where(F.col("column").isin([r["column"] for r in some]) & (F.octet_length("value") > COUNTED_BYTES))
        held = here.withColumn("key", _counting_key(F.col("value"))).join(wanted, ["column", "key"], "left_semi")
        for r in held.groupBy("column").agg(F.min("value").alias("value")).collect():
            found[r["column"]] = min(r["value"], found.get(r["column"], r["value"]), key=lambda t: t.encode())
    return found
