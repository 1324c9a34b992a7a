"""Filling and dropping missing data."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prepframe.functions.columns import coerce_literal, col, is_numeric, present
from prepframe.guards import require, require_numeric, with_categories
from prepframe.operators.profile import modes
from prepframe.operators.quantile import finish_medians, sketch

METHODS = ("mean", "median", "mode", "constant")


@dataclass
class Fill:
    """The value that takes the place of missing ones, per column; `widened` columns become double.

    Columns filled with a mean or median are double whether or not they had gaps when it was fitted, so that the type
    depends on the method alone. Columns keep their metadata; a category list is extended by a value it lacks.
    """

    values: dict[str, object]
    widened: list[str] = field(default_factory=list)

    def transform(self, df: DataFrame) -> DataFrame:
        def filled(c: str):
            value = self.values.get(c)
            if value is None:
                return col(c)
            dtype = T.DoubleType() if c in self.widened else df.schema[c].dataType
            filled_in = F.coalesce(present(df, c).cast(dtype), F.lit(value).cast(dtype))
            return filled_in.alias(c, metadata=with_categories(df, c, [value]))

        return df.select(*[filled(c) for c in df.columns])


def fit_fill(df: DataFrame, rules: Mapping[str, str], constant=None) -> Fill:
    """Fit `{column: method}`. Means, counts and median brackets share one aggregation."""
    unknown = sorted(set(rules.values()) - set(METHODS))
    if unknown:
        raise ValueError(f"unknown methods: {unknown}; choose from {list(METHODS)}")
    require(df, list(rules))
    by = {m: [c for c, method in rules.items() if method == m] for m in METHODS}
    require_numeric(df, by["mean"] + by["median"])
    values: dict[str, object] = {c: coerce_literal(constant, df.schema[c].dataType) for c in by["constant"]}

    aggs = [F.avg(present(df, c).cast("double")).alias(f"mean{i}") for i, c in enumerate(by["mean"])]
    for i, c in enumerate(by["median"]):
        aggs += [F.count(present(df, c)).alias(f"n{i}"), sketch(present(df, c)).alias(f"sketch{i}")]
    widened = [c for c in by["mean"] + by["median"] if not isinstance(df.schema[c].dataType, T.DoubleType)]
    if aggs:
        row = df.agg(*aggs).first()
        values |= {c: row[f"mean{i}"] for i, c in enumerate(by["mean"])}
        values |= finish_medians(df, {c: (row[f"n{i}"], row[f"sketch{i}"]) for i, c in enumerate(by["median"])})
    if by["mode"]:
        values |= modes(df, by["mode"])
    return Fill(values, widened)


def fill(df: DataFrame, rules: Mapping[str, str], constant=None) -> DataFrame:
    return fit_fill(df, rules, constant).transform(df)


def fit_fill_table(df: DataFrame, method: str, constant=None) -> Fill:
    """One method for the whole table: mean and median for the numeric columns, a constant where it fits."""
    if method not in METHODS:
        raise ValueError(f"unknown method: {method}; choose from {list(METHODS)}")
    if method == "constant":
        fits = {}
        for f in df.schema:
            if isinstance(f.dataType, (T.StringType, T.NumericType, T.BooleanType)):
                try:
                    fits[f.name] = coerce_literal(constant, f.dataType)
                except ValueError:
                    continue
        return Fill(fits)
    cols = [f.name for f in df.schema if method == "mode" or is_numeric(f.dataType)]
    return fit_fill(df, {c: method for c in cols})


def fill_table(df: DataFrame, method: str, constant=None) -> DataFrame:
    return fit_fill_table(df, method, constant).transform(df)


def drop_sparse_rows(df: DataFrame, at_least: int = 1, cols: Sequence[str] | None = None) -> DataFrame:
    """Keep rows with at least that many present values (NaN counts as missing)."""
    names = require(df, cols) if cols else df.columns
    return df.dropna(thresh=at_least, subset=names)


def drop_sparse_columns(df: DataFrame, at_least: int = 1, cols: Sequence[str] | None = None) -> DataFrame:
    """Keep columns with at least that many present values; `cols` limits which ones may go."""
    names = require(df, cols) if cols else df.columns
    row = df.agg(*[F.count(present(df, c)).alias(f"n{i}") for i, c in enumerate(names)]).first()
    gone = {c for i, c in enumerate(names) if row[f"n{i}"] < at_least}
    return df.select(*[col(c) for c in df.columns if c not in gone])


def null_report(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """(column, nulls) for every column, and under the column name NULL the rows with any missing value."""
    names = require(df, cols) if cols else df.columns
    missing = [present(df, c).isNull() for c in names]
    any_missing = missing[0]
    for m in missing[1:]:
        any_missing = any_missing | m
    counts = df.agg(
        *[F.count_if(m).alias(f"n{i}") for i, m in enumerate(missing)], F.count_if(any_missing).alias("rows")
    )
    entries = [F.struct(F.lit(c).alias("column"), col(f"n{i}").alias("nulls")) for i, c in enumerate(names)]
    entries.append(F.struct(F.lit(None).cast("string").alias("column"), F.col("rows").alias("nulls")))
    return counts.select(F.inline(F.array(*entries)))
