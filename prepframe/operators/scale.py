"""Min-max and standard scaling, fitted with one aggregation."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prepframe.functions.columns import col, present
from prepframe.guards import chosen_numeric


@dataclass
class Scaling:
    """Per scaled column: subtract `shift`, divide by `span`; constant columns are not listed."""

    method: str
    shift: dict[str, float]
    span: dict[str, float]

    def transform(self, df: DataFrame) -> DataFrame:
        return df.select(
            *[
                ((present(df, c).cast("double") - F.lit(self.shift[c])) / F.lit(self.span[c])).alias(c)
                if c in self.shift
                else col(c)
                for c in df.columns
            ]
        )

    def as_pairs(self) -> dict[str, tuple[float, float]]:
        """(min, max) or (mean, deviation) per column."""
        if self.method == "minmax":
            return {c: (s, s + self.span[c]) for c, s in self.shift.items()}
        return {c: (s, self.span[c]) for c, s in self.shift.items()}

    def to_table(self, spark: SparkSession) -> DataFrame:
        rows = [(c, float(a), float(b)) for c, (a, b) in self.as_pairs().items()]
        return spark.createDataFrame(rows, "column string, a double, b double")


def _fit(df: DataFrame, cols: Sequence[str] | None, method: str) -> Scaling:
    names = chosen_numeric(df, cols)
    stats = []
    for i, c in enumerate(names):
        v = present(df, c).cast("double")
        stats += [F.min(v).alias(f"lo{i}"), F.max(v).alias(f"hi{i}")]
        if method == "standard":
            stats += [F.avg(v).alias(f"mean{i}"), F.stddev_samp(v).alias(f"std{i}")]
    row = df.agg(*stats).first()
    shift, span = {}, {}
    for i, c in enumerate(names):
        lo, hi = row[f"lo{i}"], row[f"hi{i}"]
        if lo is None or lo == hi:
            continue
        if method == "minmax":
            shift[c], span[c] = lo, hi - lo
        elif row[f"std{i}"]:
            shift[c], span[c] = row[f"mean{i}"], row[f"std{i}"]
    return Scaling(method, shift, span)


def fit_minmax(df: DataFrame, cols: Sequence[str] | None = None) -> Scaling:
    return _fit(df, cols, "minmax")


def fit_standard(df: DataFrame, cols: Sequence[str] | None = None) -> Scaling:
    """Mean 0 and *sample* deviation 1."""
    return _fit(df, cols, "standard")


def minmax_scale(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    return fit_minmax(df, cols).transform(df)


def standard_scale(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    return fit_standard(df, cols).transform(df)
