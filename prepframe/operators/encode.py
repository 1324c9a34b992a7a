"""Encoding categories: one-hot, binary, smoothed target means, label codes."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from prepframe.functions.columns import col, present, strip
from prepframe.guards import as_list, categories_of, require, require_numeric, require_text
from prepframe.operators.lookup import CODE, Lookups, fit_lookups
from prepframe.operators.rowid import order_columns, with_row_id


def observed_categories(df: DataFrame, cols: Sequence[str], limit: int | None = None) -> dict[str, list]:
    """Sorted categories: those a column carries, else the ones found, for all such columns in one job.

    Categories become columns, so they come to the driver; more than `limit` in a column, if it is given, are an error.
    """
    known = {c: categories_of(df, c) for c in cols}
    open_ = [c for c in cols if known[c] is None]
    if open_:
        found = (
            df.select(*[col(c).cast("string").alias(c) for c in open_])
            .unpivot([], [col(c) for c in open_], "column", "value")
            .where("value IS NOT NULL")
            .distinct()
        )
        rows = (found if limit is None else found.limit(limit * len(open_) + 1)).collect()
        gathered: dict[str, list] = {c: [] for c in open_}
        for r in rows:
            gathered[r["column"]].append(r["value"])
        for c in open_:
            known[c] = sorted(gathered[c])
        if limit is not None and (len(rows) > limit * len(open_) or any(len(known[c]) > limit for c in open_)):
            raise ValueError(f"not categorical: more than {limit} values in one of {open_}")
    return known


@dataclass
class OneHot:
    """Columns `{column}_{value}` of 0 and 1 in category order, appended in place of the source."""

    categories: dict[str, list]
    drop_first: bool = False

    def names(self, column: str) -> list[str]:
        return [f"{column}_{v}" for v in self.categories[column][int(self.drop_first) :]]

    def transform(self, df: DataFrame) -> DataFrame:
        kept = [col(c) for c in df.columns if c not in self.categories]
        dummies = [
            F.when(col(c) == F.lit(v), 1).otherwise(0).cast("tinyint").alias(f"{c}_{v}")
            for c, values in self.categories.items()
            for v in values[int(self.drop_first) :]
        ]
        return df.select(*kept, *dummies)

    def mapping(self, spark: SparkSession) -> DataFrame:
        """(column, value, code), categories without rows included."""
        rows = [(c, str(v), i) for c, values in self.categories.items() for i, v in enumerate(values)]
        return spark.createDataFrame(rows, "column string, value string, code long")


def fit_onehot(
    df: DataFrame, cols: str | Sequence[str], drop_first: bool = False, max_categories: int | None = None
) -> OneHot:
    names = require_text(df, cols)
    return OneHot(observed_categories(df, names, max_categories), drop_first)


def onehot(df: DataFrame, cols: str | Sequence[str], drop_first: bool = False) -> DataFrame:
    return fit_onehot(df, cols, drop_first).transform(df)


def _mapping_table(lookups: Lookups, values: list[Column]) -> DataFrame:
    parts = [t.select(F.lit(c).alias("column"), F.col("key").alias("value"), *values) for c, t in lookups.tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@dataclass
class Binary:
    """Columns `{column}_bin_{i}`, most significant bit first; missing values have missing bits."""

    lookups: Lookups
    trim: bool = True

    def bits(self, column: str) -> int:
        return max(self.lookups.sizes[column] - 1, 0).bit_length()

    def transform(self, df: DataFrame) -> DataFrame:
        sources, out = list(self.lookups.tables), df
        for i, c in enumerate(sources):
            text = col(c).cast("string")
            out = self.lookups.attach(out, c, strip(text) if self.trim else text, {CODE: f"_code{i}"})
        bits = [
            F.shiftright(F.col(f"_code{i}"), self.bits(c) - 1 - b).bitwiseAND(F.lit(1)).cast("tinyint").alias(f"{c}_bin_{b}")
            for i, c in enumerate(sources)
            for b in range(self.bits(c))
        ]
        return out.select(*[col(c) for c in df.columns if c not in sources], *bits)

    def mapping(self) -> DataFrame:
        """(column, value, code, bits): bits as text, most significant first."""
        parts = []
        for c, t in self.lookups.tables.items():
            width = max(self.bits(c), 1)
            bits = F.lpad(F.bin(CODE), width, "0") if self.bits(c) else F.lit("")
            parts.append(t.select(F.lit(c).alias("column"), F.col("key").alias("value"), F.col(CODE), bits.alias("bits")))
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out


def fit_binary(
    df: DataFrame, cols: str | Sequence[str], order_by: Sequence[str | Column] | str, trim: bool = True
) -> Binary:
    """Codes follow the order in which the (trimmed) values first appear in the caller's order.

    Rows without an order value come first, as in an ascending order. Orders other than by names (descending ones, say)
    are settled by numbering the rows.
    """
    names = require_text(df, cols)
    order = order_columns(order_by)
    if not order:
        raise ValueError("order of first appearance needs order_by")
    given = [order_by] if isinstance(order_by, (str, Column)) else list(order_by)
    if not all(isinstance(o, str) for o in given):
        df = with_row_id(df, order, "_appears")
        order = [F.col("_appears")]
    keys = [(strip(col(c)) if trim else col(c)).alias(c) for c in names]
    first = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)])
    counted = (
        df.select(first.alias("_at"), *keys)
        .unpivot(["_at"], [col(c) for c in names], "column", "key")
        .where("key IS NOT NULL")
        .groupBy("column", "key")
        .agg(F.count(F.lit(1)).alias("n"), F.struct(F.min("_at").alias("at"), F.col("key").alias("tie")).alias("first"))
    )
    return Binary(fit_lookups(counted, names, order_by="first"), trim)


def binary_encode(df: DataFrame, cols: str | Sequence[str], order_by: Sequence[str | Column] | str) -> DataFrame:
    return fit_binary(df, cols, order_by).transform(df)


@dataclass
class Target:
    """Columns `{column}_target` with smoothed means; unseen and missing values get the global mean.

    Every row's own target takes part in its category's mean.
    """

    lookups: Lookups
    global_mean: float
    smoothing: float

    def _encoded(self, total: Column, count: Column) -> Column:
        """(n·mean + s·global) / (n + s), n·mean being the category's total; missing without any target."""
        s = F.lit(self.smoothing)
        return F.when(count > 0, (total + s * F.lit(self.global_mean)) / (count + s))

    def transform(self, df: DataFrame) -> DataFrame:
        sources, out = list(self.lookups.tables), df
        for i, c in enumerate(sources):
            out = self.lookups.attach(out, c, col(c).cast("string"), {"total": f"_total{i}", "nt": f"_nt{i}"})
        means = [
            F.coalesce(self._encoded(F.col(f"_total{i}"), F.col(f"_nt{i}")), F.lit(self.global_mean)).alias(f"{c}_target")
            for i, c in enumerate(sources)
        ]
        return out.select(*[col(c) for c in df.columns if c not in sources], *means)

    def mapping(self) -> DataFrame:
        """(column, value, encoded)."""
        encoded = self._encoded(F.col("total"), F.col("nt")).alias("encoded")
        return _mapping_table(self.lookups, [encoded]).where("value IS NOT NULL")


def fit_target(df: DataFrame, cols: str | Sequence[str], target: str, smoothing: float = 1.0) -> Target:
    """One pass over the data: the global mean follows from the categories' totals (missing ones included)."""
    require_numeric(df, target)
    names = require_text(df, cols)
    counted = (
        df.select(present(df, target).cast("double").alias("_t"), *[col(c) for c in names])
        .unpivot(["_t"], [col(c) for c in names], "column", "key")
        .groupBy("column", "key")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("_t").alias("total"), F.count("_t").alias("nt"))
    )
    lookups = fit_lookups(counted, names)
    whole = lookups.tables[names[0]].agg(F.sum("total").alias("total"), F.sum("nt").alias("nt")).first()
    mean = whole["total"] / whole["nt"] if whole["nt"] else None
    return Target(lookups, mean, float(smoothing))


def target_encode(df: DataFrame, cols: str | Sequence[str], target: str, smoothing: float = 1.0) -> DataFrame:
    return fit_target(df, cols, target, smoothing).transform(df)


@dataclass
class LabelCodes:
    """Columns `{column}_code`: the place of the value in sorted order, -1 where it is missing or unseen."""

    lookups: Lookups

    def transform(self, df: DataFrame) -> DataFrame:
        out = df
        for c in self.lookups.tables:
            out = self.lookups.attach(out, c, col(c), {CODE: f"{c}_code"})
        return out.select(
            *[col(c) for c in df.columns],
            *[F.coalesce(col(f"{c}_code"), F.lit(-1)).cast("int").alias(f"{c}_code") for c in self.lookups.tables],
        )

    def mapping(self) -> DataFrame:
        return _mapping_table(self.lookups, [F.col(CODE)])


def fit_label_codes(df: DataFrame, cols: str | Sequence[str]) -> LabelCodes:
    names = require_text(df, as_list(cols))
    carried = {c: categories_of(df, c) for c in names}
    counted = (
        df.select(*[col(c) for c in names])
        .unpivot([], [col(c) for c in names], "column", "key")
        .where("key IS NOT NULL")
        .groupBy("column", "key")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    without_rows = [(c, v, 0) for c, values in carried.items() for v in values or []]
    if without_rows:
        extra = df.sparkSession.createDataFrame(without_rows, "column string, key string, n long")
        counted = counted.unionByName(extra).groupBy("column", "key").agg(F.sum("n").alias("n"))
    return LabelCodes(fit_lookups(counted, names, order_by="key"))


def label_codes(df: DataFrame, cols: str | Sequence[str]) -> DataFrame:
    return fit_label_codes(df, cols).transform(df)


def encodable(df: DataFrame, cols: Sequence[str]) -> list[str]:
    """Of the given columns, those that hold text or categories."""
    return [c for c in require(df, list(cols)) if c in [f.name for f in df.schema if f.dataType.simpleString() == "string"]]
