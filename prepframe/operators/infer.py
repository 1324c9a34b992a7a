"""Column kinds guessed from content: boolean, numeric, date, categorical or text.

All columns are judged in one aggregation over (column, value) pairs, whose size does not depend on the number
of columns; a second one counts the distinct values of the columns that may be categorical.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prepframe.functions.columns import (
    DATE_FORMATS,
    PLAIN_NUMBER,
    READABLE_NUMBER,
    col,
    fits_date,
    is_numeric,
    parse_date,
    parse_number,
    strip,
)
from prepframe.guards import CATEGORIES, KIND, require

# How sure a guess must be, and how few values make a category.
MIN_SHARE = 0.7
MIN_VALUES = 3
MAX_CATEGORY_VALUES = 100
MAX_CATEGORY_SHARE = 0.5


def _shapes(fmt: str) -> list[str]:
    """The texts of a date format with every digit written as 0: single-digit parts may have one or two."""
    shapes = [""]
    for part in re.split("(yyyy|[MdHms])", fmt):
        options = ["0000"] if part == "yyyy" else ["0", "00"] if part in ("M", "d", "H", "m", "s") else [part]
        shapes = [s + o for s in shapes for o in options]
    return shapes


#: The longest shape of any format; longer texts are no dates.
_LONGEST = max(len(s) for f in DATE_FORMATS for s in _shapes(f))


def _by_shape() -> tuple[Column, Column]:
    """A text's digits as zeros, and from this shape the formats it allows, a bit for each."""
    bits: dict[str, int] = {}
    for i, f in enumerate(DATE_FORMATS):
        for s in _shapes(f):
            bits[s] = bits.get(s, 0) | 1 << i
    same: dict[int, list[str]] = {}
    for s, number in bits.items():
        same.setdefault(number, []).append(s)
    shape = F.when(F.length("text") <= _LONGEST, F.translate("text", "123456789", "000000000"))
    out = F.lit(0)
    for number, shapes in same.items():
        out = F.when(F.col("shape").isin(shapes), F.lit(number)).otherwise(out)
    return shape, out


@dataclass(frozen=True)
class Kind:
    kind: str
    decimal_mark: str | None = None
    date_format: str | None = None
    whole: bool = False
    parse_loss: int = 0
    categories: tuple | None = None


def _texts(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    texts = df.select(*[col(b) for b in by], *[col(c).cast("string").alias(c) for c in cols])
    return texts.unpivot([col(b) for b in by], [col(c) for c in cols], "column", "value")


def _share(hits: str, of: str = "n") -> Column:
    return F.try_divide(F.col(hits), F.col(of))


def detect(df: DataFrame, cols: Sequence[str] | None = None, by: Sequence[str] = ()) -> DataFrame:
    """One row per column (and group, if `by` is said) with the counts every decision rests on, over all rows."""
    names = require(df, cols) if cols else [c for c in df.columns if c not in by]
    text, dotted = F.col("text"), F.replace(F.col("text"), F.lit(","), F.lit("."))
    dot, comma = F.contains(text, F.lit(".")), F.contains(text, F.lit(","))
    # cheap tests stand before the dear ones: a text that does not start like a number is neither number nor date
    starts = text.rlike(r"(?i)^[+-]?([.\d]|inf)")
    shape, allowed = _by_shape()
    may = F.col("allowed")
    formats = [F.count_if((may.bitwiseAND(F.lit(1 << i)) != 0) & fits_date(text, f)).alias(f"d{i}") for i, f in enumerate(DATE_FORMATS)]
    return (
        _texts(df, names, by)
        .select(*[col(b) for b in by], "column", strip(F.col("value")).alias("text"))
        .withColumn("shape", shape)
        .withColumn("allowed", allowed)
        .groupBy(*[col(b) for b in by], "column")
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.count(text).alias("n"),
            F.count_if(starts & dotted.rlike(PLAIN_NUMBER)).alias("plain"),
            F.count_if(starts & text.rlike(READABLE_NUMBER)).alias("readable"),
            # a number written with a comma, readable once the comma is a dot
            F.count_if(starts & comma & dotted.rlike(READABLE_NUMBER)).alias("readable_comma"),
            F.count_if(starts & ~dot & ~comma & text.rlike(r"^[+-]?\d{1,18}$")).alias("whole"),
            F.count_if(F.lower(text).isin("true", "false")).alias("boolean"),
            F.count_if(dot & text.rlike(r"\d+\.\d+")).alias("dots"),
            F.count_if(comma & text.rlike(r"\d+,\d+")).alias("commas"),
            F.count_if(starts & text.try_cast("timestamp_ntz").isNotNull()).alias("any_date"),
            F.approx_count_distinct(text, 0.02).alias("distinct_about"),
            *formats,
        )
    )


def decisions(found: DataFrame, min_share: float = MIN_SHARE, date_min_share: float = MIN_SHARE) -> DataFrame:
    """What the counts say, as columns: is_numeric, decimal_mark, date_format, date_hits, is_date (if not numeric)."""
    enough = F.col("n") >= MIN_VALUES
    numeric = F.coalesce(
        (enough & (_share("plain") > min_share)) | ((F.col("n") > 0) & (F.col("readable") == F.col("n"))), F.lit(False)
    )
    hits = F.greatest(*[F.col(f"d{i}") for i in range(len(DATE_FORMATS))])
    best = F.coalesce(
        *[F.when((F.col(f"d{i}") == hits) & (hits > 0), F.lit(f)) for i, f in enumerate(DATE_FORMATS)]
    )
    known = F.try_divide(hits, F.col("n")) > date_min_share
    return found.select(
        "*",
        numeric.alias("is_numeric"),
        F.when(F.col("dots") >= F.col("commas"), ".").otherwise(",").alias("decimal_mark"),
        best.alias("date_format"),
        hits.alias("date_hits"),
        F.coalesce(~numeric & enough & (known | (_share("any_date") > MIN_SHARE)), F.lit(False)).alias("is_date"),
    )


def detect_categorical(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, n_rows, distinct_values, is_categorical) from exact distinct counts."""
    values = _texts(df, require(df, cols)).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    per_column = values.groupBy("column").agg(
        F.sum("n").alias("n_rows"), F.count("value").alias("distinct_values")
    )
    few = (F.col("distinct_values") / F.col("n_rows") < MAX_CATEGORY_SHARE) & (
        F.col("distinct_values") < MAX_CATEGORY_VALUES
    )
    return per_column.select("column", "n_rows", "distinct_values", few.alias("is_categorical"))


def few_values(df: DataFrame, cols: Sequence[str], by: Sequence[str]) -> DataFrame:
    """(by …, column, value): the distinct present values, MAX_CATEGORY_VALUES of a column and group at most.

    A group that shows so many has too many values for a category, whichever they are.
    """
    distinct = _texts(df, require(df, cols), by).where("value IS NOT NULL").distinct()
    return first_values(distinct, by)


def first_values(distinct: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(*[col(b) for b in by], "column").orderBy("value"))
    return distinct.withColumn("_place", place).where(F.col("_place") <= MAX_CATEGORY_VALUES).drop("_place")


def _categories(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple]:
    """The sorted values of columns known to hold few of them."""
    if not cols:
        return {}
    rows = _texts(df, cols).where("value IS NOT NULL").distinct().collect()
    return {c: tuple(sorted(r["value"] for r in rows if r["column"] == c)) for c in cols}


def _typed_kind(dtype: T.DataType) -> Kind | None:
    if is_numeric(dtype):
        return Kind("numeric", whole=isinstance(dtype, T.IntegralType))
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return Kind("date")
    if isinstance(dtype, T.BooleanType):
        return Kind("boolean")
    return None if isinstance(dtype, T.StringType) else Kind("other")


def kind_of(r: Row, listed_date: bool = False, date_format: str | None = None) -> Kind:
    """What a row of decisions says of its column; categories are told apart from text by their values, elsewhere."""
    if listed_date:
        return Kind("date", date_format=date_format or r["date_format"])
    if r["n"] == 0:
        return Kind("empty")
    if r["boolean"] == r["n"]:
        return Kind("boolean")
    if r["is_numeric"]:
        read = r["readable"] + (r["readable_comma"] if r["decimal_mark"] == "," else 0)
        return Kind("numeric", decimal_mark=r["decimal_mark"], whole=r["whole"] == r["n"], parse_loss=r["n"] - read)
    if r["is_date"]:
        fmt = r["date_format"]
        return Kind("date", date_format=fmt, parse_loss=r["n"] - (r["date_hits"] if fmt else r["any_date"]))
    return Kind("text")


def infer_kinds(
    df: DataFrame,
    date_columns: Sequence[str] = (),
    date_format: str | None = None,
    min_share: float = MIN_SHARE,
    date_min_share: float = MIN_SHARE,
) -> dict[str, Kind]:
    """The kind of every column: listed dates first, then boolean, numeric, date, categorical, text.

    `date_min_share=0` takes a column for a date as soon as one value fits a known format.
    """
    require(df, list(date_columns))
    kinds = {f.name: _typed_kind(f.dataType) for f in df.schema}
    texts = [c for c, k in kinds.items() if k is None]
    maybe_categorical = []
    if texts:
        for r in decisions(detect(df, texts), min_share, date_min_share).collect():
            c = r["column"]
            kinds[c] = kind_of(r, c in date_columns, date_format)
            if kinds[c].kind == "text" and r["distinct_about"] < 2 * MAX_CATEGORY_VALUES:
                maybe_categorical.append(c)
    if maybe_categorical:
        few = [r["column"] for r in detect_categorical(df, maybe_categorical).collect() if r["is_categorical"]]
        for c, values in _categories(df, few).items():
            kinds[c] = replace(kinds[c], kind="categorical", categories=values)
    return kinds


def apply_kinds(df: DataFrame, kinds: Mapping[str, Kind]) -> DataFrame:
    """Convert text columns to their kinds in one projection; what does not parse becomes missing."""

    def converted(c: str) -> Column:
        k = kinds.get(c)
        if k is None or not isinstance(df.schema[c].dataType, T.StringType):
            return col(c)
        if k.kind == "numeric":
            if k.whole:
                return strip(col(c)).try_cast("long").alias(c)
            return parse_number(col(c), k.decimal_mark or ".").alias(c)
        if k.kind == "date":
            return parse_date(col(c), k.date_format).alias(c)
        if k.kind == "boolean":
            return strip(col(c)).try_cast("boolean").alias(c)
        if k.kind == "categorical":
            return col(c).alias(c, metadata={KIND: "categorical", CATEGORIES: list(k.categories)})
        return col(c)

    return df.select(*[converted(c) for c in df.columns])


def kinds_table(df: DataFrame, kinds: Mapping[str, Kind]) -> DataFrame:
    rows = [(c, k.kind, k.date_format, k.decimal_mark, k.parse_loss) for c, k in kinds.items()]
    return df.sparkSession.createDataFrame(
        rows, "column string, kind string, date_format string, decimal_mark string, parse_loss long"
    )


def narrow_integers(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Give whole-number columns the smallest integer type that holds their range. Doubles keep their precision."""
    names = [
        f.name
        for f in df.schema
        if isinstance(f.dataType, (T.LongType, T.IntegerType, T.ShortType)) and (cols is None or f.name in cols)
    ]
    if not names:
        return df
    row = df.agg(
        *[agg(col(c)).alias(f"{tag}{i}") for i, c in enumerate(names) for tag, agg in (("lo", F.min), ("hi", F.max))]
    ).first()
    targets = {}
    for i, c in enumerate(names):
        lo, hi = row[f"lo{i}"], row[f"hi{i}"]
        if lo is None:
            continue
        for target, top in (("tinyint", 2**7), ("smallint", 2**15), ("int", 2**31)):
            if -top <= lo and hi < top:
                targets[c] = target
                break
    return df.select(*[col(c).cast(targets[c]).alias(c) if c in targets else col(c) for c in df.columns])
