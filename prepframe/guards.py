"""Argument checks made before any job starts, and column lists by role."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from prepframe.functions.columns import is_numeric

KIND = "kind"
CATEGORIES = "categories"


def as_list(cols: str | Sequence[str] | None) -> list[str]:
    if cols is None:
        return []
    return [cols] if isinstance(cols, str) else list(cols)


def require(df: DataFrame, cols: str | Sequence[str]) -> list[str]:
    cols = as_list(cols)
    unknown = [c for c in cols if c not in df.columns]
    if unknown:
        raise ValueError(f"unknown columns: {unknown}")
    return cols


def require_numeric(df: DataFrame, cols: str | Sequence[str]) -> list[str]:
    cols = require(df, cols)
    wrong = [c for c in cols if not is_numeric(df.schema[c].dataType)]
    if wrong:
        raise ValueError(f"columns are not numeric: {wrong}")
    return cols


def require_text(df: DataFrame, cols: str | Sequence[str]) -> list[str]:
    cols = require(df, cols)
    wrong = [c for c in cols if not isinstance(df.schema[c].dataType, T.StringType)]
    if wrong:
        raise ValueError(f"columns are neither text nor categorical: {wrong}")
    return cols


def numeric_columns(df: DataFrame, cols: Sequence[str] | None = None) -> list[str]:
    """Numeric columns, of the chosen ones or of all; the others are left out."""
    return [f.name for f in df.schema if is_numeric(f.dataType) and (cols is None or f.name in cols)]


def chosen_numeric(df: DataFrame, cols: Sequence[str] | None) -> list[str]:
    names = numeric_columns(df, None if cols is None else as_list(cols))
    if not names:
        raise ValueError("no numeric columns among those chosen")
    return names


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def categories_of(df: DataFrame, name: str) -> list | None:
    """The category list a column carries, if it is categorical."""
    meta = df.schema[name].metadata
    return meta.get(CATEGORIES) if meta.get(KIND) == "categorical" else None


def with_categories(df: DataFrame, name: str, values: Sequence) -> dict:
    """A column's metadata, its category list extended by those of the values that it lacks."""
    meta, known = dict(df.schema[name].metadata), categories_of(df, name)
    if known is not None:
        meta[CATEGORIES] = [*known, *dict.fromkeys(v for v in values if v is not None and v not in known)]
    return meta


def columns_by_role(df: DataFrame) -> dict[str, list[str]]:
    roles: dict[str, list[str]] = {"numeric": [], "categorical": [], "date": [], "text": [], "other": []}
    for f in df.schema:
        if is_numeric(f.dataType):
            role = "numeric"
        elif f.metadata.get(KIND) == "categorical":
            role = "categorical"
        elif isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            role = "date"
        elif isinstance(f.dataType, T.StringType):
            role = "text"
        else:
            role = "other"
        roles[role].append(f.name)
    return roles
