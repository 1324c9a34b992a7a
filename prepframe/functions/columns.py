"""Column helpers: safe references, missing values, text clean-up, number and date parsing."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The texts a CSV reader takes for "missing" by default.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Known date formats; when two fit equally well the earlier one wins.
DATE_FORMATS = [
    "yyyy-M-d", "d-M-yyyy", "M-d-yyyy",
    "yyyy/M/d", "d/M/yyyy", "M/d/yyyy",
    "yyyy.M.d", "d.M.yyyy", "M.d.yyyy",
    "yyyy-M-d H:m:s", "d-M-yyyy H:m:s",
    "yyyy/M/d H:m:s", "d/M/yyyy H:m:s",
    "d.M.yyyy H:m:s", "yyyy.M.d H:m:s",
    "H:m:s d-M-yyyy", "H:m:s yyyy-M-d",
]

# What counts as a number when a column's kind is guessed.
PLAIN_NUMBER = r"^-?\d+(\.\d+)?$"
# What a number may look like when it is read (Spark's own cast would also take "1.5f" and "2D").
READABLE_NUMBER = r"(?i)^[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf|infinity)$"


def col(name: str) -> Column:
    """Reference a column whatever its name holds (dots, blanks, backticks)."""
    return F.col("`" + name.replace("`", "``") + "`")


def is_numeric(dtype: T.DataType) -> bool:
    """Numbers, never booleans."""
    return isinstance(dtype, T.NumericType)


def present(df: DataFrame, name: str) -> Column:
    """The column with NaN turned into NULL, so that one test finds all missing values."""
    c = col(name)
    if isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType)):
        return F.when(~F.isnan(c), c)
    return c


def strip(c: Column) -> Column:
    """Drop white space (blanks, tabs, newlines) at both ends."""
    return F.btrim(c, F.lit(" \t\n\r\x0b\x0c"))


def na_to_null(c: Column) -> Column:
    return F.when(~c.isin(NA_TOKENS), c)


def parse_number(c: Column, decimal_mark: str = ".") -> Column:
    """Text to double; what is not a number becomes NULL."""
    text = strip(c)
    if decimal_mark == ",":
        text = F.replace(text, F.lit(","), F.lit("."))
    return F.when(text.rlike(READABLE_NUMBER), text.try_cast("double"))


def parse_date(c: Column, fmt: str | None) -> Column:
    """Text to a timestamp without zone; with no format the general parser is used."""
    if fmt is None:
        return strip(c).try_cast("timestamp_ntz")
    return F.try_to_timestamp(strip(c), F.lit(fmt)).cast("timestamp_ntz")


def short_label(c: Column, limit: int = 15, keep: int = 12) -> Column:
    """Long chart labels are cut and end in three dots."""
    return F.when(F.length(c) > limit, F.concat(F.substring(c, 1, keep), F.lit("..."))).otherwise(c)


_DATE_PARTS = {
    "yyyy": r"\d{4}",
    "M": r"(0?[1-9]|1[0-2])",
    "d": r"(0?[1-9]|[12]\d|3[01])",
    "H": r"([01]?\d|2[0-3])",
    "m": r"[0-5]?\d",
    "s": r"[0-5]?\d",
}


def date_shape(fmt: str) -> str:
    """A regular expression for texts of a date format, right but for the length of months.

    Spark's parser builds an exception for every text it cannot read; the test in front avoids almost all.
    """
    parts = re.split("(yyyy|[MdHms])", fmt)
    return "^" + "".join(_DATE_PARTS.get(p) or re.escape(p) for p in parts) + "$"


def fits_date(c: Column, fmt: str) -> Column:
    return c.rlike(date_shape(fmt)) & F.try_to_timestamp(c, F.lit(fmt)).isNotNull()


def coerce_literal(value, dtype: T.DataType):
    """Give a user-typed literal the column's type; ValueError when it does not fit."""
    if value is None or isinstance(dtype, T.StringType):
        return value if value is None else str(value)
    if isinstance(dtype, T.BooleanType):
        if str(value).lower() in ("true", "false"):
            return str(value).lower() == "true"
        raise ValueError(f"{value!r} is not a boolean")
    if isinstance(dtype, T.IntegralType):
        number = int(value)
        if float(value) != number:
            raise ValueError(f"{value!r} is not a whole number")
        return number
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return float(value)
    return value
