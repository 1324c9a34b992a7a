"""Sub-tables: rows by position, columns by name, pages and patches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prepframe.functions.columns import col
from prepframe.guards import as_list, categories_of, require, with_categories
from prepframe.operators.rowid import ROW_ID, Numbered, number_rows, order_columns


def keep_columns(df: DataFrame, cols: str | Sequence[str]) -> DataFrame:
    return df.select(*[col(c) for c in require(df, cols)])


def remove_columns(df: DataFrame, cols: str | Sequence[str]) -> DataFrame:
    return df.drop(*require(df, cols))


def preview(df: DataFrame, n: int = 5, order_by: Sequence[str | Column] = ()) -> DataFrame:
    """The first n rows."""
    order = order_columns(order_by)
    return (df.orderBy(*order) if order else df).limit(n)


def _check_positions(positions: Sequence[int], total: int) -> None:
    outside = [p for p in positions if not 0 <= p < total]
    if outside:
        raise ValueError(f"row positions outside 0..{total - 1}: {outside[:10]}")


def _as_numbered(df: DataFrame | Numbered, order_by) -> Numbered:
    return df if isinstance(df, Numbered) else number_rows(df, order_by)


def _key_names(df: DataFrame | Numbered, order_by) -> list[str] | None:
    """The order's columns, if rows can be looked up by their values: plain names of simple types."""
    names = as_list(order_by) if isinstance(order_by, str) else list(order_by)
    if isinstance(df, Numbered) or not names or not all(isinstance(o, str) for o in names):
        return None
    simple = (T.IntegralType, T.StringType, T.DateType)
    return names if all(isinstance(df.schema[c].dataType, simple) for c in require(df, names)) else None


class _Keys:
    """The order columns alone, numbered: positions are settled on them, and only the rows wanted are then read
    from the table by key. None is given wherever equal or missing keys leave it open which rows are meant."""

    def __init__(self, df: DataFrame, names: list[str]):
        self.df, self.names = df, names
        self.numbered = number_rows(df.select(*[col(c) for c in names]), names)

    def distinct_keys(self, positions: Sequence[int]) -> dict[int, tuple] | None:
        """The keys at the positions, if no neighbour has the same one."""
        near = self.numbered.at(sorted({q for p in positions for q in (p - 1, p, p + 1)}))
        found = {p: tuple(near[p]) for p in positions}
        for p, key in found.items():
            if None in key or any(q in near and tuple(near[q]) == key for q in (p - 1, p + 1)):
                return None
        return found

    def table(self, positions: Sequence[int]) -> DataFrame | None:
        """(keys…, _seq) for a list of positions."""
        found = self.distinct_keys(positions)
        if found is None:
            return None
        fields = [self.df.schema[c] for c in self.names]
        schema = T.StructType([*fields, T.StructField("_seq", T.LongType())])
        return self.df.sparkSession.createDataFrame([(*found[p], i) for i, p in enumerate(positions)], schema)

    def between(self, start: int, end: int) -> DataFrame | None:
        """Rows from start to end by a condition on the keys, which reaches the scan."""
        near = {p: tuple(r) for p, r in self.numbered.at([start - 1, start, end, end + 1]).items()}
        low, high = near[start], near[end]
        if None in (*low, *high) or near.get(start - 1) == low or near.get(end + 1) == high:
            return None

        def key(values: tuple) -> Column:
            return F.struct(*[F.lit(v).cast(self.df.schema[c].dataType).alias(c) for c, v in zip(self.names, values)])

        first, own = col(self.names[0]), F.struct(*[col(c).alias(c) for c in self.names])
        rows = self.df.where((first >= F.lit(low[0])) & (first <= F.lit(high[0])))
        return rows if len(self.names) == 1 else rows.where((own >= key(low)) & (own <= key(high)))


#: Positions up to which their rows' keys are looked up, and up to which a table of them is broadcast.
KEYED_POSITIONS = 1_000
BROADCAST_POSITIONS = 10_000


def _positions_table(df: DataFrame, positions: Sequence[int]) -> DataFrame:
    """(row id, _seq), to be broadcast if it is small; a larger one is joined as Spark sees fit."""
    rows = [(int(p), i) for i, p in enumerate(positions)]
    table = df.sparkSession.createDataFrame(rows, f"{ROW_ID} long, _seq long")
    return F.broadcast(table) if len(rows) <= BROADCAST_POSITIONS else table


def keep_rows(df: DataFrame | Numbered, positions: Sequence[int], order_by: Sequence[str | Column] = ()) -> DataFrame:
    """Rows at the listed positions, in the listed order, as often as listed."""
    names = _key_names(df, order_by)
    if names and 0 < len(positions) <= KEYED_POSITIONS:
        keys = _Keys(df, names)
        _check_positions(positions, keys.numbered.count)
        wanted = keys.table(positions)
        if wanted is not None:
            return df.join(F.broadcast(wanted), names).orderBy("_seq").select(*[col(c) for c in df.columns])
    numbered = _as_numbered(df, order_by)
    _check_positions(positions, numbered.count)
    if not positions:
        return numbered.rows(0, -1).drop(ROW_ID)
    near = numbered.rows(min(positions), max(positions))
    return near.join(_positions_table(near, positions), ROW_ID).orderBy("_seq").drop(ROW_ID, "_seq")


def remove_rows(df: DataFrame | Numbered, positions: Sequence[int], order_by: Sequence[str | Column] = ()) -> DataFrame:
    names = _key_names(df, order_by)
    if names and 0 < len(positions) <= KEYED_POSITIONS:
        keys = _Keys(df, names)
        _check_positions(positions, keys.numbered.count)
        gone = keys.table(sorted(set(positions)))
        if gone is not None:
            return df.join(F.broadcast(gone.drop("_seq")), names, "left_anti").select(*[col(c) for c in df.columns])
    numbered = _as_numbered(df, order_by)
    _check_positions(positions, numbered.count)
    rows = numbered.rows()
    return rows.join(_positions_table(rows, positions), ROW_ID, "left_anti").drop(ROW_ID)


def _between(df: DataFrame | Numbered, start: int, end: int, order_by, keys: _Keys | None) -> DataFrame:
    rows = keys.between(start, end) if keys else None
    return _as_numbered(df, order_by).rows(start, end).orderBy(ROW_ID).drop(ROW_ID) if rows is None else rows.orderBy(*keys.names)


def rows_range(df: DataFrame | Numbered, start: int, end: int, order_by: Sequence[str | Column] = ()) -> DataFrame:
    """Rows from position start to end, both included."""
    names = _key_names(df, order_by)
    keys = _Keys(df, names) if names else None
    numbered = keys.numbered if keys else (df := _as_numbered(df, order_by))
    _check_positions([start, end], numbered.count)
    if start > end:
        raise ValueError("start lies after end")
    return _between(df, start, end, order_by, keys)


def extract_subtable(
    df: DataFrame | Numbered,
    rows: Sequence[int] | None = None,
    cols: str | Sequence[str] | None = None,
    mode: str = "keep",
    order_by: Sequence[str | Column] = (),
) -> DataFrame:
    """Keep, or remove, the listed rows and columns."""
    if mode not in ("keep", "remove"):
        raise ValueError("mode must be keep or remove")
    names = as_list(cols)
    require(df.table if isinstance(df, Numbered) else df, names)
    if rows is not None:
        df = (keep_rows if mode == "keep" else remove_rows)(df, rows, order_by)
    elif isinstance(df, Numbered):
        df = df.rows().drop(ROW_ID)
    if names:
        df = (keep_columns if mode == "keep" else remove_columns)(df, names)
    return df


def page(
    df: DataFrame | Numbered, number: int, size: int | None = 100, order_by: Sequence[str | Column] = ()
) -> tuple[DataFrame, dict[str, int]]:
    """A page of rows (0-based; `size=None` means all) and its place: page, pages, first, last, total.

    A page number past either end is moved to the nearest page. Number the table once with `number_rows`
    to leaf through it: each page then reads only the files that hold it.
    """
    if size is not None and size < 1:
        raise ValueError("page size must be positive")
    names = _key_names(df, order_by)
    keys = _Keys(df, names) if names else None
    numbered = keys.numbered if keys else (df := _as_numbered(df, order_by))
    total = numbered.count
    size = size or max(total, 1)
    pages = max(1, -(-total // size))
    number = min(max(number, 0), pages - 1)
    first, last = number * size, min((number + 1) * size, total) - 1
    shown = _between(df, first, last, order_by, keys if total else None)
    return shown, {"page": number, "pages": pages, "first": first + 1 if total else 0, "last": last + 1, "total": total}


def drop_null_target(df: DataFrame, target: str) -> DataFrame:
    require(df, target)
    return df.dropna(subset=[target])


def split_target(df: DataFrame, target: str) -> tuple[DataFrame, DataFrame]:
    """Features and target of the rows whose target is present."""
    rows = drop_null_target(df, target)
    return rows.drop(target), rows.select(col(target))


def apply_patches(df: DataFrame, patches: DataFrame, key: str) -> DataFrame:
    """Edit cells in bulk from a table (key, column, value): values are cast to the column's type.

    A text that does not fit its column leaves the cell as it was. Keys must be unique in `df`; the latest of
    several patches for one cell is taken if the table has a `seq` column, else the greatest text.
    """
    require(df, key)
    require(patches, [key, "column", "value"])
    targets = [c for c in df.columns if c != key]
    rank = F.col("seq") if "seq" in patches.columns else F.col("value")
    per_key = patches.groupBy(col(key)).agg(
        *[
            F.max_by(F.when(F.col("column") == c, F.col("value")), F.when(F.col("column") == c, rank)).alias(f"_p{i}")
            for i, c in enumerate(targets)
        ]
    )
    joined = df.join(per_key, key, "left")
    listed = [c for c in targets if categories_of(df, c) is not None]
    new: dict[str, list] = {c: [] for c in listed}
    if listed:
        wanted = patches.where(F.col("column").isin(listed) & F.col("value").isNotNull()).select("column", "value").distinct()
        for r in wanted.orderBy("column", "value").collect():  # what categories the patches name
            new[r["column"]].append(r["value"])
    patched = {
        c: F.coalesce(col(f"_p{i}").try_cast(df.schema[c].dataType), col(c)).alias(c, metadata=with_categories(df, c, new.get(c, [])))
        for i, c in enumerate(targets)
    }
    return joined.select(*[patched.get(c, col(c)) for c in df.columns])
