"""Row positions 0..n-1 in a stated order, without sorting the table in one task.

The table is range-partitioned on the order and written once with each row's part number and place in the
part. Parts are then shifted by the number of rows before them, of which there is one figure per part. Since
the places are read back from files, they cannot change when a task is run again.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from prepframe.functions.columns import col
from prepframe.scratch import stored

ROW_ID = "_row_id"
_PART, _PLACE, _ARRIVAL = "_part", "_place", "_arrival"
_PLACE_MASK = (1 << 33) - 1


def order_columns(order_by: Sequence[str | Column] | str | Column) -> list[Column]:
    if isinstance(order_by, (str, Column)):
        order_by = [order_by]
    return [col(o) if isinstance(o, str) else o for o in order_by]


@dataclass
class Numbered:
    """A stored table in order; `before[p]` rows stand in parts ahead of part p."""

    table: DataFrame
    before: dict[int, int]
    sizes: dict[int, int]

    @property
    def count(self) -> int:
        return sum(self.sizes.values())

    def rows(self, start: int | None = None, end: int | None = None, name: str = ROW_ID) -> DataFrame:
        """Rows with positions from start to end (both included); parts outside are not read."""
        table, parts = self.table, self.before
        if start is not None:
            parts = {p: b for p, b in parts.items() if b <= end and b + self.sizes[p] > start}
            table = table.where(col(_PART).isin(list(parts))) if parts else table.where(F.lit(False))
        shifts = table.sparkSession.createDataFrame(list(parts.items()), f"{_PART} int, _before long")
        numbered = table.join(F.broadcast(shifts), _PART).withColumn(name, F.col("_before") + col(_PLACE))
        if start is not None:
            numbered = numbered.where(col(name).between(start, end))
        return numbered.drop(_PART, _PLACE, "_before")


    def at(self, positions: Sequence[int]) -> dict[int, Row]:
        """A few single rows by position, without their row numbers."""
        wanted = [p for p in positions if 0 <= p < self.count]
        parts = {p: b for p, b in self.before.items() if any(b <= w < b + self.sizes[p] for w in wanted)}
        places = F.lit(False)
        for part, before in parts.items():
            here = [w - before for w in wanted if before <= w < before + self.sizes[part]]
            places = places | ((col(_PART) == part) & col(_PLACE).isin(here))
        found = {}
        for r in self.table.where(places).collect():
            values = r.asDict()
            position = self.before[values.pop(_PART)] + values.pop(_PLACE)
            found[position] = Row(**values)
        return found


def number_rows(df: DataFrame, order_by: Sequence[str | Column] = ()) -> Numbered:
    """Store the table in the given order (ties, and no order at all, keep the order of arrival)."""
    order = order_columns(order_by)
    if order:
        keys = [*order, F.col(_ARRIVAL)]
        df = (
            df.withColumn(_ARRIVAL, F.monotonically_increasing_id())
            .repartitionByRange(*keys)
            .sortWithinPartitions(*keys)
            .drop(_ARRIVAL)
        )
    table = stored(
        df.select(
            "*",
            F.spark_partition_id().alias(_PART),
            F.monotonically_increasing_id().bitwiseAND(F.lit(_PLACE_MASK)).alias(_PLACE),
        ),
        "rows",
    )
    counted = table.groupBy(_PART).agg(F.count(F.lit(1)).alias("n")).collect()
    before, sizes, total = {}, {}, 0
    for row in sorted(counted, key=lambda r: r[_PART]):
        before[row[_PART]], sizes[row[_PART]] = total, row["n"]
        total += row["n"]
    return Numbered(table, before, sizes)


def with_row_id(df: DataFrame, order_by: Sequence[str | Column] = (), name: str = ROW_ID) -> DataFrame:
    return number_rows(df, order_by).rows(name=name)


def with_weight_before(numbered: Numbered, weight: str, name: str) -> DataFrame:
    """The numbered rows with, as `name`, the total weight of all rows earlier in the order."""
    table = numbered.table
    totals = {r[_PART]: r["w"] for r in table.groupBy(_PART).agg(F.sum(col(weight)).alias("w")).collect()}
    shifts, total = [], 0
    for part in sorted(totals):
        shifts.append((part, numbered.before[part], total))
        total += totals[part] or 0
    shift_table = table.sparkSession.createDataFrame(shifts, f"{_PART} int, _before long, _weight long")
    within = Window.partitionBy(_PART).orderBy(_PLACE).rowsBetween(Window.unboundedPreceding, -1)
    return (
        table.withColumn("_within", F.coalesce(F.sum(col(weight)).over(within), F.lit(0)))
        .join(F.broadcast(shift_table), _PART)
        .withColumn(ROW_ID, F.col("_before") + col(_PLACE))
        .withColumn(name, F.col("_weight") + F.col("_within"))
        .drop(_PART, _PLACE, "_before", "_weight", "_within")
    )
