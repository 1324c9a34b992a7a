"""Exact medians by narrowing: a sketch brackets the middle, counts prove it, and only the bracket is gathered.

No task ever holds more than the sketch or a bracket of at most GATHER_ROWS distinct values, however large
the column is; each extra round narrows the bracket about two thousand times.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prepframe.functions.columns import present

SKETCH_ACCURACY = 10_000
SLACK = 2.0 / SKETCH_ACCURACY
GATHER_ROWS = 50_000
# NaN is free to stand for "below the bracket": missing values were dropped before.
BELOW = float("nan")


@dataclass
class Bracket:
    """The middle of a column lies between lo and hi; n values are present."""

    n: int
    lo: float
    hi: float

    @property
    def ranks(self) -> tuple[int, int]:
        """0-based ranks of the two middle values (the same one when n is odd)."""
        return (self.n - 1) // 2, self.n // 2


def sketch(value: Column) -> Column:
    """Aggregate: a pair of values on either side of the median, as (lo, hi)."""
    at = F.array(F.lit(0.5 - SLACK), F.lit(0.5 + SLACK))
    return F.percentile_approx(value.cast("double"), at, SKETCH_ACCURACY)


def _narrow(values: DataFrame, brackets: dict[str, Bracket]) -> dict[str, Bracket]:
    """Count both sides of every bracket, then sketch again around the wanted ranks inside it."""

    def inside(c: str) -> Column:
        return F.col(c).between(brackets[c].lo, brackets[c].hi)

    counts = values.agg(
        *[F.count_if(F.col(c) < brackets[c].lo).alias(f"{c}_below") for c in brackets],
        *[F.count_if(inside(c)).alias(f"{c}_in") for c in brackets],
    ).first()
    aims = []
    for c, b in brackets.items():
        below, n_in = counts[f"{c}_below"], counts[f"{c}_in"]
        first, last = b.ranks
        low = max(0.0, (first - below) / n_in - SLACK)
        high = min(1.0, (last + 1 - below) / n_in + SLACK)
        at = F.array(F.lit(low), F.lit(high))
        aims.append(F.percentile_approx(F.when(inside(c), F.col(c)), at, SKETCH_ACCURACY).alias(c))
    row = values.agg(*aims).first()
    return {c: Bracket(b.n, *row[c]) for c, b in brackets.items()}


def _gather(values: DataFrame, brackets: dict[str, Bracket], limit: int) -> dict[str, list] | None:
    """Counts of the values up to each bracket's end; all that lie below a bracket count as one group."""
    marked = values.select(
        *[F.when(F.col(c) < b.lo, BELOW).when(F.col(c) <= b.hi, F.col(c)).alias(c) for c, b in brackets.items()]
    )
    rows = (
        marked.unpivot([], list(brackets), "name", "v")
        .where("v IS NOT NULL")
        .groupBy("name", "v")
        .agg(F.count(F.lit(1)).alias("n"))
        .limit(limit + 1)
        .collect()
    )
    if len(rows) > limit:
        return None
    found: dict[str, list] = {c: [] for c in brackets}
    for r in rows:
        found[r["name"]].append((not math.isnan(r["v"]), r["v"], r["n"]))
    return found


def _pick(groups: list, ranks: tuple[int, int]) -> float | None:
    """The mean of the values at the two ranks, or None when the bracket does not hold them."""
    picked, seen = [], 0
    for is_inside, value, n in sorted(groups):
        picked += [value if is_inside else None for r in ranks if seen <= r < seen + n]
        seen += n
    if len(picked) < 2 or None in picked:
        return None
    return picked[0] if picked[0] == picked[1] else (picked[0] + picked[1]) / 2.0


def finish_medians(
    df: DataFrame, brackets: dict[str, tuple[int, list | None]], gather_rows: int = GATHER_ROWS
) -> dict[str, float | None]:
    """Medians from each column's count and sketch pair (as aggregated with `sketch`)."""
    medians: dict[str, float | None] = {c: None for c in brackets}
    open_ = {c: Bracket(n, *pair) for c, (n, pair) in brackets.items() if n}
    names = {c: f"c{i}" for i, c in enumerate(open_)}
    values = df.select(*[present(df, c).cast("double").alias(names[c]) for c in open_])
    while open_:
        found = _gather(values.select(*[names[c] for c in open_]), {names[c]: b for c, b in open_.items()}, gather_rows)
        if found is None:
            narrowed = _narrow(values, {names[c]: b for c, b in open_.items()})
            if all(narrowed[names[c]] == b for c, b in open_.items()):
                gather_rows *= 2
            open_ = {c: narrowed[names[c]] for c in open_}
            continue
        for c, b in list(open_.items()):
            medians[c] = _pick(found[names[c]], b.ranks)
            if medians[c] is None:
                # the sketch missed its stated error: fall back to the whole range
                open_[c] = Bracket(b.n, float("-inf"), float("inf"))
            else:
                del open_[c]
    return medians


def exact_medians(df: DataFrame, cols: Sequence[str], gather_rows: int = GATHER_ROWS) -> dict[str, float | None]:
    if not cols:
        return {}
    row = df.agg(
        *[F.count(present(df, c)).alias(f"n{i}") for i, c in enumerate(cols)],
        *[sketch(present(df, c)).alias(f"s{i}") for i, c in enumerate(cols)],
    ).first()
    return finish_medians(df, {c: (row[f"n{i}"], row[f"s{i}"]) for i, c in enumerate(cols)}, gather_rows)


#: Bits of a whole number that one round settles.
_ROUND_BITS = 16


def whole_medians(df: DataFrame, cols: Sequence[str]) -> dict[str, Decimal | None]:
    """Exact medians of whole-number columns, whatever their size: sixteen bits a round, by counting.

    A round groups the values that share the bits settled so far by their next bits; one row for each column and middle
    rank reaches the driver.
    """
    names = {f"c{i}": c for i, c in enumerate(cols)}
    values = df.select(*[present(df, c).cast("long").alias(n) for n, c in names.items()])
    counted = values.agg(*[F.count(n).alias(n) for n in names]).first()
    long = values.unpivot([], list(names), "name", "v").where("v IS NOT NULL")
    # (column, which of the two middles, rank among what is left, bits settled)
    wanted = [(n, k, r, 0) for n in names if counted[n] for k, r in enumerate(((counted[n] - 1) // 2, counted[n] // 2))]
    for shift in range(64 - _ROUND_BITS, -1, -_ROUND_BITS):
        if not wanted:
            break
        state = F.broadcast(df.sparkSession.createDataFrame(wanted, "name string, which int, rank long, settled long"))
        here = long.join(state, "name")
        if shift + _ROUND_BITS < 64:
            here = here.where(F.shiftright("v", shift + _ROUND_BITS) == F.col("settled"))
        bucket = F.shiftright("v", shift).alias("bucket")
        counts = here.groupBy("name", "which", "rank", bucket).agg(F.count(F.lit(1)).alias("n"))
        upto = F.sum("n").over(Window.partitionBy("name", "which").orderBy("bucket"))
        met = counts.withColumn("upto", upto).where("upto > rank").groupBy("name", "which", "rank")
        first = met.agg(F.min(F.struct("bucket", "n", "upto")).alias("at")).collect()
        wanted = [(r["name"], r["which"], r["rank"] - (r["at"]["upto"] - r["at"]["n"]), r["at"]["bucket"]) for r in first]
    middles: dict[str, list[int]] = {}
    for n, _, _, value in wanted:
        middles.setdefault(n, []).append(value)
    return {c: Decimal(sum(middles[n])) / 2 if n in middles else None for n, c in names.items()}
