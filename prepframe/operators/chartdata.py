"""The aggregates behind bar, pie, line and scatter charts."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prepframe.functions.columns import col, present
from prepframe.guards import as_list, require, require_numeric

# What stands for "no column", and the label of the remaining categories.
NO_COLUMN = ("", "brak", None)
OTHER = "Inne"


def choose_hue(df: DataFrame, hue: str | None = None, color: str | None = None) -> str | None:
    """The hue column, else the colour column, if it exists in the table."""
    for c in (hue, color):
        if c not in NO_COLUMN and c in df.columns:
            return c
    return None


def _counts(df: DataFrame, x: str) -> DataFrame:
    require(df, x)
    return (
        df.where(present(df, x).isNotNull())
        .groupBy(col(x).cast("string").alias("category"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _by_count(descending: bool) -> list:
    return [F.col("n").desc() if descending else F.col("n").asc(), F.col("category").asc()]


def category_counts(df: DataFrame, x: str, descending: bool = True) -> DataFrame:
    """(category, n), missing left out, sorted by count, then by name."""
    return _counts(df, x).orderBy(*_by_count(descending))


def topk_with_other(
    df: DataFrame, x: str, max_categories: int = 8, descending: bool = True, other: str = OTHER
) -> DataFrame:
    """The first max_categories - 1 categories, and one row for the rest when there are more than fit.

    Spark keeps only max_categories rows of the sorted counts; the rest follows from the total.
    """
    if max_categories < 1:
        raise ValueError("max_categories must be at least 1")
    counts = _counts(df, x)
    totals = counts.agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("categories"))
    total, categories = totals.select("total").scalar(), totals.select("categories").scalar()
    order = _by_count(descending)
    place = Window.partitionBy(F.lit(0)).orderBy(*order)
    top = counts.orderBy(*order).limit(max_categories).withColumn("place", F.row_number().over(place))
    before = F.sum("n").over(place.rowsBetween(Window.unboundedPreceding, -1))
    is_other = (F.col("place") == max_categories) & (categories > max_categories)
    return top.select(
        F.when(is_other, F.lit(other)).otherwise(F.col("category")).alias("category"),
        F.when(is_other, total - F.coalesce(before, F.lit(0))).otherwise(F.col("n")).alias("n"),
        is_other.alias("is_other"),
        F.col("place").cast("long").alias("place"),
    ).orderBy("place")


def share_distribution(
    df: DataFrame, x: str, max_categories: int = 8, min_percent: float = 1.0, other: str = OTHER
) -> DataFrame:
    """(category, n, percent, is_other): shares of at least min_percent of the top categories and the rest.

    The rest counts every row not shown under its own name, so its n also takes in small shares left out. With
    nothing left there is one row for the rest, at 100 percent.
    """
    shown = topk_with_other(df, x, max_categories, other=other).collect()
    total = sum(r["n"] for r in shown)
    schema = "category string, n long, percent double, is_other boolean"
    kept = [r for r in shown if total and r["n"] / total * 100 >= min_percent]
    named = sum(r["n"] for r in kept if not r["is_other"])
    rows = [
        (r["category"], total - named if r["is_other"] else r["n"], r["n"] / total * 100, r["is_other"]) for r in kept
    ]
    return df.sparkSession.createDataFrame(rows or [(other, total, 100.0, True)], schema)


def mean_by_category(
    df: DataFrame, x: str, y: str, hue: str | None = None, descending: bool = True
) -> DataFrame:
    """(x, [hue,] mean_y): categories in the order they appear once the rows are sorted by y."""
    require_numeric(df, y)
    groups = [col(c) for c in require(df, [x, *([hue] if hue else [])])]
    v = present(df, y).cast("double")
    edge = F.max(v) if descending else F.min(v)
    means = df.where(col(x).isNotNull() & v.isNotNull()).groupBy(*groups).agg(F.avg(v).alias("_mean"), edge.alias("_edge"))
    first = F.col("_edge").desc() if descending else F.col("_edge").asc()
    return means.orderBy(first, *groups).select(*groups, F.col("_mean").alias("mean_y"))


def line_series(df: DataFrame, x: str, y: str, hue: str | None = None) -> DataFrame:
    """(x, [hue,] mean_y, n, low, high) sorted by x; the band is mean ± 1.96 standard errors."""
    require_numeric(df, y)
    groups = [col(c) for c in require(df, [x, *([hue] if hue else [])])]
    v = present(df, y).cast("double")
    points = (
        df.where(col(x).isNotNull() & v.isNotNull())
        .groupBy(*groups)
        .agg(F.avg(v).alias("_mean"), F.count(v).alias("_n"), F.stddev_samp(v).alias("_s"))
        .orderBy(*groups)
    )
    mean, n = F.col("_mean"), F.col("_n")
    half = F.lit(1.96) * F.col("_s") / F.sqrt(n.cast("double"))
    return points.select(
        *groups, mean.alias("mean_y"), n.alias("n"), (mean - half).alias("low"), (mean + half).alias("high")
    )


def _limits(most: int = 11) -> list[str]:
    """Where a uniform number of 8 hex digits passes from a Poisson count (of mean 1) to the next."""
    out, share, below = [], math.exp(-1), 0.0
    for k in range(most):
        below += share
        out.append(f"{int(below * 2**32):08x}")
        share /= k + 1
    return out


#: A draw's count is the number of limits it reaches.
POISSON_LIMITS = _limits()


def line_band(
    df: DataFrame, x: str, y: str, keys: str | Sequence[str], hue: str | None = None, replicates: int = 200, level: float = 0.95
) -> DataFrame:
    """(x, [hue,] mean_y, n, low, high) sorted by x, with a bootstrap band of the mean.

    In every replicate a row counts as often as a Poisson number drawn from the MD5 of its keys and the replicate says,
    so the band is the same however the rows are partitioned. All replicates come from one grouping, summed before the
    shuffle: a group costs as many sums as there are replicates, whatever its rows. Four replicates share a digest. Rows
    of equal keys are drawn together, so the keys should name a row.
    """
    require_numeric(df, y)
    if replicates < 4 or replicates % 4:
        raise ValueError("replicates must be a multiple of 4")
    if not 0 < level < 1:
        raise ValueError("level must lie between 0 and 1")
    named = require(df, as_list(keys))
    if not named:
        raise ValueError("name the columns that tell rows apart")
    groups = require(df, [x, *([hue] if hue else [])])
    own = [f"_g{i}" for i in range(len(groups))]
    v = present(df, y).cast("double")
    key = F.concat_ws(":", *[F.coalesce(col(k).cast("string"), F.lit("")) for k in named])
    rows = df.where(col(x).isNotNull() & v.isNotNull()).select(*[col(g).alias(a) for g, a in zip(groups, own, strict=True)], v.alias("_v"), key.alias("_key"))
    # Round 0 stands for the rows as they are, the others for four replicates each.
    drawn = rows.withColumn("_round", F.explode(F.sequence(F.lit(0), F.lit(replicates // 4))))
    drawn = drawn.withColumn("_hex", F.when(F.col("_round") > 0, F.md5(F.concat_ws(":", "_key", F.col("_round").cast("string")))))
    sums = []
    for j in range(4):
        digits = F.substring("_hex", 8 * j + 1, 8)
        times = F.when(F.col("_round") == 0, F.lit(1)).otherwise(sum(((digits >= t).cast("int") for t in POISSON_LIMITS), F.lit(0)))
        drawn = drawn.withColumn(f"_w{j}", times)
        sums.append(F.struct(F.sum(F.col(f"_w{j}") * F.col("_v")).alias("s"), F.sum(f"_w{j}").alias("n")))
    each = drawn.groupBy(*own, "_round").agg(F.array(*sums).alias("_all")).select(*own, "_round", F.posexplode("_all").alias("_j", "_m"))
    mean = F.try_divide(F.col("_m.s"), F.col("_m.n"))
    plain = (F.col("_round") == 0) & (F.col("_j") == 0)
    of = F.when(F.col("_round") > 0, mean)  # of a replicate without any row of the group there is no mean
    tail = (1 - level) / 2
    points = each.groupBy(*own).agg(
        F.max(F.when(plain, mean)).alias("_mean"), F.max(F.when(plain, F.col("_m.n"))).alias("_n"), F.percentile(of, [tail, 1 - tail]).alias("_band")
    )
    return points.orderBy(*own).select(
        *[F.col(a).alias(g) for g, a in zip(groups, own, strict=True)], F.col("_mean").alias("mean_y"), F.col("_n").alias("n"), F.col("_band")[0].alias("low"), F.col("_band")[1].alias("high")
    )


def scatter_points(df: DataFrame, x: str, y: str, hue: str | None = None, size: str | None = None) -> DataFrame:
    """One row per point: x, y and, if asked for, hue and size. Points without x or y are not drawn."""
    chosen = {"x": x, "y": y, "hue": hue, "size": size}
    require(df, [c for c in chosen.values() if c])
    points = df.select(*[present(df, c).alias(role) for role, c in chosen.items() if c])
    return points.dropna(subset=["x", "y"])


def scatter_sample(
    df: DataFrame, x: str, y: str, key: str | Sequence[str], limit: int = 5_000, hue: str | None = None, size: str | None = None
) -> DataFrame:
    """At most `limit` points, those whose keys have the smallest digests: the same ones however the rows are parted.

    Each task keeps its own smallest ones and hands on no more. Keys should tell rows apart; rows of equal key are
    ranked by their values.
    """
    keys = [key] if isinstance(key, str) else list(key)
    require(df, keys)
    chosen = {"x": x, "y": y, "hue": hue, "size": size}
    require(df, [c for c in chosen.values() if c])
    text = F.concat_ws("|", *[F.coalesce(col(k).cast("string"), F.lit("")) for k in keys])
    points = df.select(F.md5(text.cast("binary")).alias("_draw"), *[present(df, c).alias(role) for role, c in chosen.items() if c])
    points = points.dropna(subset=["x", "y"])
    return points.orderBy(*points.columns).limit(limit).drop("_draw")


def scatter_bins(df: DataFrame, x: str, y: str, bins: int = 50) -> DataFrame:
    """(x_bin, y_bin, x_low, y_low, n): all points counted in a grid of equal cells, empty cells left out.

    The largest values lie in the last cells; a column with one value has one cell.
    """
    require_numeric(df, [x, y])
    points = df.select(present(df, x).cast("double").alias("x"), present(df, y).cast("double").alias("y")).dropna()
    ends = points.agg(*[f(c).alias(f"{n}_{c}") for c in "xy" for n, f in (("low", F.min), ("high", F.max))])

    def cell(c: str) -> Column:
        at = F.floor((F.col(c) - F.col(f"low_{c}")) * bins / F.nullif(F.col(f"high_{c}") - F.col(f"low_{c}"), F.lit(0.0)))
        return F.least(F.coalesce(at, F.lit(0)), F.lit(bins - 1)).cast("int")

    def low(c: str) -> Column:
        return F.col(f"low_{c}") + F.col(f"{c}_bin") * (F.col(f"high_{c}") - F.col(f"low_{c}")) / bins

    held = points.join(F.broadcast(ends)).select("*", cell("x").alias("x_bin"), cell("y").alias("y_bin"))  # one row of ends
    counted = held.groupBy("x_bin", "y_bin", *ends.columns).agg(F.count(F.lit(1)).alias("n"))
    return counted.select("x_bin", "y_bin", low("x").alias("x_low"), low("y").alias("y_low"), "n")


def trend_line(df: DataFrame, x: str, y: str) -> DataFrame:
    """Least-squares (slope, intercept, n); both missing when x is constant."""
    require_numeric(df, [x, y])
    vx, vy = present(df, x).cast("double"), present(df, y).cast("double")
    return df.agg(
        F.regr_slope(vy, vx).alias("slope"),
        F.regr_intercept(vy, vx).alias("intercept"),
        F.regr_count(vy, vx).alias("n"),
    )
