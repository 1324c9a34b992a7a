"""Pearson and Spearman matrices over pairwise complete rows; a constant column has no correlation."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations_with_replacement

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prepframe.functions.columns import col, present
from prepframe.guards import chosen_numeric
from prepframe.operators.gramian import column_survey, pair_moments
from prepframe.operators.lookup import HOT_SHARE, RANK, Lookups, fit_lookups
from prepframe.scratch import stored

PAIRS_PER_JOB = 150
#: Columns up to which ranks are joined one column after the other.
COLUMN_BY_COLUMN = 8
#: Length of a row's vector up to which all products are summed at once (the sums are its square, on the driver).
GRAM_WIDTH = 3_000
#: Of a sum of squares, the part that must be left after the mean is taken off; with less, a pair is computed alone.
CANCELLED = 1e-9


def _alone(df: DataFrame, pairs: list[tuple[str, str]]) -> list[float | None]:
    """Correlation of each pair by its own deviations, some 150 pairs to an aggregation."""
    out: list[float | None] = []
    for at in range(0, len(pairs), PAIRS_PER_JOB):
        aggs = []
        for i, (a, b) in enumerate(pairs[at : at + PAIRS_PER_JOB]):
            x, y = F.when(F.col(b).isNotNull(), F.col(a)), F.when(F.col(a).isNotNull(), F.col(b))
            deviations = F.stddev_pop(x) * F.stddev_pop(y)
            aggs.append((F.covar_pop(x, y) / F.nullif(deviations, F.lit(0.0))).alias(f"r{i}"))
        out += [None if r is None else max(-1.0, min(1.0, r)) for r in df.agg(*aggs).first()]
    return out


def _correlations(df: DataFrame, pairs: list[tuple[str, str]]) -> list[float | None]:
    """Correlation of each pair of columns over the rows that have both.

    Few pairs are one plain aggregation. Of more, the products of all columns are summed in one scan after a survey: a row is a vector of its values (about the mean, 0 where missing), their squares, and whether they are present; the
    products of all parts, summed, hold every pair's count, sums, squares and product.
    """
    names = sorted({c for p in pairs for c in p})
    width = 3 * len(names)
    if len(pairs) <= PAIRS_PER_JOB:
        return _alone(df, pairs)
    if width > GRAM_WIDTH:
        found = {(r["a"], r["b"]): r["r"] for r in block_correlations(df, names).collect()}
        at = {c: i for i, c in enumerate(names)}
        return [found.get((min(at[a], at[b]), max(at[a], at[b]))) for a, b in pairs]
    row = df.agg(*[f(c).alias(f"{tag}{i}") for i, c in enumerate(names) for tag, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    parts = []
    for i, c in enumerate(names):
        mean, scale = row[f"m{i}"] or 0.0, row[f"s{i}"] or 1.0
        z = F.coalesce((F.col(c) - F.lit(mean)) / F.lit(scale), F.lit(0.0))
        parts += [z.alias(f"z{i}"), (z * z).alias(f"q{i}"), F.col(c).isNotNull().cast("double").alias(f"p{i}")]
    flat = df.select(*parts)
    vectors = VectorAssembler(inputCols=flat.columns, outputCol="_v").transform(flat).select("_v")
    gram = RowMatrix(MLUtils.convertVectorColumnsFromML(vectors, "_v")).computeGramianMatrix().toArray()
    at = {c: 3 * i for i, c in enumerate(names)}
    out: list[float | None] = []
    again = []
    for k, (a, b) in enumerate(pairs):
        za, zb = at[a], at[b]
        n = gram[za + 2, zb + 2]
        if n < 1:
            out.append(None)
            continue
        sa, sb = gram[za, zb + 2], gram[zb, za + 2]
        qa, qb = gram[za + 1, zb + 2], gram[zb + 1, za + 2]
        va, vb = qa - sa * sa / n, qb - sb * sb / n
        if va <= CANCELLED * max(qa, 1.0) or vb <= CANCELLED * max(qb, 1.0):
            again.append(k)
            out.append(None)
        else:
            out.append(float(max(-1.0, min(1.0, (gram[za, zb] - sa * sb / n) / np.sqrt(va * vb)))))
    for k, r in zip(again, _alone(df, [pairs[k] for k in again]), strict=True):
        out[k] = r
    return out


def block_correlations(values: DataFrame, names: Sequence[str], block: int | None = None) -> DataFrame:
    """(a, b, r) for every pair of places a <= b in `names`, from a grid of column blocks, as a table."""
    x = values.select(F.array(*[col(c) for c in names]).alias("x"))
    mean, scale = np.zeros(len(names)), np.ones(len(names))
    for r in column_survey(x, "x", len(names)).collect():
        mean[r["place"]] = r["total"] / r["n"]
        scale[r["place"]] = (r["high"] - r["low"]) or 1.0
    n = F.nullif(F.col("n"), F.lit(0.0))
    va = F.col("qa") - F.col("sa") * F.col("sa") / n
    vb = F.col("qb") - F.col("sb") * F.col("sb") / n
    lost = (va <= F.lit(CANCELLED) * F.col("qa")) | (vb <= F.lit(CANCELLED) * F.col("qb"))
    r = (F.col("sab") - F.col("sa") * F.col("sb") / n) / F.nullif(F.sqrt(F.abs(va * vb)), F.lit(0.0))
    limited = F.when(F.col("a") == F.col("b"), 1.0).otherwise(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r)))
    moments = pair_moments(x, "x", mean, scale, block)
    found = moments.select("a", "b", F.when((F.col("n") > 0) & ~lost, limited).alias("r"), F.coalesce((F.col("n") > 1) & lost & (F.col("qa") > 0) & (F.col("qb") > 0), F.lit(False)).alias("again"))
    found = stored(found, "pairs")
    again = [(r["a"], r["b"]) for r in found.where("again").select("a", "b").collect()]
    if not again:
        return found.drop("again")
    alone = _alone(values, [(names[a], names[b]) for a, b in again])
    rows = [(a, b, r) for (a, b), r in zip(again, alone, strict=True)]
    return found.where("NOT again").drop("again").unionByName(values.sparkSession.createDataFrame(rows, "a int, b int, r double"))


def pearson_blocks(df: DataFrame, cols: Sequence[str] | None = None, block: int | None = None) -> DataFrame:
    """`pearson_matrix` for tables of very many columns: the number of jobs doesn't follow the columns, and the matrix is
    a table that never stands on the driver. Only pairs that lose their digits are computed alone."""
    names = chosen_numeric(df, cols)
    if df.isEmpty():
        return _table(df, names, {})
    values = df.select(*[present(df, c).cast("double").alias(f"v{i}") for i, c in enumerate(names)])
    found = block_correlations(values, values.columns, block)
    both = found.union(found.where("a < b").select("b", "a", "r"))
    every = df.sparkSession.createDataFrame(list(enumerate(names)), "place int, name string")
    labelled = both
    for side in ("a", "b"):
        own = F.broadcast(every.select(F.col("place").alias(side), F.col("name").alias(f"column_{side}")))
        labelled = labelled.join(own, side)
    return labelled.select("column_a", "column_b", "r")


def _table(df: DataFrame, names: list[str], found: dict[tuple[str, str], float | None]) -> DataFrame:
    def r(a: str, b: str) -> float | None:
        value = found.get((a, b), found.get((b, a)))
        return 1.0 if a == b and value is not None else value

    rows = [(a, b, r(a, b)) for a in names for b in names]
    return df.sparkSession.createDataFrame(rows, "column_a string, column_b string, r double")


def _survey(values: DataFrame) -> tuple[set[str], set[str]]:
    """Columns with missing values, and columns that hold more than one value."""
    row = values.agg(
        *[F.count_if(col(c).isNull()).alias(f"{c}_gaps") for c in values.columns],
        *[(F.min(col(c)) < F.max(col(c))).alias(f"{c}_varies") for c in values.columns],
    ).first()
    return {c for c in values.columns if row[f"{c}_gaps"]}, {c for c in values.columns if row[f"{c}_varies"]}


def _prepared(df: DataFrame, cols: Sequence[str] | None) -> tuple[list[str], DataFrame, set[str], list[tuple[int, int]]]:
    """Column names, their values as v0, v1, …, those with gaps, and the pairs worth computing."""
    names = chosen_numeric(df, cols)
    values = df.select(*[present(df, c).cast("double").alias(f"v{i}") for i, c in enumerate(names)])
    gaps, varying = _survey(values)
    pairs = combinations_with_replacement(range(len(names)), 2)
    return names, values, gaps, [(i, j) for i, j in pairs if {f"v{i}", f"v{j}"} <= varying]


def pearson_matrix(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """(column_a, column_b, r) for every ordered pair of numeric columns."""
    if 3 * len(chosen_numeric(df, cols)) > GRAM_WIDTH:
        return pearson_blocks(df, cols)
    names, values, _, pairs = _prepared(df, cols)
    found = _correlations(values, [(f"v{i}", f"v{j}") for i, j in pairs])
    return _table(df, names, {(names[i], names[j]): r for (i, j), r in zip(pairs, found, strict=True)})


def _ranks_by_column(values: DataFrame, ranked: dict[str, Column], counted: DataFrame) -> DataFrame:
    lookups, out = fit_lookups(counted, list(ranked), order_by="key"), values
    of: dict[str, list[str]] = {}
    for n in ranked:
        of.setdefault(n.split("_")[0], []).append(n)
    for own, names in of.items():
        each = [lookups.tables[n].select("key", "n", F.lit(n).alias("of"), F.col(RANK).alias("rank")) for n in names]
        ranks = [F.max(F.when(F.col("of") == n, F.col("rank"))).alias(f"rank_{n}") for n in names]
        table = stored(reduce(DataFrame.union, each).groupBy("key").agg(F.max("n").alias("n"), *ranks), "lookup")
        hot = {}
        if any(n in lookups.hot for n in names):
            rows = table.agg(F.sum("n")).first()[0]
            hot = {own: table.where(F.col("n") * HOT_SHARE > rows)}
        out = Lookups({own: table}, {}, hot).attach(out, own, col(own), {f"rank_{n}": f"rank_{n}" for n in names})
    return out.select(*[F.when(key.isNotNull(), col(f"rank_{n}")).alias(n) for n, key in ranked.items()])


def _ranks_in_long_form(values: DataFrame, ranked: dict[str, Column], counted: DataFrame) -> DataFrame:
    # written with their numbers, which would not be the same if a task were run again
    numbered = stored(values.select(F.monotonically_increasing_id().alias("_row"), "*"), "ranked")
    wide = numbered.select("_row", *[e.alias(n) for n, e in ranked.items()])
    long = wide.unpivot(["_row"], list(ranked), "column", "key").where("key IS NOT NULL")
    both = F.struct("column", "key")
    lookups = fit_lookups(counted.select(F.lit("all").alias("column"), both.alias("key"), "n"), ["all"], order_by="key")
    # a rank counts the rows of all columns that come before; those of one column lie together
    joined = lookups.attach(long, "all", both, {RANK: "_rank"})
    side_by_side = joined.groupBy("_row").agg(*[F.max(F.when(F.col("column") == n, F.col("_rank"))).alias(n) for n in ranked])
    return side_by_side.drop("_row")


def spearman_matrix(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """As `pearson_matrix`, on average ranks taken anew over each pair's complete rows.

    A column is ranked once for all partners that have no missing values, and once more for each one that has. Ranks
    come from value counts, so equal values are one row however often they occur. Of up to COLUMN_BY_COLUMN columns, all
    ranks of one are joined at once: by broadcast where it has few values, else by a shuffle. Of more columns, all ranks
    are joined in long form and put side by side by one grouping, however many columns there are.
    """
    names, values, gaps, pairs = _prepared(df, cols)
    ranked: dict[str, Column] = {}

    def ranked_column(i: int, partner: int) -> str:
        own, other = f"v{i}", f"v{partner}"
        if i == partner or other not in gaps:
            ranked.setdefault(own, F.col(own))
            return own
        ranked.setdefault(f"{own}_{other}", F.when(F.col(other).isNotNull(), F.col(own)))
        return f"{own}_{other}"

    sides = [(ranked_column(i, j), ranked_column(j, i)) for i, j in pairs]
    if not sides:
        return _table(df, names, {})
    wide = values.select(*[e.alias(n) for n, e in ranked.items()])
    counted = stored(wide.unpivot([], list(ranked), "column", "key").where("key IS NOT NULL").groupBy("column", "key").agg(F.count(F.lit(1)).alias("n")), "counts")
    by_column = len({n.split("_")[0] for n in ranked}) <= COLUMN_BY_COLUMN
    side_by_side = (_ranks_by_column if by_column else _ranks_in_long_form)(values, ranked, counted)
    found = _correlations(stored(side_by_side, "ranks"), sides)
    return _table(df, names, {(names[i], names[j]): r for (i, j), r in zip(pairs, found, strict=True)})


def corr_matrix_wide(pairs: DataFrame, digits: int = 4) -> DataFrame:
    """One row per variable and one rounded column per variable, for reading."""
    names = list(dict.fromkeys(r["column_a"] for r in pairs.select("column_a").collect()))
    cells = pairs.select(F.col("column_a").alias("Variable"), "column_b", F.round("r", digits).alias("r"))
    return cells.groupBy("Variable").pivot("column_b", names).agg(F.first("r"))
