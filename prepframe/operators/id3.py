"""ID3: a tree over categories with a branch for each value, from tables of attribute, value and class.

One grouping a level counts (node, attribute, value, class) over all rows of all open nodes at once. Entropies and gains
follow from that table; the attribute of the largest gain splits its node, the first one of equally good ones. A node is
final when it is pure or no attribute gains anything. Nodes are named by their path, as in `/colour=red/size=?`, where
`?` stands for a missing value, a category like any other. The tree stays in tables, since it may have as many nodes as
the attributes have combinations of values.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prepframe.functions.columns import col
from prepframe.guards import require
from prepframe.scratch import stored

#: Nodes of a level up to which their splits are broadcast. Beyond, only those with more than 1/HOT_SHARE of all rows
#: are (fewer than HOT_SHARE), and others are joined by shuffle.
BROADCAST_NODES, HOT_SHARE = 100_000, 1_000
#: A gain below this is none; gains that differ by less are equal.
DIGITS = 9


def _times_log(n: str) -> Column:
    return F.col(n) * F.log2(F.col(n))


def _gains(counts: DataFrame) -> DataFrame:
    """(node, attribute, gain, entropy, n) from (node, attribute, value, class, n)."""
    values = counts.groupBy("node", "attribute", "value").agg(F.sum("n").alias("nv"), F.sum(_times_log("n")).alias("inner"))
    inside = values.groupBy("node", "attribute").agg(F.sum(_times_log("nv") - F.col("inner")).alias("left"), F.sum("nv").alias("n"))
    classes = counts.groupBy("node", "attribute", "class").agg(F.sum("n").alias("nc"))
    whole = classes.groupBy("node", "attribute").agg(F.sum(_times_log("nc")).alias("logs"))
    entropy = F.log2("n") - F.col("logs") / F.col("n")
    return inside.join(whole, ["node", "attribute"]).select(
        "node", "attribute", F.round(entropy - F.col("left") / F.col("n"), DIGITS).alias("gain"), F.round(entropy, DIGITS).alias("entropy"), "n"
    )


def _labels(counts: DataFrame) -> DataFrame:
    """(node, label): a node's most common class, the smallest one of equally common ones."""
    classes = counts.where("attribute = 0").groupBy("node", "class").agg(F.sum("n").alias("nc"))
    return classes.groupBy("node").agg(F.min_by("class", F.struct((-F.col("nc")).alias("nc"), "class")).alias("label"))


def _branch(names: Sequence[str]) -> Column:
    """The name of the branch that a row takes out of its node, by the place of the node's attribute."""
    step = F.coalesce(F.element_at("values", F.col("split") + 1), F.lit("?"))
    return F.concat("node", F.lit("/"), F.element_at(F.array(*[F.lit(n) for n in names]), F.col("split") + 1), F.lit("="), step)


def _meet(rows: DataFrame, nodes: DataFrame, total: int, how: str) -> DataFrame:
    """Rows joined with their nodes' figures (node, n, …); `n` is the node's number of rows."""
    if nodes.limit(BROADCAST_NODES + 1).count() <= BROADCAST_NODES:
        return rows.join(F.broadcast(nodes), "node", how)
    hot = F.col("n") * HOT_SHARE > total
    common = F.broadcast(nodes.where(hot))
    rest = rows.join(common, "node", "left_anti").join(nodes.where(~hot), "node", how)
    return rows.join(common, "node").unionByName(rest)


@dataclass
class Id3:
    """`nodes`: (node, depth, n, label, entropy, attribute, gain), the last two missing in final nodes; `gains`: the gain
    of every attribute in every node."""

    attributes: list[str]
    target: str
    nodes: DataFrame
    gains: DataFrame
    depth: int
    rows: int

    def transform(self, df: DataFrame, prediction: str = "id3_pred") -> DataFrame:
        """`df` with the class of the last known node on each row's path; the target need not be known."""
        raw = F.struct(*[col(c) for c in df.columns]).alias("raw")
        places = F.array(*[F.lit(a) for a in self.attributes])
        split = (F.array_position(places, F.col("attribute")) - 1).cast("int")
        # rows at the end of their path meet nothing more; names of their own keep them apart
        done = F.concat(F.lit("!"), F.pmod(F.xxhash64("values", F.monotonically_increasing_id()), F.lit(4096)).cast("string"))
        out = df.select(raw, _values(self.attributes), F.lit("").alias("node"), F.lit(None).cast("string").alias("found"))
        for level in range(self.depth + 1):
            here = self.nodes.where(F.col("depth") == level).select("node", "n", "label", split.alias("split"))
            met = _meet(out, here, self.rows, "left")
            out = met.select(
                "raw", "values", F.when(F.col("split").isNotNull(), _branch(self.attributes)).otherwise(done).alias("node"), F.coalesce("label", "found").alias("found")
            )
        return out.select("raw.*", F.col("found").alias(prediction))


def _values(attributes: Sequence[str]) -> Column:
    return F.array(*[col(a).cast("string") for a in attributes]).alias("values")


def fit_id3(df: DataFrame, attributes: Sequence[str], target: str, max_depth: int | None = None) -> Id3:
    """Learn from the rows whose target is present; `max_depth` splits at most, as many as attributes if not said."""
    names = list(attributes)
    if not names:
        raise ValueError("no attributes")
    require(df, [*names, target])
    most = len(names) if max_depth is None else min(max_depth, len(names))
    rows = df.where(col(target).isNotNull()).select(F.lit("").alias("node"), _values(names), col(target).cast("string").alias("class"))
    rows = stored(rows, "id3_rows")
    total, found, gains = rows.count(), [], []
    for level in range(most + 1):
        long = rows.select("node", "class", F.posexplode("values").alias("attribute", "value"))
        counts = stored(long.groupBy("node", "attribute", "value", "class").agg(F.count(F.lit(1)).alias("n")), "id3_counts")
        here = stored(_gains(counts), "id3_gains")
        best = here.groupBy("node").agg(F.max(F.struct("gain", (-F.col("attribute")).alias("attribute"))).alias("best"), F.max("entropy").alias("entropy"), F.max("n").alias("n"))
        split = (F.col("best.gain") > 0) if level < most else F.lit(False)
        own = best.join(_labels(counts), "node").select(
            "node", F.lit(level).alias("depth"), "n", "label", "entropy", F.when(split, -F.col("best.attribute")).alias("split"), F.when(split, F.col("best.gain")).alias("gain")
        )
        own = stored(own, "id3_nodes")
        found.append(own)
        gains.append(here)
        going_on = own.where("split IS NOT NULL").select("node", "n", "split")
        if going_on.isEmpty():
            break
        rows = stored(_meet(rows, going_on, total, "inner").select(_branch(names).alias("node"), "values", "class"), "id3_rows")
    nodes, every = found[0], gains[0]
    for more, some in zip(found[1:], gains[1:], strict=True):
        nodes, every = nodes.union(more), every.union(some)
    place = F.array(*[F.lit(n) for n in names])
    nodes = nodes.select("node", "depth", "n", "label", "entropy", F.when(F.col("split").isNotNull(), F.element_at(place, F.col("split") + 1)).alias("attribute"), "gain")
    every = every.select("node", F.element_at(place, F.col("attribute") + 1).alias("attribute"), "gain", "n")
    return Id3(names, target, nodes, every, len(found) - 1, total)
