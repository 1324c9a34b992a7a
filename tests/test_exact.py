"""Trees without limits, ID3, column blocks and silhouettes against plain versions."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from prepframe.operators import corr, deeptree, gramian, id3, learn
from prepframe.operators import silhouette as silhouettes
from prepframe.operators.deeptree import fit_deep_tree, grow
from prepframe.operators.id3 import fit_id3
from prepframe.scratch import stored


def vectors(spark, rows):
    df = spark.createDataFrame([(*map(float, x), int(y)) for x, y in rows], [*[f"x{i}" for i in range(len(rows[0][0]))], "y"])
    return VectorAssembler(inputCols=[c for c in df.columns if c != "y"], outputCol="v").transform(df)


def predict(nodes, x):
    at = 0
    while nodes[at][0] >= 0:
        f, cut, left, right, _ = nodes[at]
        at = left if x[f] <= cut else right
    return nodes[at][4]


@pytest.mark.parametrize("impurity", ["gini", "entropy"])
@pytest.mark.parametrize("leaf_rows, broadcast", [(50_000, 500_000), (60, 500_000), (60, 0), (7, 0)])
def test_deep_tree_is_the_same_whoever_splits(spark, monkeypatch, impurity, leaf_rows, broadcast):
    monkeypatch.setattr(deeptree, "LEAF_ROWS", leaf_rows)
    monkeypatch.setattr(deeptree, "BROADCAST_NODES", broadcast)
    draw = random.Random(4)
    rows = [((draw.randrange(12), round(draw.uniform(0, 1), 1)), 0) for _ in range(300)]
    rows = [(x, (x[0] > 5) + (x[1] > 0.55) * (x[0] % 2)) for x, _ in rows]
    df = vectors(spark, rows).repartition(5)
    found = fit_deep_tree(df, "v", "y", 3, impurity).transform(df, "v", "p").select("x0", "x1", "y", "p").collect()
    plain = grow(np.array([x for x, _ in rows]), np.array([y for _, y in rows]), np.ones(len(rows), int), 3, impurity == "gini")
    assert len(found) == len(rows)
    assert all(r["p"] == r["y"] == predict(plain, (r["x0"], r["x1"])) for r in found)


@pytest.mark.parametrize("impurity", ["gini", "entropy"])
def test_values_inside_ranges_are_counted_where_a_bound_asks_for_it(spark, monkeypatch, impurity):
    monkeypatch.setattr(deeptree, "LEAF_ROWS", 60)
    monkeypatch.setattr(deeptree, "RANGES", 4)
    written = []
    monkeypatch.setattr(deeptree, "stored", lambda df, label: (written.append(label), stored(df, label))[1])
    draw = random.Random(7)
    rows = [((draw.uniform(0, 1), draw.uniform(0, 1)), 0) for _ in range(400)]
    rows = [(x, int(0.3 < x[0] < 0.55) + int(x[1] > 0.8)) for x, _ in rows]
    found = fit_deep_tree(vectors(spark, rows).repartition(5), "v", "y", 3, impurity)
    plain = grow(np.array([x for x, _ in rows]), np.array([y for _, y in rows]), np.ones(len(rows), int), 3, impurity == "gini")
    tree, at = found.whole, np.random.default_rng(3).uniform(0, 1, (2000, 2))
    assert tree.label[tree.leaves(at)].tolist() == [predict(plain, x) for x in at]
    assert found.n_nodes == len(plain) and "values" in written


def test_a_feature_of_noise_is_not_counted_value_by_value(spark, monkeypatch):
    monkeypatch.setattr(deeptree, "LEAF_ROWS", 600)
    written = []
    monkeypatch.setattr(deeptree, "stored", lambda df, label: (written.append(label), stored(df, label))[1])
    draw = random.Random(5)
    rows = [((i % 8, draw.uniform(0, 1)), i % 2) for i in range(4_000)]
    assert fit_deep_tree(vectors(spark, rows), "v", "y", 2).whole.depth() >= 7
    assert "values" not in written


def test_deep_tree_cases(spark):
    steps = [((i,), i % 2) for i in range(120)]
    model = fit_deep_tree(vectors(spark, steps), "v", "y", 2)
    assert model.whole.depth() > 30 and model.n_nodes == 2 * 120 - 1
    # equal rows of two classes cannot be told apart: the more common class is said
    tied = [((1,), 0)] * 3 + [((1,), 1)] * 2 + [((2,), 1)]
    df = vectors(spark, tied)
    assert Counter((r["x0"], r["p"]) for r in fit_deep_tree(df, "v", "y", 2).transform(df, "v", "p").collect()) == {(1.0, 0.0): 5, (2.0, 1.0): 1}
    one = vectors(spark, [((1,), 1)] * 4)
    assert {r["p"] for r in fit_deep_tree(one, "v", "y", 2).transform(one, "v", "p").collect()} == {1.0}
    with pytest.raises(ValueError):
        fit_deep_tree(one.limit(0), "v", "y", 2)
    with pytest.raises(ValueError):
        fit_deep_tree(one, "v", "y", 2, "other")


def test_thresholds_lie_between_neighbours():
    low, high = np.array([1.0, 1.0, -1e308]), np.array([2.0, np.nextafter(1.0, 2), 1e308])
    cut = deeptree._half_way(low, high)
    assert cut[0] == 1.5 and (low <= cut).all() and (cut < high).all()


def test_too_many_classes(spark):
    df = spark.range(1_000_000).select("id", (F.col("id") * 1.5).alias("target"))
    with pytest.raises(ValueError, match="classes"):
        learn.fit_labels(df, "target")
    assert len(learn.fit_labels(df.where("id < 900"), "target").values) == 900


def brute_id3(rows, names, depth, path="", level=0):
    """{path: (n, label, attribute, gain)} by recursion."""

    def entropy(part):
        return -sum(k / len(part) * math.log2(k / len(part)) for k in Counter(y for _, y in part).values())

    label = min(Counter(y for _, y in rows).items(), key=lambda t: (-t[1], t[0]))[0]
    gains = []
    for a in range(len(names)):
        groups = {}
        for x, y in rows:
            groups.setdefault(x[a], []).append((x, y))
        gains.append((round(entropy(rows) - sum(len(g) / len(rows) * entropy(g) for g in groups.values()), 9), -a, groups))
    gain, a, groups = max(gains, key=lambda t: t[:2])
    if level == depth or gain <= 0:
        return {path: (len(rows), label, None, None)}
    out = {path: (len(rows), label, names[-a], gain)}
    for value, own in groups.items():
        out |= brute_id3(own, names, depth, f"{path}/{names[-a]}={'?' if value is None else value}", level + 1)
    return out


@pytest.mark.parametrize("bound", [id3.BROADCAST_NODES, 0])
def test_id3_by_brute_force(spark, monkeypatch, bound):
    monkeypatch.setattr(id3, "BROADCAST_NODES", bound)
    monkeypatch.setattr(id3, "HOT_SHARE", 5)
    draw = random.Random(2)
    names = ["a", "b", "c"]
    rows = [((draw.choice("xyz"), draw.choice(["1", "2", None]), draw.choice("pq")), None) for _ in range(200)]
    rows = [(x, "yes" if (x[0] == "x") != (x[1] == "1") else draw.choice(["yes", "no"])) for x, _ in rows]
    df = spark.createDataFrame([(*x, y) for x, y in rows], "a string, b string, c string, t string")
    model = fit_id3(df, names, "t")
    found = {r["node"]: (r["n"], r["label"], r["attribute"], r["gain"]) for r in model.nodes.collect()}
    want = brute_id3(rows, names, 3)
    assert found.keys() == want.keys()
    for k, (n, label, attribute, gain) in want.items():
        assert found[k][:3] == (n, label, attribute) and abs((found[k][3] or 0) - (gain or 0)) < 1e-8
    unseen = spark.createDataFrame([("x", "1", "p"), ("new", "1", "p"), (None, None, None), ("y", "new", "q")], "a string, b string, c string")
    said = {(r["a"], r["b"]): r["id3_pred"] for r in model.transform(unseen).collect()}

    def walk(x):
        path, label = "", None
        while path in want:
            _, label, attribute, _ = want[path]
            if attribute is None:
                break
            path += f"/{attribute}={x[names.index(attribute)] or '?'}"
        return label

    assert all(said[x[0], x[1]] == walk(x) for x in [("x", "1", "p"), ("new", "1", "p"), (None, None, None), ("y", "new", "q")])


def test_id3_cases(spark):
    df = spark.createDataFrame([("u", "a"), ("u", "b"), ("u", None)], "x string, t string")
    only = fit_id3(df, ["x"], "t").nodes.collect()
    assert [(r["node"], r["n"], r["label"], r["attribute"]) for r in only] == [("", 2, "a", None)]
    assert fit_id3(df, ["x"], "t", 0).depth == 0 and fit_id3(df.limit(0), ["x"], "t").nodes.count() == 0
    with pytest.raises(ValueError):
        fit_id3(df, [], "t")


def test_wide_pearson(spark, monkeypatch):
    """Forty columns with gaps, constants and far offsets; blocks of seven, rows dealt to several stripes."""
    monkeypatch.setattr(gramian, "PIECE", 7 * 16)
    draw = np.random.default_rng(0)
    x = draw.normal(size=(300, 40)) + draw.normal(size=(300, 1))
    x[:, 3] += 1e9
    x[:, 5] = 2.5
    x[:, 6] = np.where(draw.random(300) < 0.7, np.nan, x[:, 6])
    x[:, 7] = np.nan
    x[:250, 8] = np.nan
    names = [f"c{i}" for i in range(40)]
    df = spark.createDataFrame([tuple(None if np.isnan(v) else float(v) for v in row) for row in x], ", ".join(f"{n} double" for n in names)).repartition(6)
    found = {(r["column_a"], r["column_b"]): r["r"] for r in corr.pearson_blocks(df, names, block=7).collect()}
    assert len(found) == 1600
    for i, a in enumerate(names):
        for j, b in enumerate(names):
            both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
            u, v = x[both, i], x[both, j]
            if not both.any() or np.ptp(u) == 0 or np.ptp(v) == 0:
                assert found[a, b] is None
            else:
                assert abs(found[a, b] - np.corrcoef(u, v)[0, 1]) < 1e-6
    # the same through the other two ways
    some = names[:3] + names[4:10]
    plain = {(r["column_a"], r["column_b"]): r["r"] for r in corr.pearson_matrix(df, some).collect()}
    assert all((r is None) == (found[k] is None) and (r is None or abs(r - found[k]) < 1e-9) for k, r in plain.items())
    for width in (1, 3_000):
        monkeypatch.setattr(corr, "PAIRS_PER_JOB", 1)
        monkeypatch.setattr(corr, "GRAM_WIDTH", width)
        again = {(r["column_a"], r["column_b"]): r["r"] for r in corr.pearson_matrix(df, some).collect()}
        assert all((r is None) == (found[k] is None) and (r is None or abs(r - found[k]) < 1e-9) for k, r in again.items())
    assert {r["r"] for r in corr.pearson_blocks(df.limit(0), names[:2]).collect()} == {None}


def test_jobs_of_wide_pearson(spark):
    """Columns don't add jobs."""

    def jobs(width):
        store = spark._jsc.sc().statusStore()
        df = spark.range(50).select(*[(F.hash("id", F.lit(i)) % 100).alias(f"c{i}") for i in range(width)])
        before = store.jobsList(None).size()
        corr.pearson_blocks(df, block=8).write.format("noop").mode("overwrite").save()
        return store.jobsList(None).size() - before

    assert jobs(10) == jobs(60)


def plain_silhouette(x, c):
    out = []
    for i in range(len(x)):
        d = np.sqrt(((x - x[i]) ** 2).sum(axis=1))
        if (c == c[i]).sum() == 1:
            out.append(0.0)
            continue
        inside = d[c == c[i]].sum() / ((c == c[i]).sum() - 1)
        beside = min(d[c == k].mean() for k in set(c.tolist()) if k != c[i])
        out.append((beside - inside) / max(inside, beside) if max(inside, beside) else 0.0)
    return float(np.mean(out))


def test_silhouette(spark, monkeypatch):
    draw = np.random.default_rng(0)
    c = np.repeat([0, 1, 2, 7], [500, 300, 100, 1])
    x = draw.normal(size=(901, 3)) + c[:, None]
    df = spark.createDataFrame([(i, [float(v) for v in row], int(k)) for i, (row, k) in enumerate(zip(x, c, strict=True))], "id long, v array<double>, k int")
    want = plain_silhouette(x, c)
    row = silhouettes.silhouette(df, "v", "k", "id").first()
    assert abs(row["silhouette"] - want) < 1e-9 and row["std_error"] == 0 and (row["rows"], row["compared"], row["clusters"]) == (901, 901, 4)
    monkeypatch.setattr(silhouettes, "STEP", 100)
    assert abs(silhouettes.silhouette(df.repartition(7), "v", "k", "id").first()["silhouette"] - want) < 1e-9
    monkeypatch.setattr(silhouettes, "EXACT_ROWS", 300)
    part = silhouettes.silhouette(df, "v", "k", "id").first()
    assert 300 <= part["compared"] < 400 and 0 < part["std_error"] < 0.05 and abs(part["silhouette"] - want) < 4 * part["std_error"]
    assert part == silhouettes.silhouette(df.repartition(3), "v", "k", "id").first()
    assert silhouettes.silhouette(df.where("k = 1"), "v", "k", "id").first()["silhouette"] is None
    same = df.withColumn("v", F.array(F.lit(1.0)))
    assert silhouettes.silhouette(same, "v", "k", "id").first()["silhouette"] == 0
