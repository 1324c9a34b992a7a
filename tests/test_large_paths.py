"""The ways taken beyond the size limits give what the small ways give."""

from __future__ import annotations

import statistics

import pytest
from pyspark.sql import functions as F

from prepframe.operators import corr, encode, lookup, replace
from prepframe.operators.quantile import exact_medians
from prepframe.operators.rowid import number_rows, with_row_id
from prepframe.scratch import stored
from tests.test_golden import matrix


@pytest.fixture()
def no_broadcast(monkeypatch, spark):
    monkeypatch.setattr(lookup, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(lookup, "HOT_SHARE", 4)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.fixture(scope="module")
def skewed(spark):
    """Half of the rows share one key, a tenth have none."""
    return (
        spark.range(2000)
        .select(
            F.col("id"),
            F.when(F.col("id") % 10 == 9, None)
            .when(F.col("id") % 2 == 0, "hot")
            .otherwise(F.concat(F.lit("k"), (F.col("id") % 97).cast("string")))
            .alias("k"),
            (F.col("id") * 7919 % 1009).cast("double").alias("v"),
        )
        .repartition(7)
        .cache()
    )


def rows(df):
    return sorted(df.collect(), key=str)


def test_encoders(skewed, monkeypatch):
    def run():
        return [
            rows(encode.target_encode(skewed, "k", "v").select("id", F.round("k_target", 9))),
            rows(encode.label_codes(skewed, "k")),
            rows(encode.binary_encode(skewed, "k", "id")),
            rows(encode.fit_binary(skewed, ["k"], "id").mapping()),
        ]

    small = run()
    monkeypatch.setattr(lookup, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(lookup, "HOT_SHARE", 4)
    assert run() == small


def test_two_columns_at_once(skewed, no_broadcast):
    df = skewed.withColumn("p", F.concat(F.lit("p"), (F.col("id") % 13).cast("string")))
    coded = encode.label_codes(df, ["k", "p"])
    for c in ("k", "p"):
        order = sorted({r[c] for r in df.select(c).distinct().collect() if r[c] is not None})
        for r in coded.select(c, f"{c}_code").distinct().collect():
            assert r[1] == (-1 if r[0] is None else order.index(r[0]))


def test_hot_rows_are_salted(skewed, no_broadcast):
    plan = encode.label_codes(skewed, "k")._jdf.queryExecution().executedPlan().toString()
    assert "_salt" in [part for part in plan.split("SortMergeJoin [")[1:]][0].split("]")[0]
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_long_keys_are_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(lookup, "BROADCAST_BYTES", 500)
    df = spark.range(100).select("id", F.repeat((F.col("id") % 4).cast("string"), 300).alias("k"))
    fitted = encode.fit_label_codes(df, "k")
    assert list(fitted.lookups.hot) == ["k"]
    assert {(r["id"] % 4, r["k_code"]) for r in fitted.transform(df).collect()} == {(i, i) for i in range(4)}


def test_ranks(skewed, no_broadcast):
    df = skewed.select("v", (F.col("v") * F.col("v") % 50).alias("w"), F.when(F.col("id") % 3 > 0, F.col("id")).alias("u"))
    import pandas as pd

    want = pd.DataFrame(df.toPandas()).corr(method="spearman")
    for (a, b), r in matrix(corr.spearman_matrix(df)).items():
        assert r == pytest.approx(want.loc[a, b], abs=1e-9)


def test_rules_as_a_table(spark, monkeypatch):
    df = spark.createDataFrame(
        [(i, f"v{i % 50}" if i % 11 else None, i % 30) for i in range(500)], "id long, k string, n int"
    )
    rules = [("k", f"v{i}", f"v{i + 1}" if i % 3 else f"w{i}", i) for i in range(40)]
    rules += [("k", "nan", "none", 100), ("k", "none", "nothing", 101), ("n", "3", "4", 102), ("n", "4", "4.5", 103)]
    rules += [("n", "abc", "1", 104), ("absent", "a", "b", 105)]
    table = spark.createDataFrame(rules, "column string, old string, new string, seq int")
    small = replace.replace_from_table(df, table)
    large = replace.replace_from_table(df, table, max_rules=5)
    assert large.schema == small.schema
    assert rows(large) == rows(small)
    monkeypatch.setattr(lookup, "BROADCAST_ROWS", 0)
    assert rows(replace.replace_from_table(df, table, max_rules=5)) == rows(small)


def _rule_cases(spark):
    """(df, rules) where literals, types, chains and categories are hard."""
    big = 2**53
    numbers = spark.createDataFrame([(1, big), (2, big + 1), (3, None), (4, 5), (5, 1000), (6, 7), (7, -5)], "id int, n long")
    ints = spark.createDataFrame([(1, 1000), (2, 5), (3, 7), (4, None)], "id int, n int")
    doubles = spark.createDataFrame([(1, 5.0), (2, 0.5), (3, None), (4, float("nan")), (5, 1e20), (6, -0.0), (7, 1e-5)], "id int, n double")
    flags = spark.createDataFrame([(1, True), (2, False), (3, None)], "id int, n boolean")
    texts = spark.createDataFrame([(1, "a"), (2, "nan"), (3, None), (4, "5"), (5, " a"), (6, "5.0")], "id int, n string")
    days = spark.createDataFrame([(1, "2020-01-02"), (2, None)], "id int, n string").selectExpr("id", "cast(n as date) as n")
    from prepframe.operators.infer import Kind, apply_kinds

    listed = apply_kinds(spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, n string"), {"n": Kind("categorical", categories=("a", "b"))})
    chain = [(f"{i}", f"{i + 1}") for i in range(5, 40)]
    return [
        (numbers, [(str(big), "1"), ("5.0", "6"), ("+7", "8"), ("nan", "9")]),
        (numbers, [(str(big + 1), str(big + 3)), ("1e3", "1"), ("5", "20"), ("7", "x")]),
        (numbers, [("5", "4.5"), ("4.5", "6.0"), ("6", "11"), (None, "NaN"), ("-5", "99999999999999999999")]),
        (numbers, chain),
        (numbers, [("5", None), (None, "3"), ("3", "5"), ("5", "12")]),
        (ints, [("1e3", "1"), ("5", "20"), ("7", "x")]),
        (ints, [("5", "3000000000"), ("7", "007")]),
        (ints, [("5", "2.5"), ("1000", ".5")]),
        (doubles, [("5", "6"), (".50", "7"), ("nan", "1.5"), ("0", "3"), ("100000000000000000000", "4"), ("0.00001", "9")]),
        (doubles, [("5.0", "five"), ("6.", "x"), ("1.0e20", "2.0e3")]),
        (flags, [("TRUE", "false"), ("nan", "true"), ("maybe", "true")]),
        (texts, [("a", "b"), ("b", "c"), ("NaN", "none"), ("none", "gone"), ("5", "five"), ("c", "nan")]),
        (days, [("2020-1-2", "2021-01-01"), ("nan", "2022-02-02"), ("x", "2023-01-01")]),
        (listed, [("a", "z"), ("b", "y"), ("z", "b"), ("nan", "q")]),
        (listed, [("a", "b"), ("b", "a"), ("a", "c")]),
    ]


def test_rules_are_the_same_at_every_size(spark, monkeypatch):
    for df, pairs in _rule_cases(spark):
        table = spark.createDataFrame([("n", old, new, i) for i, (old, new) in enumerate(pairs)], "column string, old string, new string, seq int")
        cased = replace.replace_from_table(df, table)
        monkeypatch.setattr(replace, "CASE_RULES", 0)
        joined = replace.replace_from_table(df, table)
        monkeypatch.setattr(replace, "CASE_RULES", 50)
        large = replace.replace_from_table(df, table, max_rules=0)
        for other in (joined, large):
            assert other.schema == cased.schema and other.schema["n"].metadata == cased.schema["n"].metadata, pairs
            assert rows(other) == rows(cased), pairs


def test_many_rules_resolve_quickly():
    import time

    chain = [replace.Rule("c", i, i + 1) for i in range(50_000)] + [replace.Rule("c", -i, 50_000) for i in range(1, 50_000)]
    began = time.time()
    ends = replace.resolve(chain + [replace.Rule("c", 50_000, "end")])["c"]
    assert time.time() - began < 5 and set(ends.values()) == {"end"} and len(ends) == 100_000
    few = [replace.Rule("c", "a", "b"), replace.Rule("c", "b", "a"), replace.Rule("c", "a", "c"), replace.Rule("c", "b", "x")]
    assert replace.resolve(few)["c"] == {"a": "c", "b": "c"}


@pytest.mark.parametrize("bound", [100_000, 0])
def test_long_texts_are_counted_by_digest(spark, monkeypatch, bound):
    from prepframe.operators import profile

    monkeypatch.setattr(profile, "BROADCAST_DIGESTS", bound)
    texts = ["b" * 500, "b" * 500, "a" * 300, "a" * 300, "short", None, "é" * 70, "z"]
    df = spark.createDataFrame([(t, "s", "k" * 100 if t else None) for t in texts], "t string, s string, k string")
    for cut in (64, 0, 10_000):
        monkeypatch.setattr(profile, "COUNTED_BYTES", cut)
        got = {r["column"]: r for r in profile.categorical_profile(df).collect()}
        assert got["t"]["mode"] == "a" * 300 and got["t"]["distinct"] == 5 and got["t"]["length_max"] == 500
        assert got["s"]["mode"] == "s" and got["k"]["mode"] == "k" * 100 and got["k"]["fill_pct"] == 87.5


def test_hot_long_values_are_salted(spark, no_broadcast):
    text = F.when(F.col("id") % 2 == 0, F.repeat(F.lit("x"), 2000)).otherwise(F.concat(F.lit("k"), F.col("id").cast("string")))
    df = spark.range(400).select("id", text.alias("k"))
    fitted = encode.fit_label_codes(df, "k")
    hot = [r["key"] for r in fitted.lookups.hot["k"].collect()]
    assert len(hot) == 1 and hot[0].startswith("\0sha256 ") and len(hot[0]) < 100
    order = {k: i for i, k in enumerate(sorted({r["k"] for r in df.collect()}))}
    assert {(r["id"], r["k_code"]) for r in fitted.transform(df).collect()} == {(r["id"], order[r["k"]]) for r in df.collect()}


def test_values_count_for_the_broadcast_bound(spark, monkeypatch):
    monkeypatch.setattr(lookup, "BROADCAST_BYTES", 5_000)
    rows_ = [("c", f"k{i}", 1, "v" * 100) for i in range(100)]
    counted = spark.createDataFrame(rows_, "column string, key string, n long, new string")
    assert "c" in lookup.fit_lookups(counted, ["c"]).hot
    assert "c" not in lookup.fit_lookups(counted.drop("new"), ["c"]).hot


def test_many_positions_are_not_broadcast(spark, monkeypatch):
    from prepframe.operators import extract

    df = spark.range(2000).select("id", (F.col("id") * 2).alias("v"))
    asked = [7, 3, 1999, 3] + list(range(100, 200))
    before = [extract.keep_rows(df, asked, "id").collect(), rows(extract.remove_rows(df, asked, "id"))]
    monkeypatch.setattr(extract, "KEYED_POSITIONS", 5)
    monkeypatch.setattr(extract, "BROADCAST_POSITIONS", 5)
    assert [extract.keep_rows(df, asked, "id").collect(), rows(extract.remove_rows(df, asked, "id"))] == before
    hinted = [("ResolvedHint" in extract._positions_table(df, p)._jdf.queryExecution().analyzed().toString()) for p in (asked, asked[:5])]
    assert hinted == [False, True]


def test_a_million_positions(spark):
    from prepframe.operators import extract

    df = spark.range(1_000_100).select("id")
    left = extract.remove_rows(df, range(1_000_000), "id")
    assert [r["id"] for r in left.orderBy("id").collect()] == list(range(1_000_000, 1_000_100))


def test_binary_orders(spark):
    df = spark.createDataFrame([(1, None, "b"), (2, 5, "a"), (3, None, "a"), (4, 1, "c"), (5, None, "d")], "id int, o int, k string")
    codes = lambda order: {r["value"]: r["code"] for r in encode.fit_binary(df, "k", order).mapping().collect()}
    assert codes(["o", "id"]) == codes([F.col("o"), F.col("id")]) == {"b": 0, "a": 1, "d": 2, "c": 3}
    assert codes("o")["c"] == 3
    assert codes([F.col("id").desc()]) == {"d": 0, "c": 1, "a": 2, "b": 3}


@pytest.mark.parametrize("wide", [3_000, 1])
def test_correlations_alone_and_together(spark, monkeypatch, wide):
    import pandas as pd

    monkeypatch.setattr(corr, "GRAM_WIDTH", wide)
    data = [(float(i), 1e9 + i % 7, None if i % 5 == 0 else float(i * i % 11), 3.0, 1e-9 * (i % 4), None if i % 2 else 4.0) for i in range(60)]
    df = spark.createDataFrame(data, "a double, b double, c double, d double, e double, f double")
    for method in ("pearson", "spearman"):
        want = pd.DataFrame(data, columns=list("abcdef")).corr(method=method)
        for (a, b), r in matrix(getattr(corr, f"{method}_matrix")(df)).items():
            w = want.loc[a, b]
            assert (r is None and w != w) or r == pytest.approx(w, abs=1e-6), (method, a, b)


def test_correlation_plans_do_not_grow_with_columns(spark):
    def jobs(n):
        cols = [F.when((F.col("id") + i) % 5 > 0, (F.col("id") * (i + 3)) % 7).cast("double").alias(f"x{i}") for i in range(n)]
        df = spark.range(300).select(*cols)
        tracker, group = spark.sparkContext.statusTracker(), f"corr-{n}"
        spark.sparkContext.setJobGroup(group, group)
        corr.spearman_matrix(df).collect()
        corr.pearson_matrix(df).collect()
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(tracker.getJobIdsForGroup(group))

    assert jobs(12) <= jobs(4) + 2


@pytest.mark.parametrize("n", [1, 2, 9, 1000, 4001])
def test_medians_with_a_tiny_gather_limit(spark, n):
    data = [((i * 7919 % 104729) / 8.0, float(i % 3), -1.0) for i in range(n)]
    df = spark.createDataFrame(data, "a double, b double, c double").repartition(3)
    got = exact_medians(df, ["a", "b", "c"], gather_rows=4)
    assert got == {c: statistics.median(r[i] for r in data) for i, c in enumerate("abc")}


def test_median_recovers_from_a_wrong_bracket(spark):
    from prepframe.operators.quantile import finish_medians

    df = spark.range(1, 102).select(F.col("id").cast("double").alias("a"))
    assert finish_medians(df, {"a": (101, [80.0, 90.0])}) == {"a": 51.0}
    assert exact_medians(spark.createDataFrame([(None,)], "a double"), ["a"]) == {"a": None}


@pytest.mark.parametrize("parts", [1, 4, 7])
def test_row_ids_do_not_depend_on_partitions(spark, parts):
    df = spark.range(1000).select(F.col("id"), F.xxhash64("id").alias("h")).repartition(parts, "h")
    got = {r["id"]: r["_row_id"] for r in with_row_id(df, ["id"]).collect()}
    assert got == {i: i for i in range(1000)}


def test_ties_keep_their_order_of_arrival(spark):
    df = spark.range(0, 1000, 1, 5).select("id", F.lit(1).alias("same"))
    assert {r["id"]: r["_row_id"] for r in with_row_id(df, ["same"]).collect()} == {i: i for i in range(1000)}
    assert {r["id"]: r["_row_id"] for r in with_row_id(df).collect()} == {i: i for i in range(1000)}


def test_rows_are_read_by_key_where_keys_allow(spark, tmp_path):
    from prepframe.operators import extract

    path = str(tmp_path / "t")
    spark.range(1000).select("id", (F.col("id") % 10).alias("k"), F.col("id").cast("string").alias("s")).write.parquet(path)
    df = spark.read.parquet(path)
    by_key = extract.rows_range(df, 100, 199, "id")
    plan = by_key._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(id,100)" in plan and "LessThanOrEqual(id,199)" in plan
    for order in (["id"], ["k", "id"], ["s"], ["k", "s"]):
        rows = [tuple(r) for r in df.collect()]
        at = [df.columns.index(c) for c in order]
        rows.sort(key=lambda r: [r[i] for i in at])
        assert [tuple(r) for r in extract.rows_range(df, 95, 305, order).collect()] == rows[95:306]
        assert [tuple(r) for r in extract.keep_rows(df, [999, 0, 7, 7], order).collect()] == [rows[i] for i in (999, 0, 7, 7)]
        left = {tuple(r) for r in extract.remove_rows(df, [999, 0, 7, 7], order).collect()}
        assert left == set(rows) - {rows[999], rows[0], rows[7]}
        assert [tuple(r) for r in extract.page(df, 3, 50, order)[0].collect()] == rows[150:200]


def test_equal_or_missing_keys_take_the_whole_order(spark):
    from prepframe.operators import extract

    df = spark.range(0, 100, 1, 4).select("id", F.when(F.col("id") >= 10, F.col("id") % 2).alias("k"))
    arrival = sorted(range(100), key=lambda i: (i >= 10, i % 2 if i >= 10 else 0, i))
    assert [r["id"] for r in extract.rows_range(df, 5, 30, "k").collect()] == arrival[5:31]
    assert [r["id"] for r in extract.keep_rows(df, [3, 50, 99], "k").collect()] == [arrival[i] for i in (3, 50, 99)]
    assert {r["id"] for r in extract.remove_rows(df, [3, 50], "k").collect()} == set(range(100)) - {arrival[3], arrival[50]}
    assert extract.page(df.limit(0), 0, 10, "id")[0].count() == 0


def test_a_range_reads_only_its_parts(spark):
    numbered = number_rows(spark.range(0, 1000, 1, 8).select("id"))
    assert len(numbered.before) == 8
    near = numbered.rows(130, 240)
    assert [r["id"] for r in near.orderBy("id").collect()] == list(range(130, 241))
    assert "PushedFilters: [" in near._jdf.queryExecution().executedPlan().toString()


def test_ranks_of_few_columns_travel_with_their_rows(spark, monkeypatch):
    """Rows keep their columns side by side, with the same result as in long form, for columns of few and of many values."""
    monkeypatch.setattr(lookup, "BROADCAST_ROWS", 20)
    cells = [F.when((F.col("id") + i) % 5 > 0, (F.col("id") * 7919 + i) % m).cast("double").alias(f"x{i}") for i, m in enumerate((7, 211, 2))]
    df = spark.range(900).select(*cells, (F.col("id") % 400).cast("double").alias("x3"))
    written = []
    monkeypatch.setattr(corr, "stored", lambda df, label: (written.append(label), stored(df, label))[1])
    found = matrix(corr.spearman_matrix(df))
    assert "ranked" not in written
    monkeypatch.setattr(corr, "COLUMN_BY_COLUMN", 0)
    long = matrix(corr.spearman_matrix(df))
    assert "ranked" in written and found.keys() == long.keys()
    assert all(found[k] == pytest.approx(long[k], abs=1e-9) for k in found)
