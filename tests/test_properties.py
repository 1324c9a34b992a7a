"""Facts that hold for any table, independence of partitions, and the shape of plans."""

from __future__ import annotations

import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from prepframe.functions import columns
from prepframe.operators import chartdata, corr, dedup, encode, missing, profile, replace, scale

texts = st.one_of(st.none(), st.sampled_from(["a", "b", "", " c", "zażółć", "'x\"", "10", "9"]))
numbers = st.one_of(st.none(), st.floats(-1e6, 1e6, allow_nan=False), st.just(float("nan")))
tables = st.lists(st.tuples(texts, numbers, st.one_of(st.none(), st.integers(-5, 5))), min_size=1, max_size=30)
quick = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def make(spark, rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "row_id long, k string, v double, n int")


@quick
@given(tables)
def test_scaled_ranges(spark, rows):
    df = make(spark, rows)
    got = [r["v"] for r in scale.minmax_scale(df, ["v"]).collect() if r["v"] is not None]
    present = {r[1] for r in rows if r[1] is not None and r[1] == r[1]}
    if len(present) > 1:
        got = [v for v in got if v == v]
        assert min(got) == 0 and max(got) == 1


@quick
@given(tables)
def test_encodings_can_be_undone(spark, rows):
    df = make(spark, rows)
    hot = encode.fit_onehot(df, "k")
    names = hot.names("k")
    for r, source in zip(hot.transform(df).orderBy("row_id").collect(), rows):
        ones = [n for n in names if r[n] == 1]
        assert ones == ([] if source[0] is None else [f"k_{source[0]}"])
    codes = encode.fit_label_codes(df, "k")
    back = {r["code"]: r["value"] for r in codes.mapping().collect()}
    for r in codes.transform(df).collect():
        assert back.get(r["k_code"]) == r["k"]
    bits = [r["bits"] for r in encode.fit_binary(df, "k", "row_id").mapping().collect()]
    assert len(bits) == len(set(bits)) == len({r[0].strip() for r in rows if r[0] is not None})


@quick
@given(tables)
def test_duplicates(spark, rows):
    df = make(spark, rows)
    keys = {(r[0], r[2]) for r in rows}
    first = dedup.drop_duplicates(df, ["k", "n"], "first", "row_id")
    kept = {r["row_id"]: (r["k"], r["n"]) for r in first.collect()}
    assert sorted(kept) == sorted(min(i for i, r in enumerate(rows) if (r[0], r[2]) == key) for key in keys)
    assert dedup.drop_duplicates(first, ["k", "n"], "first", "row_id").count() == len(keys)
    report = dedup.duplicate_report(df, ["k", "n"]).first()
    assert report["surplus"] == len(rows) - len(keys)
    assert report["members"] == len(rows) - dedup.drop_duplicates(df, ["k", "n"], "none").count()


@quick
@given(tables)
def test_filling_leaves_nothing_missing(spark, rows):
    df = make(spark, rows)
    filled = missing.fill(df, {"k": "mode", "v": "median", "n": "mean"})
    for i, c in enumerate(("k", "v", "n")):
        present = [r[i] for r in rows if r[i] is not None and r[i] == r[i]]
        gaps = filled.where(columns.present(filled, c).isNull()).count()
        assert gaps == (0 if present else len(rows))


@quick
@given(tables, st.integers(1, 6))
def test_shares_add_up(spark, rows, k):
    df = make(spark, rows)
    total = sum(r[0] is not None for r in rows)
    assert sum(r["n"] for r in chartdata.topk_with_other(df, "k", k).collect()) == total
    if total:
        assert sum(r["n"] for r in chartdata.share_distribution(df, "k", k, 0.0).collect()) == total


@quick
@given(tables, st.lists(st.tuples(texts, texts), max_size=5))
def test_rules_run_one_after_another(spark, rows, pairs):
    rules = {old: new for old, new in pairs}
    want = [r[0] for r in rows]
    for old, new in rules.items():
        want = [new if v == old else v for v in want]
    got = replace.replace_values(make(spark, rows), {"k": rules})
    assert [r["k"] for r in got.orderBy("row_id").collect()] == want


@pytest.mark.parametrize("parts", [1, 4, 7])
def test_results_do_not_depend_on_partitions(spark, sf_dir, parts):
    df = spark.read.parquet(f"{sf_dir}/lineitem.parquet").withColumn("l_quantity", F.when(F.col("l_tax") > 0, F.col("l_quantity")))
    mixed = df.repartition(parts, F.xxhash64("l_extendedprice"))
    cols = ["l_quantity", "l_extendedprice", "l_discount"]

    def results(t):
        return [
            sorted(profile.numeric_profile(t, cols).select("column", F.round("mean", 6), "median", F.round("std_pop", 6)).collect()),
            sorted(corr.spearman_matrix(t, cols).select("column_a", "column_b", F.round("r", 9)).collect()),
            sorted(dedup.drop_duplicates(t, "l_orderkey", "first", ["l_extendedprice", "l_partkey"]).select("l_partkey", "l_extendedprice").collect()),
            sorted(encode.fit_binary(t, "l_returnflag", ["l_extendedprice", "l_orderkey"]).mapping().collect()),
        ]

    assert results(mixed) == results(df)


# ---- plans ----


def plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def initial(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def lineitem(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet")


def test_scans_read_only_the_columns_used(lineitem):
    text = initial(missing.null_report(lineitem, ["l_quantity"]))
    assert re.search(r"ReadSchema: struct<l_quantity:double>", text)
    text = initial(dedup.duplicate_report(lineitem, ["l_orderkey"]))
    assert re.search(r"ReadSchema: struct<l_orderkey:bigint>", text)


def test_fitted_transforms_need_no_shuffle(lineitem):
    for df in (
        scale.standard_scale(lineitem, ["l_quantity"]),
        encode.onehot(lineitem, "l_returnflag"),
        encode.target_encode(lineitem, "l_returnflag", "l_quantity"),
        encode.label_codes(lineitem, ["l_returnflag", "l_linestatus"]),
        missing.fill(lineitem, {"l_quantity": "median"}),
        replace.replace_values(lineitem, {"l_returnflag": {"A": "B"}}),
    ):
        text = initial(df)
        assert "Exchange hashpartitioning" not in text and "Exchange SinglePartition" not in text
        assert "Python" not in text


def test_duplicates_are_cut_before_the_shuffle(lineitem):
    text = initial(dedup.drop_duplicates(lineitem, ["l_orderkey"], "first", ["l_linenumber", "l_partkey"]))
    assert text.count("WindowGroupLimit") == 2
    assert text.count("Exchange hashpartitioning") == 1
    text = initial(dedup.drop_duplicates(lineitem, ["l_orderkey"], "none"))
    assert text.count("Exchange hashpartitioning") == 1 and "Window" not in text


def test_value_counts_combine_before_the_shuffle(lineitem):
    text = initial(profile.value_counts(lineitem, ["l_returnflag", "l_linestatus"]))
    assert text.count("HashAggregate") == 2 and text.count("Exchange hashpartitioning") == 1
    assert "Window" not in text


def test_chart_totals_come_from_sorted_limits(lineitem):
    text = initial(chartdata.topk_with_other(lineitem, "l_shipdate", 5))
    assert "TakeOrderedAndProject" in text and "CartesianProduct" not in text and "NestedLoop" not in text
