"""The small table and other hand-made cases with known results."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from prepframe.operators import chartdata, corr, dedup, encode, extract, infer, missing, profile, replace, scale

DATA = ["k", "g", "x", "t"]


def values(df, column, order="row_id"):
    return [r[column] for r in df.orderBy(order).collect()]


def ids(df):
    return sorted(r["row_id"] for r in df.collect())


def test_numeric_profile(m):
    row = profile.numeric_profile(m, ["x", "k"]).first()
    assert (row["mean"], row["median"], row["min"], row["max"], row["count"]) == (3.8, 2.0, 1.0, 10.0, 5)
    assert row["std_pop"] == pytest.approx(3.249615361854384)


def test_scaling(m):
    got = values(scale.minmax_scale(m, ["x"]), "x")
    assert got[2] is None
    assert [v for v in got if v is not None] == pytest.approx([0, 1 / 9, 1 / 3, 1, 1 / 9])
    got = values(scale.standard_scale(m, ["x"]), "x")
    assert got[2] is None
    assert [round(v, 6) for v in got if v is not None] == [-0.770675, -0.495434, 0.055048, 1.706494, -0.495434]
    mean, std = scale.fit_standard(m, ["x"]).as_pairs()["x"]
    assert (mean, std) == (pytest.approx(3.8), pytest.approx(3.6331804249169903))


def test_constant_columns_are_left_alone(spark):
    df = spark.range(1000).select(F.lit(0.1).alias("c"), F.col("id").cast("double").alias("v"))
    for scaled in (scale.minmax_scale(df), scale.standard_scale(df)):
        assert scaled.select("c").distinct().collect() == [(0.1,)]
    one = spark.createDataFrame([(3.0,)], "c double")
    assert scale.standard_scale(one).collect() == [(3.0,)]
    with pytest.raises(ValueError):
        scale.minmax_scale(df, ["absent"])


def test_filling(m):
    filled = missing.fill(m, {"x": "mean", "k": "mode"})
    assert values(filled, "x")[2] == 3.8
    assert values(filled, "k")[2] == "a"
    assert values(missing.fill(m, {"t": "median"}), "t")[3] == 20.0
    with pytest.raises(ValueError):
        missing.fill(m, {"x": "guess"})
    with pytest.raises(ValueError):
        missing.fill(m, {"absent": "mean"})
    with pytest.raises(ValueError):
        missing.fill(m, {"x": "constant"}, "many")


def test_filling_whole_numbers(spark):
    df = spark.createDataFrame([(1, 5), (2, 5), (5, 5), (None, 5)], "a int, b int")
    filled = missing.fill_table(df, "mean")
    assert [f.dataType.simpleString() for f in filled.schema] == ["double", "double"]  # by the method alone
    assert sorted(r["a"] for r in filled.collect()) == pytest.approx([1, 2, 8 / 3, 5])
    empty = spark.createDataFrame([(None,)], "a string")
    assert missing.fill(empty, {"a": "mode"}).collect() == [(None,)]


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,), (3.0,)], "v double")
    assert profile.numeric_profile(df).first()["mean"] == 2.0
    assert sorted(r["v"] for r in missing.fill(df, {"v": "median"}).collect()) == [1.0, 2.0, 3.0]


def test_sparse_rows_and_columns(m):
    assert ids(missing.drop_sparse_rows(m, 3, DATA)) == [0, 1, 3, 4, 5]
    assert missing.drop_sparse_columns(m, 5, DATA).columns == ["row_id", *DATA]
    assert missing.drop_sparse_columns(m, 6, DATA).columns == ["row_id"]
    assert {r["column"]: r["nulls"] for r in missing.null_report(m, DATA).collect()} == {
        "k": 1, "g": 1, "x": 1, "t": 1, None: 3,
    }


def test_categorical_profile(m):
    row = profile.categorical_profile(m, ["k"]).first()
    assert (row["count"], row["distinct"], row["mode"], row["top_share"]) == (5, 3, "a", 0.4)
    assert row["fill_pct"] == pytest.approx(500 / 6)


def test_pooled_mean(m, spark):
    assert profile.pooled_mean(m, ["x", "t"]).first()[0] == pytest.approx(14.9)
    assert profile.pooled_mean(spark.createDataFrame([(None,)], "v double")).first()[0] == 0.0


def test_duplicates(m):
    assert ids(dedup.drop_duplicates(m, DATA, "first", "row_id")) == [0, 1, 2, 3, 4]
    assert ids(dedup.drop_duplicates(m, DATA, "last", "row_id")) == [0, 2, 3, 4, 5]
    assert ids(dedup.drop_duplicates(m, DATA, "none")) == [0, 2, 3, 4]
    report = dedup.duplicate_report(m, DATA).first()
    assert (report["members"], report["surplus"]) == (2, 1)
    with pytest.raises(ValueError):
        dedup.drop_duplicates(m, ["k"], "first")


def test_missing_keys_are_duplicates_of_each_other(spark):
    df = spark.createDataFrame([(None, 1), (None, 2)], "k string, o int")
    assert dedup.duplicate_report(df, "k").first()["members"] == 2
    assert dedup.drop_duplicates(df, "k", "none").count() == 0


def test_encoding(m):
    assert values(encode.target_encode(m, "k", "t"), "k_target") == [18, 22, 26, 18, 38, 22]
    assert values(encode.label_codes(m, "k"), "k_code") == [0, 1, -1, 0, 2, 1]
    binary = encode.binary_encode(m, "k", "row_id")
    assert values(binary, "k_bin_0") == [0, 0, None, 0, 1, 0]
    assert values(binary, "k_bin_1") == [0, 1, None, 0, 0, 1]
    hot = encode.onehot(m, "k")
    assert hot.columns == ["row_id", "g", "x", "t", "k_a", "k_b", "k_c"]
    assert hot.where("row_id = 2").select("k_a", "k_b", "k_c").first() == (0, 0, 0)
    assert encode.onehot(m, "k", drop_first=True).columns[-2:] == ["k_b", "k_c"]


def test_encoding_guards(m, spark):
    with pytest.raises(ValueError):
        encode.onehot(m, "x")
    with pytest.raises(ValueError):
        encode.target_encode(m, "k", "g")
    with pytest.raises(ValueError):
        encode.fit_onehot(m, "k", max_categories=2)
    single = spark.createDataFrame([(1, " a"), (2, "a ")], "o int, k string")
    assert encode.binary_encode(single, "k", "o").columns == ["o"]


def test_replacing(m):
    got = replace.replace_values(m, {"k": {"a": "b", "b": "c"}, "absent": {"a": "b"}})
    assert values(got, "k") == ["c", "c", None, "c", "c", "c"]
    got = replace.replace_values(m, {"x": {"2": "2.5", "abc": 1, "nan": 0}})
    assert values(got, "x") == [1.0, 2.5, 0.0, 4.0, 10.0, 2.5]
    swapped = replace.replace_values(m, {"k": {"a": "z", "b": "a"}})
    assert values(swapped, "k") == ["z", "a", None, "z", "c", "a"]
    report = replace.replace_report(m, {"k": {"a": "b", "b": "c", None: "z"}})
    assert [r["changed"] for r in report.orderBy("seq").collect()] == [2, 4, 1]
    assert replace.replace_values(m, {}).collect() == m.collect()


def test_replacing_extends_categories(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",), ("a",)], "k string")
    typed = infer.apply_kinds(df, {"k": infer.Kind("categorical", categories=("a", "b"))})
    got = replace.replace_values(typed, {"k": {"a": "z"}})
    assert got.schema["k"].metadata["categories"] == ["a", "b", "z"]
    assert encode.onehot(got, "k").columns == ["k_a", "k_b", "k_z"]
    assert encode.label_codes(got, "k").select("k_code").distinct().count() == 2


def test_rows_by_position(m, spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate((1, 2, 3))], "o int, v int")
    assert [r["v"] for r in extract.keep_rows(df, [2, 0, 0], ["o"]).collect()] == [3, 1, 1]
    assert sorted(r["v"] for r in extract.remove_rows(df, [2, 0, 0], ["o"]).collect()) == [2]
    assert ids(extract.rows_range(m, 1, 3, ["row_id"])) == [1, 2, 3]
    for bad in ([3], [-1]):
        with pytest.raises(ValueError):
            extract.keep_rows(df, bad, ["o"])
    with pytest.raises(ValueError):
        extract.keep_columns(df, ["absent"])
    assert extract.keep_rows(df, [], ["o"]).count() == 0


def test_pages(m):
    from prepframe.operators.rowid import number_rows

    numbered = number_rows(m, ["row_id"])
    shown, place = extract.page(numbered, 1, 4)
    assert ids(shown) == [4, 5]
    assert place == {"page": 1, "pages": 2, "first": 5, "last": 6, "total": 6}
    assert extract.page(numbered, -3, 4)[1]["page"] == 0
    assert extract.page(numbered, 9, None)[1] == {"page": 0, "pages": 1, "first": 1, "last": 6, "total": 6}


def matrix(df):
    return {(r["column_a"], r["column_b"]): r["r"] for r in df.collect()}


def test_correlations(m, spark):
    assert matrix(corr.pearson_matrix(m, ["x", "t"]))["x", "t"] == pytest.approx(0.98674736)
    assert matrix(corr.spearman_matrix(m, ["x", "t"]))["x", "t"] == pytest.approx(1.0)
    gaps = spark.createDataFrame([(1, 5), (2, None), (3, 1), (4, 1), (None, 9)], "a int, b int")
    assert matrix(corr.spearman_matrix(gaps))["a", "b"] == pytest.approx(-0.8660254037844387)
    ties = spark.createDataFrame([(1, 5), (2, 1), (2, 3), (4, 0)], "a int, b int")
    assert matrix(corr.spearman_matrix(ties))["b", "a"] == pytest.approx(-0.9486832980505138)
    constant = spark.createDataFrame([(1, 1), (1, 2), (1, 3)], "a int, b int")
    for found in (corr.pearson_matrix(constant), corr.spearman_matrix(constant)):
        assert matrix(found) == {("a", "a"): None, ("a", "b"): None, ("b", "a"): None, ("b", "b"): 1.0}


def test_constant_only_where_the_partner_is_present(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (2, None)], "a int, b int")
    for found in (corr.pearson_matrix(df), corr.spearman_matrix(df)):
        assert matrix(found)["a", "b"] is None and matrix(found)["a", "a"] == 1.0


def test_shares(spark):
    letters = "a" * 50 + "b" * 30 + "c" * 15 + "d" * 4 + "e"
    df = spark.createDataFrame([(x,) for x in letters], "k string")
    rows = chartdata.share_distribution(df, "k", 3).collect()
    assert [(r["category"], r["percent"]) for r in rows] == [("a", 50), ("b", 30), ("Inne", 20)]
    rows = chartdata.share_distribution(df, "k", 4, 6.0).collect()
    assert [(r["category"], r["n"]) for r in rows] == [("a", 50), ("b", 30), ("c", 15)]
    rows = chartdata.share_distribution(df, "k", 3, 25.0).collect()
    assert [(r["category"], r["n"]) for r in rows] == [("a", 50), ("b", 30)]
    assert chartdata.share_distribution(df, "k", 8, 99.0).collect() == [("Inne", 100, 100.0, True)]
    top = chartdata.topk_with_other(df, "k", 5)
    assert top.where("is_other").count() == 0 and top.count() == 5
    only = chartdata.topk_with_other(df, "k", 1).collect()
    assert [(r["category"], r["n"]) for r in only] == [("Inne", 100)]


def test_hue_choice(m):
    assert chartdata.choose_hue(m, "brak", "g") == "g"
    assert chartdata.choose_hue(m, "k", "g") == "k"
    assert chartdata.choose_hue(m, "absent", "") is None


def test_trend_of_constant_x(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "x double, y double")
    assert tuple(chartdata.trend_line(df, "x", "y").first())[:2] == (None, None)


def test_kinds(spark):
    rows = [(f"{i},5", f"{i % 28 + 1}.02.2020", "ab"[i % 2], str(i), f"C{i}", "true", None) for i in range(40)]
    df = spark.createDataFrame(rows, "price string, day string, flag string, id string, code string, yes string, none string")
    kinds = infer.infer_kinds(df)
    assert {c: k.kind for c, k in kinds.items()} == {
        "price": "numeric", "day": "date", "flag": "categorical", "id": "numeric", "code": "text", "yes": "boolean",
        "none": "empty",
    }
    typed = infer.apply_kinds(df, kinds)
    assert [f.dataType.simpleString() for f in typed.schema] == [
        "double", "timestamp_ntz", "string", "bigint", "string", "boolean", "string",
    ]
    assert infer.narrow_integers(typed).schema["id"].dataType.simpleString() == "tinyint"


def test_seventy_percent_is_not_enough(spark):
    df = spark.createDataFrame([("1,5",), ("C48",), ("2",)], "v string")
    assert infer.infer_kinds(df)["v"].kind != "numeric"
    few = spark.createDataFrame([("C1",), ("2",)], "v string")
    assert infer.infer_kinds(few)["v"].kind == "text"


def test_number_and_date_texts(spark):
    from prepframe.functions.columns import parse_date, parse_number

    df = spark.createDataFrame([(" 1,25 ", "1-2-2020", "31-12-2020", "1.5f")], "n string, d string, e string, f string")
    got = df.select(
        parse_number(F.col("n"), ",").alias("n"),
        F.date_format(parse_date(F.col("d"), "d-M-yyyy"), "yyyy-MM-dd").alias("d"),
        parse_date(F.col("e"), "M-d-yyyy").alias("e"),
        parse_number(F.col("f")).alias("f"),
    ).first()
    assert tuple(got) == (1.25, "2020-02-01", None, None)


def test_one_date_in_ten(spark):
    df = spark.createDataFrame([("2020-01-01",)] + [(f"w{i}",) for i in range(9)], "v string")
    assert infer.infer_kinds(df)["v"].kind == "text"
    assert infer.infer_kinds(df, date_min_share=0)["v"].kind == "date"


def test_patches(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], "id int, k string, v double")
    patches = spark.createDataFrame(
        [(1, "v", "7.5", 1), (1, "v", "8.5", 2), (2, "v", "x", 1), (2, "k", "c", 1)],
        "id int, column string, value string, seq int",
    )
    got = sorted(extract.apply_patches(df, patches, "id").collect())
    assert got == [(1, "a", 8.5), (2, "c", 2.0)]


def test_whole_medians(spark):
    from decimal import Decimal

    from prepframe.operators.quantile import whole_medians

    big = 2**53
    for values in ([big + 1], [big + 1, big + 3], [big, big + 1], [-5, None, 7, -(2**63)], [2**63 - 1] * 3, [], [None]):
        df = spark.createDataFrame([(v,) for v in values], "v long")
        present = sorted(v for v in values if v is not None)
        n = len(present)
        want = Decimal(present[(n - 1) // 2] + present[n // 2]) / 2 if n else None
        assert whole_medians(df, ["v"]) == {"v": want}
    row = profile.whole_profile(spark.createDataFrame([(big + 1, "x"), (big + 2, "y")], "v long, s string")).first()
    assert (row["min"], row["max"], row["median"]) == (big + 1, big + 2, Decimal(2 * big + 3) / 2)
