from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.llm.data import ODD


@pytest.fixture()
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows, and extra columns with names the operators use inside."""
    rows = spark.createDataFrame(ODD, "doc_id long, text string, lang string, source string, n_chars long")
    names = ["k0", "i0", "n0", "c0", "fp", "digest", "text_hash", "place", "label", "starts", "items", "a.b"]
    return rows.withColumns({n: F.lit(1) for n in names})


@pytest.fixture()
def nothing(odd):
    return odd.limit(0)


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="module")
def plain(docs):
    return [(r["doc_id"], r["text"]) for r in docs.orderBy("doc_id").collect()]
