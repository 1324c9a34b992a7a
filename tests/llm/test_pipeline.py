from __future__ import annotations

import hashlib

import numpy as np
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry_file
import corpus_pipeline
from prepframe.llm.quality import CUT, fit_ranking
from prepframe.llm.queries import VOCABULARY, fold
from prepframe.llm.secret_scan import Scanner
from prepframe.llm.simhash import simhash
from tests.llm.test_scans import brute
from tests.llm.test_simhash import groups


@pytest.fixture(scope="module")
def labels(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def test_by_brute_force(spark, sf_dir, docs, plain, labels):
    """All stages, row by row in plain Python; only the ranking's fit is shared."""
    ranking = fit_ranking(docs, labels.where(fold(5) != 0))
    left = [(i, t) for i, t in plain if ranking.score(t) >= CUT]
    top = groups([(i, simhash(t)) for i, t in left])
    left = [(i, t) for i, t in left if top[i] == i]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    left = [(i, t) for i, t in left if not brute(t, items)[4]]
    library = Tokenizer.from_file(VOCABULARY)
    want = {}
    for i, t in left:
        out, at = [], 0
        for a, _, b in Scanner().spans([t])[0]:
            out += [t[at:a], "[secret]"] if a >= at else []
            at = max(at, b)
        want[i] = library.encode("".join([*out, t[at:]]), add_special_tokens=False).ids
    rows = {r["doc_id"]: r for r in corpus_pipeline.run(spark, sf_dir).collect()}
    assert {i: r["ids"] for i, r in rows.items()} == want and len(want) < len(plain)
    assert all(r["ids_sha256"] == hashlib.sha256(np.array(r["ids"], "<u4").tobytes()).hexdigest() for r in rows.values())


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stage_cases(spark, sf_dir, odd, nothing, name, stage):
    found = stage(spark, odd, sf_dir)
    if name != "encoding":
        assert found.columns == odd.columns and found.schema["text"] == odd.schema["text"]
    if name in ("secrets", "encoding"):
        assert found.count() == odd.count()
    assert stage(spark, nothing, sf_dir).count() == 0


def test_near_copies(spark, sf_dir, odd):
    left = sorted(r["doc_id"] or 0 for r in corpus_pipeline.drop_near_copies(spark, odd, sf_dir).collect())
    assert left == [0, 1, 3, 5, 6, 7, 8, 9, 10]  # 2 copies 1, 4 has no words like 3


def test_registered():
    names = [f"op{n}_" for n in range(1, 14)] + ["pipeline"]
    assert all(sum(k.startswith(n) for k in entry_file.queries()) == 1 for n in names)
    assert set(entry_file.oracle_sql()) <= set(entry_file.queries())
