"""Kinds of a folder whose files arrive over time."""

from __future__ import annotations

import os

import pytest

from prepframe.operators.infer import infer_kinds
from prepframe.sources import arrivals
from prepframe.sources.csv import read_texts


def _put(folder, name, header, rows, sep=","):
    path = folder / name
    path.write_text("\n".join([sep.join(header), *[sep.join(map(str, r)) for r in rows]]) + "\n")
    return path


@pytest.fixture()
def folder(tmp_path):
    base = tmp_path / "in"
    base.mkdir()
    return base


def _one_pass(spark, folder):
    return infer_kinds(read_texts(spark, str(folder)))


def test_two_arrivals_like_one_pass(spark, folder, tmp_path):
    store = str(tmp_path / "store")
    first = _put(folder, "a.csv", ["id", "day", "code", "late"], [(i, f"{i % 28 + 1}.3.2024", "xyz"[i % 3], "") for i in range(300)])
    assert [os.path.basename(f) for f in arrivals.arrive(spark, str(folder), store)] == ["a.csv"]
    assert arrivals.kinds_of(arrivals.merge_states(arrivals.states(spark, str(folder), store))) == _one_pass(spark, folder)
    # In another dialect, with another column, one column short, and values that change what a column is.
    _put(folder, "b c.csv", ["code", "id", "price"], [("w", f"{i},5", i / 4) for i in range(150)], ";")
    assert [os.path.basename(f) for f in arrivals.arrive(spark, str(folder), store)] == ["b c.csv"]
    want = _one_pass(spark, folder)
    merged = arrivals.merge_states(arrivals.states(spark, str(folder), store))
    assert arrivals.kinds_of(merged) == want and want["code"].categories == ("w", "x", "y", "z")
    assert want["late"].kind == "empty" and want["price"].kind == "numeric" and want["id"].decimal_mark == ","
    assert {r["n_rows"] for r in merged.collect()} == {450}
    # Old files are not read again: their content may change as long as size and time stand.
    time = os.stat(first)
    first.write_bytes(b"?" * time.st_size)
    os.utime(first, ns=(time.st_atime_ns, time.st_mtime_ns))
    assert arrivals.arrive(spark, str(folder), store) == []
    assert arrivals.folder_kinds(spark, str(folder), store) == want


def test_replaced_and_removed(spark, folder, tmp_path):
    store = str(tmp_path / "store")
    _put(folder, "a.csv", ["x", "y"], [(i, f"t{i}") for i in range(400)])
    b = _put(folder, "b.csv", ["x", "y"], [("word", "u") for _ in range(900)])
    assert arrivals.folder_kinds(spark, str(folder), store) == _one_pass(spark, folder)
    _put(folder, "b.csv", ["x", "y"], [(7, "u") for _ in range(500)])
    assert len(arrivals.arrive(spark, str(folder), store)) == 1
    assert arrivals.folder_kinds(spark, str(folder), store) == _one_pass(spark, folder)
    b.unlink()
    assert arrivals.folder_kinds(spark, str(folder), store) == _one_pass(spark, folder)


def test_values_at_the_limit(spark, folder, tmp_path):
    """99 values in three files are a category, 100 are not, however they are dealt."""
    for most in (99, 100):
        own = folder / str(most)
        own.mkdir()
        store = str(tmp_path / f"store{most}")
        for k in range(3):
            _put(own, f"{k}.csv", ["v"], [(f"v{(i * 3 + k) % most}",) for i in range(100)])
            found = arrivals.folder_kinds(spark, str(own), store)
            assert found == _one_pass(spark, own)
        assert found["v"].kind == ("categorical" if most == 99 else "text")


def test_odd_files(spark, folder, tmp_path):
    store = str(tmp_path / "store")
    (folder / "empty.csv").write_text("")
    _put(folder, "header.csv", ["a", "b"], [])
    known = arrivals.arrive(spark, str(folder), store)
    assert "header.csv" in {os.path.basename(f) for f in known}
    assert arrivals.arrive(spark, str(folder), store) == []
    _put(folder, "rows.csv", ["a", "b"], [("1", ""), ("2", ""), ("3", "")])
    assert [os.path.basename(f) for f in arrivals.arrive(spark, str(folder), store)] == ["rows.csv"]
    found = arrivals.folder_kinds(spark, str(folder), store)
    assert found["a"].kind == "numeric" and found["b"].kind == "empty"
    # A store with a file read by two runs at once counts it once.
    spark.read.parquet(store).write.mode("append").parquet(str(tmp_path / "twice"))
    spark.read.parquet(store).write.mode("append").parquet(str(tmp_path / "twice"))
    assert arrivals.folder_kinds(spark, str(folder), str(tmp_path / "twice")) == found
