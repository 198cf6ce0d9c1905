"""Malformed rows of exports: kept as raw lines, and too many stop a load."""

from __future__ import annotations

from decimal import Decimal

import pytest

from tallyloom.sources.quarantine import CheckedLoads, MalformedExport

SCHEMA = "code INT, name STRING, amount DECIMAL(18,2)"


def export(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(f"{x}\n" for x in lines))
    return str(folder)


def content(done):
    rows = sorted((tuple(r) for r in done.rows.collect()), key=repr)
    return rows, sorted(r["_raw"] for r in done.malformed.collect())


def test_wrong_values_and_numbers_of_fields_are_set_apart(spark, tmp_path):
    folder = export(
        tmp_path / "in", "a.csv",
        "code,name,amount", "1,x,1.50", "y,x,1", "2,x,n/a", "3,x,1,more", "4,x", '5,"a, b",', ",,", "6,x,99999999999999999999",
    )
    loads = CheckedLoads(spark, str(tmp_path / "out"), SCHEMA, most_malformed=0.7)
    done = loads.load(folder)
    rows, malformed = content(done)
    assert rows == sorted([(1, "x", Decimal("1.50")), (5, "a, b", None), (None, None, None)], key=repr)
    assert malformed == ["2,x,n/a", "3,x,1,more", "4,x", "6,x,99999999999999999999", "y,x,1"]
    assert (done.n_rows, done.n_malformed) == (3, 5)
    assert all(r["_file"].endswith("/in/a.csv") for r in done.malformed.collect())
    assert content(loads.current()) == (rows, malformed)


def test_too_many_keep_the_load_before(spark, tmp_path):
    folder = export(tmp_path / "in", "a.csv", "code,name,amount", "1,x,1.50")
    loads = CheckedLoads(spark, str(tmp_path / "out"), SCHEMA, most_malformed=0.4)
    with pytest.raises(LookupError):
        loads.current()
    before = content(loads.load(folder))
    export(tmp_path / "in", "b.csv", "code,name,amount", "1,x,2", "2,x,bad")
    with pytest.raises(MalformedExport, match="1 of 2 rows"):
        loads.load(folder, pattern="b.csv")
    assert content(loads.current()) == before == ([(1, "x", Decimal("1.50"))], [])


def test_json_empty_exports_and_refusals(spark, tmp_path):
    folder = export(tmp_path / "in", "a.json", '{"code": 1, "name": "x", "amount": 2}', '{"code": "one"}', "{no json", '{"name": "y"}')
    done = CheckedLoads(spark, str(tmp_path / "json"), SCHEMA, most_malformed=0.5).load(folder, "json")
    assert content(done) == ([(1, "x", Decimal("2.00")), (None, "y", None)], ['{"code": "one"}', "{no json"])
    empty = export(tmp_path / "empty", "a.csv", "code,name,amount")
    done = CheckedLoads(spark, str(tmp_path / "none"), SCHEMA).load(empty)
    assert content(done) == ([], []) and done.rows.columns == ["code", "name", "amount"]
    with pytest.raises(Exception, match="(?i)header"):
        other = export(tmp_path / "other", "a.csv", "code,amount,name", "1,2,x")
        CheckedLoads(spark, str(tmp_path / "others"), SCHEMA).load(other)
    with pytest.raises(ValueError, match="reserved"):
        CheckedLoads(spark, str(tmp_path / "x"), "_raw STRING")
    with pytest.raises(ValueError, match="load_newest"):
        CheckedLoads(spark, str(tmp_path / "x"), SCHEMA).load(folder, "parquet")
