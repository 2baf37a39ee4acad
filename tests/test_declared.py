"""Text sources with records that cannot be read."""

import pytest
from rollbook.operators.checks import CheckFailed, CheckLog
from rollbook.sources.declared import read_gated

SCHEMA = "id int, name string, grade double"
LINES = ["id,name,grade", "1,Ann,3.5", "2,Bo", "3,Cy,high", "4,Di,2.0,extra", '5,"Ed, jr",', ",,"]


@pytest.fixture
def source(tmp_path):
    path = tmp_path / "roll.csv"
    path.write_text("\n".join(LINES) + "\n")
    return {"roll": {"path": str(path), "format": "csv", "schema": SCHEMA}, "none": None}


def test_bad_records_are_kept_apart(spark, source):
    log = CheckLog(spark)
    good, bad = read_gated(spark, source, "roll", log, tolerance_pct=50)
    assert sorted(map(tuple, good.collect()), key=str) == sorted([(1, "Ann", 3.5), (5, "Ed, jr", None), (None, None, None)], key=str)
    assert sorted(r["record"] for r in bad.collect()) == ["2,Bo", "3,Cy,high", "4,Di,2.0,extra"]
    assert all(r["file"].endswith("roll.csv") for r in bad.collect())
    assert [(r["check"], r["result"], r["value"]) for r in log.table().filter("severity = 'stop'").collect()] == [("roll: records can be read", "PASS", "3 of 6")]


def test_the_gate_stops_and_shows_them(spark, source):
    log = CheckLog(spark)
    with pytest.raises(CheckFailed, match="roll: records can be read: 3 of 6"):
        read_gated(spark, source, "roll", log)
    assert sorted(r["__bad_record"] for r in log.offenders("roll: records can be read").collect()) == ["2,Bo", "3,Cy,high", "4,Di,2.0,extra"]


def test_without_a_log_nothing_stops(spark, source):
    good, bad = read_gated(spark, source, "roll", clean_names=True)
    assert good.columns == ["id", "name", "grade"] and (good.count(), bad.count()) == (3, 3)


def test_columns_in_another_order_are_refused(spark, source):
    wrong = {"roll": source["roll"] | {"schema": "name string, id int, grade double"}}
    with pytest.raises(Exception, match="(?i)header"):
        read_gated(spark, wrong, "roll")


def test_broken_json_and_other_formats(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"id": 1, "name": "Ann"}\n{"id": 2, "name"\n{"id": "x", "name": "Cy"}\n')
    good, bad = read_gated(spark, {"j": {"path": str(tmp_path / "a.json"), "format": "json", "schema": "id int, name string"}}, "j")
    assert [tuple(r) for r in good.collect()] == [(1, "Ann")] and bad.count() == 2
    spark.range(3).write.parquet(str(tmp_path / "p"))
    good, bad = read_gated(spark, {"p": {"path": str(tmp_path / "p")}}, "p")
    assert good.count() == 3 and bad.count() == 0


def test_absent_empty_and_undeclared(spark, source, tmp_path):
    assert read_gated(spark, source, "none") is None
    with pytest.raises(KeyError):
        read_gated(spark, source, "other")
    with pytest.raises(ValueError, match="needs a schema"):
        read_gated(spark, {"roll": {"path": "x", "format": "csv"}}, "roll")
    (tmp_path / "e.csv").write_text("id,name,grade\n")
    empty = {"roll": source["roll"] | {"path": str(tmp_path / "e.csv")}}
    good, bad = read_gated(spark, empty, "roll", CheckLog(spark))
    assert good.count() == bad.count() == 0
    with pytest.raises(CheckFailed, match="need 1"):
        read_gated(spark, empty, "roll", CheckLog(spark), min_rows=1)
