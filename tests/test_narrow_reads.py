"""Queries that use few columns of the transcript or the spells neither store nor shuffle the others."""

from __future__ import annotations

import pytest
from test_scale import physical, plain_plans  # noqa: F401

import __spark_entry__ as E
from rollbook.harness import views as V
from rollbook.operators import ordered as O
from rollbook.operators import student_year as SY

SMOKE = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name, stored", [("c14_snapshot_selection", {"sp", "student_year"}), ("u03_set_difference", set()), ("a06_orphan_weight", set()),
                                          ("a24_spells_without_courses", set()), ("a25_joined_by_year", {"sp", "student_year"})])
def test_no_whole_table_is_stored_for_few_columns(spark, name, stored):
    V.Tables.forget()
    E.queries()[name](spark, SMOKE)
    assert {key for _, _, key in V.Tables._kept} == stored


def test_set_difference_reads_each_table_once(spark, plain_plans):  # noqa: F811
    a = spark.createDataFrame([(1, "x", 0), (1, "x", 1), (2, None, 0), (None, "y", 0)], "k int, s string, n int")
    b = spark.createDataFrame([(2, None, 5), (3, "z", 5), (3, "z", 6)], "k int, s string, n int")
    out = O.set_difference(a, b, ["k", "s"])
    assert sorted(map(tuple, out.collect()), key=repr) == sorted([(1, "x", "left"), (None, "y", "left"), (3, "z", "right")], key=repr)
    assert physical(out).count("Scan ") == 2 and "Join" not in physical(out)


def test_student_years_repeat_no_spell(spark, plain_plans):  # noqa: F811
    t = V.Tables(spark, SMOKE)
    V.Tables.forget()
    from rollbook.harness.q_checks import clean_sp
    sp = clean_sp(t)
    assert "Expand" not in physical(SY.collapse_years(sp, SY.home_school(SY.spells_by_school(sp))))
