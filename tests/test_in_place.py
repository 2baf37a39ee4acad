"""Sections of one teacher are put together where they are dealt; resolved rows are dealt once for the student stage and the sums after it."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F
from test_components import plain
from test_one_deal import COLUMNS, records
from test_scale import physical, plain_plans  # noqa: F401

from rollbook.harness import views as V
from rollbook.operators import components
from rollbook.operators import double_booking as DB
from rollbook.operators import meetings as M
from rollbook.plans import schedule as S


def rows_of(kind):
    r = random.Random(kind)
    if kind == "chain":  # longer than the turns reach
        return [(f"s{k + d:03}", 1, k) for k in range(60) for d in (0, 1)]
    if kind == "shared":  # sections of several teachers tie their components together
        return [(f"s{r.randrange(80):03}", r.randrange(12), r.randrange(9)) for _ in range(150)]
    if kind == "one slot":
        return [(f"s{k:03}", 1, 1) for k in range(200)]
    return [(f"s{k:03}", k % 9, r.randrange(30)) for k in range(200)]


@pytest.mark.parametrize("kind", ["chain", "shared", "one slot", "apart"])
def test_components_where_rows_are_dealt(spark, monkeypatch, kind):
    general, asked = components.connected_components, []
    monkeypatch.setattr(components, "connected_components", lambda m, *a: asked.append(m.count()) or general(m, *a))
    rows = rows_of(kind)
    d = spark.createDataFrame(rows + rows[:9], "sec string, who int, slot int")
    got = components.dealt_components(d, "sec", ["who"], F.col("slot").cast("string"))
    assert sorted(got.columns) == ["component", "sec", "slot", "who"]
    assert sorted((x.sec, x.who, x.slot) for x in got.collect()) == sorted(set(rows))
    want = plain([(s, (w, g)) for s, w, g in rows])
    assert {(x.sec, x.component) for x in got.collect()} == set(want.items())
    assert bool(asked) == (kind in ("chain", "shared")) and sum(asked) < len(set(rows))
    assert components.dealt_components(d.limit(0), "sec", ["who"], F.col("slot").cast("string")).collect() == []


def test_a_student_and_term_lie_together(spark, plain_plans):  # noqa: F811
    """Sums by student, class and term slot follow the student stage without another exchange; what rows are dealt by is not shuffled."""
    w = S.weigh(spark.createDataFrame(records(8), COLUMNS), V.PR).drop("C_class_id").localCheckpoint()
    rows = DB.flag_records(w, V.PR, only_flagged=True)
    dealt = physical(rows)
    assert dealt.count("Exchange") == 1 and "__at" not in dealt[dealt.index("Exchange"):]
    resolved = DB.resolve_double_bookings(rows.localCheckpoint(), V.PR.recipe)[0]
    plan = physical(resolved.groupBy("D_stu_id", "C_class_id_post_teachers", M.TERM).agg(F.sum("M_class_weight_post_student")))
    assert plan.count("Exchange") == physical(resolved).count("Exchange")
