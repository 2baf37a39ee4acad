"""Double-booking rates before resolution, with and without what-if filters."""

from dataclasses import replace

from rollbook.operators import meetings as M

P = M.ScheduleParams(term_weights={"Y": 1.0, "S1": 0.5}, term_expands={"Y": ["S1", "S2"]})
SCHEMA = "D_stu_id int, D_employee_id int, D_term string, D_period string, D_rotation string, C_class_id string"
ROWS = [
    (1, 7, "Y", "1", "A", "a"), (1, 7, "S1", "1", "A", "b"),      # meet in S1
    (2, 7, "Y", "MISC", "A-B", "c"), (2, 8, "S1", "MISC", "B", "d"),  # meet in MISC only
    (3, None, "S1", "2", "A", "e"), (4, None, "S1", "2", "A", "f"),   # the unknown teacher has two classes
    (5, 9, "S1", "3", "B", None), (5, 9, "S1", "3", "B", "g"),      # an unknown class is one more
]


def test_each_scenario(spark):
    rules = ({"col": "D_period", "op": "in", "val": ["MISC"]}, {"col": "D_period", "op": "eq", "val": "1"})
    got = {(r[0], r[1]): (r[2], r[3]) for r in M.conflict_sizes(spark.createDataFrame(ROWS, SCHEMA), replace(P, sizing_filters=rules)).collect()}
    student = {k[1]: v for k, v in got.items() if k[0] == "D_stu_id"}
    assert student["all rows"] == (5, 1 + 1 + 1)
    assert student["without D_period in MISC"] == (4, 2)
    assert student["without D_period eq 1"] == (4, 2)
    assert student["without any"] == (3, 1)
    teacher = {k[1]: v for k, v in got.items() if k[0] == "D_employee_id"}
    assert teacher["all rows"] == (4, 3) and teacher["without any"] == (2, 2)


def test_no_rules_and_no_rows(spark):
    assert [r["scenario"] for r in M.conflict_sizes(spark.createDataFrame(ROWS, SCHEMA), P, ["D_stu_id"]).collect()] == ["all rows"]
    assert [tuple(r)[2:] for r in M.conflict_sizes(spark.createDataFrame([], SCHEMA), P, ["D_stu_id"]).collect()] == [(0, 0, None)]
