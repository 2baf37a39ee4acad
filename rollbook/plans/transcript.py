"""Transcript analysis: clean spells and courses, reconcile, assign home schools, select, code, export."""

from __future__ import annotations

from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates, ranges, text
from ..functions.nullsafe import flag, is_in, join_same, not_in
from ..operators import cohort as C
from ..operators import joins as J
from ..operators import scope
from ..operators import student_year as SY
from ..operators.checks import Check, CheckLog, unique
from ..operators.gated import Gate, keyed, must, write_gated
from ..operators.ordered import mobility
from ..sources.sinks import Sink
from ..sources.tables import cut_lineage, prefix_order

# Term markers, tried on the course id and then on the course name.
TERM_RULES = ((r"S1\s*\*?\s*$", "Semester 1"), (r"S2\s*\*?\s*$", "Semester 2"), (r"DA\s*\*?\s*$", "Semester 1"), (r"DB\s*\*?\s*$", "Semester 2"))


@dataclass(frozen=True)
class TranscriptParams:
    date_formats: tuple = ("M/d/yyyy",)
    strip_prefix: str | None = r"^\d{2}-\d{2}\s+"
    strip_suffix: str | None = r"\s+\d{1,2}-\d{1,2}$"
    aliases: dict = field(default_factory=dict)
    schools: tuple = ()
    merges: tuple = ()
    race_map: dict = field(default_factory=dict)
    negative_days: str = "floor_zero"
    term_rules: tuple = TERM_RULES
    id_strip_suffix: str = r"(?:\p{P})?(?:S1|S2|DA|DB)$"
    grade_bounds: tuple = ((0, 100), (0, 110))
    credit_bounds: tuple = ((0, 2), (0, 10))
    impossible_above: float = 2
    grade_buckets: tuple = ((90, "90+"), (80, "80-89"), (70, "70-79"), (60, "60-69"), (0, "Below 60"))
    entry_year: int = 2022
    entry_grade: int = 9
    progression: dict = field(default_factory=lambda: {2022: 9, 2023: 10, 2024: 11, 2025: 12})
    universe_rule: str = "entry_grade_any_school"
    duration_rule: str = "all_years"
    progression_rule: str = "all_years"
    duration_min_days: int = 200
    school_rule: str = "in_scope_all_years"
    snapshot_year: int = 2025
    snapshot_grades: tuple = (9, 10, 11, 12)
    snapshot_min_days: int = 200
    # limits of the stopping gates, in percent; a gate's own name in ``tolerances`` overrides its default of 0
    min_student_match_pct: float = 99
    min_student_year_match_pct: float = 90
    min_grade_agreement_pct: float = 90
    min_coding_match_pct: float = 99.5
    tolerances: dict = field(default_factory=dict)
    expected_years: dict = field(default_factory=dict)

    @property
    def years(self):
        return sorted(self.progression)

    def gate(self, name: str, bad, default: float = 0.0, **more) -> Gate:
        return Gate(name, bad, self.tolerances.get(name, default), **more)


def location_years(raw: DataFrame, p: TranscriptParams) -> DataFrame:
    """Everything derived about a reported location, by year.

    The spells are counted per location, name and year first, so cleaning, merging, canonical names and
    scope work on a table as small as the list of schools.
    """
    d = raw.groupBy("D_location_id", "D_location_name", "D_year").agg(F.count(F.lit(1)).alias("n"))
    d = d.withColumn("C_location_name", text.clean_location_name("D_location_name", p.strip_prefix, p.strip_suffix, p.aliases))
    if p.merges:
        d = J.apply_merges(d, J.merge_plan(d, "D_location_id", "C_location_name", "D_year", p.merges, "n"), "D_location_id", "C_location_name")
    else:
        d = d.withColumns({"C_location_id": F.col("D_location_id"), "C_location_name_merged": F.col("C_location_name")})
    d = J.canonical_names(d, "C_location_id", "C_location_name_merged", weight="n")
    d = scope.member_flag(d, d.filter(is_in("C_location_name_merged", p.schools)).select("C_location_id"), "C_location_id", "C_school_in_scope")
    return d


def location_table(raw: DataFrame, p: TranscriptParams) -> DataFrame:
    """One row per (location id, reported name)."""
    return location_years(raw, p).drop("n", "D_year").distinct()


DATES = ("D_stu_enter_date", "D_stu_exit_date")


def clean_spells(raw: DataFrame, p: TranscriptParams, locations: DataFrame | None = None, marks: bool = False) -> DataFrame:
    """Raw spells -> dates, days in the school-year window, cleaned and merged locations, recoded fields.

    ``marks`` adds what the gates need of the raw values: ``H_unreadable_<date>`` and ``H_days_signed``.
    """
    d = raw.withColumns({f"H_unreadable_{c}": dates.date_unreadable(c, p.date_formats) for c in DATES}) if marks else raw
    d = d.withColumns({c: dates.parse_date(c, p.date_formats) for c in DATES})
    d = d.withColumn("C_exit_date_imputed", F.col("D_stu_exit_date").isNull())
    d = d.withColumn("D_stu_exit_date", dates.fill_date("D_stu_exit_date", dates.year_date("D_year", 6, 30)))
    d = dates.enrolment_days(d)
    if marks:
        d = d.withColumn("H_days_signed", F.datediff("D_stu_exit_date", "D_stu_enter_date"))
    d = dates.negative_days(d, p.negative_days)
    d = join_same(d, cut_lineage(location_table(raw, p)) if locations is None else locations, ["D_location_id", "D_location_name"])
    d = scope.recode(d, "D_stu_race", p.race_map, "C_stu_race")
    return d.withColumnsRenamed({"D_stu_ell": "C_stu_ell_flag", "D_stu_swd": "C_stu_swd_flag", "D_stu_frl": "C_stu_poverty_flag"})


def clean_transcript(raw: DataFrame, p: TranscriptParams) -> DataFrame:
    """Raw course rows -> term, base id, bounded grades and credits, credit flags, scope."""
    term, source = text.first_pattern(["D_course_id", "D_course_name"], p.term_rules)
    d = raw.withColumns({"C_term": term, "C_term_source": source, "C_course_id_base": text.base_course_id("D_course_id", p.id_strip_suffix),
                         "C_course_name_trimmed": F.trim("D_course_name"), "C_course_name_starred": text.starred("D_course_name"),
                         "D_stu_grade_raw": F.col("D_stu_grade")})
    d = ranges.two_tier(d, "D_stu_grade", *p.grade_bounds, "na", "C_grade_above_100", "C_grade_not_a_grade")
    d = d.withColumn("C_creds_out_of_range", ranges.outside("D_creds_earn", *p.credit_bounds[0]) | ranges.outside("D_creds_possible", *p.credit_bounds[0]))
    d = d.withColumn("C_creds_earn_exceeds_attempted", ranges.earned_exceeds())
    d = ranges.impossible_credits(d, p.impossible_above)
    return scope.apply_scope(d, ["D_course_id"])


# Criteria in funnel order: verdict column, reason when failed.
REASONS = {"C_met_years": "Not enrolled in all required years", "C_met_duration": "Did not meet duration",
           "C_met_progression": "Did not progress on grade", "C_met_school": "Left the in-scope schools"}
FUNNEL = {"enrolled in all years": "C_met_years", "duration": "C_met_duration", "grade progression": "C_met_progression", "home school in scope": "C_met_school"}


def select_cohort(student_year: DataFrame, p: TranscriptParams):
    """(entrants, criteria per entrant, cohort table). ``student_year`` should be a stored table."""
    universe = C.entrants(student_year, p.entry_year, p.entry_grade, p.universe_rule)
    rows = C.with_expected_grade(C.cohort_rows(student_year, universe, p.years), p.progression)
    in_scope = F.col("C_home_school_in_scope")
    school = {"in_scope_all_years": (in_scope, "all_years", p.years), "in_scope_entry_year": (in_scope, "bookends", [p.entry_year]),
              "in_scope_any_year": (in_scope, "any", p.years)}[p.school_rule]
    met = C.verdicts(rows, {
        "C_met_years": (F.lit(True), "all_years", p.years), "C_met_duration": (C.duration_ok("days", p.duration_min_days), p.duration_rule, p.years),
        "C_met_progression": (F.col("on_grade"), p.progression_rule, p.years), "C_met_school": school})
    criteria = C.criteria_table(universe, met, REASONS)
    ids = criteria.filter("C_stu_cohort = 'include'").select(C.ID)
    cohort = C.cohort_table(C.attribute_school(student_year, ids, p.years), universe, p.entry_year)
    return universe, criteria, cohort


def _locations(raw: DataFrame, p: TranscriptParams, log: CheckLog | None) -> DataFrame:
    """The stored table of locations. Listed schools must occur, and no location may miss a year that is not declared away."""
    years = cut_lineage(location_years(raw, p))
    if log is not None:
        log.begin("locations")
        if p.schools:
            log.require(J.unresolved_names(years.select(F.col("C_location_name_merged").alias("location_name")), p.schools))
        gaps = J.year_gaps(years, "C_location_id", "C_location_name_canonical", "D_year", p.expected_years).filter("not declared")
        limit = p.tolerances.get("every location has every year", 0.0)
        if limit < 100:
            log.require(Check("every location has every year", gaps))
        else:
            log.info("location-years missing", gaps.count())
    return years.drop("n", "D_year").distinct()


def _spells(raw: DataFrame, p: TranscriptParams, log: CheckLog | None) -> DataFrame:
    locations = _locations(raw, p, log)
    gates = [*[p.gate(f"dates parse: {c}", F.col(f"H_unreadable_{c}")) for c in DATES],
             p.gate("exit date is not before enter date", F.col("H_days_signed") < 0),
             p.gate("days enrolled are known", F.col("M_days_enrolled").isNull()),
             p.gate("location is known", F.col("C_location_id").isNull(), keys=("D_location_id", "D_location_name")),
             p.gate("value map covers all codes: D_stu_race", F.col("D_stu_race").isNotNull() & not_in("D_stu_race", p.race_map) if p.race_map else F.lit(False), keys=("D_stu_race",))]
    info = {"exit dates missing": F.count_if("C_exit_date_imputed"), "rows at in-scope schools": F.count_if("C_school_in_scope"),
            "spells before the window": F.count_if("C_spell_before_window"), "spells after the window": F.count_if("C_spell_after_window")}
    marks = log is not None
    out, _ = write_gated(clean_spells(raw, p, locations, marks), "enrolment spells", log, gates if marks else (), info, min_rows=1)
    return out.drop(*[f"H_unreadable_{c}" for c in DATES], "H_days_signed")


def _transcript(raw: DataFrame, p: TranscriptParams, log: CheckLog | None) -> tuple[DataFrame, dict]:
    gates = [p.gate("grades beyond the hard bounds within tolerance", F.col("C_grade_not_a_grade"), keys=("D_stu_grade_raw",)),
             p.gate("student and year are known", F.col(C.ID).isNull() | F.col(C.YEAR).isNull()),
             p.gate("course id is known", F.col("D_course_id").isNull())]
    info = {"rows with no term detected": F.count_if(F.col("C_term").isNull()), "grades above 100": F.count_if("C_grade_above_100"),
            "credits out of range": F.count_if("C_creds_out_of_range"), "earned above attempted": F.count_if("C_creds_earn_exceeds_attempted")}
    return write_gated(clean_transcript(raw, p), "transcript", log, gates, info, min_rows=1)


def _student_years(spells: DataFrame, home: DataFrame, p: TranscriptParams, log: CheckLog | None) -> DataFrame:
    gates = [p.gate("home school is known", F.col("C_home_school_id").isNull()), p.gate("grade level is known", F.col("C_stu_grade_level").isNull()),
             p.gate("home days within days enrolled", must(F.col("C_home_school_days") <= F.col("M_days_enrolled_year")))]
    out, _ = write_gated(SY.collapse_years(spells, home), "student-years", log, gates)
    if log is not None:
        log.require(unique(out, SY.ID_YEAR, "one row per student-year"))
    return out


def _reconcile(transcript: DataFrame, spells: DataFrame, p: TranscriptParams, log: CheckLog) -> None:
    """Ids and id-years of the transcript that enrolment knows, and grades on which both agree."""
    t = transcript.select(*SY.ID_YEAR).distinct()
    t = scope.member_flag(scope.member_flag(t, spells, SY.ID_YEAR, "year_found"), spells, C.ID, "id_found")
    first = t.groupBy(C.ID).agg(F.min(C.YEAR).alias("first_year"))
    t = join_same(t, first, C.ID).withColumn("counts_id", F.col(C.YEAR).eqNullSafe(F.col("first_year")))
    write_gated(t, "student-years of the transcript", log, [
        p.gate("transcript students found in enrolment", ~F.col("id_found"), 100 - p.min_student_match_pct, base=F.col("counts_id"), keys=(C.ID,)),
        p.gate("transcript student-years found in enrolment", ~F.col("year_found"), 100 - p.min_student_year_match_pct)])
    write_gated(J.grade_agreement(transcript, spells), "grades compared", log,
                [p.gate("grade levels agree", must(F.col("diff") == 0), 100 - p.min_grade_agreement_pct)], {"grades compared": F.count(F.lit(1))})


def _cohort(sy: DataFrame, spells: DataFrame, p: TranscriptParams, log: CheckLog | None) -> tuple[DataFrame, DataFrame]:
    universe, criteria, cohort = select_cohort(sy, p)
    criteria, _ = write_gated(criteria, "cohort criteria", log, [], {"entrants": F.count(F.lit(1)), "entrants selected": F.count_if(F.col("C_stu_cohort") == "include")})
    if log is None:
        return criteria, cut_lineage(cohort)
    marked = scope.member_flag(cohort, universe, C.ID, "H_entrant")
    inside = spells.filter("C_school_in_scope").select(F.col("C_location_id").alias("C_cohort_school_id")).distinct()
    marked = scope.member_flag(marked, inside, "C_cohort_school_id", "H_in_scope")
    cohort, _ = write_gated(marked, "cohort", log, [
        p.gate("cohort students are entrants", ~F.col("H_entrant")), p.gate("cohort school is known", F.col("C_cohort_school_id").isNull()),
        p.gate("cohort schools are in scope", ~F.col("H_in_scope"), keys=("C_cohort_school_id", "C_cohort_school_name"))], min_rows=1)
    log.require(unique(cohort, [C.ID], "one cohort row per student"))
    return criteria, cohort.drop("H_entrant", "H_in_scope")


def _onto_rows(coded: DataFrame, reported: list, spells: DataFrame, sy: DataFrame, moves: DataFrame, cohort: DataFrame, snap: DataFrame, p: TranscriptParams) -> DataFrame:
    """What is known of a student and a year, put together on the transcript's student-years first, so that the coded rows are joined once."""
    known = scope.member_flag(coded.select(*SY.ID_YEAR).distinct(), spells, SY.ID_YEAR, "C_has_enrolment_record")
    known = join_same(J.join_checked(known, sy, SY.ID_YEAR, "student-year onto transcript"), moves, C.ID)
    known = scope.member_flag(known, cohort, C.ID, "C_cohort_include")
    known = scope.member_flag(known, snap.filter("selected"), C.ID, "C_stu_snapshot_include").withColumn(
        "C_stu_snapshot_include", F.col("C_stu_snapshot_include") & (F.col(C.YEAR) == p.snapshot_year))
    first = ["C_has_enrolment_record", *[c for c in sy.columns if c not in SY.ID_YEAR]]
    last = [c for c in known.columns if c not in first and c not in SY.ID_YEAR]
    return join_same(coded, known, SY.ID_YEAR).select(*reported, *first, *[c for c in coded.columns if c not in reported], *last)


def build(raw_spells: DataFrame, raw_transcript: DataFrame, coding: DataFrame, p: TranscriptParams, log: CheckLog | None = None) -> dict[str, DataFrame]:
    """All tables of the analysis. The tables that many later steps read are stored once.

    With a ``log`` every stage stops on its gates, which are counted while the stage is written; the export is then stored as well. Without one nothing stops.
    """
    spells = _spells(raw_spells, p, log)
    transcript, seen = _transcript(raw_transcript, p, log)
    if log is not None:
        _reconcile(transcript, spells, p, log)
    by_school = SY.spells_by_school(spells)
    home = SY.home_school(by_school)
    sy = _student_years(spells, home, p, log)
    subject = "C_course_subject_area" if "C_course_subject_area" in coding.columns else None
    recovered = C.credit_recovery(transcript)
    coded = J.code_courses(recovered, keyed(coding, ["D_course_id", "D_course_name"], "course coding", log), needs=subject).withColumns({
        "C_course_failed": ranges.course_failed(), "C_grade_pct_rollup": ranges.bucket_down("D_stu_grade", p.grade_buckets),
        "C_course_marked_repeat": F.col("C_course_name_starred")})
    moves = mobility(sy)
    criteria, cohort = _cohort(sy, spells, p, log)
    snap = C.snapshot_table(sy, transcript, p.snapshot_year, p.snapshot_grades, "days", p.snapshot_min_days)
    out = _onto_rows(coded, transcript.columns, spells, sy, moves, cohort, snap, p)
    if log is not None:
        out, wrote = write_gated(out, "transcript export", log, [
            p.gate("course coding match rate", F.col("C_coding_source").isNull(), 100 - p.min_coding_match_pct, keys=("D_course_id", "D_course_name")),
            p.gate("student-year joined wherever enrolment is known", F.col("C_has_enrolment_record") & F.col("C_home_school_id").isNull())],
            {"rows coded by id and name": F.count_if(F.col("C_coding_source") == "id_and_name"), "rows coded by id only": F.count_if(F.col("C_coding_source") == "id_only"),
             "rows with an enrolment record": F.count_if("C_has_enrolment_record"), "credit recovery rows": F.count_if("C_credit_recovery_flag")})
        log.require_equal("joins keep the transcript's row count", seen["rows"], wrote["rows"])
    return {"spells": spells, "transcript": transcript, "by_school": by_school, "home": home, "student_year": sy, "transcript_out": out,
            "criteria": criteria, "cohort": cohort, "mobility": moves, "snapshot": snap,
            "student_year_export": C.student_year_export(sy, criteria, moves, cohort, snap, p.snapshot_year)}


# Columns of the published tables that later analyses rely on.
CONTRACT = {
    "transcript": {"D_stu_id": None, "D_year": None, "D_course_id": "string", "C_term": "string", "C_coding_source": "string", "C_cohort_include": "boolean", "C_stu_snapshot_include": "boolean"},
    "student_year": {"D_stu_id": None, "D_year": None, "M_days_enrolled_year": "bigint", "C_stu_cohort": "string", "C_stu_snapshot": "string"},
}


def publish(built: dict[str, DataFrame], sink: Sink, run: str, district: str, p: TranscriptParams, log: CheckLog) -> dict[str, dict | None]:
    """Output stage: the transcript and the student-years in column order, under their contracts, then the log itself. Repeating a run adds nothing."""
    log.begin("outputs")
    made = {}
    for name, table in (("transcript", built["transcript_out"]), ("student_year", built["student_year_export"])):
        kinds = {f.name: f.dataType.simpleString() for f in table.schema}
        contract = {c: kind or kinds.get(c, "any") for c, kind in CONTRACT[name].items()}
        made[name] = sink.publish(prefix_order(table), name, run, log, contract)
    made["check_log"] = log.write(sink, run, district, asdict(p))
    return made
