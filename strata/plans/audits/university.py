"""Academic checks."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.dates import age_years
from strata.functions.money import ratio, within
from strata.operators.dedupe import duplicate_counts
from strata.operators.intervals import with_previous
from strata.operators.lookup import condense, weighted_if
from strata.operators.quantiles import exact_quantiles
from strata.operators.stats import decile_association, histogram, share_match
from strata.session import stage

Tables = Mapping[str, DataFrame]
MAX_LOAD = 8


def day(as_of: str) -> Column:
    return F.lit(as_of).cast("date")


def semesters(t: Tables, as_of: str) -> DataFrame:
    """Ranges, overlaps of neighbours by start, codes."""
    return with_previous(t["university_semesters"], ["start_date", "semester_id"], "end_date", "previous_end").agg(
        F.count_if(F.col("end_date") < F.col("start_date")).alias("invalid_date_ranges"),
        F.count_if(F.col("start_date") <= F.col("previous_end")).alias("overlapping_pairs"),
        F.count_if(F.col("code") != F.concat_ws("-", "year", "half")).alias("code_mismatches"),
    )


def student_ages(t: Tables, as_of: str) -> DataFrame:
    """Ages are whole days over a fixed year length, so quantiles of days are quantiles of ages."""
    days = F.datediff("enrolled_at", "birth_date")
    age = age_years(F.col("birth_date"), F.col("enrolled_at"), "365.2425")
    year = F.lit(365.2425)
    return t["university_students"].agg(
        F.round(F.min(days) / year, 2).alias("age_min"),
        F.round(F.percentile(days, 0.5) / year, 2).alias("age_median"),
        F.count_if(age < 15).alias("age_below_15"),
        F.count_if(age < 18).alias("age_below_18"),
        F.count_if(days <= 0).alias("birth_on_or_after_registration"),
    )


def course_departments(t: Tables, as_of: str) -> DataFrame:
    courses, professors = t["university_courses"], t["university_professors"]
    theirs = professors.select("professor_id", F.col("department").alias("theirs"))
    pairs = condense(courses, ["professor_id", "department"]).join(theirs, "professor_id")
    expected = share_match(courses, "department", professors, "department")
    return pairs.agg(
        weighted_if(F.col("department") == F.col("theirs")).alias("same_department"),
        weighted_if(F.col("department") != F.col("theirs")).alias("different_department"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_courses"),
    ).select("*", F.round(F.lit(expected.scalar()) * 100, 2).alias("expected_same_pct"))


def mismatched_professors(t: Tables, as_of: str) -> DataFrame:
    theirs = t["university_professors"].select("professor_id", F.col("department").alias("theirs"))
    return t["university_courses"].join(theirs, "professor_id").where("department <> theirs").agg(
        F.count_distinct("professor_id").alias("professors"))


def enrollment_window(t: Tables, as_of: str) -> DataFrame:
    """Where the enrollment date lies against its semester, and active rows in closed semesters."""
    folded = condense(t["university_enrollments"], ["semester_id", "enrolled_at", "status"])
    rows = folded.join(t["university_semesters"].select("semester_id", "start_date", "end_date"), "semester_id")
    at = F.col("enrolled_at")
    return rows.agg(
        weighted_if((at >= F.col("start_date")) & (at <= F.col("end_date"))).alias("inside"),
        weighted_if(at < F.col("start_date")).alias("before"),
        weighted_if(at > F.col("end_date")).alias("after"),
        weighted_if((F.col("status") == "active") & (F.col("end_date") < day(as_of))).alias("active_in_ended_semester"),
    )


def enrollment_chronology(t: Tables, as_of: str) -> DataFrame:
    folded = condense(t["university_enrollments"], ["student_id", "semester_id", "course_id", "enrolled_at"])
    registered = t["university_students"].select("student_id", F.col("enrolled_at").alias("registered_at"))
    ends = t["university_semesters"].select("semester_id", "end_date")
    hired = t["university_courses"].select("course_id", "professor_id").join(
        t["university_professors"].select("professor_id", "hired_at"), "professor_id").select("course_id", "hired_at")
    rows = folded.join(registered, "student_id", "left").join(ends, "semester_id", "left").join(hired, "course_id", "left")
    return rows.agg(
        weighted_if(F.col("enrolled_at") < F.col("registered_at")).alias("before_student_registration"),
        weighted_if(F.col("registered_at") > F.col("end_date")).alias("student_registered_after_semester_end"),
        weighted_if(F.col("enrolled_at") < F.col("hired_at")).alias("before_professor_hire"),
    )


def logical_duplicates(t: Tables, as_of: str) -> DataFrame:
    groups = t["university_enrollments"].groupBy("student_id", "course_id", "semester_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("status").alias("low"), F.max("status").alias("high"))
    many = F.col("n") > 1
    return groups.agg(
        F.count_if(many).alias("duplicate_groups"),
        F.coalesce(F.sum(F.when(many, F.col("n"))), F.lit(0)).alias("rows_in_duplicate_groups"),
        F.count_if(many & (F.col("low") < F.col("high"))).alias("groups_with_conflicting_status"),
    )


def course_load(t: Tables, as_of: str) -> DataFrame:
    return t["university_enrollments"].groupBy("student_id", "semester_id").agg(F.count(F.lit(1)).alias("n")).agg(
        F.max("n").alias("max_courses"), F.count_if(F.col("n") > MAX_LOAD).alias("groups_over_limit"))


def status_distribution(t: Tables, as_of: str) -> DataFrame:
    return t["university_enrollments"].groupBy("status").agg(F.count(F.lit(1)).alias("enrollments"))


def grade_ranges(t: Tables, as_of: str) -> DataFrame:
    s, w = F.col("score"), F.col("weight")
    return t["university_grades"].agg(
        F.count_if((s < 0) | (s > 100)).alias("score_outside"), F.count_if((w < 0) | (w > 1)).alias("weight_outside"),
        F.min(s).alias("score_min"), F.max(s).alias("score_max"),
        ratio(F.sum(s), F.count(s), 4).alias("score_mean"),
        F.min(w).alias("weight_min"), F.max(w).alias("weight_max"),
        ratio(F.sum(w), F.count(w), 4).alias("weight_mean"),
    )


def grade_chronology(t: Tables, as_of: str) -> DataFrame:
    folded = condense(t["university_grades"], ["enrollment_id", "graded_at"])
    enrolled = t["university_enrollments"].select("enrollment_id", "student_id", "semester_id", "enrolled_at")
    semesters_ = t["university_semesters"].select("semester_id", "start_date", "end_date")
    registered = t["university_students"].select("student_id", F.col("enrolled_at").alias("registered_at"))
    rows = folded.join(enrolled, "enrollment_id").join(semesters_, "semester_id").join(registered, "student_id")
    at = F.col("graded_at")
    return rows.agg(
        weighted_if(at < F.col("enrolled_at")).alias("before_enrollment"),
        weighted_if(at < F.col("registered_at")).alias("before_student_registration"),
        weighted_if((at >= F.col("start_date")) & (at <= F.col("end_date"))).alias("inside_semester"),
        weighted_if(at < F.col("start_date")).alias("before_semester"),
        weighted_if(at > F.col("end_date")).alias("after_semester"),
    )


def _coverage(t: Tables) -> DataFrame:
    """Every enrollment with its grade presence; grades are folded per enrollment first."""
    graded = t["university_grades"].groupBy("enrollment_id").agg(
        F.max(F.coalesce(F.col("assessment") == "final", F.lit(False))).alias("has_final"), F.lit(True).alias("has_grades"))
    return t["university_enrollments"].join(graded, "enrollment_id", "left").withColumns({
        "has_grades": F.coalesce("has_grades", F.lit(False)), "has_final": F.coalesce("has_final", F.lit(False))})


def grade_presence(t: Tables, as_of: str) -> DataFrame:
    """Distinct graded enrollments against all enrollments, as counts."""
    graded = t["university_grades"].agg(F.count_distinct("enrollment_id"))
    return t["university_enrollments"].agg(F.count(F.lit(1)).alias("enrollments")).select(
        F.lit(graded.scalar()).alias("enrollments_with_grades"),
        (F.col("enrollments") - F.lit(graded.scalar())).alias("enrollments_without_grades"))


def ungraded_by_status(t: Tables, as_of: str) -> DataFrame:
    graded = t["university_grades"].select("enrollment_id").distinct()
    return t["university_enrollments"].join(graded, "enrollment_id", "left_anti").groupBy("status").agg(
        F.count(F.lit(1)).alias("without_grades"))


def _weight_sums(t: Tables) -> DataFrame:
    return t["university_grades"].groupBy("enrollment_id").agg(F.sum("weight").alias("w"))


def weight_sums(t: Tables, as_of: str) -> DataFrame:
    w = stage(_weight_sums(t))
    spread = exact_quantiles(w, "w", [0.0, 0.5, 1.0], ["weight_min", "weight_median", "weight_max"])
    counts = w.agg(
        F.count_if(F.round(F.col("w") * 100, 0) == 100).alias("exactly_one_at_cent_precision"),
        F.count_if(within(F.col("w"), F.lit(1).cast("decimal(10,3)"))).alias("within_0_01"),
        F.count(F.lit(1)).alias("weight_groups"),
    )
    return counts.select("*", *[F.lit(spread.select(c).scalar()).alias(c) for c in spread.columns])


def weight_histogram(t: Tables, as_of: str) -> DataFrame:
    return histogram(_weight_sums(t), "w", 60)


def duplicate_assessments(t: Tables, as_of: str) -> DataFrame:
    return duplicate_counts(t["university_grades"], ["enrollment_id", "assessment"]).select(
        "duplicate_groups", "rows_in_duplicate_groups")


def coverage_by_status(t: Tables, as_of: str) -> DataFrame:
    return _coverage(t).groupBy("status").agg(
        F.count(F.lit(1)).alias("enrollments"), F.count_if("has_grades").alias("with_grades"),
        F.count_if(~F.col("has_grades")).alias("without_grades"), F.count_if("has_final").alias("with_final"))


def normal_scores(t: Tables) -> DataFrame:
    """Weighted mean score per enrollment, NULL without grades or with weights that sum to zero."""
    points = F.sum(F.col("score") * F.col("weight"))
    per = t["university_grades"].groupBy("enrollment_id").agg(
        ratio(points, F.sum("weight"), 16).cast("double").alias("normal_score"))
    return t["university_enrollments"].join(per, "enrollment_id", "left")


def scores_by_status(t: Tables, as_of: str) -> DataFrame:
    folded = stage(normal_scores(t).where("normal_score is not null").groupBy("status", "normal_score").agg(
        F.count(F.lit(1)).alias("n")))
    base = folded.groupBy("status").agg(
        F.sum("n").alias("scored"), F.round(F.sum(F.col("normal_score") * F.col("n")) / F.sum("n"), 2).alias("score_mean"))
    middle = exact_quantiles(folded, "normal_score", [0.5], ["score_median"], ["status"], digits=2, weight="n")
    return base.join(middle, "status")


def status_score_association(t: Tables, as_of: str) -> DataFrame:
    return decile_association(normal_scores(t), "status", "normal_score", "cramers_v")


AUDITS: dict[str, Callable[[Tables, str], DataFrame]] = {
    "uni_semesters": semesters,
    "uni_student_ages": student_ages,
    "uni_course_departments": course_departments,
    "uni_mismatched_professors": mismatched_professors,
    "uni_enrollment_window": enrollment_window,
    "uni_enrollment_chronology": enrollment_chronology,
    "uni_logical_duplicates": logical_duplicates,
    "uni_course_load": course_load,
    "uni_status_distribution": status_distribution,
    "uni_grade_ranges": grade_ranges,
    "uni_grade_chronology": grade_chronology,
    "uni_grade_presence": grade_presence,
    "uni_ungraded_by_status": ungraded_by_status,
    "uni_weight_sums": weight_sums,
    "uni_weight_histogram": weight_histogram,
    "uni_duplicate_assessments": duplicate_assessments,
    "uni_coverage_by_status": coverage_by_status,
    "uni_scores_by_status": scores_by_status,
    "uni_status_score_association": status_score_association,
}
