"""Learning: one row per enrolment with four definitions of completion, and the bridge between them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from tallywork.functions import at_least, classify, cond_count, is_missing, is_present, n_distinct, pct, row_count, truthy
from tallywork.operators import (
    accepted, best_outcome, define_flags, expression, fan_in, fill, flag_primary_completion, generic_warn, lookup,
    not_null, summarize, unique,
)

Tables = Mapping[str, DataFrame]

CATEGORIES = ["passed_exam", "sat_failed_exam", "finished_lessons_no_exam", "incomplete", "other"]
COMPLETION_FLAGS = [
    "is_complete_platform", "is_complete_all_lessons", "is_complete_80pct_lessons", "is_complete_assessment",
]
# Fixed value: share of lessons that counts as finished under the lenient definition.
LENIENT_PCT = 80


# ---- staging ------------------------------------------------------------------------

def stg_students(raw: Tables) -> DataFrame:
    return raw["raw_students"]


def stg_courses(raw: Tables) -> DataFrame:
    return raw["raw_courses"]


def _lesson_time() -> Column:
    return F.coalesce("completed_at", "started_at")


def stg_lessons(raw: Tables, partition_by_status: bool = False) -> DataFrame:
    flagged = flag_primary_completion(
        raw["raw_lessons"], ["enrollment_id", "lesson_number"], [_lesson_time(), "lesson_event_id"],
        partition_by_status=partition_by_status,
    )
    missing = is_missing(F.col("completed_at")) & (F.col("lesson_status") == "completed")
    return flagged.withColumn("missing_completed_at", truthy(missing))


def stg_assessments(raw: Tables) -> DataFrame:
    return raw["raw_assessments"].withColumn("is_ungraded", truthy(F.col("attempt_status") == "submitted"))


# ---- children at enrolment grain ----------------------------------------------------

def lesson_rollup(raw: Tables, partition_by_status: bool = False) -> DataFrame:
    """Distinct completed lessons per enrolment, without ranking or flagging single events.

    A lesson counts when the first of its events is a completion (any event, with
    ``partition_by_status``), so one row per lesson carries all that is needed.
    """
    completed = F.col("lesson_status") == "completed"
    stamp = _lesson_time()
    first = F.min(F.struct(stamp.isNull(), stamp, "lesson_event_id", completed.alias("completed")))
    counts = F.bool_or(completed) if partition_by_status else first["completed"]
    lessons = raw["raw_lessons"].groupBy("enrollment_id", "lesson_number").agg(
        counts.alias("counts"), F.max(stamp).alias("last_at")
    )
    return lessons.groupBy("enrollment_id").agg(
        cond_count(F.col("counts") & F.col("lesson_number").isNotNull()).alias("lessons_completed"),
        F.max("last_at").alias("last_lesson_at"),
    )


def assessment_rollup(raw: Tables) -> DataFrame:
    return best_outcome(
        raw["raw_assessments"], "enrollment_id", passed="is_passed", score="score",
        ungraded=F.col("attempt_status") == "submitted", first_ts="submitted_at", last_ts="graded_at",
    )


# ---- intermediate -------------------------------------------------------------------

def int_enrollment_progress(raw: Tables, partition_by_status: bool = False) -> DataFrame:
    courses = stg_courses(raw).select("course_id", "course_title", "category", "lesson_count", "pass_threshold")
    enrolled = lookup(stg_students(raw), courses, "course_id")
    outcomes = assessment_rollup(raw).drop("first_attempt_at").withColumnsRenamed({
        "total_attempts": "assessment_attempts", "ever_passed": "passed_assessment",
    })
    joined = fan_in(enrolled, "enrollment_id", [lesson_rollup(raw, partition_by_status), outcomes])
    # Every assessed enrolment has a count of attempts, so its presence means the exam was sat.
    sat = joined.withColumn("sat_assessment", is_present(F.col("assessment_attempts")))
    filled = fill(sat, zeros=["lessons_completed", "assessment_attempts", "ungraded_attempts"], falses=["passed_assessment"])
    return filled.withColumn("pct_lessons_completed", pct(F.col("lessons_completed"), F.col("lesson_count"), 1))


# ---- marts --------------------------------------------------------------------------

def completion_category() -> Column:
    """Exactly one class per enrolment; ``other`` is left for unknown course length."""
    passed, sat, share = F.col("passed_assessment"), F.col("sat_assessment"), F.col("pct_lessons_completed")
    return classify([
        (passed, "passed_exam"),
        (sat, "sat_failed_exam"),
        (share >= LENIENT_PCT, "finished_lessons_no_exam"),
        (share < LENIENT_PCT, "incomplete"),
    ], default="other")


def mart_enrollment_completion(progress: DataFrame) -> DataFrame:
    done, length = F.col("lessons_completed"), F.col("lesson_count")
    flagged = define_flags(progress, {
        "is_complete_platform": F.col("enrollment_status") == "completed",
        "is_complete_all_lessons": done >= length,
        "is_complete_80pct_lessons": at_least(F.col("pct_lessons_completed"), LENIENT_PCT),
        "is_complete_assessment": F.col("passed_assessment"),
    })
    described = flagged.withColumns({
        "completion_category": completion_category(),
        "is_tested_out": truthy(F.col("passed_assessment") & (done < length)),
    })
    return described.drop("pass_threshold", "ungraded_attempts", "last_graded_at")


def mart_completion_summary(completion: DataFrame) -> DataFrame:
    category = F.col("completion_category")
    counted = summarize(completion, {
        "total_enrollments": row_count(),
        "total_people": n_distinct(F.col("student_id")),
        **{flag.removeprefix("is_"): cond_count(F.col(flag)) for flag in COMPLETION_FLAGS},
        "bridge_passed_exam": cond_count(category == "passed_exam"),
        "bridge_lessons_no_exam": cond_count(category == "finished_lessons_no_exam"),
        "bridge_sat_failed": cond_count(category == "sat_failed_exam"),
        "bridge_incomplete": cond_count(category == "incomplete"),
        "tested_out": cond_count(F.col("is_tested_out")),
    })
    total = F.col("total_enrollments")
    return counted.withColumns({
        "platform_rate_pct": pct(F.col("complete_platform"), total, 1),
        "all_lessons_rate_pct": pct(F.col("complete_all_lessons"), total, 1),
        "pct80_rate_pct": pct(F.col("complete_80pct_lessons"), total, 1),
        "assessment_rate_pct": pct(F.col("complete_assessment"), total, 1),
    })


# ---- declaration for the run --------------------------------------------------------

STAGING = {
    "stg_students": stg_students, "stg_courses": stg_courses, "stg_lessons": stg_lessons,
    "stg_assessments": stg_assessments,
}
# Staging that only adds flags to its feed: same rows, same keys.
FLAGS_ONLY = {"stg_students": "raw_students", "stg_courses": "raw_courses", "stg_lessons": "raw_lessons", "stg_assessments": "raw_assessments"}
INTERMEDIATE = "int_enrollment_progress"


def intermediate(raw: Tables, **_) -> DataFrame:
    return int_enrollment_progress(raw)


def marts(inter: DataFrame, raw: Tables) -> dict[str, DataFrame]:
    completion = mart_enrollment_completion(inter)
    return {"mart_enrollment_completion": completion, "mart_completion_summary": mart_completion_summary(completion)}


CHECKS = generic_warn([
    *[check(table, key) for table, key in [
        ("stg_courses", "course_id"), ("stg_students", "enrollment_id"), ("stg_lessons", "lesson_event_id"),
        ("stg_assessments", "assessment_attempt_id"), ("int_enrollment_progress", "enrollment_id"),
        ("mart_enrollment_completion", "enrollment_id"),
    ] for check in (unique, not_null)],
    accepted("mart_enrollment_completion", "completion_category", CATEGORIES),
    # A course can be cut after its lessons were taken; that is to be seen, not to stop a run.
    expression("mart_enrollment_completion", "lessons_completed <= lesson_count", severity="warn"),
    expression("mart_enrollment_completion", "pct_lessons_completed >= 0"),
    expression("mart_completion_summary", "complete_all_lessons <= complete_80pct_lessons"),
    expression("mart_completion_summary", "total_people <= total_enrollments"),
])

# Loaded-at column, warn and error age in hours, and whether an error blocks.
FRESHNESS = {
    "raw_lessons": ("started_at", 30, 48, True),
    "raw_assessments": ("submitted_at", 30, 48, True),
    "raw_students": ("last_active_at", 48, 72, False),
}
