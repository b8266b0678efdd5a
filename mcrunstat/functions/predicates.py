"""Row-level labels and cohort predicates as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Pod and measure labels.
POD_DAYCASE = "ip_elective_daycase"
POD_REGULAR_DAY = "ip_regular_day_attender"
POD_REGULAR_NIGHT = "ip_regular_night_attender"
POD_OP_PROCEDURE = "op_procedure"
POD_OP_FIRST = "op_first"
POD_OP_FOLLOWUP = "op_follow-up"
POD_SDEC = "aae_type-05"
MEASURE_AMBULANCE = "ambulance"
MEASURE_WALKIN = "walk-in"
GROUPED = "grouped"
UNKNOWN = "unknown"


def ip_pod(pod: str = "pod", classpat: str = "classpat") -> Column:
    """patient class '2' is a day case whatever the admission pod was."""
    return F.when(F.col(classpat) == "2", F.lit(POD_DAYCASE)).otherwise(F.col(pod))


def ip_pod_from_class(classpat: str = "classpat", group: str = "grp") -> Column:
    """pod from patient class, else from the admission group."""
    c = F.col(classpat)
    return (F.when(c == "2", F.lit(POD_DAYCASE))
            .when(c == "3", F.lit(POD_REGULAR_DAY))
            .when(c == "4", F.lit(POD_REGULAR_NIGHT))
            .otherwise(F.concat(F.lit("ip_"), F.col(group), F.lit("_admission"))))


def op_pod(is_first: str = "is_first", has_procedures: str = "has_procedures") -> Column:
    """procedure beats first/follow-up; a non-first attendance is a follow-up."""
    return (F.when(F.col(has_procedures), F.lit(POD_OP_PROCEDURE))
            .when(F.col(is_first), F.lit(POD_OP_FIRST))
            .otherwise(F.lit(POD_OP_FOLLOWUP)))


def aae_measure(is_ambulance: str = "is_ambulance") -> Column:
    """F8: arrival mode label."""
    return F.when(F.col(is_ambulance), F.lit(MEASURE_AMBULANCE)).otherwise(F.lit(MEASURE_WALKIN))


def is_op_procedure(pod: str = "pod") -> Column:
    """Null-safe pod test (a null pod is not an outpatient procedure)."""
    return F.col(pod).eqNullSafe(POD_OP_PROCEDURE)


# outpatient and A&E cohorts.
def op_consultant_referral() -> Column:
    return F.col("is_cons_cons_ref")


def op_followup() -> Column:
    return ~F.col("is_first") & ~F.col("has_procedures")


def op_gp_referred_first() -> Column:
    return F.col("is_gp_ref") & F.col("is_first")


def op_tele_convertible() -> Column:
    return ~F.col("has_procedures")


# The flag columns.
AAE_FLAGS = (
    "is_discharged_no_treatment",
    "is_frequent_attender",
    "is_left_before_treatment",
    "is_low_cost_referred_or_discharged",
)
