"""Data-quality checks over cleaned and scored tables.

Every check is a distributed aggregate returning a small table of counts or
values; nothing is collected to the driver. Several checks that read the
same table share one pass (conditional aggregation) instead of one job per
case.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanscore.functions.casts import to_int_trunc
from loanscore.functions.keys import empty_profile_key
from loanscore.functions.ladders import GRADE_LETTERS, SUB_GRADE_DIGITS

# --------------------------------------------------------------- domains

# The expected value sets of the cleaned categorical columns.
GOLDEN: dict[str, tuple[str, ...]] = {
    "home_ownership": ("MORTGAGE", "OWN", "RENT"),
    "loan_status": ("Charged Off", "Current", "Default", "Full Paid", "In Grace Period", "Late"),
    "purpose": (
        "car",
        "credit_card",
        "debt_consolidation",
        "educational",
        "home_improvement",
        "house",
        "major_purchase",
        "medical",
        "moving",
        "other",
        "renewable_energy",
        "small_business",
        "vacation",
        "wedding",
    ),
    "grade": tuple(GRADE_LETTERS),
    "sub_grade": tuple(g + d for g in GRADE_LETTERS for d in SUB_GRADE_DIGITS),
    "pymnt_plan": ("n", "y"),
}

# Domains whose nulls are dropped before comparing.
NON_NULL_DOMAINS = ("loan_status", "pymnt_plan")


def _pairs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(domain, value) for each listed column of each row, via one ``stack``."""
    args = ", ".join(f"'{c}', CAST(`{c}` AS STRING)" for c in columns)
    return df.select(F.expr(f"stack({len(columns)}, {args}) AS (domain, value)"))


def domain_values(personal_clean: DataFrame, payment_clean: DataFrame, loan_clean: DataFrame) -> DataFrame:
    """(domain, value): distinct values of each checked column.

    Each table is read once and emits all of its checked columns as pairs;
    one distinct over the union dedups them (one shuffle, combined map-side,
    so frequent values never pile up on a reducer).
    """
    pairs = (
        _pairs(personal_clean, ["home_ownership", "grade", "sub_grade"])
        .unionByName(_pairs(loan_clean, ["loan_status", "purpose"]))
        .unionByName(_pairs(payment_clean, ["pymnt_plan"]))
    )
    keep = ~F.col("domain").isin(*NON_NULL_DOMAINS) | F.col("value").isNotNull()
    return pairs.where(keep).distinct()


def golden_frame(spark: SparkSession) -> DataFrame:
    """The expected sets as a tiny literal table (size fixed by the code)."""
    rows = [(d, v) for d, vals in GOLDEN.items() for v in vals]
    return spark.createDataFrame(rows, "domain string, value string")


def golden_differences(spark: SparkSession, domains: DataFrame) -> DataFrame:
    """(domain, value, status): values missing from the data or not expected, from one aggregate of both."""
    flagged = domains.withColumn("found", F.lit(True)).unionByName(golden_frame(spark).withColumn("found", F.lit(False)))
    sides = flagged.groupBy("domain", "value").agg(F.bool_or("found").alias("found"), F.bool_or(~F.col("found")).alias("expected"))
    one_sided = sides.where("found <> expected")
    return one_sided.select("domain", "value", F.when(F.col("found"), "unexpected").otherwise("missing").alias("status"))


# ---------------------------------------------------------------- maxima

MAXIMA = (
    ("annual_inc", "max_annual_inc"),
    ("chargeoff_within_12_mths", "max_chargeoff_within_12_mths"),
    ("inq_last_12m", "max_inq_last_12m"),
    ("inq_fi", "max_inq_fi"),
    ("mort_acc", "max_mort_acc"),
    ("pub_rec_bankruptcies", "max_pub_rec_bankruptcies"),
    ("delinq_2yrs", "max_delinq_2yrs"),
    ("acc_now_delinq", "max_acc_now_delinq"),
)


def maxima(member_profile: DataFrame) -> DataFrame:
    """Column maxima of the cleaned member tables, one global aggregate."""
    return member_profile.agg(*[F.max(c).alias(a) for c, a in MAXIMA])


def bad_states(personal_clean: DataFrame) -> DataFrame:
    bad = F.col("addr_state").isNotNull() & (F.length("addr_state") != 2)
    return personal_clean.agg(F.count_if(bad).alias("bad_state_rows"))


def duplicate_ids(loan_clean: DataFrame) -> DataFrame:
    """How many loan ids occur more than once, and in how many rows (the two MDM forms differ on them)."""
    per_id = loan_clean.where("id IS NOT NULL").groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return per_id.agg(F.count(F.lit(1)).alias("ids"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows"))


def funnel(keyed: DataFrame, bits: int) -> DataFrame:
    """Raw rows, rows with a profile, and distinct members, in one aggregate."""
    kept = F.col("member_id") != empty_profile_key(bits)
    return keyed.agg(
        F.count(F.lit(1)).alias("raw_rows"),
        F.count_if(kept).alias("kept_rows"),
        F.count_distinct(F.when(kept, F.col("member_id"))).alias("members"),
    )


# ----------------------------------------------------- ladder violations


@dataclass(frozen=True)
class Case:
    ladder: str
    inputs: tuple[str, ...]
    values: tuple
    expected: float


def _cases(ladder: str, inputs: Sequence[str], table: Sequence[tuple]) -> list[Case]:
    out = []
    for row in table:
        *vals, pts = row
        out.append(Case(ladder, tuple(inputs), tuple(vals), float(pts)))
    return out


# The point checks of the rule tests, (input..., expected points).
PERSONAL_CASES = (
    _cases("grade_points", ["sub_grade"], [("A1", 200.0), ("A3", 175.0), ("B2", 155.0), ("D4", 95.0),
                                            ("E1", 85.0), ("F5", 40.0), ("G3", 25.0)])
    + _cases("home_points", ["home_ownership"], [("OWN", 350.0), ("RENT", 250.0), ("MORTAGE", 100.0)])
    + _cases("exp_points", ["emp_length"], [(0, -500.0), (1, 0.0), (3, 100.0), (5, 250.0), (7, 350.0),
                                             (9, 500.0)])
    + _cases("verification_points", ["verification_status"], [(True, 350.0), (False, 100.0)])
)
PAYMENT_CASES = _cases(
    "late_fees_points",
    ["total_rec_late_fee"],
    [(50000, -500.0), (30000, 0.0), (5000, 250.0), (10000, 100.0), (1000, 350.0), (500, 500.0)],
)
DEFAULTS_CASES = (
    _cases("mort_points", ["mort_acc"], [(0, 500.0), (1, 250.0), (2, 100.0), (5, -500.0), (3, -500.0)])
    + _cases("deliq_points", ["delinq_2yrs", "acc_now_delinq"],
             [(0, 0, 500.0), (0, 1, 350.0), (1, 0, 350.0), (1, 1, 250.0), (2, 1, 100.0)])
    + _cases("public_rec_points", ["pub_rec_bankruptcies"], [(0, 500.0), (1, 250.0), (3, -500.0), (5, -500.0)])
)
INQUIRIES_CASES = (
    _cases("inq_12m_points", ["inq_last_12m"], [(0, 500.0), (1, 350.0), (2, 250.0), (3, 100.0), (4, 0.0),
                                                 (7, 0.0)])
    + _cases("inq_points", ["inq_fi"], [(0, 500.0), (1, 350.0), (2, 250.0), (3, 100.0), (4, 0.0), (7, 0.0)])
    + _cases("mnth_inq_points", ["mnths_since_inq"], [(0, 500.0), (1, 350.0), (3, 250.0), (4, 100.0), (7, 0.0)])
    + _cases("charge_off_points", ["chargeoff_within_12_mths"], [(0, 500.0), (1, -500.0), (3, -500.0),
                                                                  (4, -500.0), (7, -500.0)])
)
LOAN_CASES = (
    _cases("loan_status_points", ["loan_status"], [("Fully Paid", 500.0), ("Current", 350.0), ("Late", 250.0),
                                                    ("Charged Off", -500.0), ("In Grace Period", 100.0),
                                                    ("Default", 0.0)])
    + _cases("purpose_points", ["purpose"], [("debt_consolidation", -500.0), ("credit_card", -500.0),
                                              ("home_improvement", 250.0), ("major_purchase", 250.0),
                                              ("small_business", 250.0), ("education", 500.0), ("house", 500.0)])
)


def case_label(case: Case) -> str:
    return ",".join(str(v).lower() if isinstance(v, bool) else str(v) for v in case.values)


def _input_column(name: str) -> Column:
    # emp_length leaves cleaning as digit text and is compared as a number.
    return to_int_trunc(F.col("emp_length")) if name == "emp_length" else F.col(name)


def _selects(case: Case) -> Column:
    cond: Column | None = None
    for name, v in zip(case.inputs, case.values):
        term = _input_column(name) == F.lit(v)
        cond = term if cond is None else cond & term
    assert cond is not None
    return cond


def ladder_violations(points: DataFrame, cases: Sequence[Case]) -> DataFrame:
    """(ladder, input, expected, matched, violations) per case, one pass over ``points``.

    ``matched`` counts rows with the case's input, so a check that selects
    nothing is visible instead of passing silently.
    """
    aggs = []
    for i, case in enumerate(cases):
        sel = _selects(case)
        aggs.append(F.count_if(sel).alias(f"m{i}"))
        aggs.append(F.count_if(sel & (F.col(case.ladder) != F.lit(case.expected))).alias(f"v{i}"))
    wide = points.agg(*aggs)
    entries = [
        F.struct(
            F.lit(case.ladder).alias("ladder"),
            F.lit(case_label(case)).alias("input"),
            F.lit(case.expected).alias("expected"),
            F.col(f"m{i}").alias("matched"),
            F.col(f"v{i}").alias("violations"),
        )
        for i, case in enumerate(cases)
    ]
    return wide.select(F.explode(F.array(*entries)).alias("c")).select("c.*")


# ------------------------------------------------------------------ totals


# Each total and the sum it must equal; the totals that are rounded are rounded to 2 places.
TOTALS = (
    ("personal", "total_personal_points", "round(home_points + exp_points + verification_points + grade_points, 2)"),
    ("payment", "total_payments_points", "late_fees_points + installment_points"),
    ("defaults", "total_defaults_points", "mort_points + deliq_points + public_rec_points"),
    ("inquiries", "total_inquires_points", "inq_12m_points + inq_points + mnth_inq_points + charge_off_points"),
    ("loan", "total_loan_points", "loan_status_points + purpose_points"),
    (
        "final",
        "total_points",
        "round(total_loan_points * 0.15D + total_personal_points * 0.15D + total_defaults_points * 0.25D"
        " + total_inquires_points * 0.25D + total_payments_points * 0.2D, 2)",
    ),
)


def totals(points: DataFrame) -> DataFrame:
    """(subject, rows, mismatches): rows whose total differs from its parts (null-safe), in one pass.

    ``points`` is a stored points table: computed in the same plan, total and
    parts would be one expression and the optimizer would fold the comparison.
    """
    counts = [F.count_if(~F.col(total).eqNullSafe(F.expr(parts))).alias(subject) for subject, total, parts in TOTALS]
    wide = points.agg(F.count(F.lit(1)).alias("rows"), *counts)
    entries = [F.struct(F.lit(s).alias("subject"), F.col("rows"), F.col(s).alias("mismatches")) for s, _, _ in TOTALS]
    return wide.select(F.explode(F.array(*entries)).alias("e")).select("e.*")
