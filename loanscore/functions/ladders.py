"""Scoring ladders as data, compiled to one ``CASE WHEN`` column each.

A ladder is an ordered list of arms ``(condition, level)``: the first arm
whose condition is true gives the points, a null condition falls through,
and a ladder without ``otherwise`` yields null when no arm matches (which
then makes the subject total null). Levels are names of ``Levels`` fields
or plain numbers. Everything compiles to built-in expressions, so a whole
subject's ladders run inside one whole-stage-codegen projection.

The arms reproduce the observed rules, including arms that can never fire
and gaps (for example ``MORTAGE``, ``Fully Paid`` and the second arm of the
income and credit-line ladders).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from loanscore.levels import DEFAULT_LEVELS, Levels

Level = str | float


def _points_sql(level: Level, levels: Levels) -> str:
    v = levels.value(level) if isinstance(level, str) else float(level)
    # exact: the shortest round-trip text of the double, parsed back as a double
    return f"CAST('{v!r}' AS DOUBLE)"


@dataclass(frozen=True)
class Ladder:
    """Ordered arms of (SQL condition, level) plus an optional else level.

    Compiles to one SQL ``CASE`` expression, i.e. a single call into the JVM
    per ladder when the plan is built, and one codegen'd expression at run
    time.
    """

    name: str
    arms: Sequence[tuple[str, Level]]
    otherwise: Level | None = None

    def sql(self, levels: Levels = DEFAULT_LEVELS) -> str:
        arms = " ".join(f"WHEN ({cond}) THEN {_points_sql(lv, levels)}" for cond, lv in self.arms)
        other = _points_sql(self.otherwise, levels) if self.otherwise is not None else "CAST(NULL AS DOUBLE)"
        return f"CASE {arms} ELSE {other} END"

    def expr(self, levels: Levels = DEFAULT_LEVELS) -> Column:
        return F.expr(self.sql(levels))

    def column(self, levels: Levels = DEFAULT_LEVELS) -> Column:
        return self.expr(levels).alias(self.name)


# ---------------------------------------------------------------- personal

# The arms' bounds and levels.
VERIFICATION = Ladder("verification_points", [("verification_status", "good")], otherwise="bad")

# Grade letters and the sub-grade digits they combine with.
GRADE_LETTERS = "ABCDEFG"
SUB_GRADE_DIGITS = "12345"
GRADE_BASE_POINTS = 200.0


# Share of the base points for each sub-grade, A1 to G5.
GRADE_FACTORS = {
    "A1": 1.0, "A2": 0.9, "A3": 0.875, "A4": 0.85, "A5": 0.825,
    "B1": 0.8, "B2": 0.775, "B3": 0.75, "B4": 0.725, "B5": 0.7,
    "C1": 0.675, "C2": 0.65, "C3": 0.625, "C4": 0.6, "C5": 0.575,
    "D1": 0.55, "D2": 0.525, "D3": 0.5, "D4": 0.475, "D5": 0.45,
    "E1": 0.425, "E2": 0.4, "E3": 0.375, "E4": 0.35, "E5": 0.325,
    "F1": 0.3, "F2": 0.275, "F3": 0.25, "F4": 0.225, "F5": 0.2,
    "G1": 0.175, "G2": 0.15, "G3": 0.125, "G4": 0.1, "G5": 0.05,
}


def sub_grade_points() -> list[tuple[str, str, float]]:
    """(grade, sub_grade, points) for all 35 sub-grades, best first."""
    return [(sub_grade[0], sub_grade, GRADE_BASE_POINTS * factor) for sub_grade, factor in GRADE_FACTORS.items()]


@dataclass(frozen=True)
class LookupLadder:
    """A ladder whose arms are ``key = k AND guard`` for many distinct keys.

    Compiles to one map lookup instead of one branch per key, which keeps the
    generated code small (35 sub-grades would otherwise be 70 comparisons).
    The result equals the chained form because the keys are distinct.
    """

    name: str
    key: str
    guard: str
    table: Sequence[tuple[str, float]]
    otherwise: Level

    def sql(self, levels: Levels = DEFAULT_LEVELS) -> str:
        pairs = ", ".join(f"'{k}', {_points_sql(float(p), levels)}" for k, p in self.table)
        found = f"try_element_at(map({pairs}), {self.key})"
        return f"coalesce(CASE WHEN ({self.guard}) THEN {found} END, {_points_sql(self.otherwise, levels)})"

    def expr(self, levels: Levels = DEFAULT_LEVELS) -> Column:
        return F.expr(self.sql(levels))

    def column(self, levels: Levels = DEFAULT_LEVELS) -> Column:
        return self.expr(levels).alias(self.name)


# A sub-grade scores only together with its own letter grade.
GRADE = LookupLadder(
    "grade_points",
    key="sub_grade",
    guard="grade = substring(sub_grade, 1, 1)",
    table=[(sg, pts) for _, sg, pts in sub_grade_points()],
    otherwise="no_points",
)

# emp_length leaves cleaning as the digits of an int (no sign, no leading
# zeros), so comparing the text with canonical digits equals comparing
# numbers, without parsing on every row.
EXPERIENCE = Ladder(
    "exp_points",
    [
        ("emp_length = '0'", "unacceptable"),
        ("emp_length IN ('1', '2')", "very_bad"),
        ("emp_length IN ('3', '4')", "bad"),
        ("emp_length IN ('5', '6')", "ok"),
        ("emp_length IN ('7', '8')", "good"),
        ("emp_length IN ('9', '10')", "very_good"),
    ],
)

# Home ownership spellings as the rule tests them ('MORTAGE' sic).
HOME = Ladder(
    "home_points",
    [
        ("home_ownership = 'OWN'", "good"),
        ("home_ownership = 'RENT'", "ok"),
        ("home_ownership = 'MORTAGE'", "bad"),
    ],
    otherwise="no_points",
)

PERSONAL_LADDERS = (VERIFICATION, GRADE, EXPERIENCE, HOME)

# ----------------------------------------------------------------- payment

# The arms' bounds and levels.
LATE_FEES = Ladder(
    "late_fees_points",
    [
        ("total_rec_late_fee >= 40000", "unacceptable"),
        ("total_rec_late_fee >= 25000 AND total_rec_late_fee < 40000", "very_bad"),
        ("total_rec_late_fee >= 10000 AND total_rec_late_fee < 25000", "bad"),
        ("total_rec_late_fee >= 5000 AND total_rec_late_fee < 10000", "ok"),
        ("total_rec_late_fee >= 1000 AND total_rec_late_fee < 5000", "good"),
        ("total_rec_late_fee < 1000", "very_good"),
    ],
    otherwise="no_points",
)

# The arms' bounds and levels.
INSTALLMENT = Ladder(
    "installment_points",
    [
        ("installment * 2 > annual_inc / 12", "very_bad"),
        ("installment > annual_inc / 12", "bad"),
        ("installment = annual_inc / 12", "ok"),
        ("installment < annual_inc / 12", "good"),
        ("installment * 2 < annual_inc / 12", "very_good"),
    ],
    otherwise="no_points",
)

PAYMENT_LADDERS = (LATE_FEES, INSTALLMENT)

# ---------------------------------------------------------------- defaults

# The arms' bounds and levels.
DELINQUENCY = Ladder(
    "deliq_points",
    [
        ("delinq_2yrs = 0 AND acc_now_delinq = 0", "very_good"),
        ("delinq_2yrs = 1 AND acc_now_delinq = 0", "good"),
        ("delinq_2yrs = 0 AND acc_now_delinq = 1", "good"),
        ("delinq_2yrs = 1 AND acc_now_delinq = 1", "ok"),
        ("delinq_2yrs = 2 AND acc_now_delinq >= 1", "bad"),
        ("delinq_2yrs = 3 AND acc_now_delinq >= 1", "very_bad"),
    ],
    otherwise="no_points",
)

# The arms' bounds and levels.
PUBLIC_RECORDS = Ladder(
    "public_rec_points",
    [
        ("pub_rec_bankruptcies = 0", "very_good"),
        ("pub_rec_bankruptcies = 1", "ok"),
        ("pub_rec_bankruptcies > 1", "unacceptable"),
    ],
)

# The arms' bounds and levels.
MORTGAGES = Ladder(
    "mort_points",
    [
        ("mort_acc = 0", "very_good"),
        ("mort_acc = 1", "ok"),
        ("mort_acc = 2", "bad"),
        ("mort_acc > 2", "unacceptable"),
    ],
)

DEFAULTS_LADDERS = (DELINQUENCY, PUBLIC_RECORDS, MORTGAGES)

# --------------------------------------------------------------- inquiries

# The arms' bounds and levels.
MONTHS_SINCE_INQUIRY = Ladder(
    "mnth_inq_points",
    [
        ("mnths_since_inq = 0", "very_good"),
        ("mnths_since_inq > 0 AND mnths_since_inq <= 2", "good"),
        ("mnths_since_inq >= 3 AND mnths_since_inq < 4", "ok"),
        ("mnths_since_inq >= 4 AND mnths_since_inq < 6", "bad"),
        ("mnths_since_inq >= 6 AND mnths_since_inq < 9", "very_bad"),
    ],
    otherwise="no_points",
)

# The arms' bounds and levels.
CHARGE_OFFS = Ladder(
    "charge_off_points",
    [("chargeoff_within_12_mths = 0", "very_good")],
    otherwise="unacceptable",
)


# The arms' bounds and levels.
def _count_ladder(name: str, column: str) -> Ladder:
    return Ladder(
        name,
        [
            (f"{column} = 0", "very_good"),
            (f"{column} = 1", "good"),
            (f"{column} = 2", "ok"),
            (f"{column} = 3", "bad"),
            (f"{column} = 4", "very_bad"),
            (f"{column} > 4", "no_points"),
        ],
    )


FINANCE_INQUIRIES = _count_ladder("inq_points", "inq_fi")
YEAR_INQUIRIES = _count_ladder("inq_12m_points", "inq_last_12m")

INQUIRIES_LADDERS = (MONTHS_SINCE_INQUIRY, CHARGE_OFFS, FINANCE_INQUIRIES, YEAR_INQUIRIES)

# -------------------------------------------------------------------- loan

# Loan status spellings as the rule tests them ('Fully Paid'
# although cleaning writes 'Full Paid').
LOAN_STATUS = Ladder(
    "loan_status_points",
    [
        ("loan_status = 'Fully Paid'", "very_good"),
        ("loan_status = 'Current'", "good"),
        ("loan_status = 'Late'", "ok"),
        ("loan_status = 'Charged Off'", "unacceptable"),
        ("loan_status = 'In Grace Period'", "bad"),
        ("loan_status = 'Default'", "very_bad"),
    ],
    otherwise="no_points",
)

# The arms' bounds and levels.
PURPOSE = Ladder(
    "purpose_points",
    [
        ("purpose IN ('debt_consolidation', 'credit_card')", "unacceptable"),
        ("purpose IN ('educational', 'house')", "very_good"),
    ],
    otherwise="ok",
)

# The arms' bounds and levels.
INCOME = Ladder(
    "income_points",
    [
        ("annual_inc < loan_amnt * 0.5D", "unacceptable"),
        ("annual_inc <= loan_amnt AND annual_inc < loan_amnt * 0.5D", "very_bad"),
        ("annual_inc > loan_amnt AND annual_inc < loan_amnt * 1.5D", "bad"),
        ("annual_inc > loan_amnt * 1.5D AND annual_inc < loan_amnt * 2.0D", "ok"),
        ("annual_inc > loan_amnt AND annual_inc < loan_amnt * 2.5D", "good"),
        ("annual_inc > loan_amnt * 2.5D", "very_good"),
    ],
    otherwise="no_points",
)

# The arms' bounds and levels.
CREDIT_LINE = Ladder(
    "credi_line_points",
    [
        ("loan_amnt >= tot_hi_cred_lim * 2", "unacceptable"),
        ("loan_amnt >= tot_hi_cred_lim * 2", "very_bad"),
        ("loan_amnt >= tot_hi_cred_lim * 1.5D", "bad"),
        ("loan_amnt >= tot_hi_cred_lim", "ok"),
        ("loan_amnt * 1.5D >= tot_hi_cred_lim", "good"),
        ("loan_amnt * 2 >= tot_hi_cred_lim", "very_good"),
    ],
    otherwise="no_points",
)

LOAN_LADDERS = (LOAN_STATUS, PURPOSE, INCOME, CREDIT_LINE)
