"""Every ladder arm, boundary, null and unreachable arm on literal frames.

Each case selects exactly the row it describes, so no check passes empty.
"""

import pytest

from loanscore.functions import ladders as L
from loanscore.levels import Levels

VB, B, OK, G, VG, U, N = 0.0, 100.0, 250.0, 350.0, 500.0, -500.0, 0.0


def score(spark, ladder, schema, rows, levels=None):
    df = spark.createDataFrame(rows, schema)
    col = ladder.column(levels) if levels else ladder.column()
    return [r[0] for r in df.select(col).collect()]


def test_verification(spark):
    assert score(spark, L.VERIFICATION, "verification_status boolean", [(True,), (False,)]) == [G, B]


def test_grade_every_sub_grade(spark):
    table = L.sub_grade_points()
    rows = [(g, sg) for g, sg, _ in table]
    got = score(spark, L.GRADE, "grade string, sub_grade string", rows)
    assert got == [p for _, _, p in table]
    # the rule: A1 200, A2 180, A3 175 falling by 5 to G4 20, G5 10
    assert [round(p, 6) for p in got[:3]] == [200.0, 180.0, 175.0]
    assert round(got[-2], 6) == 20.0 and round(got[-1], 6) == 10.0
    assert all(round(a - b, 6) == 5.0 for a, b in zip(got[2:-2], got[3:-1]))


def test_grade_mismatch_null_unknown(spark):
    rows = [("B", "A1"), (None, "A1"), ("A", None), ("H", "H1"), ("A", "A6")]
    assert score(spark, L.GRADE, "grade string, sub_grade string", rows) == [N] * 5


def test_grade_points_are_the_decimal_products(spark):
    # C5 is 200 * 0.575 in binary floating point, not exactly 115
    got = dict((sg, p) for _, sg, p in L.sub_grade_points())
    assert got["C5"] == 200.0 * 0.575
    assert got["D1"] == 200.0 * 0.55


def test_experience(spark):
    rows = [(v,) for v in ["0", "1", "2", "3", "4", "5", "6", "7", "8", "9", "10", "11", None]]
    assert score(spark, L.EXPERIENCE, "emp_length string", rows) == [U, VB, VB, B, B, OK, OK, G, G, VG, VG, None, None]


def test_home(spark):
    rows = [("OWN",), ("RENT",), ("MORTAGE",), ("MORTGAGE",), (None,)]
    assert score(spark, L.HOME, "home_ownership string", rows) == [G, OK, B, N, N]


def test_late_fees_boundaries(spark):
    vals = [40000.0, 39999.99, 25000.0, 24999.0, 10000.0, 9999.0, 5000.0, 4999.0, 1000.0, 999.99, 0.0, None]
    want = [U, VB, VB, B, B, OK, OK, G, G, VG, VG, N]
    assert score(spark, L.LATE_FEES, "total_rec_late_fee double", [(v,) for v in vals]) == want


def test_installment(spark):
    # m = annual_inc / 12 = 100
    rows = [
        (60.0, 1200.0),  # 2i > m
        (50.0, 1200.0),  # 2i = m, i < m -> good (the 2i < m arm is unreachable)
        (10.0, 1200.0),  # 2i < m but i < m fires first -> good
        (0.0, 0.0),  # i = m only at zero
        (None, 1200.0),  # null installment -> no points
    ]
    assert score(spark, L.INSTALLMENT, "installment double, annual_inc double", rows) == [VB, G, G, OK, N]


def test_delinquency(spark):
    rows = [(0, 0), (1, 0), (0, 1), (1, 1), (2, 1), (2, 3), (3, 1), (2, 0), (3, 0), (0, 2), (1, 2), (4, 1), (None, 0)]
    want = [VG, G, G, OK, B, B, VB, N, N, N, N, N, N]
    assert score(spark, L.DELINQUENCY, "delinq_2yrs int, acc_now_delinq int", rows) == want


def test_public_records_no_else(spark):
    rows = [(0,), (1,), (2,), (10,), (-1,), (None,)]
    assert score(spark, L.PUBLIC_RECORDS, "pub_rec_bankruptcies int", rows) == [VG, OK, U, U, None, None]


def test_mortgages_no_else(spark):
    rows = [(0,), (1,), (2,), (3,), (15,), (-1,)]
    assert score(spark, L.MORTGAGES, "mort_acc int", rows) == [VG, OK, B, U, U, None]


def test_months_since_inquiry(spark):
    rows = [(v,) for v in [0, 1, 2, 3, 4, 5, 6, 8, 9, 20, -1, None]]
    want = [VG, G, G, OK, B, B, VB, VB, N, N, N, N]
    assert score(spark, L.MONTHS_SINCE_INQUIRY, "mnths_since_inq int", rows) == want


def test_charge_offs(spark):
    rows = [(0,), (1,), (10,), (None,)]
    assert score(spark, L.CHARGE_OFFS, "chargeoff_within_12_mths bigint", rows) == [VG, U, U, U]


@pytest.mark.parametrize("ladder,column", [(L.FINANCE_INQUIRIES, "inq_fi"), (L.YEAR_INQUIRIES, "inq_last_12m")])
def test_inquiry_counts(spark, ladder, column):
    rows = [(v,) for v in [0, 1, 2, 3, 4, 5, 50, -1, None]]
    assert score(spark, ladder, f"{column} int", rows) == [VG, G, OK, B, VB, N, N, None, None]


def test_loan_status(spark):
    rows = [(v,) for v in ["Fully Paid", "Full Paid", "Current", "Late", "Charged Off", "In Grace Period", "Default", None]]
    assert score(spark, L.LOAN_STATUS, "loan_status string", rows) == [VG, N, G, OK, U, B, VB, N]


def test_purpose(spark):
    rows = [(v,) for v in ["debt_consolidation", "credit_card", "educational", "house", "car", "other", None]]
    assert score(spark, L.PURPOSE, "purpose string", rows) == [U, U, VG, VG, OK, OK, OK]


def test_income(spark):
    # L = 100
    rows = [(v, 100.0) for v in [49.0, 50.0, 100.0, 100.5, 150.0, 160.0, 200.0, 240.0, 250.0, 251.0]] + [(None, 100.0)]
    # <0.5L U; 0.5L..L gap N; (L,1.5L) B; 1.5L -> G (gap in OK arm); (1.5L,2L) OK; [2L,2.5L) G; 2.5L N; >2.5L VG
    want = [U, N, N, B, G, OK, G, G, N, VG, N]
    assert score(spark, L.INCOME, "annual_inc double, loan_amnt double", rows) == want


def test_credit_line(spark):
    # H = 100
    rows = [(v, 100.0) for v in [200.0, 150.0, 100.0, 70.0, 50.0, 40.0]] + [(100.0, None)]
    want = [U, B, OK, G, VG, N, N]
    assert score(spark, L.CREDIT_LINE, "loan_amnt double, tot_hi_cred_lim double", rows) == want


def test_levels_are_arguments(spark):
    lv = Levels(very_good=1.5, no_points=-2.0)
    assert score(spark, L.HOME, "home_ownership string", [("OWN",), ("X",)], lv) == [G, -2.0]
    assert score(spark, L.CHARGE_OFFS, "chargeoff_within_12_mths bigint", [(0,)], lv) == [1.5]


def test_ladders_are_codegen_friendly(spark):
    df = spark.createDataFrame([("A", "A1")], "grade string, sub_grade string")
    plan = df.select(L.GRADE.column())._jdf.queryExecution().executedPlan().toString()
    assert "CaseWhen" not in plan and "element_at" in plan.lower()
