"""Casts, domain rules, caps and the order of cleaning steps."""

from pyspark.sql import functions as F

from loanscore.functions.casts import to_double, to_int_trunc, to_month_date
from loanscore.functions.keys import drop_empty_profiles, member_key, with_member_key
from loanscore.operators import defaults, inquiries, loan, payment, personal
from loanscore.operators.common import normalized_loan_status
from loanscore.schema import PROFILE_COLUMNS, RAW_FIELDS


def one_col(spark, values, typ, fn):
    df = spark.createDataFrame([(v,) for v in values], f"x {typ}")
    return [r[0] for r in df.select(fn(F.col("x"))).collect()]


def test_int_trunc_text(spark):
    vals = ["2", "2.9", "-2.9", " 36", "+5", "5.", "1e3", "5d", ".5", "abc", "", None, "99999999999"]
    got = one_col(spark, vals, "string", lambda c: to_int_trunc(c))
    assert got == [2, 2, -2, 36, 5, 5, None, None, 0, None, None, None, None]


def test_int_trunc_number(spark):
    from pyspark.sql.types import DoubleType

    got = one_col(spark, [2.9, -2.9, 0.0, None, 1e20], "double", lambda c: to_int_trunc(c, DoubleType()))
    assert got == [2, -2, 0, None, None]


def test_double_and_month(spark):
    assert one_col(spark, ["12.5", "n/a", None], "string", to_double) == [12.5, None, None]
    import datetime as dt

    got = one_col(spark, ["Dec-2015", "Mar-2019", "bad", None], "string", to_month_date)
    assert got == [dt.date(2015, 12, 1), dt.date(2019, 3, 1), None, None]


def test_member_key_skips_nulls_and_empty_profile(spark):
    cols = ", ".join(f"{c} string" for c in PROFILE_COLUMNS)
    rows = [
        ("A", None, "b", None, None, None, None, None, None),
        ("A", "b", None, None, None, None, None, None, None),
        tuple([None] * 9),
    ]
    df = with_member_key(spark.createDataFrame(rows, cols), 512)
    keys = [r.member_id for r in df.collect()]
    assert keys[0] == keys[1]  # nulls are skipped, so these share a key
    assert len(keys[0]) == 128
    kept = drop_empty_profiles(df, "member_id", 512)
    assert kept.count() == 2
    # the key-only form of the filter gives the same rows
    assert drop_empty_profiles(df.select("member_id"), "member_id", 512).count() == 2
    empty = df.select(member_key(512)).collect()[2][0]
    assert empty.startswith("cf83e1357eefb8bdf")


def test_personal_rules(spark):
    rows = [
        ("k1", "CA", "Verified", "OWN", 2_500_000.0, "190xx", 5),
        ("k2", "94111", "Not Verified", "ANY", 10.0, "abcde", 0),
        ("k3", None, None, None, 0.0, "12", -3),
        ("k4", "NY", "Source Verified", "MORTGAGE", 5.0, "1a3xx", 10),
        ("k5", "NY", "Verified", "RENT", 5.0, "ab1cd", 1),
    ]
    df = spark.createDataFrame(
        rows,
        "personal_member_id string, addr_state string, verification_status string, home_ownership string, "
        "annual_inc double, zip_code string, emp_length int",
    )
    out = personal.with_outliers(df).orderBy("personal_member_id").collect()
    assert [r.addr_state for r in out] == ["CA", None, None, "NY", "NY"]
    assert [r.verification_status for r in out] == [True, False, False, True, True]
    assert [r.home_ownership for r in out] == ["OWN", "RENT", "RENT", "MORTGAGE", "RENT"]
    assert [r.annual_inc for r in out] == [1_000_000.0, 10.0, 0.0, 5.0, 5.0]
    # 190xx: 'xx' at 3-4 is '0x', so the prefix decides (190 is a number: kept)
    # abcde: no 'xx' and no numeric prefix: null; '12': wrong length: null
    # 1a3xx: has 'xx' at 3-4? no ('3x'), prefix '1a3' not a number: null
    # ab1cd: null
    assert [r.zip_code for r in out] == ["190xx", None, None, None, None]
    assert [r.emp_length for r in out] == ["5", "0", "3", "10", "1"]


def test_emp_length_text_scores_as_zero(spark):
    """Text lengths are cast before digits are extracted, so they become 0."""
    rows = [("10+ years",), ("7",), ("< 1 year",), ("-3",)]
    df = spark.createDataFrame(rows, "emp_length string").select(
        F.lit("k").alias("personal_member_id"),
        to_int_trunc(F.col("emp_length")).alias("emp_length"),
        F.lit(None).cast("double").alias("annual_inc"),
        F.lit(None).cast("double").alias("avg_cur_bal"),
        F.lit(None).cast("double").alias("tot_cur_bal"),
        F.lit(None).cast("double").alias("tot_hi_cred_lim"),
        F.lit(None).cast("string").alias("addr_state"),
        F.lit(None).cast("string").alias("verification_status"),
        F.lit(None).cast("string").alias("home_ownership"),
        F.lit(None).cast("string").alias("zip_code"),
    )
    out = personal.with_outliers(personal.filled(df))
    assert [r.emp_length for r in out.collect()] == ["0", "7", "0", "3"]


def test_loan_status_and_purpose(spark):
    vals = [
        "Fully Paid",
        "Does not meet the credit policy. Status:Fully Paid",
        "Charged Off",
        "Does not meet the credit policy. Status:Charged Off",
        "Late (31-120 days)",
        "Late (16-30 days)",
        "Current",
        "In Grace Period",
        "Default",
        "Issued",
        None,
    ]
    got = one_col(spark, vals, "string", lambda c: normalized_loan_status("x"))
    assert got == ["Full Paid", "Full Paid", "Charged Off", "Charged Off", "Late", "Late", "Current",
                   "In Grace Period", "Default", None, None]
    df = spark.createDataFrame([("car", None), ("spaceship", None), (None, None)], "purpose string, loan_status string")
    assert [r.purpose for r in loan.with_outliers(df).collect()] == ["car", "other", "other"]


def test_payment_recomputes_totals(spark):
    df = spark.createDataFrame(
        [(100.0, 10.25, 2.5, 1.0, "Charged Off"), (50.0, 0.0, 0.0, 0.0, "n")],
        "loan_amnt double, total_rec_prncp double, total_rec_int double, total_rec_late_fee double, pymnt_plan string",
    ).withColumn("loan_status", F.lit("Current"))
    out = payment.with_outliers(df).collect()
    assert [r.total_pymnt for r in out] == [13.75, 0.0]
    assert [r.out_prncp for r in out] == [89.75, 50.0]
    assert [r.pymnt_plan for r in out] == [None, "n"]


def test_caps_keep_type_and_null(spark):
    df = spark.createDataFrame([(30, 9, 12, 20), (None, 1, 1, 1)],
                               "delinq_2yrs int, acc_now_delinq int, pub_rec_bankruptcies int, mort_acc int")
    out = defaults.with_outliers(df)
    assert dict(out.dtypes)["delinq_2yrs"] == "int"
    assert [tuple(r) for r in out.collect()] == [(24, 5, 10, 15), (None, 1, 1, 1)]
    inq = spark.createDataFrame([(3, 12, 150, 60)],
                                "mnths_since_inq int, chargeoff_within_12_mths bigint, inq_last_12m int, inq_fi int")
    row = inquiries.with_outliers(inq).collect()[0]
    assert (row.chargeoff_within_12_mths, row.inq_last_12m, row.inq_fi) == (10, 100, 50)


def test_raw_schema():
    assert len(RAW_FIELDS) == 151
    assert sum(1 for _, t in RAW_FIELDS if t == "string") == 98
    assert sum(1 for _, t in RAW_FIELDS if t == "double") == 53


def test_int_trunc_fast_paths_equal_the_plain_rule(spark):
    from loanscore.functions.casts import INT_TEXT, int_trunc_sql

    vals = ["36", " 36", "36 ", "-2", "+4", "3.0", "-3.0", " 3.0", "3 .0", "+4.0", ".0", "1e3.0", "2147483647",
            "2147483648", "2147483647.0", "2147483648.0", "-2147483648.0", "12.50", "7.", "0.0", "00.0", "1.0e0",
            "abc.0", "1,0", "", " ", "\t5\t", "5.00", "NaN", "Infinity", "0x10", "1_000"]
    df = spark.createDataFrame([(v,) for v in vals], "x string")
    plain = f"CASE WHEN x RLIKE r'{INT_TEXT}' THEN try_cast(try_cast(x AS DOUBLE) AS INT) END"
    got = df.select(F.expr(int_trunc_sql("x")).alias("a"), F.expr(plain).alias("b")).collect()
    assert [r.a for r in got] == [r.b for r in got]


def test_int_digits_equals_regex_strip(spark):
    from loanscore.functions.casts import digits_only, int_digits

    df = spark.createDataFrame([(v,) for v in [0, 7, -3, 10, -2147483648, 2147483647, None]], "x int")
    got = df.select(int_digits("x").alias("a"), digits_only(F.col("x")).alias("b")).collect()
    assert [r.a for r in got] == [r.b for r in got]
