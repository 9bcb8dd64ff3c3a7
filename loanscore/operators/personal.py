"""Personal subject: one row per member describing the borrower."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanscore.functions import ladders as L
from loanscore.functions.casts import int_digits, int_trunc_sql, to_double, to_int_trunc, to_month_date
from loanscore.functions.keys import RANK, ROW
from loanscore.levels import DEFAULT_LEVELS, Levels
from loanscore.operators.common import (
    fill_zero,
    keep_profiles,
    latest_per_member,
    rank_column,
    subject_columns,
    rename_key,
    stamp,
)

KEY = "personal_member_id"

# Raw columns of the subject; ``id`` is carried only to break ties between
# rows issued in the same month.
DETAILS = (
    "member_id",
    "grade",
    "sub_grade",
    "emp_title",
    "emp_length",
    "verification_status",
    "home_ownership",
    "annual_inc",
    "zip_code",
    "addr_state",
    "avg_cur_bal",
    "tot_cur_bal",
    "tot_hi_cred_lim",
    "issue_d",
    "id",
)
FILL = ("annual_inc", "avg_cur_bal", "tot_cur_bal", "tot_hi_cred_lim", "emp_length")
LATEST = (
    "grade",
    "sub_grade",
    "emp_title",
    "emp_length",
    "verification_status",
    "home_ownership",
    "annual_inc",
    "zip_code",
    "addr_state",
    "avg_cur_bal",
    "tot_cur_bal",
    "tot_hi_cred_lim",
)

# Accepted verification and home ownership values, the
# replacement for any other home value, and the income cap.
VERIFIED = ("Source Verified", "Verified")
HOME_KEPT = ("OWN", "RENT", "MORTGAGE")
HOME_DEFAULT = "RENT"
INCOME_CAP = 1_000_000
MASK = "xx"


def details(keyed: DataFrame) -> DataFrame:
    return subject_columns(keyed, DETAILS)


def type_columns(df: DataFrame) -> dict[str, Column]:
    types = {f.name: f.dataType for f in df.schema.fields}
    return {
        "issue_d": to_month_date("issue_d"),
        "annual_inc": to_double("annual_inc"),
        "avg_cur_bal": to_double("avg_cur_bal"),
        "tot_cur_bal": to_double("tot_cur_bal"),
        "tot_hi_cred_lim": to_double("tot_hi_cred_lim"),
        "emp_length": to_int_trunc("emp_length", types["emp_length"]),
        "id": to_int_trunc("id", types["id"]),
    }


def typed(details_df: DataFrame, bits: int = 512, kept: bool = False) -> DataFrame:
    """Typed columns plus the row's rank within its member (``RANK``, for ``latest``).

    kept: rows without a profile are gone already, so their key is not compared again.
    """
    df = rename_key(details_df, KEY) if kept else keep_profiles(rename_key(details_df, KEY), KEY, bits)
    return df.withColumns({RANK: rank_column(df), **type_columns(df)}).drop(ROW)


def filled(typed_df: DataFrame) -> DataFrame:
    return fill_zero(typed_df, FILL)


def latest(filled_df: DataFrame) -> DataFrame:
    return latest_per_member(filled_df, KEY, LATEST)


def outlier_columns() -> dict[str, Column]:
    """Row-level domain rules; each reads the column's incoming value."""
    zip5 = "CASE WHEN length(zip_code) = 5 THEN zip_code END"
    bad_zip = f"substring({zip5}, 3, 2) != '{MASK}' AND ({int_trunc_sql(f'substring({zip5}, 1, 3)')}) IS NULL"
    verified = ", ".join(f"'{v}'" for v in VERIFIED)
    kept = ", ".join(f"'{v}'" for v in HOME_KEPT)
    return {
        "addr_state": F.expr("CASE WHEN length(addr_state) = 2 THEN addr_state END"),
        "verification_status": F.expr(f"CASE WHEN verification_status IN ({verified}) THEN true ELSE false END"),
        "home_ownership": F.expr(
            f"CASE WHEN home_ownership IN ({kept}) THEN home_ownership ELSE '{HOME_DEFAULT}' END"
        ),
        "zip_code": F.expr(f"CASE WHEN {bad_zip} THEN CAST(NULL AS STRING) ELSE {zip5} END"),
        # emp_length is an int here (cast and filled before deduplication)
        "emp_length": int_digits("emp_length"),
        "annual_inc": F.expr(
            f"CASE WHEN annual_inc > {INCOME_CAP} THEN CAST({INCOME_CAP} AS DOUBLE) ELSE annual_inc END"
        ),
    }


def with_outliers(df: DataFrame) -> DataFrame:
    return df.withColumns(outlier_columns())


def clean(details_df: DataFrame, bits: int = 512, kept: bool = False) -> DataFrame:
    """rename, drop empty profiles, cast, fill, latest per member, domain rules, stamp."""
    return stamp(with_outliers(latest(filled(typed(details_df, bits, kept)))))


def total(levels: Levels = DEFAULT_LEVELS) -> Column:
    parts = {lad.name: lad.expr(levels) for lad in L.PERSONAL_LADDERS}
    s = parts["verification_points"] + parts["home_points"] + parts["exp_points"] + parts["grade_points"]
    return F.round(s, 2)


def points(clean_df: DataFrame, levels: Levels = DEFAULT_LEVELS) -> DataFrame:
    cols = [lad.column(levels) for lad in L.PERSONAL_LADDERS]
    df = clean_df.select("*", *cols)
    s = F.col("verification_points") + F.col("home_points") + F.col("exp_points") + F.col("grade_points")
    return df.withColumn("total_personal_points", F.round(s, 2))
