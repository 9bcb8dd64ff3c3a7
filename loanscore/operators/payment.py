"""Payment subject: one row per loan; the latest per member is scored."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanscore.functions import ladders as L
from loanscore.functions.casts import to_double_2, to_int_trunc, to_month_date
from loanscore.functions.keys import RANK, ROW
from loanscore.levels import DEFAULT_LEVELS, Levels
from loanscore.operators.common import (
    fill_zero,
    keep_profiles,
    latest_per_member,
    normalized_loan_status,
    rank_column,
    subject_columns,
    rename_key,
    stamp,
    unranked,
)

KEY = "payment_member_id"

DETAILS = (
    "id",
    "member_id",
    "installment",
    "loan_amnt",
    "loan_status",
    "pymnt_plan",
    "total_pymnt",
    "total_rec_prncp",
    "total_rec_int",
    "total_rec_late_fee",
    "out_prncp",
    "last_pymnt_d",
    "last_pymnt_amnt",
    "issue_d",
)
# total_pymnt is still text at this point and is recomputed by cleaning, so
# it is not filled; installment is deliberately left unfilled.
FILL = (
    "loan_amnt",
    "total_rec_prncp",
    "total_rec_int",
    "total_rec_late_fee",
    "out_prncp",
    "last_pymnt_amnt",
)
LATEST = (
    "id",
    "installment",
    "loan_amnt",
    "loan_status",
    "pymnt_plan",
    "total_pymnt",
    "total_rec_prncp",
    "total_rec_int",
    "total_rec_late_fee",
    "out_prncp",
    "last_pymnt_d",
    "last_pymnt_amnt",
)

# Fixed value: a payment plan holding this text is not a plan.
NOT_A_PLAN = "Charged Off"


def details(keyed: DataFrame) -> DataFrame:
    return subject_columns(keyed, DETAILS)


def type_columns(df: DataFrame) -> dict[str, Column]:
    types = {f.name: f.dataType for f in df.schema.fields}
    return {
        "issue_d": to_month_date("issue_d"),
        "total_rec_prncp": to_double_2("total_rec_prncp"),
        "total_rec_int": to_double_2("total_rec_int"),
        "total_rec_late_fee": to_double_2("total_rec_late_fee"),
        "out_prncp": to_double_2("out_prncp"),
        "id": to_int_trunc("id", types["id"]),
        "last_pymnt_amnt": to_double_2("last_pymnt_amnt"),
    }


def typed(details_df: DataFrame, bits: int = 512, kept: bool = False) -> DataFrame:
    """Typed columns plus the row's rank within its member (``RANK``, for ``latest``).

    kept: rows without a profile are gone already, so their key is not compared again.
    """
    df = rename_key(details_df, KEY) if kept else keep_profiles(rename_key(details_df, KEY), KEY, bits)
    return df.withColumns({RANK: rank_column(df), **type_columns(df)}).drop(ROW)


def filled(typed_df: DataFrame) -> DataFrame:
    return fill_zero(typed_df, FILL)


def outlier_columns() -> dict[str, Column]:
    return {
        "loan_status": normalized_loan_status(),
        "pymnt_plan": F.expr(f"CASE WHEN pymnt_plan = '{NOT_A_PLAN}' THEN CAST(NULL AS STRING) ELSE pymnt_plan END"),
        "total_pymnt": F.expr("round(total_rec_prncp + total_rec_int + total_rec_late_fee, 2)"),
        "out_prncp": F.expr("round(loan_amnt - total_rec_prncp, 2)"),
    }


def with_outliers(df: DataFrame) -> DataFrame:
    return df.withColumns(outlier_columns())


def clean(details_df: DataFrame, bits: int = 512, kept: bool = False) -> DataFrame:
    """rename, drop empty profiles, cast, fill, domain rules, stamp (one row per loan)."""
    return stamp(unranked(clean_rows(details_df, bits, kept)))


def clean_rows(details_df: DataFrame, bits: int = 512, kept: bool = False) -> DataFrame:
    """The cleaned rows with their rank, for ``latest``."""
    return with_outliers(filled(typed(details_df, bits, kept)))


def latest(ranked_rows: DataFrame) -> DataFrame:
    """The latest cleaned row of each member, from ``clean_rows``."""
    out = latest_per_member(ranked_rows, KEY, LATEST)
    return out.select("id", KEY, *[c for c in LATEST if c != "id"])


def ladder_columns(levels: Levels = DEFAULT_LEVELS) -> list[Column]:
    return [lad.column(levels) for lad in L.PAYMENT_LADDERS]


def total(levels: Levels = DEFAULT_LEVELS) -> Column:
    return L.LATE_FEES.expr(levels) + L.INSTALLMENT.expr(levels)


def points(rows: DataFrame, levels: Levels = DEFAULT_LEVELS) -> DataFrame:
    """Latest payments with their member's cleaned ``annual_inc``, scored."""
    df = rows.select("*", *ladder_columns(levels))
    return df.withColumn("total_payments_points", F.col("late_fees_points") + F.col("installment_points"))
