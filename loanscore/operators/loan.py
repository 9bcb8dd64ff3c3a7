"""Loan subject: one row per loan; the latest per member is scored."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanscore.functions import ladders as L
from loanscore.functions.casts import to_int_trunc, to_month_date
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

KEY = "loan_member_id"

DETAILS = ("id", "member_id", "loan_amnt", "term", "int_rate", "installment", "issue_d", "loan_status", "purpose")
FILL = ("loan_amnt", "int_rate", "installment")
LATEST = ("id", "loan_amnt", "term", "int_rate", "installment", "issue_d", "loan_status", "purpose")

# Accepted loan purposes; anything else becomes OTHER_PURPOSE.
PURPOSES = (
    "debt_consolidation",
    "credit_card",
    "home_improvement",
    "major_purchase",
    "medical",
    "small_business",
    "car",
    "vacation",
    "moving",
    "house",
    "wedding",
    "renewable_energy",
    "educational",
)
OTHER_PURPOSE = "other"


def details(keyed: DataFrame) -> DataFrame:
    return subject_columns(keyed, DETAILS)


def type_columns(df: DataFrame) -> dict[str, Column]:
    types = {f.name: f.dataType for f in df.schema.fields}
    return {
        "issue_d": to_month_date("issue_d"),
        # ' 36 months' -> ' 36' -> 36
        "term": to_int_trunc("substring(term, 1, 3)"),
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


def outlier_columns() -> dict[str, Column]:
    kept = ", ".join(f"'{p}'" for p in PURPOSES)
    return {
        "loan_status": normalized_loan_status(),
        "purpose": F.expr(f"CASE WHEN purpose IN ({kept}) THEN purpose ELSE '{OTHER_PURPOSE}' END"),
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


def total(levels: Levels = DEFAULT_LEVELS) -> Column:
    # Only status and purpose reach the total; income and credit line do not.
    return L.LOAN_STATUS.expr(levels) + L.PURPOSE.expr(levels)


def points(rows: DataFrame, levels: Levels = DEFAULT_LEVELS) -> DataFrame:
    """Latest loans with their member's cleaned ``annual_inc`` and ``tot_hi_cred_lim``, scored."""
    df = rows.select("*", *[lad.column(levels) for lad in L.LOAN_LADDERS])
    return df.withColumn("total_loan_points", F.col("loan_status_points") + F.col("purpose_points"))
