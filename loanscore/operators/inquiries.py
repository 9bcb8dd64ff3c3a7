"""Inquiries subject: one row per member; a roll-up plus the latest counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanscore.functions import ladders as L
from loanscore.functions.casts import to_int_trunc, to_month_date
from loanscore.functions.keys import RANK, ROW
from loanscore.levels import DEFAULT_LEVELS, Levels
from loanscore.operators.common import (
    cap,
    fill_zero,
    keep_profiles,
    latest_per_member,
    rank_column,
    subject_columns,
    rename_key,
    stamp,
)

KEY = "inquires_member_id"

DETAILS = (
    "member_id",
    "mths_since_recent_inq",
    "chargeoff_within_12_mths",
    "inq_last_12m",
    "inq_fi",
    "issue_d",
    "id",
)
COUNTS = ("mths_since_recent_inq", "chargeoff_within_12_mths", "inq_last_12m", "inq_fi")

# Caps; the charge-off cap applies to the per-member sum.
CAPS = {"inq_last_12m": 100, "inq_fi": 50, "chargeoff_within_12_mths": 10}


def details(keyed: DataFrame) -> DataFrame:
    return subject_columns(keyed, DETAILS)


def type_columns(df: DataFrame) -> dict[str, Column]:
    types = {f.name: f.dataType for f in df.schema.fields}
    out = {"issue_d": to_month_date("issue_d")}
    for c in ("mths_since_recent_inq", "chargeoff_within_12_mths", "inq_last_12m", "inq_fi", "id"):
        out[c] = to_int_trunc(c, types[c])
    return out


def typed(details_df: DataFrame, bits: int = 512, kept: bool = False) -> DataFrame:
    """Typed columns plus the row's rank within its member (``RANK``, for ``latest``).

    kept: rows without a profile are gone already, so their key is not compared again.
    """
    df = rename_key(details_df, KEY) if kept else keep_profiles(rename_key(details_df, KEY), KEY, bits)
    return df.withColumns({RANK: rank_column(df), **type_columns(df)}).drop(ROW)


def filled(typed_df: DataFrame) -> DataFrame:
    return fill_zero(typed_df, COUNTS)


def rollup_aggs() -> list[Column]:
    """Longest gap since an inquiry, and the total of charge-offs."""
    return [
        F.max("mths_since_recent_inq").alias("mnths_since_inq"),
        F.sum("chargeoff_within_12_mths").alias("chargeoff_within_12_mths"),
    ]


def rollup(filled_df: DataFrame) -> DataFrame:
    """Grouped max and sum per member (hash aggregate with partial step)."""
    return filled_df.groupBy(KEY).agg(*rollup_aggs())


def latest(filled_df: DataFrame) -> DataFrame:
    """Roll-up and latest counts in one aggregate, so one shuffle serves both."""
    out = latest_per_member(filled_df, KEY, ("inq_last_12m", "inq_fi"), extra_aggs=rollup_aggs())
    return out.select(KEY, "mnths_since_inq", "chargeoff_within_12_mths", "inq_last_12m", "inq_fi")


def outlier_columns() -> dict[str, Column]:
    return {c: cap(c, limit) for c, limit in CAPS.items()}


def with_outliers(df: DataFrame) -> DataFrame:
    return df.withColumns(outlier_columns())


def clean(details_df: DataFrame, bits: int = 512, kept: bool = False) -> DataFrame:
    return stamp(with_outliers(latest(filled(typed(details_df, bits, kept)))))


def points(clean_df: DataFrame, levels: Levels = DEFAULT_LEVELS) -> DataFrame:
    df = clean_df.select("*", *[lad.column(levels) for lad in L.INQUIRIES_LADDERS])
    s = F.col("mnth_inq_points") + F.col("inq_12m_points") + F.col("inq_points") + F.col("charge_off_points")
    return df.withColumn("total_inquires_points", s)
