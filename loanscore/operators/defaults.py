"""Defaults subject: one row per member with delinquency counts."""

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

KEY = "defaults_member_id"

DETAILS = ("member_id", "delinq_2yrs", "pub_rec_bankruptcies", "acc_now_delinq", "mort_acc", "issue_d", "id")
COUNTS = ("delinq_2yrs", "pub_rec_bankruptcies", "acc_now_delinq", "mort_acc")

# Upper caps of the four counts.
CAPS = {"pub_rec_bankruptcies": 10, "delinq_2yrs": 24, "acc_now_delinq": 5, "mort_acc": 15}


def details(keyed: DataFrame) -> DataFrame:
    return subject_columns(keyed, DETAILS)


def type_columns(df: DataFrame) -> dict[str, Column]:
    types = {f.name: f.dataType for f in df.schema.fields}
    out = {"issue_d": to_month_date("issue_d")}
    for c in ("delinq_2yrs", "acc_now_delinq", "pub_rec_bankruptcies", "mort_acc", "id"):
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


def latest(filled_df: DataFrame) -> DataFrame:
    """All four counts are ints, so this is a pure hash aggregate."""
    return latest_per_member(filled_df, KEY, COUNTS)


def outlier_columns() -> dict[str, Column]:
    return {c: cap(c, limit) for c, limit in CAPS.items()}


def with_outliers(df: DataFrame) -> DataFrame:
    return df.withColumns(outlier_columns())


def clean(details_df: DataFrame, bits: int = 512, kept: bool = False) -> DataFrame:
    return stamp(with_outliers(latest(filled(typed(details_df, bits, kept)))))


def total(levels: Levels = DEFAULT_LEVELS) -> Column:
    return L.MORTGAGES.expr(levels) + L.PUBLIC_RECORDS.expr(levels) + L.DELINQUENCY.expr(levels)


def points(clean_df: DataFrame, levels: Levels = DEFAULT_LEVELS) -> DataFrame:
    df = clean_df.select("*", *[lad.column(levels) for lad in L.DEFAULTS_LADDERS])
    s = F.col("mort_points") + F.col("public_rec_points") + F.col("deliq_points")
    return df.withColumn("total_defaults_points", s)
