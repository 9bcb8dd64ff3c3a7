"""Member totals: five subject totals and their weighted sum.

Two forms with equal results:

* ``final_points`` joins five per-member points tables on the member key, for
  subjects that arrive as separate tables.
* ``member_scores`` computes everything from the raw rows with one shuffle.
  All subjects come from the same rows, the same filter and the same key,
  and all of them take the same latest row, so every row-level rule and
  ladder is evaluated before the shuffle, and the shuffle carries only the
  member key (as its binary digest), a rank and six numbers per member and
  task. The aggregate is a hash aggregate with a map-side partial step; a
  member that owns a large share of the rows is reduced to one buffer per
  task before the exchange, so there is no hot reducer.

``member_rows`` is the same for any choice of cleaned columns: what a consumer
does not name does not cross the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanscore.functions import ladders as L
from loanscore.functions.keys import RANK, ROW, drop_empty_profiles
from loanscore.levels import DEFAULT_LEVELS, DEFAULT_WEIGHTS, Levels, Weights
from loanscore.operators import defaults, inquiries, loan, payment, personal
from loanscore.operators.common import cap, fill_zero, latest_per_member, rank_column
from loanscore.schema import USED_COLUMNS

FINAL_COLUMNS = (
    "personal_member_id",
    "total_points",
    "total_payments_points",
    "total_inquires_points",
    "total_personal_points",
    "total_defaults_points",
    "total_loan_points",
)


# Each subject's key and total; the total's weight is the field of Weights.
SUBJECT_TOTALS = {
    "personal": (personal.KEY, "total_personal_points"),
    "payments": (payment.KEY, "total_payments_points"),
    "inquiries": (inquiries.KEY, "total_inquires_points"),
    "defaults": (defaults.KEY, "total_defaults_points"),
    "loan": (loan.KEY, "total_loan_points"),
}


def weighted_total(weights: Weights = DEFAULT_WEIGHTS) -> Column:
    # Fixed order of the sum, so that the doubles add up the same everywhere.
    order = ("payments", "defaults", "inquiries", "loan", "personal")
    parts = [F.col(SUBJECT_TOTALS[name][1]) * getattr(weights, name) for name in order]
    return reduce(lambda a, b: a + b, parts)


def final_points(points: dict[str, DataFrame], weights: Weights = DEFAULT_WEIGHTS) -> DataFrame:
    """Join form: members that every subject scores, from one points table per subject (``SUBJECT_TOTALS``)."""
    totals = [points[name].select(F.col(key).alias(personal.KEY), total) for name, (key, total) in SUBJECT_TOTALS.items()]
    joined = reduce(lambda left, right: left.join(right, personal.KEY), totals)
    return joined.withColumn("total_points", weighted_total(weights)).select(*FINAL_COLUMNS)


def member_rows(
    keyed: DataFrame, columns: Iterable[str], bits: int = 512, extra_aggs: Iterable[Column] = ()
) -> DataFrame:
    """``member_id`` and the named cleaned columns of each member's latest row: one exchange.

    Only the named columns cross the shuffle, the key as its binary digest.
    """
    columns = list(columns)
    rows = prepared_rows(keyed, bits).withColumn("_key", F.unhex("member_id"))
    out = latest_per_member(rows, "_key", columns, extra_aggs)
    return out.select(F.lower(F.hex("_key")).alias("member_id"), *[c for c in out.columns if c != "_key"])


def payment_points(keyed: DataFrame, bits: int = 512, levels: Levels = DEFAULT_LEVELS) -> DataFrame:
    """Payment points table. The member's income comes from the same latest row, so there is no join."""
    rows = member_rows(keyed, (*payment.LATEST, "annual_inc"), bits).withColumnRenamed("member_id", payment.KEY)
    return payment.points(rows.withColumn(personal.KEY, F.col(payment.KEY)), levels)


def loan_points(keyed: DataFrame, bits: int = 512, levels: Levels = DEFAULT_LEVELS) -> DataFrame:
    """Loan points table. Income and credit line come from the same latest row, so there is no join."""
    rows = member_rows(keyed, (*loan.LATEST, "annual_inc", "tot_hi_cred_lim"), bits)
    rows = fill_zero(rows, ("installment",)).withColumnRenamed("member_id", loan.KEY)
    return loan.points(rows.withColumn(personal.KEY, F.col(loan.KEY)), levels)


def latest_raw_rows(keyed: DataFrame, bits: int = 512) -> DataFrame:
    """The latest raw row of each member, all used columns and the fingerprint: one exchange.

    Every consumer asks for the whole row (one struct), so several consumers
    in one plan share that exchange and the raw rows are derived once.
    """
    df = drop_empty_profiles(keyed, "member_id", bits)
    columns = [c for c in (*USED_COLUMNS, ROW) if c in df.columns]
    df = df.withColumns({RANK: rank_column(df), "_key": F.unhex("member_id")})
    out = df.groupBy("_key").agg(F.max_by(F.struct(*columns), F.col(RANK)).alias("_latest"))
    return out.select(_never_null(F.lower(F.hex("_key"))).alias("member_id"), *[F.col("_latest")[c].alias(c) for c in columns])


def _never_null(key: Column) -> Column:
    """A derived key (it hashes a text that is never null) as Spark can tell: joins on it
    then push no null test below the shared exchange."""
    return F.coalesce(key, F.lit(""))


def subject_points(keyed: DataFrame, bits: int = 512, levels: Levels = DEFAULT_LEVELS) -> dict[str, DataFrame]:
    """The five points tables, each built by its own subject pipeline.

    The inquiries roll up all rows of a member. The others score its latest
    row only, and take it from one shared aggregate.
    """
    latest = latest_raw_rows(keyed, bits)
    rows = drop_empty_profiles(keyed, "member_id", bits)
    tables = {
        "personal": personal.points(personal.clean(personal.details(latest), bits, kept=True), levels),
        "payments": payment_points(latest, bits, levels),
        "inquiries": inquiries.points(inquiries.clean(inquiries.details(rows), bits, kept=True), levels),
        "defaults": defaults.points(defaults.clean(defaults.details(latest), bits, kept=True), levels),
        "loan": loan_points(latest, bits, levels),
    }
    return {name: df.withColumn(SUBJECT_TOTALS[name][0], _never_null(F.col(SUBJECT_TOTALS[name][0]))) for name, df in tables.items()}


def final_points_joined(
    keyed: DataFrame,
    bits: int = 512,
    levels: Levels = DEFAULT_LEVELS,
    weights: Weights = DEFAULT_WEIGHTS,
) -> DataFrame:
    return final_points(subject_points(keyed, bits, levels), weights)


# What the ladders read of the latest row; the roll-up of the inquiries comes on top.
LADDER_INPUTS = (
    "grade", "sub_grade", "emp_length", "verification_status", "home_ownership", "annual_inc", "tot_hi_cred_lim",
    "total_rec_late_fee", "installment", *defaults.COUNTS, "inq_last_12m", "inq_fi", "loan_status", "purpose", "loan_amnt",
)


def member_points(
    keyed: DataFrame, bits: int = 512, levels: Levels = DEFAULT_LEVELS, weights: Weights = DEFAULT_WEIGHTS
) -> DataFrame:
    """Every ladder, every subject total and the weighted total of each member, with the ladders' inputs."""
    rows = member_rows(keyed, LADDER_INPUTS, bits, extra_aggs=inquiries.rollup_aggs())
    capped = rows.withColumn("chargeoff_within_12_mths", cap("chargeoff_within_12_mths", inquiries.CAPS["chargeoff_within_12_mths"]))
    scored = capped
    for points in (personal.points, payment.points, inquiries.points, defaults.points, loan.points):
        scored = points(scored, levels)
    return scored.withColumn("total_points", weighted_total(weights))


def prepared_rows(keyed: DataFrame, bits: int = 512) -> DataFrame:
    """One row per kept loan with every subject's typed, filled, row-cleaned columns.

    Loan installment would be filled with 0 but no loan rule reads it, and the
    payment rules need it unfilled, so it stays unfilled here.
    """
    df = drop_empty_profiles(keyed, "member_id", bits)
    df = df.withColumns(
        {
            RANK: rank_column(df),
            **personal.type_columns(df),
            **payment.type_columns(df),
            **defaults.type_columns(df),
            **inquiries.type_columns(df),
            **loan.type_columns(df),
        }
    )
    fills = dict.fromkeys(
        (*personal.FILL, *payment.FILL, *defaults.COUNTS, *inquiries.COUNTS, *[c for c in loan.FILL if c != "installment"])
    )
    df = fill_zero(df, fills)
    # One simultaneous projection: loan_status is normalised once for both
    # payment and loan, and no rule reads another rule's output.
    row_rules = {
        **personal.outlier_columns(),
        **payment.outlier_columns(),
        **loan.outlier_columns(),
        **defaults.outlier_columns(),
        "inq_last_12m": cap("inq_last_12m", inquiries.CAPS["inq_last_12m"]),
        "inq_fi": cap("inq_fi", inquiries.CAPS["inq_fi"]),
    }
    return df.withColumns(row_rules).drop(ROW)


def member_scores(
    keyed: DataFrame,
    bits: int = 512,
    levels: Levels = DEFAULT_LEVELS,
    weights: Weights = DEFAULT_WEIGHTS,
) -> DataFrame:
    """Fused form: one shuffle from raw rows to the final table.

    The key crosses the shuffle as its binary digest (``unhex``: 64 bytes for
    SHA-512 instead of 128 characters) and is turned back into lower-case hex
    once per member after the aggregate.
    """
    rows = prepared_rows(keyed, bits).select(
        F.unhex("member_id").alias("_key"),
        F.col(RANK),
        personal.total(levels).alias("_personal"),
        payment.total(levels).alias("_payments"),
        defaults.total(levels).alias("_defaults"),
        loan.total(levels).alias("_loan"),
        L.YEAR_INQUIRIES.expr(levels).alias("_inq_12m"),
        L.FINANCE_INQUIRIES.expr(levels).alias("_inq_fi"),
        F.col("mths_since_recent_inq"),
        F.col("chargeoff_within_12_mths"),
    )
    rank = F.col(RANK)
    agg = rows.groupBy("_key").agg(
        F.max_by("_personal", rank).alias("total_personal_points"),
        F.max_by("_payments", rank).alias("total_payments_points"),
        F.max_by("_defaults", rank).alias("total_defaults_points"),
        F.max_by("_loan", rank).alias("total_loan_points"),
        F.max_by("_inq_12m", rank).alias("inq_12m_points"),
        F.max_by("_inq_fi", rank).alias("inq_points"),
        *inquiries.rollup_aggs(),
    )
    agg = agg.withColumn(personal.KEY, F.lower(F.hex("_key"))).withColumn(
        "chargeoff_within_12_mths", cap("chargeoff_within_12_mths", inquiries.CAPS["chargeoff_within_12_mths"])
    )
    inq_total = (
        L.MONTHS_SINCE_INQUIRY.expr(levels)
        + F.col("inq_12m_points")
        + F.col("inq_points")
        + L.CHARGE_OFFS.expr(levels)
    )
    agg = agg.withColumn("total_inquires_points", inq_total)
    return agg.withColumn("total_points", weighted_total(weights)).select(*FINAL_COLUMNS)
