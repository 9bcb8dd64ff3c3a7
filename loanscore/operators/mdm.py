"""Member profile and the loan-level master-data view.

``member_profile`` builds the cleaned personal, defaults and inquiries
subjects together: the three are one row per member over the same rows and
the same latest row, so one aggregate (one shuffle) yields all three,
instead of three.

``mdm_view`` keeps every cleaned loan row and attaches its payment record
and its member's profile (left joins in the reference's definition).

The payment record of a loan is the payment part of the same application
row: both subjects are projections of the same rows, and the loan id is the
row's key, so the id join is a self-join that pairs each row with itself.
It is therefore computed row-wise (map-only, no shuffle); a loan whose id is
not a number gets no payment fields, as the left join would give it. This
never emits all pairs of a group of rows sharing an id; ``duplicate_ids`` in
the quality checks counts such ids, for which the two forms differ.

The only join left is the one to the per-member profile, one row per member.
The profile is grouped by the binary key and joined by the text key, so both
sides of the join are plain shuffles and AQE can split the loans of a member
who owns a large share of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanscore.functions.casts import to_long_trunc
from loanscore.functions.keys import RANK, drop_empty_profiles
from loanscore.operators import defaults, inquiries, loan, personal
from loanscore.operators.combine import prepared_rows
from loanscore.operators.common import fill_zero, latest_per_member, rank_column

PROFILE_KEY = "member_id"

MDM_COLUMNS = (
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
    "tot_cur_bal",
    "id",
    "loan_amnt",
    "term",
    "int_rate",
    "issue_d",
    "loan_status",
    "purpose",
    "installment",
    "pymnt_plan",
    "total_pymnt",
    "total_rec_prncp",
    "total_rec_int",
    "total_rec_late_fee",
    "out_prncp",
    "last_pymnt_d",
    "last_pymnt_amnt",
    "delinq_2yrs",
    "pub_rec_bankruptcies",
    "acc_now_delinq",
    "mort_acc",
    "mnths_since_inq",
    "chargeoff_within_12_mths",
    "inq_last_12m",
    "inq_fi",
)

PROFILE_COLUMNS = (
    *personal.LATEST,
    *defaults.COUNTS,
    "mnths_since_inq",
    "chargeoff_within_12_mths",
    "inq_last_12m",
    "inq_fi",
)


def member_profile(keyed: DataFrame, bits: int = 512) -> DataFrame:
    """Cleaned personal + defaults + inquiries columns, one row per member.

    Grouped by the key's binary digest and returned with the key as text.
    """
    df = drop_empty_profiles(keyed, "member_id", bits).withColumn("_key", F.unhex("member_id"))
    df = df.withColumns(
        {
            RANK: rank_column(df),
            **personal.type_columns(df),
            **defaults.type_columns(df),
            **inquiries.type_columns(df),
        }
    )
    df = fill_zero(df, dict.fromkeys((*personal.FILL, *defaults.COUNTS, *inquiries.COUNTS)))
    carried = (*personal.LATEST, *defaults.COUNTS, "inq_last_12m", "inq_fi")
    prof = latest_per_member(df, "_key", carried, extra_aggs=inquiries.rollup_aggs())
    rules = {
        **personal.outlier_columns(),
        **defaults.outlier_columns(),
        **inquiries.outlier_columns(),
    }
    return prof.withColumns(rules).select(F.lower(F.hex("_key")).alias(PROFILE_KEY), *PROFILE_COLUMNS)


INQUIRIES_CLEAN = ("mnths_since_inq", "chargeoff_within_12_mths", "inq_last_12m", "inq_fi")


def subjects_from_profile(profile: DataFrame) -> dict[str, DataFrame]:
    """The cleaned personal, defaults and inquiries subjects (without the
    load stamp) as projections of one member profile."""
    k = F.col(PROFILE_KEY)
    return {
        "personal": profile.select(k.alias(personal.KEY), *personal.LATEST),
        "defaults": profile.select(k.alias(defaults.KEY), *defaults.COUNTS),
        "inquiries": profile.select(k.alias(inquiries.KEY), *INQUIRIES_CLEAN),
    }


PAYMENT_PART = (
    "installment",
    "pymnt_plan",
    "total_pymnt",
    "total_rec_prncp",
    "total_rec_int",
    "total_rec_late_fee",
    "out_prncp",
    "last_pymnt_d",
    "last_pymnt_amnt",
)
LOAN_PART = ("id", "loan_amnt", "term", "int_rate", "issue_d", "loan_status", "purpose")


def loan_rows(keyed: DataFrame, bits: int = 512) -> DataFrame:
    """Cleaned loan columns with the same row's cleaned payment columns (map-only)."""
    rows = prepared_rows(keyed.withColumn("_raw_id", to_long_trunc("id", keyed.schema["id"].dataType)), bits)
    has_id = F.col("_raw_id").isNotNull()
    return rows.select(
        "member_id",
        *LOAN_PART,
        *[F.when(has_id, F.col(c)).alias(c) for c in PAYMENT_PART],
    )


def mdm_view(keyed: DataFrame, bits: int = 512) -> DataFrame:
    loans = loan_rows(keyed, bits)
    prof = member_profile(keyed, bits).withColumnRenamed(PROFILE_KEY, "_profile_key")
    out = loans.join(prof, loans["member_id"] == prof["_profile_key"], "left")
    return out.withColumn("member_id", F.col("_profile_key")).select(*MDM_COLUMNS)


# The temp-view names the five cleaned subjects are registered under.
SUBJECT_VIEWS = {
    "loan": "loan_tbl",
    "personal": "pers_tbl",
    "payment": "pymt_tbl",
    "defaults": "dfts_tbl",
    "inquiries": "inqs_tbl",
}


def create_temp_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def register_subject_views(
    loan_df: DataFrame,
    personal_df: DataFrame,
    payment_df: DataFrame,
    defaults_df: DataFrame,
    inquiries_df: DataFrame,
) -> None:
    """Register the five cleaned subjects under their fixed view names."""
    frames = {
        "loan": loan_df,
        "personal": personal_df,
        "payment": payment_df,
        "defaults": defaults_df,
        "inquiries": inquiries_df,
    }
    for subject, df in frames.items():
        create_temp_view(df, SUBJECT_VIEWS[subject])


# Which subject a column of the view comes from; the rest are the loan's.
_VIEW_SOURCES = {
    "payment": PAYMENT_PART,
    "personal": personal.LATEST,
    "defaults": defaults.COUNTS,
    "inquiries": INQUIRIES_CLEAN,
}
_VIEW_KEYS = {"personal": personal.KEY, "defaults": defaults.KEY, "inquiries": inquiries.KEY}


def create_mdm_sql_view(spark: SparkSession, name: str = "member_loan_mdm") -> DataFrame:
    """The master-data view over the registered subject views, itself registered as ``name``.

    Every loan, with the payment of the same id and the member's rows of the
    three per-member subjects where they exist. Ids that occur more than once
    pair all their loans with all their payments.
    """
    view = spark.table(SUBJECT_VIEWS["loan"]).select(*LOAN_PART, F.col(loan.KEY).alias("_member"))
    for subject, columns in _VIEW_SOURCES.items():
        wanted = [c for c in columns if c in MDM_COLUMNS]
        rows = spark.table(SUBJECT_VIEWS[subject])
        if subject == "payment":
            view = view.join(rows.select("id", *wanted), "id", "left")
            continue
        key = F.col(_VIEW_KEYS[subject])
        extra = [key.alias("member_id")] if subject == "personal" else []
        view = view.join(rows.select(key.alias("_member"), *extra, *wanted), "_member", "left")
    create_temp_view(view.select(*MDM_COLUMNS), name)
    return spark.table(name)
