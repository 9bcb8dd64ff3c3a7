"""Steps shared by the five subjects."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    ByteType,
    DateType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    ShortType,
    TimestampNTZType,
    TimestampType,
)

from loanscore.functions.casts import to_long_trunc, to_month_date
from loanscore.functions.keys import RANK, ROW, drop_empty_profiles, recency


def rename_key(df: DataFrame, key: str) -> DataFrame:
    return df.withColumnRenamed("member_id", key)


def keep_profiles(df: DataFrame, key: str, bits: int) -> DataFrame:
    return drop_empty_profiles(df, key, bits)


def stamp(df: DataFrame) -> DataFrame:
    """Add the load time (one value per query, evaluated on the driver)."""
    return df.withColumn("ingestion_date", F.current_timestamp())


def unstamped(df: DataFrame) -> DataFrame:
    return df.drop("ingestion_date")


def subject_columns(keyed: DataFrame, columns: Iterable[str]) -> DataFrame:
    """A subject's raw columns, and the rows' fingerprint where they have one."""
    return keyed.select(*columns, *[c for c in (ROW,) if c in keyed.columns])


def rank_column(raw: DataFrame) -> Column:
    """The rank of each raw row (``id`` and ``issue_d`` as read) within its member.

    Rows of one member with the same month and id are told apart by their
    fingerprint, so the latest row depends neither on the order of the input
    nor on the columns a consumer reads. Frames without fingerprints are told
    apart by all their columns.
    """
    types = {f.name: f.dataType for f in raw.schema.fields}
    row = F.col(ROW) if ROW in raw.columns else F.xxhash64(F.lit(0), *[F.col(c) for c in raw.columns])
    return recency(to_month_date("issue_d"), to_long_trunc("id", types["id"]), row)


def unranked(df: DataFrame) -> DataFrame:
    return df.drop(RANK, ROW)


def fill_zero(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.fillna(0, subset=list(columns))


def cap(column: str, limit: int) -> Column:
    """Values above ``limit`` become ``limit``; null stays null."""
    return F.expr(f"CASE WHEN `{column}` > {int(limit)} THEN {int(limit)} ELSE `{column}` END")


# Raw loan status spellings and what cleaning maps them to.
FULLY_PAID_RAW = ("Does not meet the credit policy. Status:Fully Paid", "Fully Paid")
CHARGED_OFF_RAW = ("Does not meet the credit policy. Status:Charged Off", "Charged Off")
LATE_RAW = ("Late (31-120 days)", "Late (16-30 days)")
STATUS_KEPT = ("Current", "In Grace Period", "Default")


def _in(values: Iterable[str]) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def normalized_loan_status(column: str = "loan_status") -> Column:
    s = f"`{column}`"
    return F.expr(
        f"CASE WHEN {s} IN ({_in(FULLY_PAID_RAW)}) THEN 'Full Paid' "
        f"WHEN {s} IN ({_in(CHARGED_OFF_RAW)}) THEN 'Charged Off' "
        f"WHEN {s} IN ({_in(LATE_RAW)}) THEN 'Late' "
        f"WHEN {s} IN ({_in(STATUS_KEPT)}) THEN {s} ELSE CAST(NULL AS STRING) END"
    )


_FIXED_WIDTH = (
    BooleanType,
    ByteType,
    ShortType,
    IntegerType,
    LongType,
    FloatType,
    DoubleType,
    DateType,
    TimestampType,
    TimestampNTZType,
)


def latest_per_member(
    df: DataFrame,
    key: str,
    columns: Iterable[str],
    extra_aggs: Iterable[Column] = (),
) -> DataFrame:
    """One row per member: the named values of its latest row, plus extra aggregates.

    "Latest" is the greatest ``RANK`` (``issue_d DESC NULLS LAST, id DESC NULLS
    LAST``, then a hash of the row). A frame without that column is ranked by
    its typed ``issue_d`` and ``id``. Written as a grouped ``max_by``, so Spark
    plans a partial aggregate before the shuffle: a member holding a large
    share of all rows is reduced to one buffer per map task. Only the named
    columns cross the shuffle; when all of them are fixed width the plan is a
    hash aggregate (no sort at all), text columns make Spark use a sort
    aggregate, still with the partial step.

    Output: ``key`` then ``columns`` then the extra aggregates, in order.
    """
    columns = list(columns)
    if RANK not in df.columns:
        row = F.xxhash64(*[F.col(c) for c in df.columns])
        df = df.withColumn(RANK, recency(F.col("issue_d"), F.col("id"), row))
    types = {f.name: f.dataType for f in df.schema.fields}
    rank = F.col(RANK)
    if all(isinstance(types[c], _FIXED_WIDTH) for c in columns):
        return df.groupBy(key).agg(*[F.max_by(F.col(c), rank).alias(c) for c in columns], *extra_aggs)
    packed = F.max_by(F.struct(*[F.col(c) for c in columns]), rank).alias("_latest")
    out = df.groupBy(key).agg(packed, *extra_aggs)
    extra_names = [n for n in out.columns if n not in (key, "_latest")]
    return out.select(key, *[F.col("_latest")[c].alias(c) for c in columns], *extra_names)
