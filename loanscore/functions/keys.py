"""Member key and ordering key.

The member key is a SHA-2 hex digest of the nine profile columns joined by
'-' (nulls are skipped, so a wholly null profile hashes the empty string).
``bits`` is 512 in production; 256 is used where results are compared with
an engine that has no SHA-512.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanscore.schema import PROFILE_COLUMNS, USED_COLUMNS

# The fingerprint of a whole raw row, made where the key is made.
ROW = "_row"


def member_key(bits: int = 512) -> Column:
    return F.sha2(F.concat_ws("-", *[F.col(c) for c in PROFILE_COLUMNS]), bits)



def with_member_key(raw: DataFrame, bits: int = 512) -> DataFrame:
    """Add (or replace) ``member_id`` with the derived member key, and the row's fingerprint ``ROW``.

    The fingerprint hashes every used column in schema order, so all subjects
    tell rows of one month and id apart in the same way.
    """
    used = [F.col(c) for c in USED_COLUMNS if c in raw.columns]
    return raw.withColumns({"member_id": member_key(bits), ROW: F.xxhash64(F.lit(0), *used)})


def empty_profile_key(bits: int = 512) -> Column:
    """Key of a row whose nine profile columns are all null (folded to a literal)."""
    return F.sha2(F.lit(""), bits)


def profile_text() -> Column:
    """The text the member key hashes ('' when the whole profile is null)."""
    return F.concat_ws("-", *[F.col(c) for c in PROFILE_COLUMNS])


def drop_empty_profiles(df: DataFrame, key: str = "member_id", bits: int = 512) -> DataFrame:
    """Remove rows whose profile is wholly null (file footers and junk).

    While the profile columns are present the test is that one of them is
    not null or not empty, so the key's hash is not computed for it; otherwise
    the key is compared with the hash of the empty text.
    """
    if all(c in df.columns for c in PROFILE_COLUMNS):
        return df.where(profile_text() != F.lit(""))
    return df.where(F.col(key) != empty_profile_key(bits))


RANK = "_rank"

# Widths of the rank's parts: id and its null flag, and the tie-break.
_ID_STEP = 2**65
_TIE_BITS = 37


def recency(issue_d: Column, ident: Column, tie: Column) -> Column:
    """One decimal(38) that ranks rows like ``issue_d DESC, id DESC, tie DESC``, nulls last.

    The greatest value is the latest row. Decimals are fixed width, so
    ``max_by`` runs as a hash aggregate with a map-side partial step (no sort,
    and a hot member collapses to one buffer per task before the shuffle).

    Parts, from the top: days since 1970 made positive (0 for null; 2**22 days
    either side of 1970 cover every date the month parser can produce), the
    whole bigint id made positive (0 for null), and the low bits of ``tie``.
    """

    def whole(c: Column) -> Column:
        return c.cast("decimal(20,0)").cast("decimal(38,0)")

    day = F.coalesce(F.unix_date(issue_d).cast("long") + F.lit(2**22 + 1), F.lit(0).cast("long"))
    number = F.coalesce(whole(ident) + F.expr(f"{2**63 + 1}BD"), F.expr("CAST(0 AS DECIMAL(38,0))"))
    low = tie.bitwiseAND(F.lit(2**_TIE_BITS - 1))
    above = (whole(day) * F.expr(f"{_ID_STEP}BD") + number).cast("decimal(38,0)")
    return ((above * F.expr(f"{2**_TIE_BITS}BD")).cast("decimal(38,0)") + whole(low)).cast("decimal(38,0)")
