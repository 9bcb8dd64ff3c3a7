"""Registered queries: one per operator key, each (spark, sf_dir) -> DataFrame.

Every query reads the driver's ``orders`` and ``customer`` tables through
the raw-application fixture, so its work grows with them. Outputs that hold
a member key use SHA-256 keys (``ORACLE_BITS``) so they can be compared with
an engine that has no SHA-512; the library default stays 512. The load-time
stamp is dropped from outputs (it is checked by ``ingest_stamp``).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanscore.functions.casts import to_int_trunc, to_month_date
from loanscore.functions.keys import drop_empty_profiles, member_key, with_member_key
from loanscore.functions.ladders import CREDIT_LINE, GRADE, INCOME
from loanscore.levels import Levels, Weights
from loanscore.operators import combine, defaults, inquiries, loan, mdm, payment, personal, quality
from loanscore.operators.common import unranked, unstamped
from loanscore.plans import job
from loanscore.session import delete_on_exit, scratch_path
from loanscore.sources import sinks
from loanscore.sources.csv import read_applications_csv, write_applications_csv
from loanscore.sources.fixture import BIG_ID_CHANGES, FIXTURE_COLUMNS, applications_from_star

ORACLE_BITS = 256

# Changed levels and weights for the custom-levels check (not the defaults).
CUSTOM_LEVELS = Levels(very_bad=-100.0, bad=50.0, ok=200.0, good=400.0, very_good=600.0,
                       unacceptable=-1000.0, no_points=10.0)
CUSTOM_WEIGHTS = Weights(payments=0.3, defaults=0.2, inquiries=0.2, loan=0.1, personal=0.2)

Query = Callable[[SparkSession, str], DataFrame]


def keyed(spark: SparkSession, sf_dir: str, bits: int = ORACLE_BITS) -> DataFrame:
    return with_member_key(applications_from_star(spark, sf_dir), bits)


def kept(spark: SparkSession, sf_dir: str, bits: int = ORACLE_BITS) -> DataFrame:
    """Keyed rows without those that have no profile, tested before the key is needed."""
    return drop_empty_profiles(keyed(spark, sf_dir, bits), "member_id", bits)


# ------------------------------------------------------- sources and keys


def q_csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = delete_on_exit(spark, scratch_path(spark, "raw-csv"))
    write_applications_csv(applications_from_star(spark, sf_dir), path)
    return read_applications_csv(spark, path).select(*FIXTURE_COLUMNS)


def _subject_sink(mod, folder: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        cleaned = mod.clean(mod.details(kept(spark, sf_dir)), ORACLE_BITS, kept=True)
        path = sinks.save_subject(cleaned, delete_on_exit(spark, scratch_path(spark, "cleaned")), folder)
        return unstamped(sinks.read_table(spark, path, cleaned.schema))

    return run


def q_job_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job, its six outputs read back and joined: one row for each loan."""
    raw = applications_from_star(spark, sf_dir)
    root = delete_on_exit(spark, scratch_path(spark, "job"))
    job.run(spark, raw, f"{root}/cleaned", f"{root}/points", ORACLE_BITS)
    k = keyed(spark, sf_dir)
    rows = {}
    for folder, mod in JOB_FOLDERS.items():
        schema = mod.clean(mod.details(k), ORACLE_BITS).schema
        table = unstamped(sinks.read_table(spark, f"{root}/cleaned/{folder}", schema))
        rows[folder] = table.select(*[F.col(c).alias(f"{folder.lower()}_{c}") for c in table.columns])
    points = sinks.read_table(spark, f"{root}/points", combine.member_scores(k, ORACLE_BITS).schema)
    rows["Points"] = points.select(*[F.col(c).alias(f"points_{c}") for c in points.columns])
    member = F.col(f"loan_{loan.KEY}")
    out = rows["Loan"].join(rows["Payment"], F.col("loan_id") == F.col("payment_id"), "left")
    for folder, key in (("Personal", personal.KEY), ("Defaults", defaults.KEY), ("Inquires", inquiries.KEY), ("Points", personal.KEY)):
        out = out.join(rows[folder], member == F.col(f"{folder.lower()}_{key}"), "left")
    return out


def q_points_sink_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    pts = combine.member_scores(keyed(spark, sf_dir), ORACLE_BITS)
    path = sinks.save_points(pts, delete_on_exit(spark, scratch_path(spark, "points")))
    return sinks.read_table(spark, path, pts.schema)


def q_member_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = applications_from_star(spark, sf_dir)
    return raw.select(
        "id",
        member_key(ORACLE_BITS).alias("member_id"),
        F.length(member_key(512)).alias("key512_len"),
    )


def q_drop_empty_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_empty_profiles(keyed(spark, sf_dir), "member_id", ORACLE_BITS).select("id", "member_id")


def q_ingest_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = loan.clean(loan.details(kept(spark, sf_dir)), ORACLE_BITS, kept=True)
    return cleaned.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("ingestion_date").alias("stamped"),
        F.count_distinct("ingestion_date").alias("stamps"),
    )


def q_issue_date_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = applications_from_star(spark, sf_dir)
    return raw.select("id", "issue_d", to_month_date("issue_d").alias("issue_date"))


def q_lenient_ints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Integers as text: each order's price, key and month, in accepted and rejected spellings."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    key, price = F.col("o_orderkey").cast("string"), F.col("o_totalprice").cast("string")
    spellings = (
        price,
        F.concat(F.lit("-"), price),
        F.concat(F.lit(" "), key, F.lit(" ")),
        F.concat(key, F.lit(".")),
        F.concat(F.lit("."), key),
        F.concat(F.lit("000"), key, F.lit(".0")),
        F.concat(key, F.lit("e3")),
        F.concat(F.year("o_orderdate").cast("string"), F.lit("-"), F.month("o_orderdate").cast("string")),
    )
    text = F.element_at(F.array(*spellings), (F.col("o_orderkey") % len(spellings) + 1).cast("int"))
    rows = orders.select("o_orderkey", text.alias("text"))
    return rows.select("o_orderkey", to_int_trunc("text").alias("value"))


# --------------------------------------------------------------- subjects

_SUBJECTS = {
    "personal": personal,
    "payment": payment,
    "defaults": defaults,
    "inquiries": inquiries,
    "loan": loan,
}
JOB_FOLDERS = {"Personal": personal, "Payment": payment, "Defaults": defaults, "Inquires": inquiries, "Loan": loan}


def _details(mod) -> Query:
    return lambda spark, sf: unranked(mod.details(keyed(spark, sf)))


def _typed(mod) -> Query:
    return lambda spark, sf: unranked(mod.typed(mod.details(kept(spark, sf)), ORACLE_BITS, kept=True))


def _filled(mod) -> Query:
    return lambda spark, sf: unranked(mod.filled(mod.typed(mod.details(kept(spark, sf)), ORACLE_BITS, kept=True)))


def _clean(mod) -> Query:
    return lambda spark, sf: unstamped(mod.clean(mod.details(kept(spark, sf)), ORACLE_BITS, kept=True))


def _latest(mod) -> Query:
    if mod in (payment, loan):
        # deduplicated in scoring, from the cleaned rows
        return lambda spark, sf: mod.latest(mod.clean_rows(mod.details(kept(spark, sf)), ORACLE_BITS, kept=True))
    return lambda spark, sf: mod.latest(mod.filled(mod.typed(mod.details(kept(spark, sf)), ORACLE_BITS, kept=True)))


def _points(mod) -> Query:
    if mod is payment:
        return lambda spark, sf: combine.payment_points(keyed(spark, sf), ORACLE_BITS)
    if mod is loan:
        return lambda spark, sf: combine.loan_points(keyed(spark, sf), ORACLE_BITS)
    return lambda spark, sf: unstamped(mod.points(mod.clean(mod.details(kept(spark, sf)), ORACLE_BITS, kept=True)))


def q_inquiries_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inquiries.rollup(inquiries.filled(inquiries.typed(inquiries.details(kept(spark, sf_dir)), ORACLE_BITS, kept=True)))


def q_grade_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = combine.member_rows(keyed(spark, sf_dir), ("grade", "sub_grade"), ORACLE_BITS)
    return rows.select(F.col("member_id").alias(personal.KEY), "grade", "sub_grade", GRADE.column())


def q_loan_ladder_extras(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = combine.member_rows(keyed(spark, sf_dir), ("annual_inc", "loan_amnt", "tot_hi_cred_lim"), ORACLE_BITS)
    return rows.select(
        F.col("member_id").alias(loan.KEY), "annual_inc", "loan_amnt", "tot_hi_cred_lim", INCOME.column(), CREDIT_LINE.column()
    )


# ---------------------------------------------------------------- combine


def q_final_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return combine.final_points_joined(keyed(spark, sf_dir), ORACLE_BITS)


def q_final_points_fused(spark: SparkSession, sf_dir: str) -> DataFrame:
    return combine.member_scores(keyed(spark, sf_dir), ORACLE_BITS)


def q_final_points_custom_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return combine.member_scores(keyed(spark, sf_dir), ORACLE_BITS, CUSTOM_LEVELS, CUSTOM_WEIGHTS)


def q_mdm_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mdm.mdm_view(keyed(spark, sf_dir), ORACLE_BITS)


def q_mdm_sql_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = kept(spark, sf_dir)
    # personal and defaults are cleaned from the latest rows alone, which both take from one shared aggregate
    latest = combine.latest_raw_rows(k, ORACLE_BITS)
    rows = {**dict.fromkeys(_SUBJECTS, k), "personal": latest, "defaults": latest}
    cleaned = {name: unstamped(mod.clean(mod.details(rows[name]), ORACLE_BITS, kept=True)) for name, mod in _SUBJECTS.items()}
    mdm.register_subject_views(*[cleaned[name] for name in ("loan", "personal", "payment", "defaults", "inquiries")])
    return mdm.create_mdm_sql_view(spark)


def q_big_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores and latest amounts where ids pass the INT range and a member's loans share one month."""
    k = with_member_key(applications_from_star(spark, sf_dir, BIG_ID_CHANGES), ORACLE_BITS)
    latest = combine.member_rows(k, ("loan_amnt", "total_rec_prncp"), ORACLE_BITS)
    scores = combine.member_scores(k, ORACLE_BITS)
    return scores.join(latest.withColumnRenamed("member_id", personal.KEY), personal.KEY)


def _written(df: DataFrame, name: str) -> DataFrame:
    """The frame written once to the shared checkpoint folder and read back: its rows are derived once for all readers."""
    path = delete_on_exit(df.sparkSession, scratch_path(df.sparkSession, name))
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def q_tied_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores where a member's loans share month and id (or have no id), in three forms that must agree.

    For each kind of tie: members, and how many of them the join form or the
    ladder inputs' form score otherwise than the fused form.
    """
    raw = applications_from_star(spark, sf_dir, BIG_ID_CHANGES)
    out = []
    for tie, ident in (("same id", F.lit("7")), ("no id", F.lit(None).cast("string"))):
        k = _written(with_member_key(raw.withColumn("id", ident), ORACLE_BITS), "tied")  # read by four aggregates
        forms = {
            "fused": combine.member_scores(k, ORACLE_BITS),
            "joined": combine.final_points_joined(k, ORACLE_BITS),
            "rows": combine.member_points(k, ORACLE_BITS).withColumnRenamed("member_id", personal.KEY).select(*combine.FINAL_COLUMNS),
        }
        marked = [f.select(F.lit(name).alias("form"), personal.KEY, F.xxhash64(*combine.FINAL_COLUMNS).alias("scores")) for name, f in forms.items()]
        members = reduce(DataFrame.unionByName, marked).groupBy(personal.KEY)
        one = {name: F.max(F.when(F.col("form") == name, F.col("scores"))) for name in forms}
        compared = members.agg(*[(~one["fused"].eqNullSafe(one[name])).alias(name) for name in ("joined", "rows")])
        out.append(
            compared.agg(
                F.lit(tie).alias("tie"),
                F.count(F.lit(1)).alias("members"),
                F.count_if("joined").alias("joined_differ"),
                F.count_if("rows").alias("rows_differ"),
            )
        )
    return reduce(DataFrame.unionByName, out)


# ---------------------------------------------------------------- quality


def q_dq_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = kept(spark, sf_dir)
    return quality.domain_values(
        combine.member_rows(k, ("home_ownership", "grade", "sub_grade"), ORACLE_BITS),
        payment.clean(payment.details(k), ORACLE_BITS, kept=True),
        loan.clean(loan.details(k), ORACLE_BITS, kept=True),
    )


def q_dq_golden(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.golden_differences(spark, q_dq_domain(spark, sf_dir))


def q_dq_maxima(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = [c for c, _ in quality.MAXIMA if c != "chargeoff_within_12_mths"]
    rows = combine.member_rows(keyed(spark, sf_dir), wanted, ORACLE_BITS, extra_aggs=inquiries.rollup_aggs())
    return quality.maxima(rows.withColumns({"chargeoff_within_12_mths": inquiries.outlier_columns()["chargeoff_within_12_mths"]}))


def q_dq_bad_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.bad_states(combine.member_rows(keyed(spark, sf_dir), ("addr_state",), ORACLE_BITS))


def q_dq_duplicate_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicate_ids(loan.clean(loan.details(kept(spark, sf_dir)), ORACLE_BITS, kept=True))


def q_dq_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.funnel(keyed(spark, sf_dir), ORACLE_BITS)


def q_dq_ladder_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    cases = [
        *quality.PERSONAL_CASES,
        *quality.PAYMENT_CASES,
        *quality.DEFAULTS_CASES,
        *quality.INQUIRIES_CASES,
        *quality.LOAN_CASES,
    ]
    return quality.ladder_violations(combine.member_points(keyed(spark, sf_dir), ORACLE_BITS), cases)


def q_dq_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals against their parts in a points table that was written and read back."""
    path = delete_on_exit(spark, scratch_path(spark, "points"))
    combine.member_points(keyed(spark, sf_dir), ORACLE_BITS).write.parquet(path)
    return quality.totals(spark.read.parquet(path))


def registry() -> dict[str, Query]:
    q: dict[str, Query] = {
        "csv_scan": q_csv_scan,
        "subject_sink_roundtrip": _subject_sink(loan, "Loan"),
        "lenient_ints": q_lenient_ints,
        "job_outputs": q_job_outputs,
        "points_sink_roundtrip": q_points_sink_roundtrip,
        "member_key": q_member_key,
        "drop_empty_profiles": q_drop_empty_profiles,
        "ingest_stamp": q_ingest_stamp,
        "issue_date_parse": q_issue_date_parse,
    }
    for name, mod in _SUBJECTS.items():
        q[f"{name}_details"] = _details(mod)
        q[f"{name}_typed"] = _typed(mod)
        q[f"{name}_fill"] = _filled(mod)
        q[f"{name}_latest"] = _latest(mod)
        q[f"{name}_clean"] = _clean(mod)
        q[f"{name}_points"] = _points(mod)
    for folder, mod in JOB_FOLDERS.items():
        if mod is not loan:
            q[f"{folder.lower()}_sink_roundtrip"] = _subject_sink(mod, folder)
    q.update(
        {
            "inquiries_rollup": q_inquiries_rollup,
            "grade_points": q_grade_points,
            "loan_ladder_extras": q_loan_ladder_extras,
            "final_points": q_final_points,
            "final_points_fused": q_final_points_fused,
            "final_points_custom_levels": q_final_points_custom_levels,
            "mdm_view": q_mdm_view,
            "mdm_sql_view": q_mdm_sql_view,
            "big_ids": q_big_ids,
            "dq_domain": q_dq_domain,
            "dq_maxima": q_dq_maxima,
            "dq_bad_state": q_dq_bad_state,
            "dq_duplicate_ids": q_dq_duplicate_ids,
            "dq_funnel": q_dq_funnel,
            "dq_ladder_violations": q_dq_ladder_violations,
            "dq_golden": q_dq_golden,
            "tied_rows": q_tied_rows,
            "dq_totals": q_dq_totals,
        }
    )
    return q
