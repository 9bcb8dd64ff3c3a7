"""The whole batch job: raw applications -> five cleaned subjects + member points.

Plan (each numbered step is one Spark job):

1. Raw rows are keyed, footer rows dropped, and the 36 used columns plus the
   key are written once as Parquet under the session's checkpoint folder.
   This cuts the lineage (a lost executor later re-reads this table from
   shared storage instead of re-parsing the raw file) and lets every later
   step read only the columns it needs.
2. Payment and 3. Loan: map-only cleaning of each loan row, written as is.
4. Member profile: one aggregate (one shuffle) builds the cleaned personal,
   defaults and inquiries columns per member; written once as a checkpoint
   table, from which 5-7 write the three per-member subjects.
8. Points: the fused scorer (one shuffle) writes the member totals.

Every write is distributed (one file per task) unless ``single_file`` is set.
The run sets ``spark.sql.codegen.hugeMethodLimit`` to 8000 in its session (README).
The two intermediate tables are deleted once every output is committed
(``keep_intermediate=True`` keeps them), so repeated runs do not leave
copies of the raw data in the checkpoint folder.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from loanscore.functions.keys import drop_empty_profiles, with_member_key
from loanscore.levels import DEFAULT_LEVELS, DEFAULT_WEIGHTS, Levels, Weights
from loanscore.operators import combine, loan, mdm, payment
from loanscore.operators.common import stamp
from loanscore.schema import USED_COLUMNS
from loanscore.session import delete_path, keep_code_compiled, scratch_path
from loanscore.sources import sinks

# Output folder names of the cleaned subjects, one per subject.
SUBJECT_FOLDERS = ("Personal", "Payment", "Defaults", "Inquires", "Loan")


@dataclass(frozen=True)
class JobOutputs:
    cleaned_dir: str
    points_dir: str
    base_table: str
    profile_table: str


def stage_base(raw: DataFrame, bits: int = 512) -> str:
    """Write keyed, non-empty raw rows (used columns only) to the checkpoint folder."""
    spark = raw.sparkSession
    keyed = with_member_key(raw.select(*[c for c in USED_COLUMNS if c in raw.columns]), bits)
    base = drop_empty_profiles(keyed, "member_id", bits)
    path = scratch_path(spark, "base")
    base.write.mode("overwrite").parquet(path)
    return path


def run(
    spark: SparkSession,
    raw: DataFrame,
    cleaned_dir: str,
    points_dir: str,
    bits: int = 512,
    levels: Levels = DEFAULT_LEVELS,
    weights: Weights = DEFAULT_WEIGHTS,
    single_file: bool = False,
    fmt: str = "csv",
    keep_intermediate: bool = False,
) -> JobOutputs:
    keep_code_compiled(spark)
    base_path = stage_base(raw, bits)
    base = spark.read.parquet(base_path)

    sinks.save_subject(payment.clean(payment.details(base), bits, kept=True), cleaned_dir, "Payment", single_file, fmt)
    sinks.save_subject(loan.clean(loan.details(base), bits, kept=True), cleaned_dir, "Loan", single_file, fmt)

    profile_path = scratch_path(spark, "profile")
    mdm.member_profile(base, bits).write.mode("overwrite").parquet(profile_path)
    subjects = mdm.subjects_from_profile(spark.read.parquet(profile_path))
    for name, folder in (("personal", "Personal"), ("defaults", "Defaults"), ("inquiries", "Inquires")):
        sinks.save_subject(stamp(subjects[name]), cleaned_dir, folder, single_file, fmt)

    points = combine.member_scores(base, bits, levels, weights)
    sinks.save_points(points, points_dir, single_file, fmt)
    if not keep_intermediate:
        delete_path(spark, profile_path)
        delete_path(spark, base_path)
    return JobOutputs(cleaned_dir, points_dir, base_path, profile_path)


def default_output_dirs(spark: SparkSession) -> tuple[str, str]:
    root = scratch_path(spark, "job")
    return os.path.join(root, "cleaned_data"), os.path.join(root, "points_data")


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> JobOutputs:
    """Command line: ``spark-submit --py-files loanscore.zip loanscore/plans/job.py
    RAW_CSV CLEANED_DIR POINTS_DIR`` (or ``python -m loanscore.plans.job ...``
    with ``spark.master`` configured).

    Reads the raw application CSV with the fixed schema and runs the whole
    job. The session comes from ``spark-submit`` (or the caller); nothing
    about masters, memory or paths is hard-coded.
    """
    import argparse

    from loanscore.sources.csv import read_applications_csv

    ap = argparse.ArgumentParser(prog="loanscore.plans.job")
    ap.add_argument("raw_csv")
    ap.add_argument("cleaned_dir")
    ap.add_argument("points_dir")
    ap.add_argument("--format", default="csv", choices=("csv", "parquet"))
    ap.add_argument("--single-file", action="store_true")
    ap.add_argument("--bits", type=int, default=512, choices=(224, 256, 384, 512))
    ap.add_argument("--keep-intermediate", action="store_true")
    args = ap.parse_args(argv)
    spark = spark or SparkSession.builder.appName("loanscore-job").getOrCreate()
    raw = read_applications_csv(spark, args.raw_csv)
    return run(
        spark,
        raw,
        args.cleaned_dir,
        args.points_dir,
        bits=args.bits,
        single_file=args.single_file,
        fmt=args.format,
        keep_intermediate=args.keep_intermediate,
    )


if __name__ == "__main__":
    main()
