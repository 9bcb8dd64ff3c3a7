"""Benchmark of the headline queries.

Runs each query at $BENCH_SF_DIR (default /root/testdata/sf0.1) on
local[$BENCH_CPUS] (default 8), forcing full evaluation with the ``noop``
sink, and prints one JSON line. All queries first run once as a JVM
warm-up (class loading, code generation and JIT dominate a cold run);
then each runs $BENCH_RUNS times (default 3) and the fastest run is
reported. ``job`` is the whole batch job (five cleaned subjects and the
points table written as CSV). ``cold_first_query`` is the first, cold run
of the flagship query, reported separately.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = (
    "final_points_fused",
    "final_points",
    "personal_clean",
    "payment_points",
    "defaults_points",
    "inquiries_points",
    "loan_points",
    "mdm_view",
    "dq_ladder_violations",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))

    from loanscore.plans import job
    from loanscore.plans.queries import registry
    from loanscore.session import local_session
    from loanscore.sources.fixture import applications_from_star

    spark = local_session(cores=cpus, shuffle_partitions=max(cpus, 8), app="loanscore-bench")
    qs = registry()
    times: dict[str, float] = {}

    def timed(name: str, action) -> None:
        best = None
        for _ in range(runs):
            t0 = time.perf_counter()
            action()
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        times[name] = round(best, 3)

    def noop(df) -> None:
        df.write.format("noop").mode("overwrite").save()

    t0 = time.perf_counter()
    noop(qs["final_points_fused"](spark, sf_dir))
    cold = round(time.perf_counter() - t0, 3)
    if os.environ.get("BENCH_WARMUP", "1") == "1":
        noop(applications_from_star(spark, sf_dir))
        for name in HEADLINE:
            noop(qs[name](spark, sf_dir))

    timed("raw_input", lambda: noop(applications_from_star(spark, sf_dir)))

    # CSV is the only real source: the flagship query over a written CSV, and
    # over one with a member of its own for nearly every loan.
    from pyspark.sql import functions as F

    from loanscore.functions.keys import with_member_key
    from loanscore.operators import combine
    from loanscore.sources.csv import read_applications_csv, write_applications_csv

    raw = applications_from_star(spark, sf_dir)
    own_title = F.when(F.col("emp_title").isNotNull(), F.concat("emp_title", F.lit(" "), "id"))
    for name, rows in (("csv_fused", raw), ("csv_near_unique_fused", raw.withColumn("emp_title", own_title))):
        path = write_applications_csv(rows, job.scratch_path(spark, name))
        source = with_member_key(read_applications_csv(spark, path), 512)
        noop(combine.member_scores(source, 512))
        timed(name, lambda k=source: noop(combine.member_scores(k, 512)))
    for name in HEADLINE:
        timed(name, lambda n=name: noop(qs[n](spark, sf_dir)))

    def run_job() -> None:
        cleaned, points = job.default_output_dirs(spark)
        job.run(spark, applications_from_star(spark, sf_dir), cleaned, points)

    timed("job", run_job)

    # Optional scale section: BENCH_REPLICAS disjoint copies of the input.
    replicas = int(os.environ.get("BENCH_REPLICAS", "0"))
    scale: dict[str, float] = {}
    if replicas > 1:
        from loanscore.functions.keys import with_member_key
        from loanscore.operators import combine
        from loanscore.sources.fixture import applications_from_tables, replicated_tables

        o, c = replicated_tables(spark, sf_dir, replicas)
        raw_path = os.path.join(job.scratch_path(spark, "bench-raw"))
        applications_from_tables(o, c).write.parquet(raw_path)
        raw = spark.read.parquet(raw_path)
        keyed = with_member_key(raw, 512)
        for name, make in (
            ("fused", lambda: combine.member_scores(keyed, 512)),
            ("join_form", lambda: combine.final_points_joined(keyed, 512)),
        ):
            t0 = time.perf_counter()
            noop(make())
            scale[name] = round(time.perf_counter() - t0, 3)
        t0 = time.perf_counter()
        cleaned, points = job.default_output_dirs(spark)
        job.run(spark, raw, cleaned, points)
        scale["job"] = round(time.perf_counter() - t0, 3)
        scale["rows"] = raw.count()

    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": sf,
                "cpus": cpus,
                "cold_first_query": cold,
                **({"scale": scale} if scale else {}),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
