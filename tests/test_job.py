"""The whole job writes five cleaned subjects and the points table."""

import os

from loanscore.plans import job
from loanscore.sources.fixture import applications_from_star
from loanscore.operators import combine
from loanscore.functions.keys import with_member_key

SMOKE = "/root/testdata/sf0.001"


def test_job_outputs(spark):
    raw = applications_from_star(spark, SMOKE)
    cleaned, points = job.default_output_dirs(spark)
    out = job.run(spark, raw, cleaned, points, bits=512)
    for folder in job.SUBJECT_FOLDERS:
        assert os.path.isdir(os.path.join(cleaned.replace("file:", ""), folder))
    pts = spark.read.option("header", True).csv(points)
    want = combine.member_scores(with_member_key(raw, 512), 512)
    assert pts.count() == want.count()
    assert len(pts.first().personal_member_id) == 128
    per = spark.read.option("header", True).csv(os.path.join(cleaned, "Personal"))
    assert per.count() == want.count()
    pay = spark.read.option("header", True).csv(os.path.join(cleaned, "Payment"))
    assert pay.count() == raw.where("grade is not null or sub_grade is not null").count()
    # intermediate tables are removed once the outputs are committed
    assert not os.path.exists(out.base_table.replace("file:", ""))
    assert not os.path.exists(out.profile_table.replace("file:", ""))


def test_command_line_job_from_csv(spark):
    from loanscore.session import scratch_path
    from loanscore.sources.csv import write_applications_csv

    raw = applications_from_star(spark, SMOKE)
    csv_path = write_applications_csv(raw, scratch_path(spark, "t-rawcsv"))
    cleaned, points = job.default_output_dirs(spark)
    job.main([csv_path, cleaned, points, "--format", "parquet"], spark=spark)
    got = spark.read.parquet(points)
    want = combine.member_scores(with_member_key(raw, 512), 512)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0

