"""CSV scan and sinks round trips, each in a fresh folder."""

from loanscore.operators import combine, loan
from loanscore.operators.common import unstamped
from loanscore.session import scratch_path
from loanscore.sources import sinks
from loanscore.sources.csv import read_applications_csv, write_applications_csv
from loanscore.sources.fixture import FIXTURE_COLUMNS, applications_from_star

SMOKE = "/root/testdata/sf0.001"


def test_csv_scan_roundtrip(spark):
    raw = applications_from_star(spark, SMOKE)
    path = scratch_path(spark, "t-raw")
    write_applications_csv(raw, path)
    back = read_applications_csv(spark, path)
    assert len(back.columns) == 151
    back = back.select(*FIXTURE_COLUMNS)
    assert back.dtypes == raw.dtypes
    assert back.exceptAll(raw).count() == 0 and raw.exceptAll(back).count() == 0
    # the leading blank of ' 36 months' survives
    assert back.where("term = ' 36 months'").count() > 0


def test_subject_and_points_sinks(spark, keyed_smoke):
    cleaned = loan.clean(loan.details(keyed_smoke), 256)
    base = scratch_path(spark, "t-cleaned")
    path = sinks.save_subject(cleaned, base, "Loan")
    back = sinks.read_table(spark, path, cleaned.schema)
    assert unstamped(back).exceptAll(unstamped(cleaned)).count() == 0
    assert back.count() == cleaned.count()

    pts = combine.member_scores(keyed_smoke, 256)
    ppath = sinks.save_points(pts, scratch_path(spark, "t-points"), single_file=True)
    import glob

    assert len(glob.glob(ppath.replace("file:", "") + "/part-*.csv")) == 1
    back = sinks.read_table(spark, ppath, pts.schema)
    assert back.exceptAll(pts).count() == 0 and pts.exceptAll(back).count() == 0

