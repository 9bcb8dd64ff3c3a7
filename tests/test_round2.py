"""Ids of any size, row order, pruned latest rows, stored totals, the MDM forms on repeated ids."""

from functools import reduce

import pytest
from pyspark.sql import functions as F

from loanscore.functions.casts import to_int_trunc, to_long_trunc
from loanscore.functions.keys import drop_empty_profiles, with_member_key
from loanscore.operators import combine, defaults, inquiries, loan, mdm, payment, personal, quality
from loanscore.operators.common import unstamped
from loanscore.plans import queries
from loanscore.sources.fixture import BIG_ID_CHANGES, applications_from_star

SMOKE = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture(scope="module")
def big(spark):
    return with_member_key(applications_from_star(spark, SMOKE, BIG_ID_CHANGES), 256)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_row_order_does_not_matter_for_ids_beyond_int(spark, big):
    want = rows(combine.member_scores(big, 256))
    for seed, parts in ((3, 1), (5, 7)):
        assert rows(combine.member_scores(big.orderBy(F.rand(seed)).repartition(parts), 256)) == want
    assert want == rows(combine.final_points_joined(big, 256))


@pytest.mark.parametrize("ident", ["7", None])
def test_rows_equal_in_month_and_id_give_one_row_to_every_consumer(spark, ident):
    raw = applications_from_star(spark, SMOKE, BIG_ID_CHANGES).withColumn("id", F.lit(ident).cast("string"))
    same = with_member_key(raw, 256)
    want = rows(combine.member_scores(same, 256))
    shuffled = with_member_key(raw.orderBy(F.rand(1)).repartition(5).select(*reversed(raw.columns)), 256)
    assert rows(combine.member_scores(shuffled, 256)) == want
    assert rows(combine.final_points_joined(same, 256)) == want
    points = combine.member_points(same, 256).withColumnRenamed("member_id", "personal_member_id")
    assert rows(points.select(*combine.FINAL_COLUMNS)) == want
    # two consumers that read different columns take them from the same row
    both = combine.member_rows(same, ("loan_amnt", "total_rec_prncp"), 256).select("member_id", "loan_amnt")
    assert rows(both) == rows(combine.member_rows(same, ("loan_amnt",), 256))


def test_rank_stays_in_a_hash_aggregate(big):
    for df in (
        combine.member_scores(big, 256),
        combine.member_rows(big, ("annual_inc", "loan_amnt"), 256),
        defaults.clean(defaults.details(big), 256),
    ):
        plan = plan_of(df)
        assert "SortAggregate" not in plan and "partial_max_by" in plan


def test_integer_text_spellings(spark):
    cases = {"12": 12, " 12 ": 12, "12.9": 12, "-12.9": -12, ".5": 0, ".": 0, "-.7": 0, "12\t": 12, "12\x01": 12, "": None, "-": None,
             "1e3": None, "1.2.3": None, "2147483648": None, "3000000000.0": None}
    frame = spark.createDataFrame([(k,) for k in cases], "t string")
    got = {r.t: (r.a, r.b) for r in frame.select("t", to_int_trunc("t").alias("a"), to_int_trunc(F.col("t")).alias("b")).collect()}
    assert got == {k: (v, v) for k, v in cases.items()}
    assert frame.where("t = '3000000000.0'").select(to_long_trunc("t")).first()[0] == 3_000_000_000


@pytest.mark.parametrize("mod", [personal, payment, defaults, inquiries, loan])
def test_the_key_is_hashed_once(keyed_smoke, mod):
    assert optimized(mod.clean(mod.details(drop_empty_profiles(keyed_smoke, "member_id", 256)), 256, kept=True)).count("sha2(") == 1


@pytest.mark.parametrize("key", ["payment_points", "loan_points", "loan_ladder_extras", "grade_points", "dq_bad_state", "dq_maxima"])
def test_one_member_exchange_and_only_named_columns(spark, key):
    df = queries.registry()[key](spark, SMOKE)
    plan = plan_of(df)
    assert plan.count("Exchange hashpartitioning(_key") == 1
    if key in ("loan_ladder_extras",):
        assert "SortAggregate" not in plan
    if key != "payment_points":
        assert "Mar-2019" not in plan  # the last payment's month is not even built


def test_building_a_query_writes_nothing(spark, monkeypatch):
    from pyspark.sql.readwriter import DataFrameWriter

    def refuse(*args, **kwargs):
        raise AssertionError("a query wrote while it was built")

    for method in ("parquet", "csv", "save"):
        monkeypatch.setattr(DataFrameWriter, method, refuse)
    written = {"csv_scan", "points_sink_roundtrip", "subject_sink_roundtrip", "job_outputs", "dq_totals"}
    for key, query in queries.registry().items():
        if key not in written and not key.endswith("_sink_roundtrip"):
            query(spark, SMOKE)


def test_totals_are_compared_in_the_stored_table(spark, keyed_smoke, tmp_path):
    path = str(tmp_path / "points")
    combine.member_points(keyed_smoke, 256).write.parquet(path)
    stored = spark.read.parquet(path)
    check = quality.totals(stored)
    assert "0 AS mismatches" not in optimized(check)
    assert {r.subject: r.mismatches for r in check.collect() if r.subject != "final"} == dict.fromkeys(
        ("personal", "payment", "defaults", "inquiries", "loan"), 0
    )
    off = {t: F.when(F.col("member_id").endswith("0"), F.col(t) + n * n + 1).otherwise(F.col(t)) for n, (_, t, _) in enumerate(quality.TOTALS)}
    broken = stored.withColumns(off)
    assert all(r.mismatches > 0 for r in quality.totals(broken).collect())


def test_mdm_with_ids_beyond_int_keeps_payments(big):
    view = mdm.mdm_view(big, 256)
    assert view.where("id IS NOT NULL").count() == 0  # the id column is an int, as the rules say
    assert view.where("total_pymnt IS NULL").count() == 0


def test_repeated_ids_are_counted_and_only_the_view_multiplies_them(spark, keyed_smoke):
    k = keyed_smoke.union(keyed_smoke.where("member_id != sha2('', 256)").limit(40))
    cleaned = {m: unstamped(m.clean(m.details(k), 256)) for m in (loan, personal, payment, defaults, inquiries)}
    counts = quality.duplicate_ids(cleaned[loan]).first()
    assert (counts.ids, counts.rows) == (40, 80)
    mdm.register_subject_views(*[cleaned[m] for m in (loan, personal, payment, defaults, inquiries)])
    assert mdm.create_mdm_sql_view(spark, "repeated").count() == mdm.mdm_view(k, 256).count() + 80


def test_a_hot_member_is_split_in_the_mdm_join(spark, keyed_smoke):
    from loanscore.schema import PROFILE_COLUMNS

    hot = F.col("id").try_cast("long") % 2 == 0
    raw = keyed_smoke.drop("member_id").withColumns({c: F.when(hot, F.lit("H")).otherwise(F.col(c)) for c in PROFILE_COLUMNS})
    raw = reduce(lambda a, b: a.unionByName(b), [raw] * 20).repartition(8)
    keep = {}
    wanted = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    for name, value in wanted.items():
        keep[name] = spark.conf.get(name, None)
        spark.conf.set(name, value)
    try:
        view = mdm.mdm_view(with_member_key(raw, 256), 256)
        view.collect()
        assert "skew=true" in plan_of(view)
    finally:
        for name, value in keep.items():
            spark.conf.set(name, value) if value is not None else spark.conf.unset(name)
