"""Invariants of the member totals on the sf0.001 fixture."""

from pyspark.sql import functions as F

from loanscore.operators import combine
from loanscore.plans.queries import CUSTOM_LEVELS, CUSTOM_WEIGHTS


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_fused_equals_join_form(keyed_smoke):
    fused = combine.member_scores(keyed_smoke, 256)
    joined = combine.final_points_joined(keyed_smoke, 256)
    assert fused.columns == joined.columns
    assert fused.exceptAll(joined).count() == 0 and joined.exceptAll(fused).count() == 0
    assert fused.count() > 0


def test_fused_equals_join_form_custom_levels(keyed_smoke):
    fused = combine.member_scores(keyed_smoke, 256, CUSTOM_LEVELS, CUSTOM_WEIGHTS)
    joined = combine.final_points_joined(keyed_smoke, 256, CUSTOM_LEVELS)
    joined = joined.withColumn("total_points", combine.weighted_total(CUSTOM_WEIGHTS)).select(*combine.FINAL_COLUMNS)
    assert rows(fused) == rows(joined)


def test_one_row_per_member_and_weighted_total(keyed_smoke):
    fused = combine.member_scores(keyed_smoke, 256)
    members = keyed_smoke.where("member_id != sha2('', 256)").select("member_id").distinct().count()
    assert fused.count() == members == fused.select("personal_member_id").distinct().count()
    bad = fused.where(~F.col("total_points").eqNullSafe(combine.weighted_total()))
    assert bad.count() == 0


def test_independent_of_input_order_and_partitions(spark, keyed_smoke):
    base = rows(combine.member_scores(keyed_smoke, 256))
    shuffled = keyed_smoke.orderBy(F.rand(7)).repartition(3)
    assert rows(combine.member_scores(shuffled, 256)) == base
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        assert rows(combine.member_scores(keyed_smoke.coalesce(1), 256)) == base
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_fused_plan_has_one_member_shuffle(keyed_smoke):
    plan = combine.member_scores(keyed_smoke, 256)._jdf.queryExecution().executedPlan().toString()
    # one hash exchange on the member key, hash (not sort) aggregation with a partial step
    assert plan.count("hashpartitioning(_key") == 1
    assert "SortAggregate" not in plan and "partial_max_by" in plan
    # the scan reads only the columns the fixture needs
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_totalprice:double,o_orderdate:timestamp_ntz>" in plan
    assert "o_orderpriority" not in plan and "c_mktsegment" not in plan


def test_hot_member_end_to_end(keyed_smoke):
    """A third of all rows share one profile (one member): fused = join form."""
    from loanscore.functions.keys import with_member_key
    from loanscore.schema import PROFILE_COLUMNS

    hot = F.col("id").try_cast("long") % 3 == 0
    raw = keyed_smoke.drop("member_id").withColumns(
        {c: F.when(hot, F.lit("H" if c != "annual_inc" else "55000.0")).otherwise(F.col(c)) for c in PROFILE_COLUMNS}
    )
    k = with_member_key(raw, 256)
    fused = combine.member_scores(k, 256)
    joined = combine.final_points_joined(k, 256)
    assert rows(fused) == rows(joined)
    top = k.groupBy("member_id").count().orderBy(F.desc("count")).first()
    assert top["count"] >= keyed_smoke.count() // 3 - 5
