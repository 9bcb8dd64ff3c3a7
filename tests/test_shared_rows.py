"""The join form and the SQL view derive the raw rows few times; queries keep generated code compiled."""

import pytest
from pyspark.sql import functions as F

from loanscore.functions.keys import with_member_key
from loanscore.operators import combine
from loanscore.plans import queries
from loanscore.session import keep_code_compiled
from loanscore.sources.fixture import applications_from_star

SMOKE = "/root/testdata/sf0.001"
LIMIT = "spark.sql.codegen.hugeMethodLimit"


@pytest.mark.parametrize("key, hashes", [("final_points", 2), ("mdm_sql_view", 4)])
def test_consumers_of_the_latest_row_share_its_exchange(spark, key, hashes):
    df = queries.registry()[key](spark, SMOKE)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("sha2(") <= hashes


def test_latest_raw_rows_hold_the_greatest_rank(spark):
    raw = applications_from_star(spark, SMOKE).withColumn("id", F.lit(None).cast("string"))
    k = with_member_key(raw, 256)
    latest = combine.latest_raw_rows(k.unionByName(k), 256)
    assert latest.count() == latest.select("member_id").distinct().count()
    assert latest.select("_row").exceptAll(k.select("_row")).count() == 0
    again = combine.latest_raw_rows(k.orderBy(F.rand(3)).repartition(5), 256)
    assert latest.exceptAll(again).count() == 0 and again.exceptAll(latest).count() == 0


def test_queries_lower_the_limit_of_compiled_methods(spark):
    kept = spark.conf.get(LIMIT)
    try:
        spark.conf.set(LIMIT, "65535")
        applications_from_star(spark, SMOKE)
        assert spark.conf.get(LIMIT) == "8000"
        spark.conf.set(LIMIT, "4000")
        keep_code_compiled(spark)
        assert spark.conf.get(LIMIT) == "4000"
    finally:
        spark.conf.set(LIMIT, kept)


def test_tied_rows_derives_the_raw_rows_once_for_each_tie(spark, tmp_path):
    orders = spark.range(1, 61).selectExpr(
        "id AS o_orderkey", "id % 5 + 1 AS o_custkey", "id * 1000D AS o_totalprice", "date_add(DATE'1995-01-01', int(id)) AS o_orderdate"
    )
    customer = spark.range(1, 6).selectExpr("id AS c_custkey", "concat('c', id) AS c_name", "id AS c_nationkey", "id * 10D AS c_acctbal")
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    customer.write.parquet(f"{tmp_path}/customer.parquet")
    df = queries.q_tied_rows(spark, str(tmp_path))
    assert not any("orders.parquet" in path for path in df.inputFiles())
    rows = {r.tie: (r.members, r.joined_differ, r.rows_differ) for r in df.collect()}
    assert rows == {"same id": (5, 0, 0), "no id": (5, 0, 0)}
