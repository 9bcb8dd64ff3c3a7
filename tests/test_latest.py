"""Latest row per member: ordering, ties, skew, and plan shape."""

import datetime as dt

from pyspark.sql import functions as F

from loanscore.operators.common import latest_per_member


def frame(spark, rows):
    return spark.createDataFrame(rows, "m string, issue_d date, id int, v double, s string")


def test_order_and_nulls_last(spark):
    d = dt.date
    rows = [
        ("a", d(2015, 1, 1), 5, 1.0, "old"),
        ("a", d(2016, 1, 1), 1, 2.0, "new"),
        ("a", None, 9, 3.0, "null-date"),
        ("b", d(2016, 1, 1), 1, 4.0, "low-id"),
        ("b", d(2016, 1, 1), 7, 5.0, "high-id"),
        ("b", d(2016, 1, 1), None, 6.0, "null-id"),
        ("c", None, None, 7.0, "only"),
    ]
    out = {r.m: (r.v, r.s) for r in latest_per_member(frame(spark, rows), "m", ["v", "s"]).collect()}
    assert out == {"a": (2.0, "new"), "b": (5.0, "high-id"), "c": (7.0, "only")}


def test_fixed_width_uses_hash_aggregate_with_partial_step(spark):
    df = frame(spark, [("a", dt.date(2015, 1, 1), 1, 1.0, "x")])
    plan = latest_per_member(df, "m", ["v", "id"])._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan
    assert "partial_max_by" in plan


def test_hot_member_is_combined_before_the_shuffle(spark):
    """A member holding a third of all rows still gives the right latest row,
    and the map side reduces it to one row per task before the exchange."""
    n = 30000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("m"), F.col("id").cast("string"))).alias("m"),
        F.date_add(F.lit("2010-01-01").cast("date"), (F.col("id") % 97).cast("int")).alias("issue_d"),
        F.col("id").cast("int").alias("id"),
        F.col("id").cast("double").alias("v"),
        F.lit("s").alias("s"),
    ).repartition(8)
    out = latest_per_member(df, "m", ["v"])
    hot = out.where("m = 'hot'").collect()[0]
    # latest month for id%3==0 rows: the largest id%97 among multiples of 3, then the largest id
    expect = (
        df.where("m = 'hot'").orderBy(F.col("issue_d").desc(), F.col("id").desc()).limit(1).collect()[0].v
    )
    assert hot.v == expect
    assert out.count() == n - n // 3 + 1
    # shuffle records: at most one per (task, member) reaches the exchange for the hot key
    import re

    plan = out._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"partial_max_by", plan)
