"""Raw application table derived from the driver's star-schema tables.

The raw loan file is not available, so the test input is one row per order
joined to its customer, about ten loans per customer profile. Every value is
integer arithmetic on the order key ``o`` and customer key ``k`` (plus a few
customer columns), written as SQL expressions that Spark (ANSI on) and DuckDB
evaluate the same way. Spark runs them through ``selectExpr`` on top of a
DataFrame join, so the scan keeps column pruning and Catalyst chooses the
join strategy from table statistics.

Every column is null on a "junk" row (a footer-like record whose profile is
wholly null), except ``id``, which then holds footer text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loanscore.schema import RAW_TYPES
from loanscore.session import keep_code_compiled

# Inner projection: keys, junk flag and helper values.
INNER = (
    ("o", "o"),
    ("k", "k"),
    ("junk", "o % 500 = 7"),
    ("g", "substr('ABCDEFG', CAST(k%7+1 AS INT), 1)"),
    ("sg", "CAST(floor(k/7) AS BIGINT)%5+1"),
    ("c_name", "c_name"),
    ("c_nationkey", "c_nationkey"),
    ("c_acctbal", "c_acctbal"),
    ("o_orderdate", "o_orderdate"),
    ("amt", "CAST(floor(o_totalprice/5) AS DOUBLE)"),
)

_EMP = (
    "CASE WHEN k%3=0 THEN CAST(CAST(floor(k/3) AS BIGINT)%11 AS STRING) ELSE CASE k%13 "
    "WHEN 0 THEN '< 1 year' WHEN 1 THEN '1 year' WHEN 2 THEN '2 years' WHEN 3 THEN '3 years' "
    "WHEN 4 THEN '4 years' WHEN 5 THEN '5 years' WHEN 6 THEN '6 years' WHEN 7 THEN '7 years' "
    "WHEN 8 THEN '8 years' WHEN 9 THEN '9 years' WHEN 10 THEN '10+ years' WHEN 11 THEN 'n/a' "
    "WHEN 12 THEN NULL END END"
)
_STATUS = (
    "CASE o%11 WHEN 0 THEN 'Fully Paid' WHEN 1 THEN 'Does not meet the credit policy. Status:Fully Paid' "
    "WHEN 2 THEN 'Charged Off' WHEN 3 THEN 'Does not meet the credit policy. Status:Charged Off' "
    "WHEN 4 THEN 'Late (31-120 days)' WHEN 5 THEN 'Late (16-30 days)' WHEN 6 THEN 'Current' "
    "WHEN 7 THEN 'In Grace Period' WHEN 8 THEN 'Default' WHEN 9 THEN 'Issued' WHEN 10 THEN NULL END"
)
_PURPOSE = (
    "CASE o%16 WHEN 0 THEN 'debt_consolidation' WHEN 1 THEN 'credit_card' WHEN 2 THEN 'home_improvement' "
    "WHEN 3 THEN 'major_purchase' WHEN 4 THEN 'medical' WHEN 5 THEN 'small_business' WHEN 6 THEN 'car' "
    "WHEN 7 THEN 'vacation' WHEN 8 THEN 'moving' WHEN 9 THEN 'house' WHEN 10 THEN 'wedding' "
    "WHEN 11 THEN 'renewable_energy' WHEN 12 THEN 'educational' WHEN 13 THEN 'other' "
    "WHEN 14 THEN 'spaceship' WHEN 15 THEN NULL END"
)

# (column, expression); the type comes from the raw schema.
COLUMNS = (
    ("id", "CASE WHEN junk THEN 'Total amount funded in policy code 1' ELSE CAST(o AS STRING) END"),
    ("grade", "CASE WHEN k%97=5 THEN NULL ELSE g END"),
    ("sub_grade", "concat(g, CAST(sg AS STRING))"),
    ("emp_title", "CASE WHEN k%41=3 THEN NULL ELSE c_name END"),
    ("emp_length", _EMP),
    (
        "verification_status",
        "CASE CAST(floor(k/2) AS BIGINT)%3 WHEN 0 THEN 'Verified' WHEN 1 THEN 'Source Verified' "
        "WHEN 2 THEN 'Not Verified' END",
    ),
    (
        "home_ownership",
        "CASE CAST(floor(k/4) AS BIGINT)%6 WHEN 0 THEN 'OWN' WHEN 1 THEN 'RENT' WHEN 2 THEN 'MORTGAGE' "
        "WHEN 3 THEN 'ANY' WHEN 4 THEN 'NONE' WHEN 5 THEN NULL END",
    ),
    (
        "annual_inc",
        "CASE WHEN k%89=1 THEN '2500000.0' WHEN k%53=2 THEN NULL WHEN k%61=4 THEN 'abc' "
        "ELSE concat(CAST(CAST(floor(abs(c_acctbal)*20) AS BIGINT) AS STRING),'.0') END",
    ),
    (
        "zip_code",
        "CASE WHEN k%37=0 THEN '12' WHEN k%43=0 THEN 'abcde' "
        "ELSE concat(lpad(CAST(k%1000 AS STRING),3,'0'),'xx') END",
    ),
    (
        "addr_state",
        "CASE WHEN k%47=0 THEN '94111' ELSE substr('AKALARAZCACOCTDEFLGAHIIAIDILINKSKYLAMAMDMEMIMNMOMS', "
        "CAST(c_nationkey*2+1 AS INT), 2) END",
    ),
    ("loan_amnt", "CASE WHEN o%83=0 THEN NULL ELSE amt END"),
    (
        "tot_hi_cred_lim",
        "amt * CASE o%8 WHEN 0 THEN 0.4 WHEN 1 THEN 0.6 WHEN 2 THEN 0.9 WHEN 3 THEN 1.2 WHEN 4 THEN 1.8 "
        "WHEN 5 THEN 2.5 WHEN 6 THEN NULL WHEN 7 THEN 0.0 END",
    ),
    (
        "issue_d",
        "CASE WHEN o%501=8 THEN NULL WHEN o%503=9 THEN 'bad' ELSE concat(substr("
        "'JanFebMarAprMayJunJulAugSepOctNovDec', CAST((month(o_orderdate)-1)*3+1 AS INT), 3),'-',"
        "CAST(year(o_orderdate) AS STRING)) END",
    ),
    ("term", "CASE WHEN o%2=0 THEN ' 36 months' ELSE ' 60 months' END"),
    ("installment", "CASE WHEN o%101=5 THEN NULL ELSE CAST(floor(amt/36) AS DOUBLE) END"),
    ("loan_status", _STATUS),
    ("purpose", _PURPOSE),
    (
        "total_rec_late_fee",
        "CASE WHEN o%59=0 THEN NULL ELSE CASE o%7 WHEN 0 THEN '0.0' WHEN 1 THEN '500.0' WHEN 2 THEN '1000.0' "
        "WHEN 3 THEN '5000.0' WHEN 4 THEN '10000.0' WHEN 5 THEN '25000.0' WHEN 6 THEN '40000.0' END END",
    ),
    (
        "delinq_2yrs",
        "CASE o%6 WHEN 0 THEN '0.0' WHEN 1 THEN '1.0' WHEN 2 THEN '2.0' WHEN 3 THEN '3.0' WHEN 4 THEN '30.0' "
        "WHEN 5 THEN NULL END",
    ),
    (
        "acc_now_delinq",
        "CASE CAST(floor(o/6) AS BIGINT)%4 WHEN 0 THEN '0.0' WHEN 1 THEN '1.0' WHEN 2 THEN '2.0' "
        "WHEN 3 THEN '9.0' END",
    ),
    ("pub_rec_bankruptcies", "CASE o%4 WHEN 0 THEN 0.0 WHEN 1 THEN 1.0 WHEN 2 THEN 2.0 WHEN 3 THEN 12.0 END"),
    (
        "mort_acc",
        "CASE CAST(floor(o/3) AS BIGINT)%5 WHEN 0 THEN 0.0 WHEN 1 THEN 1.0 WHEN 2 THEN 2.0 WHEN 3 THEN 3.0 "
        "WHEN 4 THEN 20.0 END",
    ),
    (
        "mths_since_recent_inq",
        "CASE WHEN k%3=0 THEN CAST(k%10 AS DOUBLE) WHEN o%5=0 THEN NULL "
        "ELSE CAST(CAST(floor(o/2) AS BIGINT)%12 AS DOUBLE) END",
    ),
    ("chargeoff_within_12_mths", "CASE WHEN o%90=0 THEN 11.0 WHEN o%9=0 THEN 1.0 ELSE 0.0 END"),
    ("inq_last_12m", "CASE WHEN o%113=0 THEN 150.0 ELSE CAST(CAST(floor(o/4) AS BIGINT)%7 AS DOUBLE) END"),
    ("inq_fi", "CASE WHEN o%109=0 THEN '60.0' ELSE concat(CAST(CAST(floor(o/5) AS BIGINT)%7 AS STRING),'.0') END"),
    ("int_rate", "CASE WHEN o%77=0 THEN NULL ELSE CAST(5 + o%20 AS DOUBLE) END"),
    (
        "avg_cur_bal",
        "CASE WHEN o%71=0 THEN NULL ELSE concat(CAST(CAST(floor(abs(c_acctbal)) AS BIGINT) AS STRING),'.0') END",
    ),
    (
        "tot_cur_bal",
        "CASE WHEN o%73=0 THEN 'n/a' ELSE concat(CAST(CAST(floor(abs(c_acctbal)*3) AS BIGINT)+o%100 AS STRING),"
        "'.0') END",
    ),
    ("pymnt_plan", "CASE WHEN o%50=0 THEN 'y' WHEN o%60=1 THEN 'Charged Off' ELSE 'n' END"),
    ("total_pymnt", "'0.0'"),
    (
        "total_rec_prncp",
        "CASE WHEN o%67=0 THEN NULL ELSE concat(CAST(CAST(floor(amt*(o%11)/10) AS BIGINT) AS STRING),'.25') END",
    ),
    ("total_rec_int", "concat(CAST(CAST(floor(amt/10) AS BIGINT) AS STRING),'.5')"),
    ("out_prncp", "'0.0'"),
    ("last_pymnt_d", "CASE WHEN o%13=0 THEN NULL ELSE 'Mar-2019' END"),
    ("last_pymnt_amnt", "concat(CAST(CAST(floor(amt/36) AS BIGINT) AS STRING),'.75')"),
)

FIXTURE_COLUMNS = tuple(name for name, _ in COLUMNS)


def _outer_expr(name: str, expr: str, string_type: str = "STRING", double_type: str = "DOUBLE") -> str:
    t = double_type if RAW_TYPES[name] == "double" else string_type
    if name == "id":
        return f"CAST({expr} AS {t}) AS {name}"
    return f"CAST(CASE WHEN junk THEN NULL ELSE {expr} END AS {t}) AS {name}"


# A second fixture: ids beyond the INT range, all loans of a member in one month.
BIG_ID_CHANGES = {
    "id": "CASE WHEN junk THEN 'Total amount funded in policy code 1' ELSE CAST(o + 3000000000 AS STRING) END",
    "issue_d": "concat('Mar-', CAST(2010 + k%5 AS STRING))",
}


def _columns(changes: dict[str, str] | None) -> list[tuple[str, str]]:
    return [(n, (changes or {}).get(n, e)) for n, e in COLUMNS]


def applications_from_tables(orders: DataFrame, customer: DataFrame, changes: dict[str, str] | None = None) -> DataFrame:
    """The raw application table (36 used columns, raw types) from the two tables."""
    # Dealt by the join key at every size: a join of two large tables needs this
    # exchange anyway, and a file with one row group is spread over all cores.
    parts = int(orders.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    orders = orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate").repartition(parts, "o_custkey")
    j = orders.join(customer, orders["o_custkey"] == customer["c_custkey"], "inner").select(
        orders["o_orderkey"].alias("o"),
        customer["c_custkey"].alias("k"),
        "c_name",
        "c_nationkey",
        "c_acctbal",
        "o_totalprice",
        "o_orderdate",
    )
    r = j.selectExpr(*[f"{e} AS {n}" for n, e in INNER])
    return r.selectExpr(*[_outer_expr(n, e) for n, e in _columns(changes)])


def applications_from_star(spark: SparkSession, sf_dir: str, changes: dict[str, str] | None = None) -> DataFrame:
    """The raw application table for the tables under ``sf_dir``."""
    keep_code_compiled(spark)
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    return applications_from_tables(orders, customer, changes)


def replicated_tables(spark: SparkSession, sf_dir: str, copies: int) -> tuple[DataFrame, DataFrame]:
    """``copies`` disjoint copies of orders and customer (keys shifted), for scale runs."""
    from pyspark.sql import functions as F

    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    o_span = 10**10  # copies after the first have ids beyond the INT range
    c_span = 10 ** 7
    o_parts, c_parts = [], []
    for i in range(copies):
        o_parts.append(
            orders.withColumn("o_orderkey", F.col("o_orderkey") + i * o_span).withColumn(
                "o_custkey", F.col("o_custkey") + i * c_span
            )
        )
        c_parts.append(customer.withColumn("c_custkey", F.col("c_custkey") + i * c_span))
    o, c = o_parts[0], c_parts[0]
    for x in o_parts[1:]:
        o = o.unionByName(x)
    for x in c_parts[1:]:
        c = c.unionByName(x)
    return o, c


def fixture_sql(orders: str = "orders", customer: str = "customer", changes: dict[str, str] | None = None) -> str:
    """The same table as one SELECT (DuckDB dialect: VARCHAR for text)."""
    inner = ", ".join(f"{e.replace('STRING', 'VARCHAR')} AS {n}" for n, e in INNER)
    outer = ", ".join(
        _outer_expr(n, e.replace("AS STRING", "AS VARCHAR"), string_type="VARCHAR") for n, e in _columns(changes)
    )
    j = (
        "SELECT o_orderkey AS o, c_custkey AS k, c_name, c_nationkey, c_acctbal, o_totalprice, o_orderdate "
        f"FROM {orders} JOIN {customer} ON o_custkey = c_custkey"
    )
    return f"SELECT {outer} FROM (SELECT {inner} FROM ({j}) j) r"
