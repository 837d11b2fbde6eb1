"""Derived fixtures shared by many plans, each with its SQL twin (a CTE body).

* churn label: a customer with an order on or before the cutoff and none in the
  365 days after it.
* stored scores: a deterministic ``p_churn`` in [0, 1) from the md5 of the key,
  shifted for churners, so every metric over it has an exact oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparklab.functions.core import md5num
from sparklab.sources.tables import Tables

# Fixed fixture parameters.
CUTOFF = "2000-08-01"
HORIZON_DAYS = 365

MD5NUM_SQL = "('0x' || substr(md5(CAST({x} AS VARCHAR)), 1, 15))::BIGINT"


def md5num_sql(x: str) -> str:
    return MD5NUM_SQL.format(x=x)


def churn_labels(t: Tables) -> DataFrame:
    """One row per customer with an order on or before the cutoff."""
    o = t.orders
    cutoff = F.to_date(F.lit(CUTOFF))
    upto = F.date_add(cutoff, 1).cast("timestamp_ntz")
    later = F.date_add(cutoff, HORIZON_DAYS + 1).cast("timestamp_ntz")
    prior = (o.where(F.col("o_orderdate") < upto)
              .groupBy(F.col("o_custkey").alias("c_custkey"))
              .agg(F.count(F.lit(1)).alias("n_orders"),
                   F.min(F.to_date("o_orderdate")).alias("first_order"),
                   F.max(F.to_date("o_orderdate")).alias("last_order")))
    future = (o.where((F.col("o_orderdate") >= upto) & (F.col("o_orderdate") < later))
               .select(F.col("o_custkey").alias("c_custkey")).distinct())
    lab = prior.join(future.withColumn("_active", F.lit(True)), "c_custkey", "left")
    return lab.select("c_custkey", "n_orders", "first_order", "last_order",
                      F.when(F.col("_active").isNull(), F.lit("Yes")).otherwise(F.lit("No")).alias("actual_churn"))


CHURN_SQL = f"""
churn AS (
  SELECT p.c_custkey, p.n_orders, p.first_order, p.last_order,
         CASE WHEN f.o_custkey IS NULL THEN 'Yes' ELSE 'No' END AS actual_churn
  FROM (SELECT o_custkey AS c_custkey, count(*) AS n_orders,
               min(CAST(o_orderdate AS DATE)) AS first_order, max(CAST(o_orderdate AS DATE)) AS last_order
        FROM orders WHERE CAST(o_orderdate AS DATE) <= DATE '{CUTOFF}' GROUP BY o_custkey) p
  LEFT JOIN (SELECT DISTINCT o_custkey FROM orders
             WHERE CAST(o_orderdate AS DATE) > DATE '{CUTOFF}'
               AND CAST(o_orderdate AS DATE) <= DATE '{CUTOFF}' + {HORIZON_DAYS}) f
    ON p.c_custkey = f.o_custkey
)"""


def churn_scores(t: Tables) -> DataFrame:
    """The stored score table: customer attributes, label and ``p_churn``."""
    lab = churn_labels(t)
    c = t.customer.select("c_custkey", "c_nationkey", "c_acctbal", F.col("c_mktsegment").alias("contract"))
    j = lab.join(c, "c_custkey")
    churn01 = (F.col("actual_churn") == "Yes").cast("int")
    return j.select(
        "c_custkey", "contract", "c_nationkey",
        F.floor(F.datediff(F.to_date(F.lit(CUTOFF)), F.col("first_order")) / 30).cast("int").alias("tenure_months"),
        (F.abs(F.col("c_acctbal")) / 10.0).alias("monthly_charges"),
        "n_orders", "actual_churn",
        ((F.pmod(md5num("c_custkey"), F.lit(1000)) + churn01 * 400) / 1400.0).alias("p_churn"))


SCORES_SQL = CHURN_SQL + f""",
scores AS (
  SELECT ch.c_custkey, c.c_mktsegment AS contract, c.c_nationkey,
         CAST(floor(date_diff('day', ch.first_order, DATE '{CUTOFF}') / 30) AS INTEGER) AS tenure_months,
         abs(c.c_acctbal) / 10.0 AS monthly_charges,
         ch.n_orders, ch.actual_churn,
         ((({md5num_sql('ch.c_custkey')}) % 1000) + CASE WHEN ch.actual_churn = 'Yes' THEN 400 ELSE 0 END) / 1400.0 AS p_churn
  FROM churn ch JOIN customer c ON c.c_custkey = ch.c_custkey
)"""


def with_sql(ctes: str, body: str) -> str:
    """Compose ``WITH <ctes> <body>``."""
    return f"WITH {ctes.strip()}\n{body}"
