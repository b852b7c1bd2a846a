from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions import exact_sum, hundredths, require_ansi
from ledgerline.sources import table

# The date and both money columns as the SQL check states them.
PRICE_SUMMARY_SQL = """
SELECT l_returnflag, l_linestatus, count(*) AS n_lines,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2)))
            AS DOUBLE) AS sum_price,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))
                * (CAST(1 AS DECIMAL(4,2))
                   - CAST(l_discount AS DECIMAL(4,2))))
            AS DOUBLE) AS revenue
FROM lineitem
WHERE l_shipdate <= TIMESTAMP '2001-06-30 00:00:00'
GROUP BY l_returnflag, l_linestatus
"""


def price_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line count, price and discounted revenue per return flag and line status.

    One scan and one shuffle. Each map task sends at most one row per group, so
    a group that holds most of the rows costs no more than a small one. Prices and
    discounts with a third decimal raise an error, and so does a session without ANSI
    mode, where the product could overflow unnoticed.
    """
    require_ansi()
    shipped = table(spark, sf_dir, "lineitem").filter(
        F.col("l_shipdate") <= F.expr("timestamp_ntz'2001-06-30 00:00:00'")
    )
    price = hundredths("l_extendedprice")
    revenue = price * (100 - hundredths("l_discount"))
    return shipped.groupBy("l_returnflag", "l_linestatus").agg(
        F.count("*").alias("n_lines"),
        exact_sum(price, scale=2).alias("sum_price"),
        exact_sum(revenue, scale=4).alias("revenue"),
    )
