"""An order star schema read as canonical operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Columns that give the lines of the star schema a total order.
ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]


def star_operations(t: dict[str, DataFrame]) -> DataFrame:
    """Joins lines to orders, customers, nations, regions, parts and suppliers, all inner; dimension sides are broadcast
    by the planner where their sizes allow."""
    d = "decimal(18,2)"
    j = t["lineitem"].join(t["orders"], F.col("l_orderkey") == F.col("o_orderkey"))
    j = j.join(t["customer"], F.col("o_custkey") == F.col("c_custkey")).join(t["nation"], F.col("c_nationkey") == F.col("n_nationkey")).join(t["region"], F.col("n_regionkey") == F.col("r_regionkey"))
    j = j.join(t["part"], F.col("l_partkey") == F.col("p_partkey")).join(t["supplier"], F.col("l_suppkey") == F.col("s_suppkey"))
    turnover = F.col("l_extendedprice").cast(d) * (F.lit(1) - F.col("l_discount").cast(d))
    return j.select(
        F.concat_ws("-", F.col("l_orderkey"), F.col("l_linenumber")).alias("JobfileNumber"),
        F.year("o_orderdate").alias("Year"),
        F.month("o_orderdate").alias("Month"),
        F.col("c_name").alias("Customer"),
        F.col("s_name").alias("HQ CTO Customer Name"),
        F.col("n_name").alias("Reporting Entity Label"),
        F.col("r_name").alias("Zone 3 Label"),
        F.col("c_mktsegment").alias("Market Segment Name"),
        F.col("p_brand").alias("Product Name"),
        F.col("p_type").alias("Activity Name (EN)"),
        F.col("o_orderpriority").alias("Shipping Type Name"),
        turnover.cast("decimal(18,4)").alias("Turnover in EUR"),
        (turnover - F.col("p_retailprice").cast(d) * F.col("l_quantity").cast(d)).cast("decimal(18,4)").alias("Direct GM in EUR"),
        F.col("l_extendedprice").cast(d).alias("Gross Billing Tax Excl. in EUR"),
        F.col("l_quantity").alias("TEU"),
        (F.col("l_quantity") * F.col("p_size")).alias("Freight Ton"),
        *ORDER,
    )
