"""The order star over the driver's TPC-H-like tables.

The order fact is line grain: `lineitem` carries the measures, `orders` the date and
customer, `part` the product and `supplier` the selling region. Attribute lookups are
left joins on unique keys, so a fact row is never lost or multiplied, and a lookup
whose column nobody asked for is not joined at all. That holds for `orders` too: lines
without an order drop out only where a column of the order is read, and the reference
gate is there to prove that there are none.

No join is hinted: Catalyst broadcasts a side only when its measured size is under the
session's threshold, and otherwise sort-merge joins with adaptive skew splitting. The
order join comes last so that its output stays hash-partitioned by order key: every
per-order distinct count above it then needs no shuffle of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from orderloom.constants import COMPLETED, DELAYED, ON_TIME_MAX_DAYS

ORDER_COLUMNS = (
    "Order_ID", "Order_Date", "Customer_ID", "Product_ID", "Region_ID",
    "Quantity", "Unit_Price", "Revenue", "Delivery_Days", "Order_Status",
)

# Declared, like every other schema here: an undeclared read spends a job per table on footers.
TABLE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}


class Star:
    """Lazy frames of one scale directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(TABLE_SCHEMAS[name]).parquet(f"{self.sf_dir}/{name}.parquet")

    def orders(self, *columns: str) -> DataFrame:
        """The order fact with only the columns named (by default all of ORDER_COLUMNS)."""
        wanted = columns or ORDER_COLUMNS
        line = self.table("lineitem")
        if "Product_ID" in wanted:
            part = self.table("part").select("p_partkey", F.col("p_brand").alias("Product_ID"))
            line = line.join(part, F.col("l_partkey") == F.col("p_partkey"), "left")
        if "Region_ID" in wanted:
            # Joined one after the other: the estimated size of a pre-joined pair is the
            # product of both files, which would forbid broadcasting a small supplier table.
            nation = self.table("nation").select("n_nationkey", F.col("n_regionkey").alias("Region_ID"))
            seller = self.table("supplier").select("s_suppkey", "s_nationkey")
            line = line.join(seller, F.col("l_suppkey") == F.col("s_suppkey"), "left")
            line = line.join(nation, F.col("s_nationkey") == F.col("n_nationkey"), "left")
        fact = line
        if {"Order_Date", "Order_Time", "Customer_ID", "Delivery_Days", "Order_Status"} & set(wanted):
            fact = line.join(self.table("orders"), F.col("l_orderkey") == F.col("o_orderkey"))

        ship, ordered = F.col("l_shipdate").cast("date"), F.col("o_orderdate").cast("date")
        days = F.abs(F.datediff(ship, ordered)).cast("bigint") % 31
        expressions = {  # column expressions only: nothing is resolved until it is selected
            "Order_ID": F.col("l_orderkey"),
            "Order_Date": ordered,
            "Order_Time": F.col("o_orderdate"),  # as stored, for conditions that a scan can use
            "Customer_ID": F.col("o_custkey"),
            "Product_ID": F.col("Product_ID"),
            "Region_ID": F.col("Region_ID"),
            "Quantity": F.col("l_quantity").cast("bigint"),
            "Unit_Price": F.try_divide(F.col("l_extendedprice"), F.col("l_quantity")),
            "Revenue": F.col("l_extendedprice"),
            "Delivery_Days": days,
            "Order_Status": F.when(days <= ON_TIME_MAX_DAYS, COMPLETED).otherwise(DELAYED),
        }
        return fact.select(*[expressions[name].alias(name) for name in wanted])

    def customers(self) -> DataFrame:
        nation = self.table("nation").select("n_nationkey", "n_regionkey")
        return (
            self.table("customer")
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
            .select(
                F.col("c_custkey").alias("Customer_ID"),
                F.col("c_name").alias("Customer_Name"),
                F.col("c_mktsegment").alias("Customer_Type"),
                F.lit(None).cast("string").alias("Industry"),
                F.col("n_regionkey").alias("Region_ID"),
            )
        )

    def products(self) -> DataFrame:
        brand = self.table("part").select(F.col("p_brand").alias("Product_ID")).distinct()
        number = F.regexp_extract("Product_ID", r"(\d+)$", 1).cast("int")
        return brand.select(
            "Product_ID",
            F.concat(F.lit("Category "), (number % 5).cast("string")).alias("Product_Category"),
            F.concat(F.lit("Line "), (number % 2).cast("string")).alias("Product_Line"),
        )

    def regions(self) -> DataFrame:
        return self.table("region").select(
            F.col("r_regionkey").alias("Region_ID"), F.col("r_name").alias("Region")
        )
