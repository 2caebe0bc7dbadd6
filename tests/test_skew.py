"""Results and plans when a third of all rows share one order, product, seller and customer."""

import duckdb
import pytest
from pyspark.sql import functions as F

from checks.catalog import QUERIES
from checks.compare import difference
from checks.oracle import SQL
from orderloom.sources.star import TABLE_SCHEMAS

SMALL_THRESHOLDS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "0",
    "spark.sql.shuffle.partitions": "24",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture(scope="module")
def skewed(spark, tiny_dir, tmp_path_factory):
    folder = tmp_path_factory.mktemp("skewed")
    hot = F.pmod(F.xxhash64("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"), F.lit(3)) == 0
    for table, schema in TABLE_SCHEMAS.items():
        frame = spark.read.schema(schema).parquet(f"{tiny_dir}/{table}.parquet")
        if table == "lineitem":
            keys = {"l_orderkey": 7, "l_partkey": 11, "l_suppkey": 5}
            frame = frame.withColumn("hot", hot)
            frame = frame.withColumns(
                {c: F.when(F.col("hot"), F.lit(v).cast("bigint")).otherwise(F.col(c)) for c, v in keys.items()}
            ).drop("hot").repartition(6)
        frame.write.parquet(f"{folder}/{table}.parquet")
    con = duckdb.connect()
    for table in TABLE_SCHEMAS:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet/*.parquet'")
    return str(folder), con


@pytest.fixture()
def tight(spark):
    before = {k: spark.conf.get(k, None) for k in SMALL_THRESHOLDS}
    for key, value in SMALL_THRESHOLDS.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.mark.parametrize(
    "name",
    ["annual_sales_trend", "annual_fulfillment_kpi", "regional_sales_contribution", "customer_value_ranking",
     "order_diagnostics", "demand_panel", "order_measures_by_region", "size_quantiles"],
)
def test_hot_keys_keep_results_exact(tight, skewed, name):
    folder, con = skewed
    assert difference(QUERIES[name](tight, folder), con, SQL[name]) is None


def test_the_hot_order_is_split(tight, skewed):
    frame = QUERIES["annual_sales_trend"](tight, skewed[0])
    frame.collect()
    assert "SortMergeJoin(skew=true)" in frame._jdf.queryExecution().executedPlan().toString()
