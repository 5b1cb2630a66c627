"""Test tables seen as a ranking feed: one row per order, its customer the player."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.schemas import FEED


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Put a scan of fewer splits than cores onto all cores; leave a larger one alone.

    The test files have one row group each, which a single task would read and
    carry through everything up to the first shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The eleven feed columns, with NULLs in `trend`, `faceImageId` and `difference`."""
    orders, customer, nation = (table(spark, sf_dir, n) for n in ("orders", "customer", "nation"))
    # Ahead of the join: once per customer, not once per order.
    customer = customer.withColumn("name", F.replace("c_name", F.lit("#"), F.lit(" ")))
    joined = spread(orders).join(customer, F.col("o_custkey") == F.col("c_custkey")).join(
        nation, F.col("c_nationkey") == F.col("n_nationkey")
    )
    key, status = F.col("o_orderkey"), F.col("o_orderstatus")
    score = F.floor(F.col("o_totalprice") / 1000)
    columns = {
        "id": F.col("o_custkey"),
        "rank": F.substring("o_orderpriority", 1, 1),
        "name": F.col("name"),
        "country": F.col("n_name"),
        "rating": score,
        "points": score,
        "lastUpdatedOn": F.col("o_orderdate").cast("date"),
        "trend": F.when(status == "F", "Up").when(status == "P", "Down"),
        "faceImageId": F.when(key % 5 != 0, F.col("o_custkey") + 300000),
        "countryId": F.col("c_nationkey"),
        "difference": F.when(status != "O", key % 7 - 3),
    }
    return joined.select(*[columns[f.name].cast(f.dataType).alias(f.name) for f in FEED])
