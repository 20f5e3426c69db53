"""Landing folders made from the given tables: CSV files written by Spark."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.scratch import new_folder
from tideline.schemas import SOURCE_FILE

LANDING_KEY = "landing_key"
# A file holds the orders of one year and of one range of this many order keys, so neither a file
# nor the task that writes it grows with the table.
ORDERS_PER_FILE = 1_000_000
YEAR_STEP = 1_000_000_000

_landed: dict[tuple[str, str, str], str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def once(spark: SparkSession, sf_dir: str, name: str, make) -> str:
    """The folder `make(folder)` filled, made once per application and data set."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _landed:
        folder = new_folder(spark, name)
        make(folder)
        _landed[key] = folder
    return _landed[key]


def order_file_key() -> Column:
    """The number of the landing file an order belongs to."""
    return F.expr(f"year(o_orderdate) * {YEAR_STEP}L + o_orderkey div {ORDERS_PER_FILE}")


def landing_key(address: str = SOURCE_FILE) -> Column:
    """The same number, cut from the address of the file."""
    return F.regexp_extract(address, rf"{LANDING_KEY}=(\d+)", 1).cast("long").alias(LANDING_KEY)


def write_orders(spark: SparkSession, sf_dir: str, folder: str) -> None:
    (
        table(spark, sf_dir, "orders")
        .withColumn(LANDING_KEY, order_file_key())
        .repartition(LANDING_KEY)
        .write.partitionBy(LANDING_KEY)
        .option("header", True)
        .csv(folder)
    )


def landed_orders(spark: SparkSession, sf_dir: str) -> str:
    """A shared landing folder of the orders, for queries that leave the files in place."""
    return once(spark, sf_dir, "orders", lambda folder: write_orders(spark, sf_dir, folder))


def own_landed_orders(spark: SparkSession, sf_dir: str) -> str:
    """A landing folder of the orders for one query that moves the files away."""
    folder = new_folder(spark, "own-orders")
    write_orders(spark, sf_dir, folder)
    return folder


def order_files(spark: SparkSession, sf_dir: str) -> int:
    return table(spark, sf_dir, "orders").select(order_file_key()).distinct().count()


def landed_customers(spark: SparkSession, sf_dir: str) -> str:
    """Customers as landed text in which every tenth nation key is no number."""

    def write(folder: str) -> None:
        nation = F.col("c_nationkey").cast("string")
        (
            table(spark, sf_dir, "customer")
            .select(
                "c_custkey",
                F.when(F.col("c_custkey") % 10 == 0, "xx").otherwise(nation).alias("age"),
                "c_acctbal",
            )
            .write.option("header", True)
            .csv(folder)
        )

    return once(spark, sf_dir, "customers", write)
