"""The ``flows`` table: labelled flow records derived from the ``lineitem`` parquet table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TARGET = "Label"
KEY = "Flow ID"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flow records with identifiers, nulls, infinities, a constant column and duplicate rows."""
    return flows_of(read_table(spark, sf_dir, "lineitem"))


def flows_of(lineitem: DataFrame) -> DataFrame:
    text = lambda name: F.col(name).cast("string")
    flag, status, part = F.col("l_returnflag"), F.col("l_linestatus"), F.col("l_partkey")
    price, quantity = F.col("l_extendedprice"), F.col("l_quantity")
    label = (
        F.when((F.col("l_orderkey") % 1000 == 7) & (F.col("l_linenumber") == 1), "Heartbleed")
        .when(flag == "N", "BENIGN")
        .when((flag == "R") & (status == "F"), "DoS Hulk")
        .when(flag == "R", "DoS GoldenEye")
        .when(status == "F", "DoS slowloris")
        .otherwise("DoS Slowhttptest")
    )
    level = (
        F.when(F.col(TARGET) == "BENIGN", 0)
        .when(F.col(TARGET) == "DoS GoldenEye", 10)
        .when(F.col(TARGET) == "DoS Hulk", 20)
        .when(F.col(TARGET) == "DoS Slowhttptest", 30)
        .when(F.col(TARGET) == "DoS slowloris", 40)
        .otherwise(50)
    )
    base = lineitem.select(
        F.concat_ws(
            "-", text("l_orderkey"), text("l_linenumber"), text("l_partkey"), text("l_suppkey"), text("l_extendedprice")
        ).alias(KEY),
        F.concat(F.lit("10.0.0."), (F.col("l_suppkey") % 255).cast("string")).alias("Source IP"),
        quantity.alias("Total Fwd Packets"),
        price.alias("Flow Duration"),
        F.when(part % 97 == 0, float("inf"))
        .when(part % 89 == 0, None)
        .otherwise(price / quantity)
        .alias("Flow Bytes/s"),
        F.when(part % 101 == 0, None).otherwise(F.col("l_discount") * 100).alias("Fwd IAT Mean"),
        (price * 1.001).alias("Fwd IAT Total"),
        F.col("l_tax").alias("Active Mean"),
        F.lit(0.0).alias("Bwd PSH Flags"),
        label.alias(TARGET),
        # rows of quantity 7 appear twice: one scan with a row generator, not two scans
        F.explode(F.when(quantity == 7, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
    )
    return base.select(
        KEY,
        "Source IP",
        "Total Fwd Packets",
        "Flow Duration",
        "`Flow Bytes/s`",
        "Fwd IAT Mean",
        "Fwd IAT Total",
        "Active Mean",
        "Bwd PSH Flags",
        (level + 100 * F.col("Active Mean")).alias("Packet Length Variance"),
        TARGET,
    )
