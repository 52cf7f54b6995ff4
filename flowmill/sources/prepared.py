"""Prepared train and test tables and the fitted state, as parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowmill.functions.columns import small_table
from flowmill.plans.prepare import CODE, ROW_KEY, Feature, Prepared, PrepState
from flowmill.sources import files

SPLITS = ("train", "test")


def save_prepared(prepared: Prepared, folder: str) -> None:
    """One table per split: features, label and key stay in one row."""
    prepared.train.write.mode("overwrite").parquet(f"{folder}/train")
    prepared.test.write.mode("overwrite").parquet(f"{folder}/test")
    save_state(prepared.train.sparkSession, prepared.state, f"{folder}/state")


def load_prepared(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, PrepState]:
    """(train, test, state). Names every missing part; checks the column order against the state."""
    parts = [f"{folder}/{s}" for s in (*SPLITS, "state")]
    missing = [p for p in parts if not files.exists(spark, p)]
    if missing:
        raise FileNotFoundError("prepared data not found: " + ", ".join(missing) + "; run the preparation first")
    state = load_state(spark, f"{folder}/state")
    train, test = (spark.read.parquet(f"{folder}/{s}") for s in SPLITS)
    for name, df in zip(SPLITS, (train, test)):
        check_order(df, state, name)
    return train, test, state


def check_order(df: DataFrame, state: PrepState, name: str = "train") -> None:
    held = [c for c in df.columns if c not in (ROW_KEY, CODE, state.target)]
    if held != state.feature_columns:
        raise ValueError(f"column order of the {name} table does not match the preparation state: prepare again")


def save_state(spark: SparkSession, state: PrepState, folder: str) -> None:
    def put(rows, schema, name):
        small_table(spark, rows, schema).coalesce(1).write.mode("overwrite").parquet(f"{folder}/{name}")

    state.table(spark).coalesce(1).write.mode("overwrite").parquet(f"{folder}/features")
    put([(i, c, state.target) for i, c in enumerate(state.classes)], "code int, name string, target string", "labels")
    dropped = [(c, "identifier") for c in state.dropped_identifiers] + [(c, "correlated") for c in state.dropped_correlated]
    put([(i, c, why) for i, (c, why) in enumerate(dropped)], "pos int, name string, reason string", "dropped")
    put([(state.balancing,)], "balancing string", "facts")


def load_state(spark: SparkSession, folder: str) -> PrepState:
    if not files.exists(spark, f"{folder}/features"):
        raise FileNotFoundError(f"no preparation state at {folder}: run the preparation first")
    # model-sized tables: one row per feature, class or dropped column
    features = spark.read.parquet(f"{folder}/features").orderBy("pos").collect()
    labels = spark.read.parquet(f"{folder}/labels").orderBy("code").collect()
    dropped = spark.read.parquet(f"{folder}/dropped").orderBy("pos").collect()
    return PrepState(
        labels[0]["target"],
        tuple(r["name"] for r in labels),
        tuple(Feature(r["name"], r["median"], r["mean"], r["scale"]) for r in features),
        tuple(r["name"] for r in dropped if r["reason"] == "identifier"),
        tuple(r["name"] for r in dropped if r["reason"] == "correlated"),
        spark.read.parquet(f"{folder}/facts").first()["balancing"] if files.exists(spark, f"{folder}/facts") else "none",
    )


def label_table(state: PrepState, spark: SparkSession) -> DataFrame:
    """(code, name) of the classes."""
    return small_table(spark, list(enumerate(state.classes)), "code int, name string")


def rows_of(folder: str, spark: SparkSession) -> DataFrame:
    """Rows per split of a stored preparation."""
    counted = [
        spark.read.parquet(f"{folder}/{s}").agg(F.count(F.lit(1)).alias("rows")).select(F.lit(s).alias("split"), "rows")
        for s in SPLITS
    ]
    return counted[0].unionByName(counted[1])
