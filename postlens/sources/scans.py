"""Table scans for work that is heavy per row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# At the default split size this is a few gigabytes.
SMALL_INPUT_SPLITS = 64


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Give every core a part of a small input.

    An input of a few splits, fewer than the cluster has cores, is repartitioned once, by key so that a
    lost task reruns to the same rows. Anything larger is left alone: it is never shuffled for this.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    splits = df.rdd.getNumPartitions()
    if splits >= cores or splits > SMALL_INPUT_SPLITS:
        return df
    return df.repartition(cores, *keys)
