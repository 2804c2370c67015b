"""Session defaults and the shared working folder."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.ui.enabled": "false",
    # The JVM never compiles longer methods; running stages unfused is faster than interpreting them.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def local_session(cpus: int = 8, memory: str = "16g", name: str = "postlens") -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(name)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    session = (
        builder.config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.driver.memory", memory)
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder all executors can reach, for written intermediates and stream checkpoints.

    The base is the cluster's ``spark.checkpoint.dir``; where that is unset, the session's warehouse folder,
    which a cluster shares as well.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return os.path.join(base, f"{purpose}-{uuid.uuid4().hex}")


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written once to the shared folder and read back, for results that are used twice.

    Survives lost executors, unlike cached blocks, and cuts the lineage.
    """
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
