"""The folder that driver and executors share, and tables written there to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names; a temporary one only where none is set and Spark runs on one machine, as in tests."""
    set_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not set_dir:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        set_dir = "file://" + tempfile.mkdtemp(prefix="lumenmap-")
        spark.conf.set("spark.checkpoint.dir", set_dir)
    return set_dir.rstrip("/")


def fresh_dir(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: later jobs neither recompute it nor need lost executors."""
    spark = df.sparkSession
    path = fresh_dir(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
