"""Tables of the session: reading them, and written intermediate ones in the folder that executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

LOCAL_CHECKPOINTS = "/tmp/checkpoints"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of the cluster; on a local master without one, a folder of our own."""
    known = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if known:
        return known
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(LOCAL_CHECKPOINTS)
    return spark.sparkContext.getCheckpointDir()


def new_path(spark: SparkSession) -> str:
    return f"{shared_dir(spark).rstrip('/')}/tables/{uuid.uuid4().hex}"


def stash(df: DataFrame) -> DataFrame:
    """Write df to the shared folder and read it back: cuts lineage, survives a lost executor."""
    path = new_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
