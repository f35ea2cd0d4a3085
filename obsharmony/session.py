"""Session for tests and benches, and durable intermediate results."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str | int = "*", partitions: int = 8, app: str = "obsharmony") -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def _ensure_checkpoint_dir(spark: SparkSession) -> None:
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if path is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        path = tempfile.mkdtemp(prefix="obsharmony-checkpoint-")
    sc.setCheckpointDir(path)


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared checkpoint folder."""
    _ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def durable(df: DataFrame, name: str = "kept") -> DataFrame:
    """Write a table to the shared checkpoint folder and read it back.

    A lost executor costs no recomputation, branches see the very same rows, and the
    optimizer knows the table's size when it chooses how to join it.
    """
    spark, path = df.sparkSession, scratch(df.sparkSession, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
