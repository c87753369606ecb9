"""Session helpers: local sessions for tests, and the checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = 8, app: str = "loanloom") -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the shared folder named by the cluster; make one in local mode only."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(shared)
        return shared
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder")
    folder = tempfile.mkdtemp(prefix="loanloom-checkpoint-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def write_table(df: DataFrame) -> str:
    """Write ``df`` as a parquet table under the checkpoint folder and give its path."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return path


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` as a parquet table under the checkpoint folder and read it back.

    Later passes neither repeat the lineage nor depend on the executors that
    computed it, and they only read the columns they need.
    """
    return df.sparkSession.read.schema(df.schema).parquet(write_table(df))
