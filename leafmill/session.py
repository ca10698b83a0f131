"""Session settings and durable materialisation."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, name: str = "leafmill") -> SparkSession:
    """A session for one machine: UTC, adaptive execution, few shuffle partitions."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", shuffle_partitions)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir; a temporary one only on a single machine that names none."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        named = tempfile.mkdtemp(prefix="leafmill-")
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def spread(df: DataFrame) -> DataFrame:
    """``df`` in as many partitions as the session shuffles into, for work that is long for its bytes: adaptive execution
    merges partitions by their bytes and would leave such work to a few tasks."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back: the lineage is cut and a lost executor costs nothing."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
