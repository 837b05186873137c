"""Session settings the jobs rely on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# All of these can be set on a running session.
SETTINGS = {
    # timestamps are stored without zone and mean UTC
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.inferTimestampNTZ.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    # session windows of a busy user are merged before the shuffle
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    # the JVM does not compile methods beyond 8000 bytes; stages with long rule ladders that would
    # exceed it use Spark's split projections, which it does compile
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def prepare(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(name: str, cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A small local session for tests and the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="warehouse-"))
    )
    spark = prepare(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by the cluster.

    Only a local master may go without: it gets a temporary folder. Elsewhere each executor would
    write to its own disk, so a missing setting is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError(f"spark.checkpoint.dir must name a shared folder on master {master}")
        folder = tempfile.mkdtemp(prefix="shared-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def steps_dir(spark: SparkSession) -> str:
    """The folder of all steps written by this application."""
    return f"{shared_dir(spark)}/clickledger-{spark.sparkContext.applicationId}"


def written(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """Write a step that several later steps read, and read it back from the shared folder.

    The file survives lost executors, cuts the lineage and gives the optimizer true sizes.
    """
    path = f"{steps_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear_steps(spark: SparkSession) -> None:
    """Remove this application's steps; call it when the results built on them are stored."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(steps_dir(spark))
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
