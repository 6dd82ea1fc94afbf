"""Session settings the engine relies on; an existing session is left as it is."""
from __future__ import annotations

import os
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Runtime SQL settings for wide clinical tables. The JVM does not compile methods over 8000
#: bytes; with this limit Spark splits a wide projection instead of generating one such method
#: (about twice as fast on the flag and cleaning plans).
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def send_package(spark: SparkSession) -> None:
    """Give Python workers this package if their path may not hold it: Spark sends it as a file, once."""
    package, context = Path(__file__).resolve().parent, spark.sparkContext
    known = [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)]
    if str(package.parent) in known or getattr(context, "_package_sent", False):
        return
    base = Path(tempfile.mkdtemp()) / package.name
    context.addPyFile(shutil.make_archive(str(base), "zip", package.parent, package.name))
    context._package_sent = True


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a running session."""
    send_package(spark)
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: str = "*", app: str = "cohortloom", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the one the cluster names in spark.checkpoint.dir.

    Only where the setting is absent and everything runs on this machine, a temporary folder is
    used. On a cluster such a folder would be another one on each executor, so that is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rsplit("/", 1)[0]
    if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return tempfile.mkdtemp(prefix="cohortloom-")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder; survives the loss of executors."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)
