"""Session settings and the two storage helpers every operator uses."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession

#: Settings that hold for any size; sizes such as the number of shuffle partitions belong to the cluster.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # files of checkpoints that nothing refers to any more are deleted
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cores: int = 8, app: str = "weftline", **settings: str) -> SparkSession:
    """A local session for tests and the bench."""
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    own = {"spark.sql.shuffle.partitions": str(cores), "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g", "spark.driver.host": "127.0.0.1"}
    for k, v in (SETTINGS | own | settings).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _is_local(spark: SparkSession) -> bool:
    """One JVM, so that driver and executors share its folders; ``local-cluster[...]`` does not."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def own_folder(prefix: str) -> str:
    """A temporary folder that is deleted when Python ends."""
    folder = tempfile.mkdtemp(prefix=prefix)
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the cluster's checkpoint folder and go on from there.

    The folder is the one of ``spark.checkpoint.dir``. Only a local session without one gets a folder of its own.
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if shared is None:
            if not _is_local(spark):
                raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
            shared = own_folder("weftline-checkpoint-")
        sc.setCheckpointDir(shared)
    return df.checkpoint(eager=True)


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder for files that executors share: below the checkpoint folder, or a temporary one in a local session."""
    import uuid

    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not _is_local(spark):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        shared = own_folder("weftline-")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def driver_folder(spark: SparkSession, name: str) -> str:
    """A new scratch folder in which Python on the driver writes; the shared folder must be one of the mounted file system."""
    folder = scratch(spark, name).removeprefix("file://").removeprefix("file:")
    if "://" in folder:
        raise RuntimeError("Python cannot write below spark.checkpoint.dir")
    os.makedirs(folder)
    return folder
