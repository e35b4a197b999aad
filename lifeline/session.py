"""Session helpers: a local session for tests and the bench, and the
reliable checkpoint folder.

Jobs never pick a folder of their own on a cluster: they read
``spark.checkpoint.dir`` from the session.  Only a local-mode session with
no folder configured gets a fresh temporary one.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("lifeline")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder, set on the context if not yet there."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "set spark.checkpoint.dir to a shared folder (HDFS/object store)"
            )
        configured = tempfile.mkdtemp(prefix="lifeline-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def reliable_checkpoint(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and cut its lineage
    (survives the loss of the executors that computed it)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
