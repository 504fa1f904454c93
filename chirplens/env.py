"""Session defaults and the shared checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """Session for tests and the bench.  On a cluster the caller brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("chirplens")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
        .getOrCreate()
    )


def use_checkpoint_dir(spark: SparkSession) -> None:
    """Point checkpoints at the folder the cluster names in ``spark.checkpoint.dir``.

    A machine-local folder is only acceptable in local mode, where every task runs on that
    machine; anywhere else a missing setting is an error.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="chirplens-checkpoint-")
    sc.setCheckpointDir(folder)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A folder of this application below the one that all executors share."""
    use_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Compute ``df`` now, keep it in the shared folder and cut its lineage.

    With ``spark.cleaner.referenceTracking.cleanCheckpoints`` Spark deletes the files when the
    frame is no longer referenced; a cluster's session should set it.
    """
    use_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
