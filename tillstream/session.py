"""Spark session defaults and the shared folder for state."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(
    app_name: str = "tillstream",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **settings: str,
) -> SparkSession:
    """A session with the settings this package is tested under.

    ``shuffle_partitions`` also fixes the number of state partitions of every
    stream at its first checkpoint; leave it unset on a cluster that configures it.
    Extra settings are passed as ``spark__sql__x="y"`` for ``spark.sql.x``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    config = {
        # Zone-less order times are read in the session zone.
        "spark.sql.session.timeZone": "UTC",
        # State lives off-heap and checkpoints only its changes, so a leaderboard
        # over many millions of products does not press on the executor heap.
        "spark.sql.streaming.stateStore.providerClass": (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        ),
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        # Landing writes a file for each status, of which there are five; with a writer
        # open for each, its rows need not be sorted by status first.
        "spark.sql.maxConcurrentOutputFileWriters": "8",
        # Checkpoints of intermediate results go when the results do.
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    if shuffle_partitions:
        config["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    config |= {name.replace("__", "."): value for name, value in settings.items()}
    for name, value in config.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def _shared_root(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, else the folder set for checkpoints, else one in the warehouse,
    which every session has and the machines of a cluster share."""
    return (
        spark.conf.get("spark.checkpoint.dir", None)
        or spark.sparkContext.getCheckpointDir()
        or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_tillstream"
    ).rstrip("/")


def shared_folder(spark: SparkSession) -> str:
    """The name of a new folder that every executor can reach."""
    return f"{_shared_root(spark)}/tillstream-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Deletes a folder made under ``shared_folder`` that is no longer needed."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def durable(rows: DataFrame) -> DataFrame:
    """The same rows from a checkpoint, which outlives the executors that wrote it."""
    context = rows.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(rows.sparkSession))
    return rows.checkpoint()
