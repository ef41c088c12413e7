"""Session settings for tests and the benchmark; on a cluster, use your own session."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = 8, shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("meshfold")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("MESHFOLD_DRIVER_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder for intermediate tables: ``spark.checkpoint.dir`` as the cluster names it.

    Only in local mode, where no other machine has to see it, one is made up: one for the process, removed at its end.
    In a folder that the session names, tables stay until whoever set it clears it.
    """
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not _own_folder:
        _own_folder.append(tempfile.mkdtemp(prefix="meshfold-"))
        atexit.register(shutil.rmtree, _own_folder[0], ignore_errors=True)
    return _own_folder[0]


_own_folder: list[str] = []


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_folder(spark)}/meshfold-{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back: its lineage is cut, lost executors don't matter.

    Used in place of ``checkpoint()``: the caller's checkpoint folder isn't set, and the columns read are pruned.
    """
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df):
    """``df`` dealt over all cores, if it is read in fewer splits than there are cores.

    For tables of few small files ahead of costly work per row. A large table has more splits than that
    and is left alone. Only for tables as read: counting the splits of a joined table would run the join.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
