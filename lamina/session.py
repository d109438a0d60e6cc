"""What a Spark session needs: the package on its workers, and a folder for checkpoints."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_shipped: dict[str, str] = {}


def ship(spark: SparkSession) -> None:
    """Send the package to the workers, once per application.

    Needed where it isn't installed on every machine; the driver's file server
    hands it out, so no shared folder is involved.
    """
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent
    path = os.path.join(tempfile.mkdtemp(prefix="lamina-"), "lamina.zip")
    with zipfile.ZipFile(path, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, Path(root.name) / p.relative_to(root))
    sc.addPyFile(path)
    _shipped[sc.applicationId] = path


def shared_checkpoints(spark: SparkSession) -> None:
    """Make checkpoint() write where spark.checkpoint.dir says.

    Without that setting a temporary folder serves, but only in local mode,
    where it is reachable by every task; on a cluster that is an error.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        where = tempfile.mkdtemp(prefix="lamina-checkpoint-")
    sc.setCheckpointDir(where)


def cut(df: DataFrame) -> DataFrame:
    """df, materialised in the shared folder; its lineage ends there."""
    shared_checkpoints(df.sparkSession)
    return df.checkpoint(eager=True)


def spread(df: DataFrame) -> DataFrame:
    """df over all cores, where its source has fewer parts than there are cores.

    A file of one row group is read by one task, however many cores there are.
    Rows of large inputs never move: those have parts enough.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


#: About so many bytes, as the plan estimates them, go to a part of ``by_key``; no more parts than MOST_PARTS.
PART_BYTES, MOST_PARTS = 2 << 20, 4_000


def by_key(df: DataFrame, key: str) -> DataFrame:
    """df in parts by key, whose size doesn't grow with the input: what a task
    counts in memory is many times the text that it reads."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(min(MOST_PARTS, max(df.sparkSession.sparkContext.defaultParallelism, size // PART_BYTES)), key)
