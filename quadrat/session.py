"""Session settings and the shared scratch folder."""

from __future__ import annotations

import sys
import tempfile
import uuid

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

from .errors import PlotDataError

# Runtime settings every plan here relies on. The number of shuffle partitions is
# left to the cluster: AQE coalesces small ones and splits skewed ones.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot key even when that costs one more exchange further up
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # rows of whole texts or sketches are copied several times over in a Python worker
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "8388608",
}

# Settings that a cluster may name otherwise. Narrow rows compress so well that the 64 MB of
# a shuffle partition are some millions of them, which a task sorts and hashes at once.
SQL_DEFAULTS = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m"}

_local_root: str | None = None


def ship_with_tasks(module: str) -> None:
    """Send the functions of a module along with the tasks that call them.

    Executors then need not have this package installed.
    """
    cloudpickle.register_pickle_by_value(sys.modules[module])


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings to ``spark`` and return it."""
    for key, value in SQL_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    for key, value in SQL_DEFAULTS.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder all executors can reach.

    A cluster names it in ``spark.checkpoint.dir``. Only a local session may fall
    back to a temporary folder of this machine.
    """
    global _local_root
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise PlotDataError("Set spark.checkpoint.dir to a folder that all executors share.")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="quadrat-")
    return _local_root


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the shared folder (nothing is created yet)."""
    return f"{shared_root(spark)}/quadrat/{purpose}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, compression: str = "snappy", path: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and go on from the written table.

    Unlike a local checkpoint this survives the loss of executors. A table written before
    into a ``path`` named by the caller is replaced.
    """
    spark = df.sparkSession
    mode, path = ("overwrite", path) if path else ("errorifexists", shared_dir(spark, "cut"))
    df.write.option("compression", compression).mode(mode).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(scan: DataFrame) -> DataFrame:
    """Use all cores for costly row work on a table that has fewer splits than cores.

    Meant for a plain scan, e.g. of a few files that cannot be split. A table with
    enough splits is left as it is: no shuffle.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan
