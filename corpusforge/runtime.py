"""Session plumbing shared by all operators: table access, lineage cuts, size-checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side is broadcast only when its measured row count is at most this.
BROADCAST_ROWS = 200_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet table ``name`` of a data directory."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors share, as the cluster names it in spark.checkpoint.dir; a local one only where it is unset."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        where = spark.conf.get("spark.checkpoint.dir", None) or "file://" + tempfile.mkdtemp(prefix="corpusforge-")
        sc.setCheckpointDir(where)
    return sc.getCheckpointDir()


def fresh_dir(spark: SparkSession, what: str) -> str:
    """A folder of its own in the shared folder, deleted when the session's file system closes."""
    path = f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(where)
    fs.deleteOnExit(where)
    return path


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder, so that later reads neither recompute it nor depend on one executor.

    Spark deletes a checkpoint when nothing refers to it any more, if spark.cleaner.referenceTracking.cleanCheckpoints is set.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def slots(spark: SparkSession) -> int:
    """Reduce-side parallelism of this session."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark ``df`` for broadcast when it has at most ``rows`` rows, else leave the join to the optimizer.

    The count stops at ``rows + 1``, so checking costs no full pass.
    """
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def spread(df: DataFrame) -> DataFrame:
    """``df`` on as many partitions as there are cores, where its scan has fewer (one small file); for row-wise work that is costly."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df._jdf.queryExecution().toRdd().getNumPartitions() < cores else df
