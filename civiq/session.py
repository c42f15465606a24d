"""Spark session settings and lineage helpers."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on: adaptive execution (runtime broadcast
# conversion, partition coalescing, skew-join splitting), UTC session time
# and no web UI.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "civiq", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library's settings."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's checkpoint folder.

    A cluster names its shared folder in ``spark.checkpoint.dir``; that value
    is always used. Only when it is unset (local tests) is a scratch folder
    created, so checkpoint() works everywhere.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError(
                "set spark.checkpoint.dir to a shared folder: checkpoints must survive "
                "the loss of the executor that wrote them")
        configured = tempfile.mkdtemp(prefix="civiq-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


_MATERIALIZED: list[str] = []


def materialize(df: DataFrame, folder_by: str | None = None) -> DataFrame:
    """Cut lineage by writing the table into the shared checkpoint folder.

    Used for derived tables that several later stages read: they are computed
    once, survive the loss of the executors that computed them, and - being
    Parquet - carry real size statistics for the planner's join choices and
    support pruning and filter pushdown when read back. ``folder_by``: a column
    whose values get folders of their own, so that a filter on it reads only these.
    The tables stay until ``drop_materialized`` is called.
    """
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/civiq-tables/{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path, partitionBy=folder_by)
    _MATERIALIZED.append(path)
    return spark.read.parquet(path)


def _file_system(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def drop_materialized(spark: SparkSession) -> int:
    """Delete the tables that ``materialize`` has written in this process, once
    no result needs them any more; returns how many."""
    n = len(_MATERIALIZED)
    while _MATERIALIZED:
        fs, p = _file_system(spark, _MATERIALIZED.pop())
        fs.delete(p, True)
    return n


def replace_folder(spark: SparkSession, new: str, target: str) -> None:
    """Put a finished folder in the place of another one. The old one is moved
    aside first and deleted last, so that it can be moved back if the new one
    cannot be moved in."""
    fs, p = _file_system(spark, target)
    path = spark._jvm.org.apache.hadoop.fs.Path
    old = path(f"{target.rstrip('/')}.old-{uuid.uuid4().hex}")
    there = fs.exists(p)
    if not fs.exists(path(new)):
        raise RuntimeError(f"there is no {new} to move to {target}")
    if there and not fs.rename(p, old):
        raise RuntimeError(f"could not move {target} aside")
    try:
        moved = fs.rename(path(new), p)
    except Exception:
        moved = False
    if not moved:
        if there:
            fs.rename(old, p)
        raise RuntimeError(f"could not move {new} to {target}")
    if there:
        fs.delete(old, True)
