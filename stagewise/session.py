"""Session helpers: a local session for tests/bench, and the shared
scratch folder for jobs that write intermediate tables.

The scratch root is the shared folder the cluster names in
``spark.checkpoint.dir``. Without that setting a local temporary folder is
used if the master is ``local``; on any other master that is an error.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

_LOCAL_CONF = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.driver.memory": "8g",
}


def local_session(app: str = "stagewise", cpus: str | int = "*", **conf: str) -> SparkSession:
    b = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for k, v in {**_LOCAL_CONF, **conf}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cluster_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings sized for a run reading ``input_bytes`` on ``total_cores``.

    The initial shuffle partition count is enough for ~``target`` bytes per
    partition (at least 2 waves of tasks); AQE then coalesces small ones
    towards the advisory size and splits skewed join partitions, so the
    number only needs to be an upper bound. File splits stay at the same
    size so a scan task's input fits comfortably in executor memory."""
    parts = max(2 * total_cores, -(-int(input_bytes) // target_partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    }


def scratch_root(checkpoint_dir: str | None, configured: str | None, master: str) -> str | None:
    """Where intermediate tables go: the session's checkpoint folder, else the one
    the cluster names in ``spark.checkpoint.dir``; None means a local temporary
    folder may be made, which only a ``local`` master (one machine) allows."""
    root = checkpoint_dir or configured
    if root is None and not (master == "local" or master.startswith("local[")):
        raise RuntimeError(
            f"spark.checkpoint.dir is not set and the master is {master!r}: executors need a shared folder for "
            "intermediate tables"
        )
    return root


def checkpoint_root(spark: SparkSession) -> str:
    """The session's shared checkpoint folder; a local one only in local mode."""
    sc = spark.sparkContext
    root = scratch_root(sc.getCheckpointDir(), spark.conf.get("spark.checkpoint.dir", None), sc.master)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root or tempfile.mkdtemp(prefix="stagewise-ckpt-"))
    return sc.getCheckpointDir()


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint root (never reused)."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/stagewise/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, name: str = "materialized") -> DataFrame:
    """Write ``df`` once as parquet under the shared scratch folder and read
    it back (known schema, so no inference job): cuts the lineage, and every
    later pass reads the same rows, column-pruned. One job, unlike an eager
    ``checkpoint()`` of an uncached plan, which computes the plan twice."""
    path = scratch_dir(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._stagewise_path = path
    return out


def drop_materialized(df: DataFrame | None) -> None:
    """Delete the scratch folder behind a ``materialize``d frame."""
    path = getattr(df, "_stagewise_path", None) if df is not None else None
    if path:
        delete_folder(df.sparkSession, path)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder and all in it, in whatever store it is."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def finished_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in ``path`` that a Spark job has finished writing (they hold ``_SUCCESS``)."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    root = hadoop.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(root) if f.isDirectory()]
    return sorted(n for n in names if fs.exists(hadoop.Path(f"{path}/{n}/_SUCCESS")))


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers (once per application),
    wherever the driver found it: ``addPyFile`` of a zip of its modules."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    top = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="stagewise-zip-"), "stagewise_modules.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(top):
            for name in sorted(n for n in names if n.endswith(".py")):
                full = os.path.join(folder, name)
                z.write(full, os.path.relpath(full, os.path.dirname(top)))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)
