"""Spark session helpers.

The library never creates a session behind the caller's back: operators take
DataFrames and use ``df.sparkSession``.  ``build_session`` is for scripts,
tests and the benchmark; on a cluster the job's own session is used as is.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import zipfile

from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "cinerank") -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    shuffle_partitions = shuffle_partitions or int(cpus)
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "16g"))
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    event_log = os.environ.get("BENCH_EVENT_LOG")
    if event_log:                    # stage/task timings for tools/event_log_profile.py
        os.makedirs(event_log, exist_ok=True)
        builder = builder.config("spark.eventLog.enabled", "true").config(
            "spark.eventLog.dir", event_log)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory, setting it only when unset.

    On a cluster the directory comes from ``spark.checkpoint.dir`` (a shared
    file system).  Only a local-mode session without one gets a scratch
    folder, which is what tests and the local benchmark run with.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder "
            "(HDFS/S3/ABFS) so lineage cuts survive executor loss")
    path = tempfile.mkdtemp(prefix="cinerank-ckpt-")
    atexit.register(shutil.rmtree, path, True)     # local scratch only: ours to remove
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``cinerank`` importable in the Python workers (the similarity
    kernel runs there): zip the package once per application and register it
    with ``addPyFile``, which Spark copies to every executor."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    parent = os.path.dirname(pkg_dir)
    archive = os.path.join(tempfile.mkdtemp(prefix="cinerank-pkg-"), "cinerank.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg_dir):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(root, name)
                    z.write(full, os.path.relpath(full, parent))
    sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)


def cluster_conf(input_bytes: int, total_cores: int) -> dict[str, str]:
    """Session settings for a cluster run over ``input_bytes`` of ratings.

    * shuffle partitions: ~256 MB of shuffle input each (the similarity grid
      replicates ratings G times, so size from the replicated volume when
      running the all-pairs keys), at least 3 waves of the cluster's cores;
      AQE coalesces what turns out smaller and splits skewed join partitions;
    * 256 MB scan splits;
    * one Python worker per core for the similarity kernel, bounded at
      ~150 MB by the kernel's buffer limits: ``spark.executor.pyspark.memory``
      reserves it outside the JVM heap.
    """
    target = 256 << 20
    partitions = max(3 * total_cores, -(-input_bytes // target))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(target),
        "spark.executor.pyspark.memory": "512m",
        "spark.python.worker.reuse": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
