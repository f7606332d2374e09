"""Small files that are published once, for tables that several writers share.

A file is written under another name and renamed without overwriting: the way in
which Spark's own streaming logs commit, through the same Hadoop interface.  Who
comes second learns it.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


def hadoop_path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def file_system(spark: SparkSession, path: str):
    return hadoop_path(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the published files of a folder, sorted; empty if there is none."""
    fs, path = file_system(spark, folder), hadoop_path(spark, folder)
    found = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
    return sorted(n for n in found if not n.startswith((".", "_")))


def publish(spark: SparkSession, path: str, payload: dict) -> bool:
    """Write ``payload`` as JSON to ``path``; False if there is such a file already
    (which stays as it is)."""
    jvm = spark.sparkContext._jvm
    target, fs = hadoop_path(spark, path), file_system(spark, path)
    fs.mkdirs(target.getParent())
    staged = jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{target.getName()}.{uuid.uuid4().hex}")
    out = fs.create(staged, False)
    out.write(bytearray(json.dumps(payload, sort_keys=True).encode()))
    out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    no_options = jvm.java.lang.reflect.Array.newInstance(jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), 0)
    try:
        context.rename(staged, target, no_options)
        return True
    except Exception as e:
        fs.delete(staged, False)
        if fs.exists(target):
            return False
        raise OSError(f"could not publish {path}: {e}") from e


def load(spark: SparkSession, path: str) -> dict:
    return json.loads("".join(r[0] for r in spark.read.option("wholetext", True).text(path).collect()))


def move_over(spark: SparkSession, staged: str, path: str) -> None:
    """Put a complete folder in the place of another one."""
    fs = file_system(spark, path)
    fs.delete(hadoop_path(spark, path), True)
    fs.mkdirs(hadoop_path(spark, path).getParent())
    if not fs.rename(hadoop_path(spark, staged), hadoop_path(spark, path)):
        raise OSError(f"could not move {staged} to {path}")
