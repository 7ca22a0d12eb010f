"""Session settings the library relies on, and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def prepare(spark: SparkSession) -> SparkSession:
    """Settings of the session the operators are written for."""
    # Day and month boundaries are UTC.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    # The JVM does not compile methods above 8000 bytes of bytecode. Wide projections exceed that when
    # a whole stage is one method; below the limit Spark generates one small method per expression.
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir; a temporary one in local mode only."""
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if root is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tidewarden-"))
        root = context.getCheckpointDir()
    return root.rstrip("/")


def fresh_dir(spark: SparkSession, purpose: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_root(spark)}/{purpose}-{uuid.uuid4().hex}"


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new path below the shared folder, removed when the application ends."""
    path = fresh_dir(spark, purpose)
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    file_system = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    # Only paths that exist can be marked.
    file_system.mkdirs(hadoop_path)
    file_system.deleteOnExit(hadoop_path)
    return path


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether the path exists on whatever file system it names."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)
