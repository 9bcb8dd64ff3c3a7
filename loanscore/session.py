"""Session helpers: a local session for tests and benches, and scratch paths.

Library functions take a session from the caller and never build one. The
only shared location they write to is the folder the cluster names in
``spark.checkpoint.dir``; a local folder is created only when that setting
is absent and the master is local (tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


# HotSpot never compiles a method above this many bytes of bytecode.
COMPILED_METHOD_BYTES = 8000


def keep_code_compiled(spark: SparkSession) -> None:
    """Have the session split generated code the JVM would only interpret; a lower limit stays.

    A loan's rules and ladders make one whole-stage method of tens of kilobytes,
    and Spark's own limit (65535 bytes) lets it run uncompiled.
    """
    name = "spark.sql.codegen.hugeMethodLimit"
    if int(spark.conf.get(name)) > COMPILED_METHOD_BYTES:
        spark.conf.set(name, str(COMPILED_METHOD_BYTES))


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "loanscore") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.codegen.hugeMethodLimit", str(COMPILED_METHOD_BYTES))
        # Plans are built from many small Column calls; skip the per-call
        # Python stack capture (only used to decorate error messages).
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of this session.

    Read from the running context or from ``spark.checkpoint.dir``. If neither
    is set, a fresh local folder is used, but only on a local master; on a
    cluster a machine-local folder would not survive the loss of a node, so
    the setting is required there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir")
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder before running this job")
        conf_dir = tempfile.mkdtemp(prefix="loanscore-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder path under the checkpoint folder (not created)."""
    base = checkpoint_dir(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex}")


def delete_path(spark: SparkSession, path: str) -> bool:
    """Recursively delete ``path`` on whatever file system it names (HDFS, S3, local)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.delete(hpath, True))


def delete_on_exit(spark: SparkSession, path: str) -> str:
    """Mark ``path`` for deletion when the driver's file systems close (JVM exit).

    For scratch tables behind a lazily evaluated query: they must live as
    long as the returned frame may run, and should not outlive the driver.
    """
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hpath)
    return path
