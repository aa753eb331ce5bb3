"""Session settings the jobs rely on."""

from __future__ import annotations

import atexit
import contextlib
import shutil
import tempfile
import uuid

from pyspark import SparkContext
from pyspark.sql import SparkSession

# Options that change results or plans; cluster sizing stays with the deployer.
CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # hot keys in equi-joins are split at run time, even at the price of one more shuffle
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # the JVM never compiles a method of more bytes: rows of many columns would be interpreted
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # decode(..., 'GBK') for landing files in the exchange's native encoding
    "spark.sql.legacy.javaCharsets": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the run-time options to a session somebody else created."""
    for name, value in CONF.items():
        spark.conf.set(name, value)
    return spark


def local_session(cpus: str = "8", partitions: str = "8", memory: str = "8g") -> SparkSession:
    """A local session for tests and measurements."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("barlake")
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.debug.maxToStringFields", "200")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for name, value in CONF.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_MADE: list[str] = []


@atexit.register
def _remove_work() -> None:
    """Intermediate tables last as long as the program that made them."""
    context = SparkContext._active_spark_context
    for path in _MADE:
        with contextlib.suppress(Exception):  # what can't be removed must not spoil the exit
            if context is None:
                shutil.rmtree(path.removeprefix("file://"), ignore_errors=True)
            else:
                where = context._jvm.org.apache.hadoop.fs.Path(path)
                where.getFileSystem(context._jsc.hadoopConfiguration()).delete(where, True)


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for checkpoints and intermediate tables.

    It lies in the shared folder the cluster names in ``spark.checkpoint.dir``, so it
    outlives any executor; it is removed when the program ends. Where that is unset, only a
    session whose driver and executors are one process may use a folder of its own; a
    cluster must name one.
    """
    shared, master = spark.conf.get("spark.checkpoint.dir", None), spark.conf.get("spark.master", "")
    if shared:
        path = f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    elif master == "local" or master.startswith("local["):
        path = tempfile.mkdtemp(prefix=f"barlake-{name}-")
    else:
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    _MADE.append(path)
    return path
