"""Session settings the operators rely on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings: safe to set on a session somebody else created.
RUNTIME_CONF = {
    # event times are UTC and the test tables hold TIMESTAMP_NTZ
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # a hot join key is split across tasks, even when the operator above then
    # needs a shuffle of its own
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(app: str = "riskloom", cores: int = 8, memory: str = "8g") -> SparkSession:
    """A local-mode session for tests and benchmarks."""
    builder = (
        SparkSession.builder.appName(app)
        .master(f"local[{cores}]")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # call-site capture costs more than planning on small inputs
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder named by ``spark.checkpoint.dir``.

    A machine-local folder is used only where that is unset *and* the session
    runs in local mode; a cluster without the setting is an error.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="riskloom-")
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def apart(df: DataFrame) -> DataFrame:
    """The same rows in a copy of their session, for whoever observes them.

    Spark keeps observations with the session in a form that does not travel, so that a model
    with its training summary, which holds the session, would no longer reach the tasks.
    """
    own = df.sparkSession._jsparkSession.cloneSession()
    dataset = df.sparkSession._jvm.org.apache.spark.sql.classic.Dataset
    return DataFrame(dataset.ofRows(own, df._jdf.logicalPlan()), df.sparkSession)


def _path(spark: SparkSession, path: str):
    """``(file system, path)`` of whatever store the path names."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def listed(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder; none if it is not there."""
    store, where = _path(spark, path)
    if not store.exists(where):
        return []
    return [s.getPath().getName() for s in store.listStatus(where)]


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that a job made for itself, if it is there."""
    store, where = _path(spark, path)
    store.delete(where, True)
