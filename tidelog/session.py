"""Session settings and the folder that intermediate tables are written to."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # merge the sessions of one input partition before they are shuffled
    "spark.sql.sessionWindow.merge.sessions.in.local.partition": "true",
    # needed by transformWithState, and keeps large state off the heap
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

#: bytes of a batch of whole texts or of their ids on its way to Python
BATCH_BYTES = 4 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"

_local_work_dirs: dict[str, str] = {}
_made: list[str] = []


def build(app: str = "tidelog", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the library's settings; `conf` wins over them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings the operators rely on to a session made elsewhere."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def bounded_batches(spark: SparkSession) -> SparkSession:
    """From now on a batch for Python ends at `BATCH_BYTES` and not only at a number of rows, unless the session has its own bound.

    Both sides hold a batch whole, so 10,000 long texts would be tens of megabytes for each task, outside the heap.
    """
    if spark.conf.get(_BATCH, None) is None:
        spark.conf.set(_BATCH, str(BATCH_BYTES))
    return spark


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared folder set in `spark.checkpoint.dir`.

    Only a local session may leave that setting empty; its folders go when the process ends.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        app = context.applicationId
        if app not in _local_work_dirs:
            _local_work_dirs[app] = tempfile.mkdtemp(prefix="tidelog-")
            atexit.register(shutil.rmtree, _local_work_dirs[app], ignore_errors=True)
        base = _local_work_dirs[app]
    _made.append(f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}")
    return _made[-1]


def cleanup(spark: SparkSession) -> None:
    """Delete the intermediate tables this process has made: when their results have been written."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    while _made:
        path = hadoop.Path(_made.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df, name: str):
    """Write `df` as a table in the shared folder and read it back.

    The files outlive any executor, and every later use reads the same rows.
    """
    spark = df.sparkSession
    path = work_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
