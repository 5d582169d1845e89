"""Session construction and shared scratch locations.

Intermediate tables and streaming checkpoints go under the cluster's shared
``spark.checkpoint.dir``.  Only a local-mode session without that setting
(tests, laptops) gets a temporary directory of its own.
"""

from __future__ import annotations

import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(master: str | None = "local[8]", app: str = "newsflow", shuffle_partitions: int | None = 8,
                  extra: dict | None = None) -> SparkSession:
    """Session with the settings the jobs are designed for (AQE, UTC, no UI).

    Without ``master`` and ``shuffle_partitions`` those come from the environment
    (``spark-submit``, ``spark-defaults.conf``), as on a cluster.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if master and master.startswith("local"):
        b = b.config("spark.driver.memory", "16g")
    b = (b.config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC"))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of this session.

    Reads ``spark.checkpoint.dir`` (or the context's checkpoint dir).  Only a
    local-mode session without one gets a fresh temporary folder, which is
    then registered as its checkpoint dir.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None)
    sc = _context(spark)
    if not root and sc is not None:
        root = sc.getCheckpointDir()
    if not root:
        if sc is None or not sc.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a shared folder on this cluster")
        root = tempfile.mkdtemp(prefix="newsflow-ckpt-")
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def _context(spark: SparkSession):
    """The SparkContext of a classic session; None on Spark Connect."""
    try:
        return spark.sparkContext
    except Exception:
        return None


_LOCAL = threading.local()        # streams run their batches in threads of their own


def _scopes() -> list[list[str]]:
    if not hasattr(_LOCAL, "scopes"):
        _LOCAL.scopes = []
    return _LOCAL.scopes


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder under the shared checkpoint root (see ``scratch_scope``)."""
    path = f"{checkpoint_root(spark)}/newsflow/{name}-{uuid.uuid4().hex}"
    if _scopes():
        _scopes()[-1].append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession):
    """Deletes at its end every scratch folder made inside it by this thread: the owner of a job ends it once the job's
    results are written or read, as DataFrames built inside may still read these folders."""
    paths: list[str] = []
    _scopes().append(paths)
    try:
        yield
    finally:
        _scopes().pop()
        sc = _context(spark)
        for p in paths if sc is not None else []:
            p = sc._jvm.org.apache.hadoop.fs.Path(p)
            p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)


def materialize(df, name: str = "table"):
    """Cut lineage with a written table in the shared checkpoint folder.

    One job writes Parquet and the result reads it back (column pruning and
    pushdown work on it).  Unlike ``checkpoint(eager=True)``, the plan is
    computed once, and unlike a cache it survives the loss of an executor.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def spread(df, key: str, tasks: int):
    """Hash-partition a table into ``tasks`` by its unique ``key``.

    CPU-heavy text expressions run per task; a file with a single row group
    would otherwise put a whole table into one task.  Hashing is deterministic
    on retry and lines up with joins on that key.
    """
    return df.repartition(tasks, key)
