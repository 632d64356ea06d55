"""Session settings and the shared scratch folder.

The library never builds its own cluster session: callers pass one in.
``local_session`` exists for tests and the bench only.  Anything a job
writes to cut lineage or to stage files goes under the folder the
cluster names in ``spark.checkpoint.dir``; a private folder is created
only when that setting is missing *and* the session runs in local mode.
"""

from __future__ import annotations

import gc
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every session used with this library should have.  AQE turns
# the planned sort-merge joins into broadcast joins only after measuring
# the real size of a side at run time, and splits skewed shuffle
# partitions of joins.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}

CHECKPOINT_CONF = "spark.checkpoint.dir"
BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 4 << 20


def _driver_memory() -> str:
    """Local mode runs everything in the driver JVM: give it at most 16 GB
    and at most half of the machine's memory."""
    env = os.environ.get("STRATA_DRIVER_MEM")
    if env:
        return env
    try:
        total = os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES")
        gb = max(1, min(16, int(total / 2 ** 30 * 0.5)))
    except (ValueError, OSError, AttributeError):
        gb = 4
    return f"{gb}g"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "strata", extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench (UI off, AQE on)."""
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", _driver_memory())
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    for k, v in {**RECOMMENDED_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


_FALLBACK_DIRS: dict[str, str] = {}


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder from ``spark.checkpoint.dir``.

    If unset, a private folder is used, but only in local mode (on a
    cluster a machine-local folder would vanish with its executor).  The
    setting itself cannot be changed at run time in Spark 4, so the private
    folder is remembered per application and given to
    ``SparkContext.setCheckpointDir`` for ``checkpoint()``.
    """
    sc = spark.sparkContext
    d = spark.conf.get(CHECKPOINT_CONF, None) or sc.getConf().get(CHECKPOINT_CONF, None)
    if not d:
        d = _FALLBACK_DIRS.get(sc.applicationId)
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                f"{CHECKPOINT_CONF} is not set; point it at a shared folder "
                "(HDFS/S3/ABFS) that every executor can reach")
        d = tempfile.mkdtemp(prefix="strata-ckpt-")
        _FALLBACK_DIRS[sc.applicationId] = d
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the shared checkpoint folder, in the
    application's own folder (see ``drop_scratch``)."""
    return f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def _scratch_root(spark: SparkSession) -> str:
    return f"{checkpoint_dir(spark)}/strata/{spark.sparkContext.applicationId}"


def drop_scratch(spark: SparkSession) -> None:
    """Delete the intermediate tables of this application.  For the caller,
    once the results are written: frames read from them are of no use then."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(root, True)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files and broadcasts of frames that are no
    longer referenced.  It does so when the driver's garbage collector finds
    them, by itself every 30 minutes or when the heap is full."""
    gc.collect()                                # Python's references to the JVM's frames
    spark.sparkContext._jvm.System.gc()


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs that run inside send rows to Python in batches of about BATCH_BYTES.

    Spark's own batches hold 10,000 rows however long their texts are, and
    executor and worker keep several copies of one.  A limit that the caller
    has set stays."""
    if spark.conf.get(BATCH_CONF, None) is not None:
        yield
        return
    spark.conf.set(BATCH_CONF, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.unset(BATCH_CONF)


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared folder (never localCheckpoint)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the Python workers this package, once per application.

    Operators that run Python refer to the package's modules; on a cluster
    whose workers don't have it installed it goes along as a zip file."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    archive = shutil.make_archive(os.path.join(tempfile.mkdtemp(prefix="strata-py-"), "strata-package"), "zip",
                                  os.path.dirname(package), os.path.basename(package))
    sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage with a written table: one job writes ``df`` as Parquet
    under the shared checkpoint folder and the result is read back.  Unlike
    ``checkpoint()`` the input is not computed twice, and later scans get
    column pruning, filter pushdown and file statistics for AQE."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
