"""Session helpers.

Library functions never build a session: the caller owns it.  ``local_session``
exists for tests and the benchmark.  ``staging_dir`` hands out folders for
files a job writes and reads back; they live under ``spark.checkpoint.dir`` so
that on a cluster they sit on shared storage, never on one machine's disk.
"""

from __future__ import annotations

import atexit
import hashlib
import os
import shutil
import tempfile
import threading
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
#: Spark's own setting: an execution's shuffle files go when it ends, not when the driver happens to collect garbage.
CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "marquee", extra_conf: dict | None = None) -> SparkSession:
    """A local session for tests and benchmarks (AQE on, UI off, UTC)."""
    builder = SparkSession.builder
    for k, v in (extra_conf or {}).items():
        builder = builder.config(k, v)
    spark = (
        builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("MARQUEE_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint dir, creating a local one only if unset.

    On a cluster ``spark.checkpoint.dir`` names shared storage and is used as
    given.  Only when nothing is configured (local tests) do we make one.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return sc.getCheckpointDir()
    current = sc.getConf().get(CHECKPOINT_CONF, None)
    if not current:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError(f"{CHECKPOINT_CONF} is not set: a cluster needs a folder that all executors share")
        current = tempfile.mkdtemp(prefix="marquee-ckpt-")  # one machine: tests and trials
        atexit.register(shutil.rmtree, current, ignore_errors=True)
    sc.setCheckpointDir(current)
    return sc.getCheckpointDir() or current


def staging_dir(spark: SparkSession, name: str, key: str | None = None) -> str:
    """A folder under the shared checkpoint dir for files a job writes.

    With ``key`` the folder is stable (same key -> same folder), so derived
    inputs are written once and read back by later queries; without it every
    call gets a fresh folder.
    """
    base = ensure_checkpoint_dir(spark).rstrip("/")
    suffix = hashlib.sha1(key.encode()).hexdigest()[:12] if key else uuid.uuid4().hex[:12]
    return f"{base}/marquee-staging/{name}-{suffix}"


def drop_staging(spark: SparkSession) -> None:
    """Delete every folder that this application has staged.  Frames that
    still read one of them cannot be computed afterwards."""
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/marquee-staging"
    delete_path(spark, root)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder on whatever file system it is."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def move_path(spark: SparkSession, source: str, target: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = p(source).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.rename(p(source), p(target)):
        raise OSError(f"could not move {source} to {target}")


def make_folder(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(p)


def fingerprint(spark: SparkSession, paths: list[str]) -> str:
    """A hash of the names, sizes and times of all files under ``paths``: what
    is kept for one set of inputs is not used for another."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    found = []
    for path in paths:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(conf)
        for status in fs.globStatus(p) or []:
            files = fs.listFiles(status.getPath(), True)
            while files.hasNext():
                f = files.next()
                found.append(f"{f.getPath()} {f.getLen()} {f.getModificationTime()}")
    return hashlib.sha1("\n".join(sorted(found)).encode()).hexdigest()


def ship_package(spark: SparkSession) -> None:
    """Give the workers this package, as a zip, once per application.  Needed
    where it is not installed on them: their Python functions import it."""
    sc = spark.sparkContext
    root = os.path.dirname(os.path.abspath(__file__))
    name = f"marquee-{sc.applicationId}.zip"
    if any(str(f).endswith(name) for f in sc._python_includes):
        return
    folder = tempfile.mkdtemp(prefix="marquee-zip-")  # the driver serves it from here
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    with zipfile.ZipFile(os.path.join(folder, name), "w", zipfile.ZIP_DEFLATED) as z:
        for d, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    z.write(os.path.join(d, f), os.path.relpath(os.path.join(d, f), os.path.dirname(root)))
    sc.addPyFile(os.path.join(folder, name))


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists, on whatever file system it names."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def mark_done(spark: SparkSession, path: str) -> None:
    """Write a completion marker (after every output of a step is written)."""
    spark.range(1).selectExpr("'ok' AS s").write.mode("overwrite").text(path)


def materialize(df, name: str = "materialized"):
    """Compute ``df`` once into a Parquet table under the shared checkpoint
    dir and continue from that table (lineage cut).

    Used where a costly intermediate (e.g. an aggregate over the largest
    table) feeds several branches of one plan: re-reading is cheaper than
    re-running the scan and shuffle, survives lost executors, and being
    columnar a branch that needs one column reads one column.  Never a
    local checkpoint, never a machine-local folder.
    """
    spark = df.sparkSession
    path = staging_dir(spark, name)
    for made in _made.get():
        made.append(path)
    with _no_shuffle_left(spark):
        df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


_made: ContextVar[tuple[list[str], ...]] = ContextVar("made", default=())
_cleaning, _cleaning_lock = {"writers": 0, "before": None}, threading.Lock()


@contextmanager
def _no_shuffle_left(spark: SparkSession) -> Iterator[None]:
    """What is written meanwhile leaves no shuffle files; nothing reads those
    of a table that is there.  The session's setting is as before afterwards."""
    with _cleaning_lock:
        if not _cleaning["writers"]:
            _cleaning["before"] = spark.conf.get(CLEANUP_CONF, None)
            spark.conf.set(CLEANUP_CONF, "true")
        _cleaning["writers"] += 1
    try:
        yield
    finally:
        with _cleaning_lock:
            _cleaning["writers"] -= 1
            if not _cleaning["writers"]:
                spark.conf.unset(CLEANUP_CONF) if _cleaning["before"] is None else spark.conf.set(CLEANUP_CONF, _cleaning["before"])


@contextmanager
def staged_tables() -> Iterator[list[str]]:
    """The paths of the tables that :func:`materialize` writes meanwhile, to
    be deleted when nothing reads them any more."""
    made: list[str] = []
    token = _made.set((*_made.get(), made))
    try:
        yield made
    finally:
        _made.reset(token)


def discard(df) -> None:
    """Delete the table of a frame that :func:`materialize` gave, when nothing
    that is still to be computed reads it."""
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        delete_path(df.sparkSession, folder)


# Suggested settings for a large cluster.  The library never sets these
# itself (the cluster's owner does); they are what the jobs were shaped for.
# Sizing for ~100 TB of input: scans split at 256 MB (~400k map tasks); the
# largest shuffle is the per-film partial aggregate of the ratings/lineitem
# table (~6 TB), so 32k shuffle partitions land near the 256 MB advisory size
# and AQE coalesces the smaller shuffles.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.shuffle.partitions": "32000",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}
