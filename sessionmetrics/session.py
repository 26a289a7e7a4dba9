"""Session construction (S6) and the shared working folder.

The job's settings: AQE on (coalesces small shuffles, splits skewed ones),
Kryo, and the session time zone pinned to UTC so ``to_date`` and
offset-less timestamps do not depend on where the driver runs.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import SparkSession

UTC = "UTC"

# Settings every session of this package gets.  Shuffle partitions are left
# to the cluster (or the caller) - AQE coalesces them at run time.
BASE_CONF = {
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": UTC,
    "spark.ui.enabled": "false",
}


def build_session(
    app_name: str = "sessionmetrics",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a SparkSession with the job's settings."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(BASE_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    pin_utc(spark)
    return spark


def pin_utc(spark: SparkSession) -> None:
    """Pin the session time zone to UTC.

    Time-zone-aware expressions take the zone when a DataFrame is analysed,
    so this must run before the plan is built.
    """
    if spark.conf.get("spark.sql.session.timeZone") != UTC:
        spark.conf.set("spark.sql.session.timeZone", UTC)


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder for intermediate tables and checkpoints.

    Taken from ``spark.checkpoint.dir`` (or the context's checkpoint dir).
    Only a local-mode session without one gets a fresh temporary folder;
    on a cluster a machine-local folder would be wrong, so that is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # not set anywhere
            configured = None
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not _is_local(spark):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; set it to a shared folder "
            "(e.g. on the cluster's distributed file system)"
        )
    local = tempfile.mkdtemp(prefix="sessionmetrics-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


# Folders handed out by scratch_path that still exist, with their session.
_SCRATCH: dict[str, SparkSession] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared folder; removed when the
    application ends unless ``remove_path`` did so earlier."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _SCRATCH[path] = spark
    return path


def _located(spark: SparkSession, path: str):
    """The path as Spark's file systems know it, and its file system."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder through Spark's own file systems."""
    _SCRATCH.pop(path, None)
    target, system = _located(spark, path)
    system.delete(target, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    target, system = _located(spark, path)
    return system.exists(target)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it is not there."""
    target, system = _located(spark, path)
    return [s.getPath().getName() for s in system.listStatus(target)] if system.exists(target) else []


def file_sizes(spark: SparkSession, path: str) -> dict[str, int]:
    """Names and sizes of a table's data files; none if it is not there."""
    target, system = _located(spark, path)
    found = system.listStatus(target) if system.exists(target) else []
    return {s.getPath().getName(): s.getLen() for s in found if s.getPath().getName()[0] not in "_."}


def read_text(spark: SparkSession, path: str) -> str:
    """A small file as text."""
    target, system = _located(spark, path)
    stream = system.open(target)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file, whole or not at all; raises if it is there already."""
    target, system = _located(spark, path)
    aside, _ = _located(spark, f"{path}.{uuid.uuid4().hex}.tmp")
    stream = system.create(aside, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    # a rename onto a file that exists fails or returns false
    if system.exists(target) or not system.rename(aside, target):
        system.delete(aside, False)
        raise FileExistsError(path)


@atexit.register
def _remove_scratch() -> None:
    for path, spark in list(_SCRATCH.items()):
        try:
            if spark.sparkContext._jsc is None:
                return
            remove_path(spark, path)
        except Exception:  # the JVM is already gone
            return
