"""Session helpers.

On a cluster the session comes from the launcher and is used as is; these
helpers only fill in settings that are unset, so the same code runs in tests
on ``local[*]`` and on a many-executor deployment.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on. They are applied only when the running
# session has no value for them.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # rows hold whole texts: small Arrow batches bound what a task and its
    # Python worker hold at a time
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "8388608",
}
# Overwrite semantics are never taken from the session: every write states
# ``partitionOverwriteMode`` itself (full replace = static, upsert = dynamic).


def build_session(master: str | None = None, app: str = "stratum",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or fetch) a session with the library defaults.

    ``master`` is only used when given, so a cluster launcher keeps control.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULTS)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    conf["spark.scheduler.mode"] = "FAIR"  # models built at the same time share the executors
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    apply_defaults(spark)
    return spark


def apply_defaults(spark: SparkSession) -> None:
    """Set library defaults that the session does not define yet."""
    for k, v in DEFAULTS.items():
        if spark.conf.get(k, None) in (None, ""):
            spark.conf.set(k, v)


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and staged writes.

    Uses the cluster's ``spark.checkpoint.dir``.  Only a local-mode session
    (tests) without one gets a private temporary folder; on a cluster a
    machine-local folder would not be visible to the executors, so a missing
    setting is an error there.
    """
    d = spark.sparkContext.getCheckpointDir()
    if d:
        return d.rstrip("/")
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (cluster session)")
        d = tempfile.mkdtemp(prefix="stratum-ckpt-")
    spark.sparkContext.setCheckpointDir(d)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def hadoop_fs(spark: SparkSession, path: str):
    """Hadoop FileSystem and Path objects for ``path`` (any scheme)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, p


def _qualify(path: str) -> str:
    """Relative local paths become absolute; anything with a scheme
    (``file:``, ``s3a://``, ``hdfs://``) or already absolute is kept."""
    if re.match(r"^[A-Za-z][A-Za-z0-9+.-]*:", path) or path.startswith("/"):
        return path
    return os.path.abspath(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = hadoop_fs(spark, _qualify(path))
    return bool(fs.exists(p))


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p = hadoop_fs(spark, path)
    if fs.exists(p):
        fs.delete(p, True)
