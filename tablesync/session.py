"""Session construction and the shared scratch location."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every tablesync session wants.  AQE re-plans joins at runtime
# (broadcast when the measured side is small, split skewed partitions of the
# left-anti join in the delta upsert) and coalesces small shuffle partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # ~256 MB input splits and post-shuffle partitions: sized for executor
    # memory, not for the data volume (AQE coalesces small shuffle partitions).
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "static",
    "spark.ui.enabled": "false",
    "spark.log.structuredLogging.enabled": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tablesync", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the tablesync defaults.

    On a cluster pass ``master=None`` and let the launcher decide; size
    ``spark.sql.shuffle.partitions`` to the data (AQE coalesces downwards).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shuffle_partitions_for(input_bytes: int, partition_bytes: int = 256 * 1024 * 1024,
                           minimum: int = 8) -> int:
    """Initial ``spark.sql.shuffle.partitions`` for a job reading ``input_bytes``:
    one ~256 MB partition per slice of input (AQE coalesces downwards).
    100 TB -> ~400 000; sf0.1 -> the minimum."""
    return max(minimum, -(-int(input_bytes) // partition_bytes))


def _is_local(spark: SparkSession) -> bool:
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def _checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session may leave it unset (tests): there a temporary folder
    is registered.  On a cluster the driver's disk is no place the executors
    can see, so an unset folder is an error.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    root = root or sc.getCheckpointDir()
    if not root:
        if not _is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="tablesync-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root


def hadoop_path(spark: SparkSession, path: str):
    """``(file system, qualified path)`` as Spark itself resolves ``path``: a
    path without a scheme belongs to the cluster's default file system."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, fs.makeQualified(p)


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh, unique directory under the shared checkpoint root."""
    fs, path = hadoop_path(spark, f"{_checkpoint_root(spark).rstrip('/')}/tablesync/{purpose}-{uuid.uuid4().hex[:12]}")
    fs.mkdirs(path)
    text = path.toString()
    default = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///")
    # A local folder is a plain path where the default file system is the local one.
    return path.toUri().getPath() if text.startswith("file:") and default.startswith("file:") else text


def path_exists(path: str, spark: SparkSession | None = None) -> bool:
    """Whether a file or folder exists, asked of the file system that Spark
    would read it from."""
    fs, p = hadoop_path(spark or SparkSession.active(), path)
    return fs.exists(p)


def list_names(path: str, spark: SparkSession | None = None, before_ms: int | None = None) -> list[str]:
    """Names in a folder (none if there is no such folder), those last changed
    up to ``before_ms`` where given."""
    fs, p = hadoop_path(spark or SparkSession.active(), path)
    if not fs.exists(p):
        return []
    return sorted(f.getPath().getName() for f in fs.listStatus(p)
                  if before_ms is None or f.getModificationTime() <= before_ms)


def delete_path(path: str, spark: SparkSession | None = None) -> bool:
    """Delete a file or a whole folder; False if there was none."""
    fs, p = hadoop_path(spark or SparkSession.active(), path)
    return fs.delete(p, True)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``tablesync`` importable on Python workers (the paged DataSource's
    reader runs there): zip the package once per application into the shared
    checkpoint folder and ``addPyFile`` it, as ``--py-files`` would."""
    import io
    import zipfile

    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for base, _, names in os.walk(pkg):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(base, name)
                    z.write(full, os.path.join("tablesync", os.path.relpath(full, pkg)))
    target = f"{scratch_dir(spark, 'pyfiles')}/tablesync.zip"
    fs, path = hadoop_path(spark, target)
    out = fs.create(path, True)
    out.write(bytearray(buf.getvalue()))
    out.close()
    sc.addPyFile(path.toString())
    _SHIPPED.add(sc.applicationId)
