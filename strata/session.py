"""Session helpers: configuration that matters at scale, and the shared scratch folder.

The library never creates a session implicitly inside an operator; callers pass one in.
``configure`` only sets options that are still unset, so cluster-level settings
(shuffle partitions, checkpoint dir, AQE thresholds) always win.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

# Settings every query relies on: UTC session time zone (dates are calendar dates),
# ANSI mode (text conversions go through try_* on purpose), and adaptive execution
# with skew-join splitting so a hot building/unit key is split at runtime.
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply library defaults without overriding anything the cluster already set."""
    conf = spark.conf
    for key, value in _DEFAULTS.items():
        try:
            if conf.get(key, None) is None:
                conf.set(key, value)
        except Exception:  # static conf on a running session: leave as is
            pass
    # These two must hold for exact results whatever the cluster default is.
    conf.set("spark.sql.session.timeZone", "UTC")
    conf.set("spark.sql.ansi.enabled", "true")
    # a table bucketed by unit joins on (charge, unit) where it lies: no exchange for the second key
    conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    return spark


# Tasks grow with the data: one shuffle partition for so many bytes of input files, before Spark puts small ones together.
TASK_BYTES = 4 << 20
_FIRST_PARTS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
_PART_BYTES = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def tasks_for(spark: SparkSession, size: int) -> int:
    """Partitions for work on ``size`` bytes of input files: the cluster's number, more where the data needs more.

    Shuffles of the session start from as many too, so a task sorts and joins a bounded number of rows at any size;
    adaptive execution puts small partitions together, up to 16 MB where the cluster names no size (rows of a ledger
    take some twenty times as much in memory as in a shuffle file).
    """
    own = int(spark.conf.get("spark.sql.shuffle.partitions"))
    need = max(own, -(-size // TASK_BYTES))
    if need > own and int(spark.conf.get(_FIRST_PARTS, None) or 0) < need:
        spark.conf.set(_FIRST_PARTS, str(need))
    # also where the cluster's own number is enough: they would be put together up to 64 MB
    if spark.conf.get(_PART_BYTES, None) is None:
        spark.conf.set(_PART_BYTES, "16m")
    return need


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "strata") -> SparkSession:
    """Session for tests and the local bench (never used by the operators themselves)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("STRATA_DRIVER_MEMORY", "8g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A fresh folder under the cluster's shared checkpoint location.

    Reads ``spark.checkpoint.dir`` from the session, else the folder set with ``setCheckpointDir``. Only a local
    session without either (tests) gets a folder under the system temp dir; on a cluster that is an error, since
    executors do not share their own disks. Every call returns a new, unique sub-folder of the application's folder,
    which ``drop_run`` removes.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = os.path.join(os.environ.get("TMPDIR", "/tmp"), "strata-checkpoints")
        spark.sparkContext.setCheckpointDir(base)
    return os.path.join(base, run_name(spark), *parts, uuid.uuid4().hex)


def run_name(spark: SparkSession) -> str:
    """Names what this application stores: its folder, and the prefix of its tables."""
    return "strata_" + "".join(c if c.isalnum() else "_" for c in spark.sparkContext.applicationId.lower())


def drop_run(spark: SparkSession) -> None:
    """Removes all that this application stored: its shared folder, its tables and the ledgers it remembers.

    For the end of a job, when no DataFrame of it is read any more.
    """
    from .plans import catalog

    name = run_name(spark)
    for table in spark.catalog.listTables(pattern=f"{name}_*"):
        spark.sql(f"DROP TABLE IF EXISTS `{table.name}`")
    app = spark.sparkContext.applicationId
    for key in [k for k in catalog._LEDGERS if k[0] == app]:
        del catalog._LEDGERS[key]
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(os.path.join(base, name))
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, on whatever file system the path names."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p))


def is_folder(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(p).isDirectory())


def path_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of a file, or of all files under a folder; 0 if absent."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return int(fs.getContentSummary(p).getLength()) if fs.exists(p) else 0


def path_stamp(spark: SparkSession, path: str) -> tuple[int, int]:
    """Bytes and latest change of a file, or of the files directly in a folder; (0, 0) if absent."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return 0, 0
    files = list(fs.listStatus(p))
    return sum(f.getLen() for f in files), max((f.getModificationTime() for f in files), default=0)
