"""Session construction and the shared scratch folder.

On a cluster the scratch folder is the shared ``spark.checkpoint.dir`` the cluster names; it is
read from the session.  Only when no checkpoint folder is configured (local runs and tests) do we
set one ourselves, under the machine's temporary folder.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str = "local[*]", app: str = "terrace", shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """A session with the settings this library assumes: AQE on, UI off, UTC session clock."""
    builder = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
    )
    settings = dict(extra or {})
    if shuffle_partitions:   # else the cluster's own setting holds
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _context(spark: SparkSession):
    """The SparkContext, or None for sessions without one (Spark Connect)."""
    try:
        return spark.sparkContext
    except Exception:  # PySparkNotImplementedError / AttributeError under Spark Connect
        return None


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder: the live ``SparkContext`` checkpoint folder, else the
    session's ``spark.checkpoint.dir`` (then also installed for ``DataFrame.checkpoint()``).
    Only for a local master with neither set (tests) is a folder created under the machine's
    temporary folder; anywhere else a missing setting is an error."""
    sc = _context(spark)
    live = sc.getCheckpointDir() if sc is not None else None
    if live:
        return live.rstrip("/")
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        if sc is None:
            return conf.rstrip("/")
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir().rstrip("/")
    master = sc.master if sc is not None else spark.conf.get("spark.master", None)
    if sc is None or not master or not master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder: staged tables and checkpoints live there")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="terrace-ckpt-"))
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder name under the shared checkpoint folder (not created)."""
    return f"{checkpoint_root(spark)}/terrace-scratch/{name}-{uuid.uuid4().hex[:12]}"


def hadoop_fs(spark: SparkSession, path: str):
    """(FileSystem, Path) for ``path`` through the session's Hadoop configuration."""
    jvm = spark._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = hadoop_fs(spark, path)
    return bool(fs.exists(jpath))


def delete_path(spark: SparkSession, path: str) -> None:
    fs, jpath = hadoop_fs(spark, path)
    if fs.exists(jpath):
        fs.delete(jpath, True)



def observed(observation, key: str, default: int = 0) -> int:
    """An observed metric, or ``default`` when the observed node never ran (AQE removes it from
    plans it proves empty)."""
    try:
        value = observation.get.get(key)
    except Exception as e:  # only "no metrics reported" means the input was empty
        java = getattr(e, "java_exception", None)
        if java is not None and java.getClass().getName() == "java.lang.AssertionError":
            return default
        raise
    return default if value is None else int(value)
