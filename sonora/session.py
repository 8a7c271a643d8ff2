"""Session construction and per-session settings every operator relies on."""
from __future__ import annotations

import os
import tempfile

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

# Settings the operators need for their results to be right, whatever built
# the session: play times are epoch seconds rendered in UTC.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
}

# Settings that only tune execution (safe to override on a cluster).
TUNING_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
}


def build_session(master: str | None = None, app: str = "sonora",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session configured for the operators.

    On a cluster pass ``master=None`` and let spark-submit decide; locally
    ``local[N]`` with shuffle partitions sized to the cores.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **REQUIRED_CONF,
        **TUNING_CONF,
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings results depend on to an existing session."""
    for k, v in REQUIRED_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and staged tables.

    Read from ``spark.checkpoint.dir`` (the cluster names a shared, durable
    folder there).  Only when nothing is configured -- local tests -- a
    scratch folder is created and registered.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="sonora-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir().rstrip("/")


def staging_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder for written intermediate tables."""
    base = checkpoint_dir(spark)
    return "/".join([base, "sonora-staged", *[p.strip("/") for p in parts]])


def missing_path(error: AnalysisException) -> bool:
    """Whether a read failed only because nothing lies at its path."""
    return error.getCondition() == "PATH_NOT_FOUND"


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme for local-only helpers (tests)."""
    return path[len("file:"):] if path.startswith("file:") else path


def env_cpus(default: int = 8) -> int:
    try:
        return int(os.environ.get("BENCH_CPUS", default))
    except ValueError:
        return default
