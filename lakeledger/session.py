"""Session helpers.

The library never creates a session behind the caller's back; these helpers
are for scripts, tests and the bench.  Cluster settings (checkpoint folder,
shuffle partitions, memory) are read from the session when present.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every session of ours needs for correct results.
REQUIRED_CONF = {
    # ISO texts carry 'Z'; event days and years are taken in UTC.
    "spark.sql.session.timeZone": "UTC",
    # try_cast / try_to_timestamp are used explicitly; keep ANSI on.
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def _default_driver_memory() -> str:
    """Half of the machine's memory, at most 16g (local mode: the driver
    heap holds every executor thread)."""
    try:
        total = os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES")
        gb = max(1, min(16, int(total / 2 ** 30 / 2)))
    except (ValueError, OSError, AttributeError):
        gb = 4
    return f"{gb}g"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "lakeledger", extra: dict | None = None) -> SparkSession:
    """A local session for tests and the bench (UI off, UTC, AQE on)."""
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         # Checkpoint files go when nothing refers to them any more.
         .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory",
                 os.environ.get("LAKELEDGER_DRIVER_MEM", _default_driver_memory()))
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         # Python call sites for error messages cost several JVM round trips
         # per column function while a plan is being built.
         .config("spark.python.sql.dataFrameDebugging.enabled", "false"))
    for k, v in {**REQUIRED_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_session_conf(spark)
    return spark


def ensure_session_conf(spark: SparkSession) -> SparkSession:
    """Apply the settings results depend on to an existing session."""
    for k, v in REQUIRED_CONF.items():
        try:
            if spark.conf.get(k, None) != v:
                spark.conf.set(k, v)
        except Exception:  # static / not modifiable at runtime: leave as is
            pass
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without the setting (tests, local runs) gets a fresh
    scratch folder; on a cluster a folder of one machine would lose data, so
    a missing setting is an error there.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        d = tempfile.mkdtemp(prefix="lakeledger-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d
