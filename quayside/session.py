"""Session helpers: building a session for tests/jobs and finding shared scratch space."""

from __future__ import annotations

import tempfile
import uuid

from pyspark import SparkConf, SparkContext
from pyspark.sql import SparkSession


def submitted_settings() -> set[str]:
    """Names of the settings that are already decided: by spark-submit (its ``--conf``, its
    properties file), or by a running session."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return set(active.conf.getAll)
    SparkContext._ensure_initialized()
    return {k for k, v in SparkConf().getAll() if (k, v) not in _LAUNCHER and k != "spark.app.name"}


# what the launcher sets where the user has decided nothing
_LAUNCHER = {("spark.master", "local[*]"), ("spark.ui.showConsoleProgress", "true"), ("spark.submit.deployMode", "client"), ("spark.submit.pyFiles", "")}


def build_session(master: str | None = "local[*]", shuffle_partitions: int | None = None, app: str = "quayside", extra: dict | None = None) -> SparkSession:
    """Session for tests, the bench and the job script. Adds only settings that are not decided
    already: nothing here overrides ``spark-submit`` or a running session."""
    wanted = {
        "spark.app.name": app,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        # folders of a table are listed in so many tasks at most, not in one task each
        "spark.sql.sources.parallelPartitionDiscovery.parallelism": "256",
    }
    if shuffle_partitions is not None:
        wanted["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master:
        wanted["spark.master"] = master
    wanted |= {k: str(v) for k, v in (extra or {}).items()}
    given = submitted_settings()
    builder = SparkSession.builder
    for k, v in wanted.items():
        if k not in given:
            builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Read from the session; only when it is unset on a local master (tests) is a private
    folder created and registered, so ``DataFrame.checkpoint()`` works as well. On a
    cluster an unset folder is an error: a machine-local folder would not be shared."""
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect sessions have no SparkContext
        sc = None
    root = spark.conf.get("spark.checkpoint.dir", None) or (sc.getCheckpointDir() if sc else None)
    if not root:
        master = spark.conf.get("spark.master", "") or ""
        if not master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: on a cluster it must name a shared folder "
                "(checkpoints and scratch tables are written there)"
            )
        root = tempfile.mkdtemp(prefix="quayside-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, prefix: str) -> str:
    """A fresh, never reused path under the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/quayside/{prefix}_{uuid.uuid4().hex[:12]}"


def fresh_name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:12]}"
