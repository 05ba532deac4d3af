"""Session construction and the shared scratch location.

Cluster deployments pass their own settings (``spark-submit --conf``); the helpers
here only fill in what is unset, so a test or a bench run on ``local[N]`` gets
sane defaults while a cluster keeps its own.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Defaults that hold at any scale: adaptive execution re-plans joins from real
# shuffle sizes, coalesces small partitions and splits skewed ones. Static
# broadcast decisions (from the planner's size estimates, which can be far off
# for derived tables) are switched off: a side is broadcast only when its
# measured size is under the adaptive threshold, otherwise it is sort-merged.
_DEFAULTS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.optimizer.nestedSchemaPruning.enabled": "true",
}


def build_session(
    master: str | None = None,
    app: str = "notchline",
    shuffle_partitions: int | None = None,
    driver_memory: str | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the defaults above.

    With ``master`` (a local run: tests, bench) every default goes on the builder.
    Without it (``spark-submit`` on a cluster) the launcher's settings win: after
    the session exists, only SQL settings the launcher left unset are filled in.
    """
    conf = dict(_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if driver_memory:
        conf["spark.driver.memory"] = driver_memory
    conf.update(extra or {})
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
        for k, v in conf.items():
            builder = builder.config(k, v)
        spark = builder.getOrCreate()
    else:
        spark = builder.getOrCreate()
        sc = _context(spark)
        given = sc.getConf() if sc is not None else None
        for k, v in conf.items():
            if k.startswith("spark.sql.") and (given is None or not given.contains(k)):
                spark.conf.set(k, v)
    sc = _context(spark)
    if sc is not None:
        sc.setLogLevel("ERROR")
    return spark


def _context(spark: SparkSession):
    """The SparkContext of a classic session; None under Spark Connect."""
    try:
        return spark.sparkContext
    except Exception:  # Spark Connect sessions have no context on the client
        return None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    Read from ``spark.checkpoint.dir`` (or a directory already set on the
    context). Only when neither is set and the master is local -- a test run -- a
    private folder is created and registered; on a cluster that is an error.
    """
    sc = _context(spark)
    configured = (sc.getConf().get("spark.checkpoint.dir") if sc else None) or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if configured:
        if sc is not None and not sc.getCheckpointDir():
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir().rstrip("/")
    if sc is None or not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="notchline-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir().rstrip("/")


def default_parallelism(spark: SparkSession) -> int:
    sc = _context(spark)
    if sc is not None:
        return sc.defaultParallelism
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder for a written table."""
    root = ensure_checkpoint_dir(spark)
    return f"{root}/tables/{name}-{uuid.uuid4().hex}"
