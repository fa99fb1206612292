"""Spark session helpers.

The library never creates a session on its own inside a report; callers pass
one in.  ``build_session`` is what tests, ``bench.py`` and ad-hoc scripts use:
AQE on (runtime coalescing, skew-join splitting, broadcast by *measured* size),
UTC session time zone, UI off.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job in this package expects.  Shuffle partitions are sized by
# the caller (cores locally, data volume on a cluster); AQE coalesces them.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot key even where that costs one more shuffle (payments join
    # bills and then charges on the same key)
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

# Added by ``build_session(cluster=True)``: sizes for ~1000 executors and
# ~100 TB of input.  AQE starts from many shuffle partitions and coalesces them
# to the advisory size; it broadcasts a join side only when its measured size
# is under 64 MB.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, app: str = "condofin",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None, cluster: bool = False) -> SparkSession:
    """A session with the settings the jobs expect; on a cluster the master and
    the memory come from its own configuration."""
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    builder = SparkSession.builder.appName(app)
    conf = dict(BASE_CONF)
    if cluster:
        conf.update(CLUSTER_CONF)
    else:
        builder = builder.master(master or f"local[{cpus}]")
        conf["spark.sql.shuffle.partitions"] = str(cpus)
        conf["spark.driver.memory"] = "16g"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory, setting it only when unset.

    On a cluster the directory comes from ``spark.checkpoint.dir`` (a shared
    file system).  Only a local-mode session without that setting gets a
    private scratch folder, as tests do.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="condofin-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


SCRATCH = "condofin-tables"

#: Open scopes of an application, the innermost last: paths of the tables
#: written since each was opened.
_SCOPES: dict[str, list[list[str]]] = {}


def scratch_table(spark: SparkSession) -> str:
    """A new path for an intermediate table in the shared checkpoint folder."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{SCRATCH}/{uuid.uuid4().hex}"
    scopes = _SCOPES.get(spark.sparkContext.applicationId)
    if scopes:
        scopes[-1].append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession):
    """Intermediate tables that are written inside are deleted at the end.

    For one report or job: compute and store its result inside, as DataFrames
    that still read such a table can't be computed again afterwards.  Scopes
    may be nested; an inner one deletes what was written in it alone."""
    scopes = _SCOPES.setdefault(spark.sparkContext.applicationId, [])
    scopes.append([])
    try:
        yield
    finally:
        for path in scopes.pop():
            _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def remove_scratch(spark: SparkSession) -> bool:
    """Delete the intermediate tables that this application has written.

    For the end of a job: DataFrames that still read them cannot be computed
    again afterwards."""
    return _delete(spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/{SCRATCH}")
