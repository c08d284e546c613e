"""Session helpers: the library never creates a session for callers; these are
for tests, the bench script and the checkpoint directory lookup."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(
    cores: str = "*", shuffle_partitions: int = 8, app: str = "likeness", min_partition_size: str | None = None
) -> SparkSession:
    """A local session tuned like the cluster one: AQE with skew join on, UI off.

    ``min_partition_size`` lowers AQE's coalescing floor: the pair joins here
    expand their inputs many times over, so partitions sized by shuffle input
    alone can leave cores idle on small data.
    """
    b = SparkSession.builder
    if min_partition_size:
        b = b.config("spark.sql.adaptive.coalescePartitions.minPartitionSize", min_partition_size)
    return (
        b.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


_FALLBACK_DIR: dict[str, str] = {}


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Only for a local master (tests), where driver and executors are one
    process, do we make one of our own, once per application; elsewhere a
    missing setting is an error, since executors share no local folder.  The directory is also registered with the
    SparkContext so that ``DataFrame.checkpoint()`` and ALS's periodic
    checkpoints use it.  (The setting is a core config, so it is read, never
    set, at runtime.)
    """
    sc = spark.sparkContext
    path = spark.conf.get(CHECKPOINT_CONF, None) or sc.getCheckpointDir()
    if not path:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
        app = sc.applicationId
        if app not in _FALLBACK_DIR:
            _FALLBACK_DIR[app] = tempfile.mkdtemp(prefix="likeness-ckpt-")
        path = _FALLBACK_DIR[app]
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` as parquet under the shared checkpoint folder and read it back.

    Used where one intermediate (a long-form set table, a candidate list) feeds
    several branches of a plan: without it every branch re-runs the scan and
    shuffles, and the analysed plan grows with each copy.  The written table
    survives executor loss (unlike a local checkpoint), costs one job (a
    reliable RDD checkpoint recomputes its last stage to write it), and gives
    the optimizer real sizes for its broadcast and partitioning decisions.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/likeness-{uuid.uuid4().hex}"
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    _WRITTEN.setdefault(spark.sparkContext.applicationId, []).append(path)
    return spark.read.parquet(path)


_WRITTEN: dict[str, list[str]] = {}


def scratch(spark: SparkSession, name: str = "files") -> str:
    """A new folder name under the shared checkpoint folder, for files that are
    written and read again; ``release_materialized`` deletes it with the tables."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/likeness-{name}-{uuid.uuid4().hex}"
    _WRITTEN.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def release_materialized(spark: SparkSession) -> int:
    """Delete the tables ``materialize`` wrote for this application.

    Call it once the results that read them have been computed or saved --
    the lazy DataFrames returned by the operators read these tables.  Uses the
    Hadoop FileSystem of each path, so it works on any shared store.
    Returns the number of folders removed.
    """
    paths = _WRITTEN.pop(spark.sparkContext.applicationId, [])
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    removed = 0
    for p in paths:
        hp = jvm.org.apache.hadoop.fs.Path(p)
        removed += bool(hp.getFileSystem(conf).delete(hp, True))
    return removed
