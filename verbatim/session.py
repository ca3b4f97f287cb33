"""Session helpers.

The library never creates its own cluster settings on a real deployment: it reads
what the session already has.  ``get_spark`` exists for tests, the bench and local use.
"""

from __future__ import annotations

import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "verbatim", extra: dict | None = None) -> SparkSession:
    """Local/test session with AQE on and the web UI off."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_shared: set[tuple[str, str]] = set()


def _is_shared(spark: SparkSession, folder: str) -> bool:
    """Whether what executors write into ``folder`` is there for the driver and all executors:
    a few rows are written and read back, once for each application and folder."""
    key = (spark.sparkContext.applicationId, folder)
    if key in _shared:
        return True
    tasks, path = 2 * spark.sparkContext.defaultParallelism, f"{folder.rstrip('/')}/verbatim-probe-{uuid.uuid4().hex}"
    try:
        spark.range(0, tasks, 1, tasks).write.parquet(path)
        there = spark.read.schema("id long").parquet(path).repartition(tasks).count() == tasks
    finally:
        _delete(spark, path)
    if there:
        _shared.add(key)
    return there


def _delete(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def _usable(spark: SparkSession, folder: str) -> tuple[bool, Exception | None]:
    try:
        return _is_shared(spark, folder), None
    except Exception as e:  # not shared shows as any error of the trial's job
        return False, e


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Shared folder for lineage cuts, taken from ``spark.checkpoint.dir``.

    A local session without one (tests, bench) gets ``fallback`` or a fresh scratch folder.
    On a cluster a folder without a URI scheme may be a mounted shared folder or one machine's
    own: it is taken if what executors write there can be read everywhere.  Without the
    setting a cluster's warehouse is taken under the same condition; with neither it is an
    error, as executors cannot read a folder on the driver's disk.
    """
    current = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    master = spark.sparkContext.master
    one_process = master.startswith("local") and not master.startswith("local-cluster")
    if current:
        if not one_process and "://" not in current and not current.startswith("file:"):
            # a bare path is on the default file system: shared, unless that is the local one
            default = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///")
            if default.startswith("file:"):
                shared, why = _usable(spark, current)
                if not shared:
                    raise RuntimeError(f"{CHECKPOINT_CONF} is {current!r}, a local path that executors "
                                       "do not share: name shared storage (HDFS/object store, a mounted folder)") from why
        return current
    if not one_process:
        warehouse = spark.conf.get("spark.sql.warehouse.dir", None)
        shared, why = _usable(spark, warehouse) if warehouse else (False, None)
        if not shared:
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a shared folder (HDFS/object store) "
                               "for lineage cuts on a cluster") from why
        return f"{warehouse.rstrip('/')}/verbatim-checkpoints"
    path = fallback or tempfile.mkdtemp(prefix="verbatim-ckpt-")
    spark.sparkContext.setCheckpointDir(path)
    return path


def cut_lineage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Materialise ``df`` as a Parquet table in the shared checkpoint folder; read it back.

    One job computes ``df``; unlike checkpoint files (serialised rows) the result is
    columnar, so later reads prune columns and carry size statistics for AQE; a lost
    executor costs a re-read, not a recomputation.  Never a local checkpoint.
    """
    spark = df.sparkSession
    base = checkpoint_dir(spark).rstrip("/")
    path = f"{base}/verbatim-tables/{name}-{uuid.uuid4().hex}"
    df.write.mode("error").parquet(path)
    for made in _open_scopes:
        made.append(path)
    return spark.read.parquet(path)


_open_scopes: list[list[str]] = []


@contextlib.contextmanager
def lineage_tables(spark: SparkSession):
    """Deletes the tables that ``cut_lineage`` made inside the block when it ends.

    Put it round a whole flow up to its last write: results that still read the tables
    must be written before the block ends.  Tables made outside of any block are the
    caller's to delete with the checkpoint folder.
    """
    made: list[str] = []
    _open_scopes.append(made)
    try:
        yield made
    finally:
        _open_scopes.remove(made)
        for path in made:
            _delete(spark, path)
