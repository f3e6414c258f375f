"""Session settings and the shared folder for staged tables."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import SparkConf
from pyspark.sql import DataFrame, SparkSession

SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where that costs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A tier or division of digits stays text when a partitioned table is read.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}

# For a large cluster, on top of the above: start with many shuffle partitions and let
# adaptive execution merge them to the advisory size, in memory and in files.
CLUSTER_SETTINGS = {
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    # Stored results are planned by their size on disk; in memory they are larger.
    "spark.sql.sources.fileCompressionFactor": "4.0",
}


def build_session(
    app_name: str = "ladderlake", master: str | None = None, **settings
) -> SparkSession:
    """Session with the settings the jobs expect.

    On a cluster it also gets ``CLUSTER_SETTINGS``, but for those that the submitter
    gave. Storage credentials belong in the Spark configuration or the environment
    of the cluster; nothing here reads or prints them.
    """
    given = SparkConf()
    master = master or given.get("spark.master", None)
    cluster = {} if not master or master.startswith("local") else CLUSTER_SETTINGS
    cluster = {k: v for k, v in cluster.items() if not given.contains(k)}
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SQL_SETTINGS, **cluster, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """A session with the SQL settings next to one that somebody else built.

    It shares the context and has the other session's settings; that session
    itself stays as it is.
    """
    session = spark.newSession()
    current = session.conf.getAll
    for key, value in {**spark.conf.getAll, **SQL_SETTINGS}.items():
        if current.get(key) != value and session.conf.isModifiable(key):
            session.conf.set(key, value)
    return session


def reachable(spark: SparkSession) -> None:
    """Let Python workers find this package where only the driver's own path names it.

    On a cluster the package is shipped with the job (``--py-files``).
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def register_source(spark: SparkSession, source: type) -> None:
    """Make a Python data source known to this session.

    Spark looks a name up in the active session before it registers it, so this one is made
    active meanwhile.
    """
    active = SparkSession.getActiveSession()
    spark.createDataFrame([], "x int")  # its session becomes the active one
    try:
        spark.dataSource.register(source)
    finally:
        if active is not None:
            active.createDataFrame([], "x int")


# Applications and folders whose rows came back, for ``comes_back``.
_proven: set[tuple[str, str]] = set()


def comes_back(spark: SparkSession, root: str) -> bool:
    """Whether rows that tasks write below a folder are all read again; tried once for each.

    Files that a task wrote to the disk of its own machine are missing from what the driver
    commits and other tasks read.
    """
    tried = (spark.sparkContext.applicationId, root)
    if tried not in _proven:
        path = f"{root}/ladderlake/probe-{uuid.uuid4().hex}"
        tasks = max(spark.sparkContext.defaultParallelism, 2)
        try:
            rows = spark.range(0, tasks, 1, tasks)
            rows.write.parquet(path)
            if spark.read.schema(rows.schema).parquet(path).distinct().count() < tasks:
                return False
        finally:
            delete_path(spark, path)
        _proven.add(tried)
    return True


def shared_root(spark: SparkSession) -> str:
    """Folder all executors can reach, as named by ``spark.checkpoint.dir``.

    On a cluster, a path without a scheme may mean the disk of one machine. Where Spark itself
    keeps its checkpoints there, tasks write to it first, and it is refused if not all that they
    wrote comes back. A mount that all machines share can also be named with ``file:``.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    local = context.master.startswith("local")
    if root and not local and "://" not in root and not root.startswith("file:"):
        if spark.conf.get("spark.hadoop.fs.defaultFS", "file:///").startswith("file:"):
            if not (context.getCheckpointDir() and comes_back(spark, root.rstrip("/"))):
                raise RuntimeError(f"{root} may be one machine's disk; name it with its scheme")
    if root:
        return root.rstrip("/")
    if not local:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    own = tempfile.mkdtemp(prefix="ladderlake-")
    atexit.register(shutil.rmtree, own, ignore_errors=True)
    context.setCheckpointDir(own)
    return context.getCheckpointDir().rstrip("/")


# Sub-folder of the application's staged data that is in use, for ``staging``.
_scope = ""


def staging_root(spark: SparkSession) -> str:
    """Where this application stages data."""
    application = spark.conf.get("spark.app.id", "application")
    return f"{shared_root(spark)}/ladderlake/{application}{_scope}"


def staging_path(spark: SparkSession, name: str) -> str:
    """A new, unused path under the shared folder, below the application's own folder."""
    return f"{staging_root(spark)}/{name}-{uuid.uuid4().hex}"


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder on any file system Spark can reach."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    found.getFileSystem(spark._jsc.hadoopConfiguration()).delete(found, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, on any file system Spark can reach."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()).exists(found)


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Data staged inside is deleted at the end; results must be written by then.

    Staged data has to outlive the lazy results built on it, so only the caller
    knows when it can go.
    """
    global _scope
    outer, _scope = _scope, f"{_scope}/{uuid.uuid4().hex}"
    try:
        yield
    finally:
        root = staging_root(spark)
        _scope = outer
        delete_path(spark, root)


_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def dropping_shuffles(spark: SparkSession) -> Iterator[None]:
    """Writes inside delete their shuffle files as they end.

    Spark keeps them until the driver happens to collect its garbage. A write is planned by
    itself, so nothing else reads them.
    """
    before = spark.conf.get(_DROP_SHUFFLES, None)
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.unset(_DROP_SHUFFLES) if before is None else spark.conf.set(_DROP_SHUFFLES, before)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a result to the shared folder and read it back.

    This cuts the lineage in a way that outlives lost executors, and the file
    sizes tell the planner how large the result really is: later joins
    broadcast it below ``spark.sql.autoBroadcastJoinThreshold`` and shuffle
    it above.
    """
    spark = df.sparkSession
    path = staging_path(spark, name)
    with dropping_shuffles(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
