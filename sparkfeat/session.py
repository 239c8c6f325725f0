"""Session settings and the shared checkpoint folder (#59)."""

from __future__ import annotations

import tempfile
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

# Adaptive execution re-plans joins and partition counts from measured shuffle
# sizes; skew handling splits oversized join partitions.  All are runtime SQL
# settings, so they can be applied to a session that already exists.
ADAPTIVE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession, extra: dict | None = None) -> SparkSession:
    """Apply the adaptive-execution settings (and ``extra``) to ``spark``."""
    for k, v in {**ADAPTIVE_CONF, **(extra or {})}.items():
        spark.conf.set(k, v)
    return spark


def build_session(app_name: str = "sparkfeat", master: str | None = None,
                  conf: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with adaptive execution on."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    for k, v in {**ADAPTIVE_CONF, **(conf or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def _is_local(spark: SparkSession) -> bool:
    master = spark.conf.get("spark.master", "") or ""
    return master.startswith("local")


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder of the session.

    Reads ``spark.checkpoint.dir`` (or the SparkContext's folder).  Only a
    local-mode session without one gets a fresh temporary folder (tests); on a
    cluster an unset folder is an error, because checkpoints must live on
    storage every executor and the driver can reach.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # a session without an RDD-level context (e.g. Spark Connect)
        sc = None
    current = sc.getCheckpointDir() if sc is not None else None
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if sc is None:
            return configured
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if _is_local(spark) and sc is not None:
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="sparkfeat-ckpt-"))
        return sc.getCheckpointDir()
    raise RuntimeError(
        "spark.checkpoint.dir is not set; point it at a shared folder "
        "(HDFS/S3/ABFS) that all executors can reach")


def ready(spark: SparkSession) -> None:
    """Before a job: make sure of the checkpoint folder, and let Python workers
    import this package from the folder it was loaded from, whatever their
    working directory (a package shipped with ``--py-files`` is found anyway)."""
    import os

    checkpoint_dir(spark)
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if os.path.isdir(root) and root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, [known])])


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder name below the shared checkpoint folder."""
    import uuid

    return f"{checkpoint_dir(spark).rstrip('/')}/sparkfeat/{name}-{uuid.uuid4().hex}"


class Scratch:
    """Folders that ``materialize`` wrote inside one :func:`scratch` scope."""

    def __init__(self):
        self.paths: list[str] = []
        self.kept: set[str] = set()

    def keep(self, df):
        """Spare the folders that ``df`` reads (a small result: its files are listed)."""
        files = df.inputFiles()
        self.kept.update(p for p in self.paths if any(f"/{p.rsplit('/', 1)[1]}/" in f for f in files))
        return df


_SCOPE: ContextVar[Scratch | None] = ContextVar("scratch", default=None)


@contextmanager
def scratch(spark: SparkSession):
    """Remove at the end, also after a failure, what the block materialised,
    except what it kept; kept folders belong to the enclosing scope, if any."""
    outer, own = _SCOPE.get(), Scratch()
    token = _SCOPE.set(own)
    try:
        yield own
    finally:
        _SCOPE.reset(token)
        for path in own.paths:
            if path not in own.kept:
                _delete(spark, path)
        if outer is not None:
            outer.paths += [p for p in own.paths if p in own.kept]


def materialize(df, name: str):
    """Write ``df`` as parquet under the shared checkpoint folder and read it
    back.  Later jobs read the columnar copy (with column pruning and real file
    statistics) instead of recomputing the lineage, and the copy survives the
    loss of any executor."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if (own := _SCOPE.get()) is not None:
        own.paths.append(path)
    with _shuffles_released(spark):
        df.write.mode("overwrite").parquet(path)
    copy = spark.read.parquet(path)
    copy._written_path = path
    return copy


def _delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def discard(copy) -> None:
    """Remove what ``materialize`` wrote for ``copy`` now, where nothing will read
    it again; later jobs on ``copy`` or on frames derived from it fail."""
    _delete(copy.sparkSession, copy._written_path)


#: Spark removes the shuffle files of a job as soon as it has ended.
_RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def setting(spark: SparkSession, name: str, value: str):
    """A runtime setting for the jobs that run inside the block."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


@contextmanager
def _shuffles_released(spark: SparkSession):
    """Jobs in this block leave no shuffle files: later jobs read what they wrote."""
    before = spark.conf.get(_RELEASE, None)
    if before is not None and spark.conf.isModifiable(_RELEASE):
        spark.conf.set(_RELEASE, "true")
    try:
        yield
    finally:
        if before is not None and spark.conf.isModifiable(_RELEASE):
            spark.conf.set(_RELEASE, before)
