"""Session settings, and the one place where lineage is cut or scratch tables are written."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    # the tables carry zone-less timestamps; a fixed zone keeps every cast of them stable
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    # no stack walk for every column expression that is built
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # checkpoints go away with the frame that needed them
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, **conf: str) -> SparkSession:
    """Build (or get) a session with the settings above; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName("ordertrail")
    if master:
        builder = builder.master(master)
    settings = DEFAULTS | {k.replace("__", "."): v for k, v in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Only a local-mode session may do without it, and then gets a temporary folder that goes away with the
    process; on a cluster, also one of several executors on this machine, a missing setting is an error,
    since a machine-local folder would lose data with its machine.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None and sc.getCheckpointDir() is not None:
        base = sc.getCheckpointDir()
    if base is None:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="ordertrail-")
        atexit.register(shutil.rmtree, base, ignore_errors=True)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(base)
    return base.rstrip("/")


_written: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for one written table in the shared folder; it goes when the process ends, or before by
    ``drop_scratch``."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if not _written:
        atexit.register(_drop_at_exit, spark)
    _written.append(path)
    return path


def drop_scratch(spark: SparkSession) -> int:
    """Delete what this process wrote to the shared folder, once no frame needs it; returns how many."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    dropped = 0
    while _written:
        path = jvm.org.apache.hadoop.fs.Path(_written.pop())
        dropped += bool(path.getFileSystem(conf).delete(path, True))
    return dropped


def _drop_at_exit(spark: SparkSession) -> None:
    # a session that was stopped can delete nothing any more
    if _written and spark.sparkContext._jsc is not None and not spark.sparkContext._jsc.sc().isStopped():
        drop_scratch(spark)


def stored(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` once to the shared folder and return the written table.

    The result keeps column pruning and predicate pushdown, has exact file sizes for Catalyst's own
    broadcast decision, and does not depend on executors that may be lost later.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Tasks per core that rows are spread over.
SPREAD = 2


def spread(df: DataFrame) -> DataFrame:
    """The same rows dealt out evenly to all cores. A small file is read by one task however dear its rows are to work on;
    this is for work that takes much longer than sending the rows."""
    return df.repartition(SPREAD * df.sparkSession.sparkContext.defaultParallelism)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package wherever they run, once per application.

    The package's source goes to the executors with Spark's own file distribution, so functions given to
    ``mapInArrow`` and the like work where the package is not installed.
    """
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="ordertrail-ship-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = f"{folder}/{os.path.basename(root)}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for where, _, names in sorted(os.walk(root)):
            for name in sorted(n for n in names if n.endswith(".py")):
                path = f"{where}/{name}"
                out.write(path, os.path.relpath(path, os.path.dirname(root)))
    sc.addPyFile(archive)
    _shipped.add(sc.applicationId)
