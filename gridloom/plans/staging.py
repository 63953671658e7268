"""Intermediate tables in the folder all executors share.

A plan that is read more than once, or whose lineage should end, is written
as Parquet under ``spark.checkpoint.dir`` and read back.  The files outlive any
executor, keep column pruning, and give the optimizer true sizes, so a later
join is broadcast only where the written table really is small.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Root of the intermediate tables: the session's ``spark.checkpoint.dir``,
    or, only where that is unset and all runs in one process (tests, a laptop),
    a temporary folder.  A cluster without the setting is refused."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = tempfile.mkdtemp(prefix="gridloom-")
        atexit.register(shutil.rmtree, _own[app], ignore_errors=True)
    return "file://" + _own[app]


def materialize(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once and return a reader of the written table."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes tables of ``materialize`` once all that reads them is written, and
    the shuffle files of finished plans."""
    for df in tables:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.staged_at)
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
    if tables:
        release(tables[0])


def release(df: DataFrame) -> None:
    """Collects the driver's garbage: Spark drops the shuffle files of a finished
    plan when the plan itself is collected."""
    df.sparkSession._jvm.java.lang.System.gc()

