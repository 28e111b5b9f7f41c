"""Session settings and the shared scratch area."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession

#: Folders that ``stage`` has written and nobody has deleted yet.
_STAGED: list[tuple[SparkSession, str]] = []


def configure(spark: SparkSession) -> SparkSession:
    """Pin the options results depend on; everything else stays as the cluster set it."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """A fresh folder on storage every executor can reach.

    The cluster names the shared folder in ``spark.checkpoint.dir``. Only a session whose executors run inside the
    driver may fall back to a folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="isobar-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/isobar-{uuid.uuid4().hex}"


def delete(spark: SparkSession, *paths: str) -> None:
    """Delete folders wherever Spark can reach them; those that do not exist are passed over."""
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def staged_so_far() -> int:
    return len(_STAGED)


def release(since: int = 0) -> None:
    """Delete what ``stage`` wrote after ``since``; its readers must be done."""
    while len(_STAGED) > since:
        spark, path = _STAGED.pop()
        delete(spark, path)


@atexit.register
def _release_at_exit() -> None:
    try:
        release()
    except (Py4JError, OSError, AttributeError, TypeError):
        pass  # the session is gone, and what remains lies in the cluster's checkpoint folder


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder as ``scratch_root`` names it, deleted by ``release`` or at the end of the program."""
    path = scratch_root(spark)
    _STAGED.append((spark, path))
    return path


def stage(df: DataFrame, root: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage in a way that survives lost executors, and gives the planner the
    true size, so that joins against the result are broadcast only below
    ``spark.sql.autoBroadcastJoinThreshold`` and sort-merged above it. The folder is deleted by ``release`` or at the
    end of the program; a ``root`` of the caller's is the caller's to delete.
    """
    path = root or shared_folder(df.sparkSession)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
