"""Session defaults and the shared work folder."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid
import weakref

from pyspark.sql import DataFrame, SparkSession

_STAGED: list[tuple[SparkSession, str]] = []
_PATHS: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def session_options() -> dict[str, str]:
    """Settings the jobs rely on; sizes of partitions are left to the cluster."""
    return {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
    }


def work_folder(spark: SparkSession) -> str:
    """The shared folder for checkpoints and staged tables.

    The cluster names it in ``spark.checkpoint.dir``.  Only a session whose executors
    are the driver itself may go without: it gets a folder of its own, once per session.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    folder = context.getCheckpointDir()
    if folder is None:
        if not re.match(r"local(\[|$)", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = "file:" + tempfile.mkdtemp(prefix="newsloom-")
        context.setCheckpointDir(folder)
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A new, unused path under the work folder."""
    return f"{work_folder(spark)}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str, **options) -> DataFrame:
    """Write a frame to the work folder and read it back: computed once, and still
    there when an executor is lost. The files go when they are released, or when the driver
    program ends. ``options``: of the writer."""
    path = fresh_folder(df.sparkSession, name)
    _STAGED.append((df.sparkSession, path))
    df.write.options(**options).parquet(path)
    written = df.sparkSession.read.schema(df.schema).parquet(path)
    _PATHS[written] = path
    return written


def _remove(spark: SparkSession, path: str) -> None:
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    location.getFileSystem(spark._jsc.hadoopConfiguration()).delete(location, True)


def release(*frames: DataFrame) -> None:
    """Remove staged tables that nothing will read again. Frames made from them must be
    written by now; other frames than those ``staged`` returned are left alone."""
    for df in frames:
        path = _PATHS.pop(df, None)
        if path is not None:
            _remove(df.sparkSession, path)
            _STAGED.remove((df.sparkSession, path))


@atexit.register
def _remove_staged() -> None:
    """Frames read from staged tables are lazy, so what is not released is removed at the end."""
    for spark, path in _STAGED:
        try:
            _remove(spark, path)
        except Exception:  # the session may be gone already
            return
