"""Session helpers: where intermediate tables go, how lineage is cut."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN_DIR: dict[str, str] = {}
_STORED: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can read. The session's ``spark.checkpoint.dir`` when it is set;
    a temporary folder of this process only where it is not (local tests)."""
    named = spark.conf.get("spark.checkpoint.dir", "") or spark.sparkContext.getConf().get("spark.checkpoint.dir", "")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN_DIR:
        _OWN_DIR[app] = "file://" + tempfile.mkdtemp(prefix="griyaflow-")
    return _OWN_DIR[app]


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: lineage is cut, statistics are exact and a
    lost executor costs only a re-read."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/griyaflow-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _STORED[path] = spark.sparkContext.applicationId
    back = spark.read.schema(df.schema).parquet(path)
    back._griyaflow_path = path
    return back


def drop_stored(df: DataFrame | None) -> None:
    """Removes a table made by :func:`stored` that no later step reads."""
    path = getattr(df, "_griyaflow_path", None)
    if path:
        _delete(df.sparkSession, path)


def _delete(spark: SparkSession, path: str) -> None:
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hpath, True)
    _STORED.pop(path, None)


def release(spark: SparkSession) -> None:
    """Removes all tables that this application stored; results that were not computed yet can't be after it."""
    for path, app in list(_STORED.items()):
        if app == spark.sparkContext.applicationId:
            _delete(spark, path)


@atexit.register
def _release_at_exit() -> None:
    try:
        spark = SparkSession.getActiveSession() if _STORED else None
        if spark is not None and spark.sparkContext._jsc is not None:
            release(spark)
    except Exception:  # noqa: BLE001 - the session may be gone already; then its folder outlives it
        pass


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
