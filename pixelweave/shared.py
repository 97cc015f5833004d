"""Tables written to the folder that driver and executors share, which cut the lineage and survive lost executors."""

from __future__ import annotations

import atexit
import contextlib
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Only a local session that names none, as in
    tests, gets one of its own."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        app = spark.sparkContext.applicationId
        if app not in _own:
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
            _own[app] = tempfile.mkdtemp(prefix="pixelweave-")
            atexit.register(shutil.rmtree, _own[app], True)
        found = _own[app]
    return found.rstrip("/")


def written(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write a table in the shared folder and read it."""
    spark = df.sparkSession
    folder = f"{shared_dir(spark)}/pixelweave/{spark.sparkContext.applicationId}"
    if folder not in _own:
        _own[folder] = folder
        atexit.register(_remove, spark, folder)
    path = f"{folder}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    back = spark.read.schema(df.schema).parquet(path)
    back._pw_path = path
    return back


def _remove(spark: SparkSession, path: str) -> None:
    with contextlib.suppress(Exception):  # at exit the session may be gone
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def discard(*tables: DataFrame) -> None:
    """Remove written tables that nothing reads any more; what is left goes when the application ends."""
    for df in tables:
        _remove(df.sparkSession, df._pw_path)
