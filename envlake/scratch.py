"""Tables written once in the folder that the driver and all executors share.

A written table cuts lineage: a lost executor costs the tasks that read it, not
the stages that made it, and what depends on where a row lay (its partition, its
place in it) is fixed. The folder is spark.checkpoint.dir; only where a session on
one machine (tests) has none is a temporary one taken. On a cluster a missing
folder is an error: a machine's own folder is not the other machines'.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_folders: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """spark.checkpoint.dir, or a temporary folder on one machine."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        root = "file://" + tempfile.mkdtemp(prefix="envlake-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder for one use below the shared root."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df, computed once: written as Parquet in this session's folder, which goes when the session ends, and read again."""
    spark = df.sparkSession
    app = spark.sparkContext.applicationId
    if app not in _folders:
        _folders[app] = scratch(spark, "core")
        atexit.register(_remove, spark, _folders[app])
    path = f"{_folders[app]}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _remove(spark: SparkSession, folder: str) -> None:
    jvm = spark.sparkContext._jvm
    if spark.sparkContext._jsc is None or jvm is None:
        return
    path = jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
