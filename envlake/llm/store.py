"""Tables written once in the folder that the driver and all executors share.

A written table cuts lineage: a lost executor costs the tasks that read it, not
the stages that made it. The folder is spark.checkpoint.dir; only where a
session on one machine (tests) has none is a temporary one set. On a cluster a
missing folder is an error: a machine's own folder is not the other machines'.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Bytes of an Arrow batch for Python, but for its last row.
BATCH_BYTES = 4 << 20

_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder of this session's tables below spark.checkpoint.dir."""
    app = spark.sparkContext.applicationId
    if app not in _folders:
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
            root = "file://" + tempfile.mkdtemp(prefix="envlake-")
            spark.conf.set("spark.checkpoint.dir", root)
        _folders[app] = f"{root.rstrip('/')}/tables-{uuid.uuid4().hex}"
        atexit.register(_remove, spark, _folders[app])
    return _folders[app]


def _remove(spark: SparkSession, folder: str) -> None:
    jvm = spark.sparkContext._jvm
    if spark.sparkContext._jsc is None or jvm is None:
        return
    path = jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def written(df: DataFrame, name: str, narrow: bool = False, wide: bool = False) -> DataFrame:
    """df, computed once: written as Parquet in the shared folder and read again.

    narrow: its rows are much less than what they are made from, so they are
    gathered into files of Spark's advisory size instead of one for each task.
    wide: a row has megabytes. Writers and readers hold a row group whole, and Parquet
    only guesses from row to row how large it is; here each row is one.
    """
    spark = df.sparkSession
    df = df.hint("rebalance") if narrow else df
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    sizes = {"parquet.block.row.count.limit": 1} if wide else {}
    df.write.options(compression="zstd", **sizes).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Hand texts to Python in smaller Arrow batches than Spark's 10,000 rows and 64 MB, unless the session says otherwise."""
    for key, default, value in (("maxRecordsPerBatch", "10000", rows), ("maxBytesPerBatch", f"{64 << 20}b", BATCH_BYTES)):
        key = f"spark.sql.execution.arrow.{key}"
        if spark.conf.get(key) == default:
            spark.conf.set(key, value)
