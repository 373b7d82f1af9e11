"""Where intermediate results live, and how lineage is cut.

Everything that must outlive an executor goes to the folder the cluster names in
``spark.checkpoint.dir``. Only when that is unset (local tests) a folder of our own is made.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of this session; made once for local sessions that name none."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named:
        existing = spark.sparkContext._jsc.sc().getCheckpointDir()
        named = existing.get() if existing.isDefined() else None
    if not named:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        named = "file://" + tempfile.mkdtemp(prefix="feedloom-")
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(named)
    return named


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` as a table in the shared folder and forget its lineage.

    A written table is computed once, is compressed and read by column; an eager checkpoint would
    compute its last stage twice.
    """
    path = scratch(df.sparkSession, "cut")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in this application's part of the shared folder, which goes when Python ends."""
    own = f"{shared_dir(spark).rstrip('/')}/feedloom-{spark.sparkContext.applicationId}"
    if own not in _OWN:
        _OWN.add(own)
        atexit.register(_remove, spark, own)
    return f"{own}/{name}-{uuid.uuid4().hex[:12]}"


_OWN: set[str] = set()


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # the session may have ended already
        pass


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


#: Rows up to which a side may be broadcast; beyond it the join shuffles.
BROADCAST_ROWS = 200_000


def small_side(df: DataFrame, rows: int | None, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if its counted size is within the bound, else unchanged."""
    return F.broadcast(df) if rows is not None and rows <= limit else df
