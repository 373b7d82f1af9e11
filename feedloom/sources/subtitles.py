"""Caption files to cues."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.functions.media import vtt_cues


def read_captions(spark: SparkSession, path: str) -> DataFrame:
    """(path, n, text, start) of the cues of all caption files under ``path``, in order."""
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    return files.select("path", F.posexplode(vtt_cues("value")).alias("n", "c")).select("path", "n", "c.text", "c.start")
