"""Run-once increments of a growing folder: new files are read, canonicalised and inserted if absent.

State lives in the table itself, not in the stream: dropping duplicates in a stream would keep keys
for ever or forget them by watermark, and neither is what a permanent key store means.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.operators.records import json_items
from feedloom.operators.state import insert_if_absent
from feedloom.plans import contracts


def ingest_available(spark: SparkSession, folder: str, table: str, checkpoint: str, run_ts: str) -> None:
    """Processes what is new in ``folder`` (JSON lines) and stops; safe to repeat after a failure."""
    c = contracts.CONTRACTS["seen_items"]
    contracts.ensure(spark, table, c)

    def sink(batch: DataFrame, _: int) -> None:
        good = json_items(batch.withColumn("__seq", F.monotonically_increasing_id())).where("reason IS NULL").withColumnRenamed("item_id", "dedup_key")
        new = insert_if_absent(good, spark.read.schema(c.schema).parquet(table), ["dedup_key"], [F.col("__seq")])
        new.withColumn("first_seen_at", F.lit(run_ts)).select(*[f.name for f in c.schema]).write.mode("append").parquet(table)

    lines = spark.readStream.text(folder)
    lines.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
