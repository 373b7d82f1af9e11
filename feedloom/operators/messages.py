"""Chat messages of scripts, and which of them a bounded run sends."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions.checks import first_failure, section_texts, texts_present
from feedloom.functions.text import col, non_blank, py_strip
from feedloom.operators.records import creator_or, script_text


def with_message(rows: DataFrame, timestamp: str | Column, most: int) -> DataFrame:
    """``rows`` with ``message`` and ``reason``: ideas joined with scripts and items as one text each.

    Needs item_id, topic, url, primary_hook, viral_rating, script_sections, creator, source_name.
    """
    df = rows.withColumn("__parts", section_texts("script_sections"))
    reason = first_failure(
        [
            *texts_present(("item_id",)),
            ("topic", F.col("topic").isNotNull()),
            *texts_present(("url", "primary_hook")),
            ("viral_rating", F.col("viral_rating").isNotNull()),
            ("script_sections", F.col("__parts").isNotNull()),
        ]
    )
    stamp = F.lit(timestamp) if isinstance(timestamp, str) else timestamp
    script = script_text(*[F.get("__parts", F.lit(i)) for i in range(4)], most)
    # The layout of a message.
    text = F.concat(
        F.col("viral_rating").cast("string"),
        F.lit("/10 - "),
        py_strip("topic"),
        F.lit("\nCreator: "),
        creator_or("creator", "source_name"),
        F.lit("\nHook: "),
        py_strip("primary_hook"),
        F.lit("\nLink: "),
        py_strip("url"),
        F.lit("\nScript:\n"),
        script,
        F.lit("\nGenerated at "),
        stamp,
        F.lit(". Item: "),
        py_strip("item_id"),
    )
    out = df.drop("message", "reason").withColumn("reason", reason)
    return out.withColumn("message", F.when(F.col("reason").isNull(), text)).drop("__parts")


def at_least(c: str | Column, least: int | None) -> Column:
    """The optional bound of a query: no bound keeps every row, null values too."""
    return F.lit(least).isNull() | (col(c) >= F.lit(least))


def already_sent(rows: DataFrame, deliveries: DataFrame, channel: str, webhook_hash: str) -> DataFrame:
    """``rows`` with ``sent``: whether their item went to this channel and webhook before."""
    done = deliveries.where((F.col("channel") == channel) & (F.col("webhook_hash") == webhook_hash)).select(F.col("item_id").alias("__sent")).distinct()
    j = rows.withColumn("__id", non_blank("item_id")).join(done, F.col("__id") == F.col("__sent"), "left")
    return j.withColumn("sent", F.col("__sent").isNotNull()).drop("__id", "__sent")
