"""Worksheets: header layout, mapped rows, and the inserts and updates that bring a sheet up to date."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.functions.checks import first_failure, section_texts, texts_present
from feedloom.functions.jsonv import string_list
from feedloom.functions.text import non_blank, py_strip
from feedloom.operators.records import cells, creator_or, hook_or, joined, script_text

# The headers a sheet must and may have.
REQUIRED_HEADERS = ("item_id", "creator", "post_link", "topic", "viral_rating", "hook", "platform", "draft_script", "status")
OPTIONAL_HEADERS = ("monetization_angle", "tools_mentioned", "published_at", "updated_at", "notes")
#: Columns of a mapped row; people's own columns are status and notes.
MAPPED = tuple(h for h in (*REQUIRED_HEADERS, *OPTIONAL_HEADERS) if h not in ("status", "notes"))
NEW = "New"


class SheetError(ValueError):
    """A worksheet that breaks its contract."""


@dataclass(frozen=True)
class Layout:
    headers: tuple[str, ...]
    key: str = "item_id"

    @property
    def width(self) -> int:
        return len(self.headers)


def layout(header: Sequence[object], key: str = "item_id") -> Layout:
    """The header row as it counts: stripped, each once (blank ones too), all required ones there."""
    names = tuple("" if h is None else str(h).strip() for h in header)
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise SheetError(f"header given twice: {twice[0]!r}")
    lacking = [h for h in REQUIRED_HEADERS if h not in names]
    if lacking:
        raise SheetError(f"headers lacking: {', '.join(lacking)}")
    if key.strip() != "item_id":
        raise SheetError("rows are found by item_id only")
    return Layout(names)


def split_rows(rows: Sequence[Sequence[object]], header_row: int = 1) -> tuple[list[object], list[list[object]]]:
    """(header, body) of all rows of a sheet; ``header_row`` counts from 1."""
    header = list(rows[header_row - 1]) if header_row <= len(rows) else []
    return header, [list(r) for r in rows[header_row:]]


def sheet_table(spark: SparkSession, body: Sequence[Sequence[object]], form: Layout, header_row: int = 1) -> DataFrame:
    """(item_id, row_number, cells) of the body's rows, padded or cut to the header. Rows without a key
    don't count; a key given twice is an error."""
    rows = [(header_row + 1 + i, ["" if x is None else str(x) for x in r]) for i, r in enumerate(body)]
    df = spark.createDataFrame(rows, "row_number long, raw array<string>").withColumn("cells", cells(F.col("raw"), form.width))
    df = df.select(non_blank(F.get("cells", F.lit(form.headers.index(form.key)))).alias("item_id"), "row_number", "cells").where("item_id IS NOT NULL")
    return unique_keys(df)


def unique_keys(sheet: DataFrame) -> DataFrame:
    twice = sheet.groupBy("item_id").agg(F.count("*").alias("n")).where("n > 1").agg(F.min("item_id").alias("k")).first()
    if twice and twice.k is not None:
        raise SheetError(f"key given twice in the sheet: {twice.k}")
    return sheet


def sheet_rows(joined_rows: DataFrame, updated_at: str) -> DataFrame:
    """(other columns, MAPPED columns as text, reason): ideas joined with scripts and items as sheet rows.

    Needs item_id, url, topic, platform, monetization_angle, published_at, viral_rating, primary_hook,
    hooks, tools_mentioned, script_sections, creator, source_name. reason names what does not hold.
    """
    keep = [c for c in joined_rows.columns if c not in (*MAPPED, "reason")]
    df = joined_rows.withColumns({"__hook": hook_or("primary_hook", "hooks"), "__tools": joined("tools_mentioned"), "__parts": section_texts("script_sections")})
    reason = first_failure(
        [
            *texts_present(("item_id", "url")),
            *[(c, F.col(c).isNotNull()) for c in ("topic", "platform", "monetization_angle", "published_at", "viral_rating")],
            ("hook", F.col("__hook").isNotNull()),
            ("tools_mentioned", string_list("tools_mentioned").isNotNull()),
            ("script_sections", F.col("__parts").isNotNull()),
        ]
    )
    part = [F.get("__parts", F.lit(i)) for i in range(4)]
    value = {
        "item_id": py_strip("item_id"),
        "creator": creator_or("creator", "source_name"),
        "post_link": py_strip("url"),
        "viral_rating": F.col("viral_rating").cast("string"),
        "hook": F.col("__hook"),
        "draft_script": script_text(*part),
        "tools_mentioned": F.col("__tools"),
        "updated_at": F.lit(updated_at),
    } | {c: py_strip(c) for c in ("topic", "platform", "monetization_angle", "published_at")}
    return df.select(*keep, *[value[c].alias(c) for c in MAPPED], reason.alias("reason"))


def changes(rows: DataFrame, sheet: DataFrame, form: Layout) -> DataFrame:
    """(columns of ``rows`` but MAPPED, item_id, action, row_number, cells): how the sheet changes.

    Updates keep people's columns and unknown ones; inserts get NEW as status. ``sheet`` is as of
    :func:`sheet_table`; its keys are unique, so no row of ``rows`` is doubled.
    """
    old = sheet.select(F.col("item_id").alias("__key"), "row_number", F.col("cells").alias("__old"))
    j = rows.join(old, F.col("item_id") == F.col("__key"), "left")
    new = F.col("__key").isNull()
    each = []
    for i, h in enumerate(form.headers):
        start = F.lit(NEW if h == "status" else "")
        each.append(F.coalesce(F.col(h), F.lit("")) if h in MAPPED else F.when(new, start).otherwise(F.get("__old", F.lit(i))))
    keep = [c for c in rows.columns if c not in MAPPED]
    return j.select(*keep, "item_id", F.when(new, "insert").otherwise("update").alias("action"), "row_number", F.array(*each).alias("cells"))
