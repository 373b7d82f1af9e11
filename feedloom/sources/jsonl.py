"""JSON lines in and out, and the newest of dated files."""

from __future__ import annotations

import json
import re
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession

from feedloom.operators.records import json_items


def read_raw_items(spark: SparkSession, path: str) -> DataFrame:
    """Canonical items of a JSON-lines file, rejected lines with their reason."""
    return json_items(spark.read.text(path))


def newest(folder: str, prefix: str = "raw_items", suffix: str = ".jsonl") -> str:
    """The file with the latest date in its name, else the undated one."""
    dated = sorted(p for p in Path(folder).glob(f"{prefix}_*{suffix}") if re.fullmatch(rf"{prefix}_\d{{4}}-\d{{2}}-\d{{2}}", p.name[: -len(suffix)]))
    plain = Path(folder) / f"{prefix}{suffix}"
    if not dated and not plain.exists():
        raise FileNotFoundError(f"no {prefix}{suffix} in {folder}")
    return str(dated[-1] if dated else plain)


def write_lines(df: DataFrame, path: str, order: list[Column]) -> None:
    """Sorted JSON lines, overwritten; range-partitioned files in order, not one task."""
    df.orderBy(*order).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_report(payload: dict, path: str) -> None:
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text(json.dumps(payload, ensure_ascii=True, indent=2, default=str) + "\n")
