"""Stages in sequence: each reads committed tables, writes its own once, and reports.

A run that ends without a failure is completed, or stopped if it was told to stop earlier; the first
failing stage is named and later ones are skipped. Every stage's write is one commit, so a rerun
repeats no work that is already in the tables.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom import storage
from feedloom.operators.records import canonical_items, gated, json_items
from feedloom.operators.select import quota_select
from feedloom.operators.state import insert_if_absent, unprocessed
from feedloom.plans import contracts
from feedloom.plans.reports import counters


@dataclass
class StageResult:
    rows: DataFrame | None
    report: dict


@dataclass
class RunReport:
    status: str = "failed"
    stages: dict[str, str] = field(default_factory=dict)
    reports: dict[str, dict] = field(default_factory=dict)
    failed_stage: str | None = None
    error: str | None = None

    @property
    def exit_code(self) -> int:
        return 0 if self.status in ("completed", "stopped") else 2

    def broken(self) -> list[str]:
        failed = [s for s, x in self.stages.items() if x == "failed"]
        out = []
        if (self.status == "failed") != (len(failed) == 1):
            out.append("a failed run has exactly one failed stage")
        if self.status == "completed" and set(self.stages.values()) - {"completed"}:
            out.append("a completed run has completed all stages")
        return out


def run(stages: Sequence[tuple[str, Callable[[], StageResult]]], stop_after: int | None = None) -> RunReport:
    """Runs the stages; ``stop_after`` counts from 1."""
    if stop_after is not None and not 1 <= stop_after <= len(stages):
        raise ValueError(f"stop_after must be 1..{len(stages)}")
    out = RunReport(stages={name: "skipped" for name, _ in stages})
    for k, (name, stage) in enumerate(stages, 1):
        try:
            result = stage()
        except Exception as e:
            out.stages[name], out.failed_stage, out.error = "failed", name, str(e) or type(e).__name__
            return out
        out.stages[name], out.reports[name] = "completed", result.report
        if k == stop_after:
            break
    out.status = "completed" if set(out.stages.values()) == {"completed"} else "stopped"
    return out


REJECTED = ["invalid_field_types", "missing_required_fields", "invalid_timestamps"]


def normalize(spark: SparkSession, raw: DataFrame, root: str, run_ts: str) -> StageResult:
    """Raw records to items that are not there yet."""
    rows = canonical_items(raw.withColumn("raw_item_json", F.to_json(F.struct(*raw.columns))).withColumn("__seq", F.monotonically_increasing_id()))
    return _inserted(spark, rows, REJECTED, root, run_ts)


def normalize_lines(spark: SparkSession, path: str, root: str, run_ts: str) -> StageResult:
    """JSON lines to items that are not there yet; blank lines are counted and passed over."""
    lines = spark.read.text(path).withColumn("__seq", F.monotonically_increasing_id())
    out = _inserted(spark, json_items(lines.withColumn("raw_item_json", F.col("value"))), ["invalid_json", "not_an_object", *REJECTED], root, run_ts)
    out.report["lines"] = lines.count()
    return out


def _inserted(spark: SparkSession, rows: DataFrame, names: list[str], root: str, run_ts: str) -> StageResult:
    state = contracts.ensure(spark, f"{root}/items", contracts.CONTRACTS["items"])
    rows = storage.cut(rows)
    report = counters(rows, "reason", names).first().asDict()
    new = storage.cut(insert_if_absent(rows.where("reason IS NULL"), state, ["item_id"], [F.col("__seq")]).withColumn("inserted_at", F.lit(run_ts)))
    report |= {"invalid": report["n_rows"] - report["n_passed"], "inserted": new.count()}
    new.select(*[f.name for f in contracts.CONTRACTS["items"].schema]).write.mode("append").parquet(f"{root}/items")
    return StageResult(spark.read.parquet(f"{root}/items"), report)


def filter_stage(spark: SparkSession, root: str, run_ts: str, terms: list, *, limit: int, quota: int, **gates) -> StageResult:
    """Items without candidates, scored, gated and selected with a quota of newsletters."""
    done = contracts.ensure(spark, f"{root}/candidates", contracts.CONTRACTS["candidates"])
    names = ["missing_required_fields", "content_too_short", "low_relevance"]
    if limit == 0:  # nothing is looked at
        return StageResult(done, dict.fromkeys(("n_rows", "n_passed", *names, "inserted"), 0) | {"reached_limit": True})
    rows = storage.cut(gated(unprocessed(spark.read.parquet(f"{root}/items"), done, ["item_id"]), terms, **gates))
    report = counters(rows, "reason", names).first().asDict()
    best = quota_select(rows.where("reason IS NULL"), F.col("source_type") == "newsletter", [F.desc("published_at"), F.col("item_id")], quota, limit)
    out = storage.cut(best.withColumns({"relevance_score": F.col("score"), "matched_keywords": F.to_json("keywords"), "created_at": F.lit(run_ts)}))
    report["inserted"] = out.count()
    report["reached_limit"] = report["inserted"] >= limit
    out.select(*[f.name for f in contracts.CONTRACTS["candidates"].schema]).write.mode("append").parquet(f"{root}/candidates")
    return StageResult(spark.read.parquet(f"{root}/candidates"), report)
