"""Run reports: zero-filled counters in one aggregation, and their invariants."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def counters(df: DataFrame, column: str, names: Sequence[str], group: Sequence[str] = ()) -> DataFrame:
    """Rows in all, rows without a reason, and one counter per name, all present even if 0."""
    c = F.col(column)
    return df.groupBy(*group).agg(F.count("*").alias("n_rows"), F.count_if(c.isNull()).alias("n_passed"), *[F.count_if(c == n).alias(n) for n in names])


def first_error(df: DataFrame, error: Column, order: Column) -> DataFrame:
    """How many errors, and the first in order."""
    e = F.when(error.isNotNull(), order)
    return df.agg(F.count(error).alias("n_errors"), F.min_by(error, e).alias("first_error"))


def broken(report: Mapping[str, int], parts: Sequence[str], total: str) -> list[str]:
    """Invariants of a report that don't hold: no negative counter, parts that add up to the total."""
    out = [f"{k} is negative" for k, v in report.items() if isinstance(v, int) and v < 0]
    if sum(report[p] for p in parts) != report[total]:
        out.append(f"{' + '.join(parts)} is not {total}")
    return out


#: Stages in order, and what the summary of a run takes from their reports (fixed values).
STAGES = ("ingest", "normalize", "filter", "enrich", "intelligence", "generate", "persist", "deliver")
METRICS = {
    "raw_items_emitted": ("ingest", "emitted"),
    "canonical_items_inserted": ("normalize", "inserted"),
    "candidates_inserted": ("filter", "inserted"),
    "enriched_inserted": ("enrich", "inserted"),
    "ideas_inserted": ("intelligence", "inserted"),
    "scripts_inserted": ("generate", "inserted"),
    "sheet_rows_inserted": ("persist", "inserted"),
    "sheet_rows_updated": ("persist", "updated"),
    "messages_sent": ("deliver", "sent"),
}
ERRORS = {"ingest": "failed", "normalize": "invalid", "enrich": "failed", "intelligence": "failed", "generate": "failed", "persist": "invalid_payload", "deliver": "errors"}


def _metric(reports: Mapping[str, Mapping], stage: str, name: str) -> int:
    """A counter of a stage's report; 0 for a stage that did not run, an error for a bad one."""
    if stage not in reports:
        return 0
    value = reports[stage].get(name)
    if type(value) is not int or value < 0:
        raise ValueError(f"{stage}.{name} must be a whole number from 0")
    return value


def key_metrics(reports: Mapping[str, Mapping]) -> dict[str, int]:
    return {k: _metric(reports, stage, name) for k, (stage, name) in METRICS.items()}


def non_fatal(reports: Mapping[str, Mapping]) -> dict[str, int]:
    """Rows that failed by stage, and the total."""
    by = {s: _metric(reports, s, ERRORS[s]) if s in ERRORS else 0 for s in STAGES}
    return by | {"total": sum(by.values())}


def _rows(head: Sequence[str], rows: Sequence[Sequence[object]]) -> list[str]:
    line = lambda cells: "| " + " | ".join("" if c is None else str(c) for c in cells) + " |"
    return [line(head), "|" + "---|" * len(head), *map(line, rows)]


def markdown(run: Mapping, statuses: Mapping[str, str], errors: Mapping[str, str | None], reports: Mapping[str, Mapping]) -> str:
    """The summary of a run: stages, key metrics and rows that failed."""
    return "\n".join(
        [
            "# Run summary",
            "",
            *[f"- {k}: {v}" for k, v in run.items()],
            "",
            "## Stages",
            *_rows(("stage", "status", "error"), [(s, st, errors.get(s)) for s, st in statuses.items()]),
            "",
            "## Key metrics",
            *_rows(("metric", "value"), list(key_metrics(reports).items())),
            "",
            "## Rows that failed",
            *_rows(("stage", "rows"), list(non_fatal(reports).items())),
            "",
        ]
    )
