"""Command line: one stage or a whole run over tables in a folder, with a report and a summary.

    python -m feedloom.cli normalize --root TABLES --input raw_items_2024-01-01.jsonl
    python -m feedloom.cli filter --root TABLES --terms terms.json --limit 100

Stages that need services (pages, speech, text models, sheets, chat) are run from Python, where these are
handed over: see ``feedloom.plans.stages``. Exit status: 0, or 2 if the run failed.
"""

from __future__ import annotations

import argparse
import json
import sys
from collections.abc import Sequence
from datetime import datetime, timezone
from pathlib import Path

from pyspark.sql import SparkSession

from feedloom.functions.scoring import compile_terms
from feedloom.plans import config, pipeline, reports
from feedloom.sources import jsonl


def now_z() -> str:
    return datetime.now(tz=timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="feedloom")
    p.add_argument("stage", choices=["normalize", "filter", "run"])
    p.add_argument("--root", required=True, help="folder of the tables")
    p.add_argument("--input", help="JSON lines; the newest raw_items file of the root if left out")
    p.add_argument("--terms", help="JSON file of keyword groups")
    p.add_argument("--limit", default="100")
    p.add_argument("--quota", default="0")
    p.add_argument("--min-chars", default="120")
    p.add_argument("--min-score", default="1")
    p.add_argument("--newsletter-min", default="1")
    p.add_argument("--trusted", nargs="*", default=[])
    p.add_argument("--stop-after", help="stages to run, from 1")
    p.add_argument("--run-ts", default=None, help="time of the run, YYYY-MM-DDTHH:MM:SSZ")
    p.add_argument("--report", help="path of the JSON report; a Markdown summary lies beside it")
    return p


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(argv)
    run_ts = a.run_ts or now_z()
    began = now_z()
    try:
        least = {n: config.override(getattr(a, n), n) for n in ("limit", "quota", "min_chars", "min_score", "newsletter_min")}
        stop = config.override(a.stop_after, "stop_after")
        spark = spark or SparkSession.builder.appName("feedloom").config("spark.sql.session.timeZone", "UTC").getOrCreate()

        def normalize() -> pipeline.StageResult:
            path = a.input or jsonl.newest(a.root)
            return pipeline.normalize_lines(spark, path, a.root, run_ts)

        def filtered() -> pipeline.StageResult:
            if not a.terms:
                raise config.ConfigError("--terms is needed")
            terms = compile_terms(json.loads(Path(a.terms).read_text()))
            gates = {k: least[k] for k in ("min_chars", "min_score", "newsletter_min")}
            return pipeline.filter_stage(spark, a.root, run_ts, terms, limit=least["limit"], quota=least["quota"], trusted=[t.strip().lower() for t in a.trusted], **gates)

        stages = [(n, f) for n, f in (("normalize", normalize), ("filter", filtered)) if a.stage in (n, "run")]
        out = pipeline.run(stages, stop)
    except (config.ConfigError, ValueError, FileNotFoundError) as e:
        print(f"error: {e}", file=sys.stderr)
        return 2
    path = a.report or config.dated_path(a.root, "report", run_ts, ".json")
    run = {"started_at": began, "finished_at": now_z(), "status": out.status}
    errors = {out.failed_stage: out.error} if out.failed_stage else {}
    jsonl.write_report(run | {"stages": out.stages, "errors": errors, "reports": out.reports, "metrics": reports.key_metrics(out.reports), "failed_rows": reports.non_fatal(out.reports)}, path)
    Path(path).with_suffix(".md").write_text(reports.markdown(run, out.stages, errors, out.reports), encoding="utf-8")
    return out.exit_code


if __name__ == "__main__":
    sys.exit(main())
