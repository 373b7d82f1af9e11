"""The stages of a run, each from committed tables to its own table and a report.

Every stage writes once. What calls a service (pages, speech, text models) is written before it is used, so
a retried task of a later step asks nothing again. Rows that fail are counted under one reason each; a
disabled stage reports zeros.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Mapping, Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom import storage
from feedloom.functions import checks, html, media
from feedloom.functions.jsonv import evidence_texts
from feedloom.functions.text import collapse, py_strip, sha_key
from feedloom.operators import messages, records, select, sheets, state
from feedloom.plans import contracts
from feedloom.plans.pipeline import StageResult
from feedloom.plans.reports import counters
from feedloom.sources import adapters, feeds
from feedloom.sources.fetching import Opener, Policy, fetched

#: Why enrichment fails, and which of it may block an item for a while (fixed values).
ENRICH_FAILURES = ("invalid_candidate_row", "newsletter_fetch_failed", "newsletter_extract_failed", "newsletter_text_too_short", "youtube_video_id_parse_failed", "youtube_transcript_unavailable", "youtube_transcript_failed", "youtube_asr_failed", "youtube_text_too_short", "transcript_cap_reached", "asr_cap_reached")
ARTICLE_CHARS = 500
SKIPPED = ("too_old", "missing_url", "missing_title")


class FullSuccessError(RuntimeError):
    """A row failed in a run in which none may."""


def _table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return contracts.ensure(spark, f"{root}/{name}", contracts.CONTRACTS[name])


def _append(df: DataFrame, root: str, name: str) -> None:
    df.select(*[f.name for f in contracts.CONTRACTS[name].schema]).write.mode("append").parquet(f"{root}/{name}")


def _replace(df: DataFrame, root: str, name: str) -> None:
    """The table's next snapshot. It is complete in the shared folder before the old one goes."""
    whole = storage.cut(df.select(*[f.name for f in contracts.CONTRACTS[name].schema]))
    whole.write.mode("overwrite").parquet(f"{root}/{name}")


def ingest(spark: SparkSession, root: str, catalog: DataFrame, opener: Opener, run_ts: str, *, recency_days: int | None, per_source: int, policy: Policy = Policy()) -> StageResult:  # noqa: B008
    """Feeds of the catalogue to entries not seen before; a source whose feed fails is counted and passed over."""
    seen = _table(spark, root, "seen_items")
    bodies = storage.cut(fetched(catalog.withColumnRenamed("name", "source_name").withColumn("fetched_at", F.lit(run_ts)), opener, policy, "feed_url"))
    rows = feeds.entries(bodies.where("fetch_error IS NULL").select("source_type", "source_id", "source_name", "fetched_at", "body"))
    cutoff = "" if recency_days is None else (datetime.strptime(run_ts, "%Y-%m-%dT%H:%M:%SZ") - timedelta(days=recency_days)).strftime("%Y-%m-%dT%H:%M:%SZ")
    rows = storage.cut(rows.withColumn("reason", records.recency_reason(F.col("published_at"), F.col("url"), F.col("title"), F.lit(cutoff))))
    order = [F.desc("published_at"), F.col("external_id"), F.col("url"), F.col("feed_pos")]
    best = select.cap_per_group(rows.where("reason IS NULL"), ["source_id"], order, per_source, "place").withColumn("dedup_key", sha_key("source_id", "external_id"))
    new = storage.cut(state.insert_if_absent(best, seen, ["dedup_key"], [F.col("place")]).withColumn("first_seen_at", F.col("fetched_at")))
    kept = best.groupBy("source_id").agg(F.count("*").alias("kept"))
    emitted = new.groupBy("source_id").agg(F.count("*").alias("emitted"))
    per = bodies.select("source_id", F.col("fetch_error").isNotNull().cast("long").alias("failed"))
    per = per.join(counters(rows, "reason", SKIPPED, ["source_id"]).drop("n_passed"), "source_id", "left").join(kept, "source_id", "left").join(emitted, "source_id", "left").na.fill(0)
    per = per.select("source_id", "failed", F.col("n_rows").alias("parsed"), *SKIPPED, (F.col("kept") - F.col("emitted")).alias("seen"), "emitted")
    per = storage.cut(per)
    _append(new, root, "seen_items")
    report = per.agg(F.count("*").alias("sources"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in per.columns[1:]]).first().asDict()
    return StageResult(new.drop("reason", "feed_pos", "first_seen_at", "dedup_key", "place"), report | {"by_source": [r.asDict() for r in per.orderBy("source_id").collect()]})


def selection(spark: SparkSession, root: str, now: str, *, limit: int, cap: int, floor_first: int, floor_second: int, diversity: bool = True, invalid: bool = True) -> tuple[DataFrame, dict]:
    """(rows, report): the candidates that a run enriches, with phase, rank and failure of each.

    Base order: score and time descending, id. Rows that fail the checks come in only with ``invalid``.
    """
    todo = state.unprocessed(_table(spark, root, "candidates"), _table(spark, root, "enriched_items"), ["item_id"]).withColumn("failure", checks.candidate_failure())
    rows = state.cooled_down(todo, _table(spark, root, "enrich_retry_state"), now)
    rows = rows.withColumns({"stype": F.lower(py_strip("source_type")), "sid": F.lower(py_strip("source_id")), "valid": F.col("failure").isNull()})
    down = lambda c: F.transform(F.split(F.regexp_replace(F.coalesce(c, F.lit("")), r"\D", ""), ""), lambda x: -F.when(x != "", x.cast("int")).otherwise(0))
    # A comparable base order, so that no global numbering of all rows is needed.
    idx = F.struct((-F.coalesce("relevance_score", F.lit(-(2**40)))).alias("a"), down(F.col("published_at")).alias("b"), F.coalesce("item_id", F.lit("")).alias("c"))
    pool = storage.cut(rows.withColumn("idx", idx))
    ready = F.col("valid") & ~F.col("blocked")
    stats = pool.agg(
        F.count("*").alias("available"),
        F.count_if(~F.col("valid")).alias("invalid_pool"),
        F.count_if(ready).alias("eligible_pool"),
        F.count_if(ready & (F.col("stype") == "newsletter")).alias("eligible_newsletters"),
        F.count_if(ready & (F.col("stype") == "youtube")).alias("eligible_youtube"),
        F.count_if(F.col("valid") & F.col("blocked")).alias("blocked"),
    ).first()
    picked = select.phased_select(pool.select("idx", "stype", "sid", "valid", "blocked"), limit=limit, cap=cap, floor_first=floor_first, floor_second=floor_second, diversity=diversity, invalid=invalid)
    out = storage.cut(pool.join(F.broadcast(picked.select("idx", "phase", "rank")), "idx"))
    chosen = out.agg(
        F.count("*").alias("selected"),
        F.count_if(F.col("valid") & (F.col("stype") == "newsletter")).alias("selected_newsletters"),
        F.count_if(F.col("valid") & (F.col("stype") == "youtube")).alias("selected_youtube"),
        F.count_if(~F.col("valid")).alias("selected_invalid"),
        F.count_distinct(F.when(F.col("valid"), F.struct("stype", "sid"))).alias("selected_sources"),
        *[F.count_if(F.col("phase") == p).alias(f"phase_{p}") for p in (1, 2, 3, 4)],
    ).first()
    report = stats.asDict() | chosen.asDict()
    first = min(floor_first, limit)
    report |= {"newsletter_floor_met": report["selected_newsletters"] >= first, "youtube_floor_met": report["selected_youtube"] >= min(floor_second, limit - first), "diversity_applied": diversity and report["phase_3"] > 0}
    return out, report


def enrich(
    spark: SparkSession,
    root: str,
    run_ts: str,
    opener: Opener,
    transcriber: Callable[[], adapters.Transcriber],
    *,
    chosen: Mapping,
    cooldown: Mapping,
    policy: Policy = Policy(),  # noqa: B008
    least_speech: int = 800,
    full_success: bool = False,
) -> StageResult:
    """Selected candidates to enriched items: pages read and stripped, videos transcribed.

    With ``full_success`` rows that fail the checks are not selected, and any failure ends the run, after
    what succeeded and the retry state are written.
    """
    rows, report = selection(spark, root, run_ts, **chosen, invalid=not full_success)
    names = ["item_id", "source_type", "source_id", "url", "title", "published_at", "rank"]
    valid = rows.where("valid").select(*[(F.lower(py_strip(c)) if c in ("source_type", "source_id") else py_strip(c)).alias(c) for c in names[:-1]], "rank")
    pages = storage.cut(fetched(valid.where("source_type = 'newsletter'"), opener, policy))
    pages = storage.cut(pages.withColumn("text", collapse(html.article_text("body"))))
    why = F.when(F.col("fetch_error").isNotNull(), "newsletter_fetch_failed").when(F.col("text").isNull() | (F.col("text") == ""), "newsletter_extract_failed")
    pages = pages.withColumn("reason", why.when(media.text_failure("text", ARTICLE_CHARS).isNotNull(), "newsletter_text_too_short"))
    talks = valid.where("source_type = 'youtube'").withColumn("known", media.video_id("url").isNotNull())
    talks = storage.cut(adapters.called(talks.withColumn("ask", F.when(F.col("known"), F.col("url"))), transcriber, ["ask"], "text"))
    why = F.when(~F.col("known"), "youtube_video_id_parse_failed").when(F.col("text").isNull(), "youtube_asr_failed")
    talks = talks.withColumn("reason", why.when(media.text_failure("text", least_speech).isNotNull(), "youtube_text_too_short"))
    both = pages.select(*names, "text", "reason", F.lit("article").alias("kind"), F.lit(2).alias("windows")).unionByName(talks.select(*names, "text", "reason", F.lit("asr").alias("kind"), F.lit(3).alias("windows")))
    bad = rows.where("NOT valid").select(*names, F.lit(None).cast("string").alias("text"), F.lit("invalid_candidate_row").alias("reason"), F.lit(None).cast("string").alias("kind"), F.lit(0).alias("windows"))
    done = storage.cut(both.unionByName(bad))
    parts = F.slice(media.snippets("text"), F.lit(1), F.col("windows"))
    snippets = F.to_json(F.transform(parts, lambda s: F.struct(s["text"].alias("text"), F.struct(F.col("kind").alias("type"), s["offset"].alias("offset"), F.lit(None).cast("string").alias("timestamp")).alias("meta"))), {"ignoreNullFields": "false"})
    good = done.where("reason IS NULL").select(
        "item_id", "source_type", "url", "title", "published_at", F.col("text").alias("enriched_text"), snippets.alias("evidence_snippets"), F.when(F.col("kind") == "article", "article_text").otherwise("asr").alias("enrichment_method"), F.lit(run_ts).alias("enriched_at"), F.lit(run_ts).alias("inserted_at"), "rank"
    )
    new = storage.cut(state.insert_if_absent(good, _table(spark, root, "enriched_items"), ["item_id"], [F.col("rank")]))
    tried = state.first_per_key(done.where("reason IS NULL OR reason <> 'invalid_candidate_row'").select("item_id", "source_type", "source_id", "reason", "rank"), ["item_id"], [F.col("rank")])
    report |= counters(done, "reason", ENRICH_FAILURES).first().asDict() | {"inserted": new.count()}
    report["failed"] = report["n_rows"] - report["n_passed"]
    _append(new, root, "enriched_items")
    _replace(state.next_retries(_table(spark, root, "enrich_retry_state"), tried, run_ts, **cooldown), root, "enrich_retry_state")
    if full_success and report["failed"]:
        first = done.where("reason IS NOT NULL").orderBy("rank").select("reason", checks.item_label("item_id").alias("item")).first()
        raise FullSuccessError(f"no failure allowed: {first.reason}, item {first.item}")
    return StageResult(new.drop("rank"), report)


def _answers(rows: DataFrame, client: Callable[[], adapters.TextModel], prompt: str, label: str) -> DataFrame:
    """``rows`` with ``answer`` and ``answer_error``; written, so that every prompt is sent once."""
    return storage.cut(adapters.called(rows.withColumn("__label", F.lit(label)), client, [prompt, "__label"], "answer").drop("__label"))


def _llm_failure(failure: str, kinds: Sequence[str]) -> F.Column:
    """The runner's reason of a failed call: no answer, no JSON, or JSON of another shape."""
    unasked, broken, wrong = kinds
    return F.when(F.col("answer_error").isNotNull() | F.col("answer").isNull(), unasked).when(F.col(failure) == "json", broken).when(F.col(failure).isNotNull(), wrong)


def intelligence(spark: SparkSession, root: str, run_ts: str, client: Callable[[], adapters.TextModel], templates: tuple[str, str], *, limit: int, most_chars: int, provider: str = "", model: str = "") -> StageResult:
    """Enriched items to ideas: an extraction and a score from a text model, both checked field by field."""
    extract, score = templates
    ideas = _table(spark, root, "ideas")
    todo = state.unprocessed(_table(spark, root, "enriched_items"), ideas, ["item_id"])
    rows = storage.cut(select.top(todo, [F.desc("published_at"), F.col("item_id")], limit).withColumn("failure", checks.enriched_failure()))
    names = ["item_id", "source_type", "url", "title", "published_at", "enriched_text"]
    good = rows.where("failure IS NULL").select("rank", "evidence_snippets", *[(F.lower(py_strip(c)) if c == "source_type" else py_strip(c)).alias(c) for c in names])
    values = {"TITLE": "title", "SOURCE_TYPE": "source_type", "URL": "url"}
    good = good.withColumn("prompt", records.rendered(extract, {k: F.col(c) for k, c in values.items()} | {"CONTENT": F.substring("enriched_text", 1, most_chars)}, exact=False))
    one = _answers(good, client, "prompt", "extract").withColumn("failure", checks.extract_failure("answer"))
    one = storage.cut(one.withColumn("reason", _llm_failure("failure", checks.EXTRACT_FAILURES)))
    field = lambda c, n: F.get_json_object(c, f"$.{n}")
    two = one.where("reason IS NULL").select("rank", *names, "evidence_snippets", *[py_strip(field("answer", n)).alias(n) for n in (*checks.EXTRACT_TEXTS, "content_type")], *[field("answer", n).alias(n) for n in checks.EXTRACT_LISTS])
    given = {n.upper(): F.col(n) for n in ("title", *checks.EXTRACT_TEXTS, *checks.EXTRACT_LISTS, "content_type")} | {"PLATFORM_HINT": checks.platform_hint("source_type"), "EVIDENCE_SNIPPETS": F.to_json(evidence_texts("evidence_snippets"))}
    two = _answers(two.withColumn("prompt", records.rendered(score, given, exact=False)), client, "prompt", "score").withColumn("failure", checks.score_failure("answer", "source_type"))
    two = storage.cut(two.withColumn("reason", _llm_failure("failure", checks.SCORE_FAILURES)))
    stripped = F.transform(F.from_json(field("answer", "hooks"), "array<string>"), py_strip)
    idea = two.where("reason IS NULL").select(
        "rank", *names[:-1], *checks.EXTRACT_TEXTS, *checks.EXTRACT_LISTS, "content_type", F.to_json(stripped).alias("hooks"),
        *[py_strip(field("answer", n)).alias(n) for n in ("rating_rationale", "platform", "recommended_format")],
        field("answer", "viral_rating").cast("long").alias("viral_rating"), F.lit(provider).alias("llm_provider"), F.lit(model).alias("llm_model"), F.lit(run_ts).alias("created_at"),
    )
    new = storage.cut(state.insert_if_absent(idea, ideas, ["item_id"], [F.col("rank")]))
    every = rows.where("failure IS NOT NULL").select(F.lit("extract_validation_failed").alias("reason")).unionByName(one.where("reason IS NOT NULL").select("reason")).unionByName(two.select("reason"))
    report = _stage_report(every, (*checks.EXTRACT_FAILURES, *checks.SCORE_FAILURES), new, todo)
    _append(new, root, "ideas")
    return StageResult(new.drop("rank"), report)


def _stage_report(every: DataFrame, names: Sequence[str], new: DataFrame, todo: DataFrame) -> dict:
    report = counters(every, "reason", names).first().asDict() | {"available": todo.count(), "inserted": new.count()}
    report["failed"] = report["n_rows"] - report["n_passed"]
    report["already_there"] = report["n_passed"] - report["inserted"]
    return report


def generate(spark: SparkSession, root: str, run_ts: str, client: Callable[[], adapters.TextModel], template: str, *, limit: int, provider: str = "", model: str = "") -> StageResult:
    """Ideas to scripts: one answer each, checked with its sections, steps, call to action and policy."""
    from feedloom.functions.jsonv import script_check

    scripts = _table(spark, root, "scripts")
    todo = state.unprocessed(_table(spark, root, "ideas"), scripts, ["item_id"])
    order = [F.desc("viral_rating"), F.desc("published_at"), F.col("item_id")]
    rows = storage.cut(select.top(todo, order, limit).withColumn("failure", checks.idea_failure()))
    texts = ("item_id", "platform", "recommended_format", "title", "url", *checks.EXTRACT_TEXTS)
    good = rows.where("failure IS NULL").select("rank", *[py_strip(c).alias(c) for c in texts], *[F.to_json(checks.filled_list(c)).alias(c) for c in (*checks.EXTRACT_LISTS, "hooks")])
    given = {n.upper(): F.col(n) for n in (*texts[1:], *checks.EXTRACT_LISTS)} | {"PRIOR_HOOKS": F.col("hooks")}
    out = _answers(good.withColumn("prompt", records.rendered(template, given)), client, "prompt", "script_generate")
    out = out.withColumn("c", script_check("answer", "recommended_format"))
    failure = F.when(checks.parsed("answer").isNull(), "json").when(~F.col("c.valid"), "payload")
    out = storage.cut(out.withColumn("failure", failure).withColumn("reason", _llm_failure("failure", checks.SCRIPT_FAILURES)))
    field = lambda n: F.get_json_object("answer", f"$.{n}")
    parts = F.from_json(field("script.sections"), "array<struct<label: string, text: string>>")
    script = out.where("reason IS NULL").select(
        "rank", "item_id", "platform", "recommended_format", *[py_strip(field(n)).alias(n) for n in ("primary_hook", "cta", "disclaimer")],
        F.to_json(F.transform(F.from_json(field("alt_hooks"), "array<string>"), py_strip)).alias("alt_hooks"),
        F.to_json(F.transform(parts, lambda s: F.struct(py_strip(s["label"]).alias("label"), py_strip(s["text"]).alias("text")))).alias("script_sections"),
        F.col("c.words").alias("word_count"), F.col("c.seconds").alias("estimated_seconds"), F.lit(provider).alias("llm_provider"), F.lit(model).alias("llm_model"), F.lit(run_ts).alias("created_at"),
    )
    new = storage.cut(state.insert_if_absent(script, scripts, ["item_id"], [F.col("rank")]))
    every = rows.where("failure IS NOT NULL").select(F.lit("script_validation_failed").alias("reason")).unionByName(out.select("reason"))
    report = _stage_report(every, checks.SCRIPT_FAILURES, new, todo)
    _append(new, root, "scripts")
    return StageResult(new.drop("rank"), report)


def ideas_with_scripts(spark: SparkSession, root: str) -> DataFrame:
    """Ideas left-joined with scripts and items; script_item_id is null where there is no script."""
    s = _table(spark, root, "scripts").select("item_id", F.col("item_id").alias("script_item_id"), "primary_hook", "script_sections")
    it = _table(spark, root, "items").select("item_id", "creator", "source_name")
    return _table(spark, root, "ideas").join(s, "item_id", "left").join(it, "item_id", "left")


def persist(spark: SparkSession, root: str, run_ts: str, sheet: adapters.Worksheet | None, *, limit: int, header_row: int = 1, key: str = "item_id", enabled: bool = True) -> StageResult:
    """The best ideas with scripts into a worksheet: new rows appended, known ones updated in place."""
    report = dict.fromkeys(("available", "considered", "inserted", "updated", "missing_script", "invalid_payload"), 0) | {"first_error": None}
    if not enabled or sheet is None:
        return StageResult(None, report)
    ideas = ideas_with_scripts(spark, root)
    rows = select.top(ideas, [F.desc("viral_rating"), F.desc("published_at"), F.col("item_id")], limit)
    rows = storage.cut(sheets.sheet_rows(rows, run_ts))
    header, body = sheets.split_rows(sheet.fetch_all(), header_row)
    form = sheets.layout(header, key)
    fit = rows.where("script_item_id IS NOT NULL AND reason IS NULL").drop("reason", "script_item_id")
    plan = storage.cut(sheets.changes(fit.select("rank", *sheets.MAPPED), sheets.sheet_table(spark, body, form, header_row), form))
    counts = rows.agg(F.count("*").alias("considered"), F.count_if(F.col("script_item_id").isNull()).alias("missing_script"), F.count_if(F.expr("script_item_id IS NOT NULL AND reason IS NOT NULL")).alias("invalid_payload"), F.min_by("reason", F.when(F.expr("script_item_id IS NOT NULL AND reason IS NOT NULL"), F.col("rank"))).alias("first_error"))
    report |= counts.first().asDict() | {"available": ideas.count()}
    report["inserted"], report["updated"] = adapters.write_sheet(plan, sheet)
    return StageResult(plan, report)


def deliver(
    spark: SparkSession,
    root: str,
    run_ts: str,
    webhook: str,
    post: Callable | None,
    *,
    limit: int,
    most_chars: int,
    min_rating: int | None = None,
    channel: str = "chat",
    enabled: bool = True,
    dry_run: bool = False,
) -> StageResult:
    """The best scripts not yet sent to a chat webhook, one message each; a dry run renders them only."""
    report = dict.fromkeys(("available", "selected", "sent", "already_sent", "missing_script", "errors"), 0) | {"first_error": None}
    if not enabled:
        return StageResult(None, report)
    webhook_hash = hashlib.sha256(webhook.encode()).hexdigest()
    done = _table(spark, root, "deliveries")
    rows = ideas_with_scripts(spark, root).where(messages.at_least("viral_rating", min_rating))
    report["available"] = rows.count()
    rows = messages.already_sent(rows, done, channel, webhook_hash)
    counts = F.col("script_item_id").isNotNull() & ~F.col("sent")
    seen = storage.cut(select.capped_scan(rows, counts, [("viral_rating", True), ("published_at", True), ("item_id", False)], limit))
    report |= seen.agg(F.count_if("selected").alias("selected"), F.count_if(F.col("script_item_id").isNull()).alias("missing_script"), F.count_if(F.expr("script_item_id IS NOT NULL AND sent")).alias("already_sent")).first().asDict()
    out = storage.cut(messages.with_message(seen.where("selected"), run_ts, most_chars))
    sent: list[tuple[str, str, str, str]] = []
    # At most ``limit`` messages, in order, each recorded if it went out.
    for r in out.orderBy(F.desc("viral_rating"), F.desc("published_at"), "item_id").toLocalIterator():
        error = r["reason"]
        if error is None and not dry_run:
            try:
                adapters.send_message(webhook, r["message"], post)
                sent.append((r["item_id"].strip(), channel, webhook_hash, run_ts))
            except adapters.ServiceError as e:
                error = str(e)
        if error is not None:
            report["errors"] += 1
            report["first_error"] = report["first_error"] or error
    new = spark.createDataFrame(sent, contracts.CONTRACTS["deliveries"].schema)
    _append(contracts.insert_strictly(new, done, contracts.CONTRACTS["deliveries"]), root, "deliveries")
    report["sent"] = len(sent)
    return StageResult(out, report)
