"""The core's queries over the test tables, and what they equal in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.functions import jsonv, media
from feedloom.functions.scoring import body_text, compile_terms, relevance
from feedloom.functions.text import py_strip
from feedloom.functions.times import strict_utc_z, utc_z
from feedloom.operators import records, select, state
from feedloom.plans import contracts, reports, stage_queries
from feedloom.storage import cut, table

GROUPS = {
    "common": {"weight": 1, "terms": ["newsletter", "agent loop", "invoice", "statute", "vaccine", "classroom", "compiler"]},
    "strong": {"weight": 2, "terms": ["most of", "by contrast", "hedge", "prompt*", "tokeni*", "n8n", "hypothesis", "invoice", "log aggregator"]},
}
GATES = {"min_chars": 120, "min_score": 2, "newsletter_min": 1, "trusted": ("tidal_ops_1", "north_quay_1")}
WS = r"\s"


def _terms_sql() -> str:
    parts = []
    for t in compile_terms(GROUPS):
        hit = f"contains(ws, '{t.needle}')" if t.kind == "phrase" else f"list_contains(toks, '{t.needle}')" if t.kind == "token" else f"len(list_filter(toks, lambda w: starts_with(w, '{t.needle}'))) > 0"
        parts.append(f"CASE WHEN {hit} THEN {{'k': '{t.text}', 'w': {t.weight}}} END")
    return "[" + ", ".join(parts) + "]"


def _scored_sql(src: str) -> str:
    return rf"""
body AS (SELECT *, CASE WHEN regexp_matches(coalesce(content_text, ''), '\S') THEN trim(content_text, chr(32)||chr(9)||chr(10)||chr(13)||chr(160)) WHEN regexp_matches(coalesce(summary, ''), '\S') THEN trim(summary, chr(32)||chr(9)||chr(10)||chr(13)||chr(160)) ELSE '' END AS body FROM {src}),
low AS (SELECT *, lower(coalesce(trim(title), '') || ' ' || body) AS txt FROM body),
tok AS (SELECT *, regexp_replace(txt, '\s+', ' ', 'g') AS ws, list_distinct(regexp_extract_all(txt, '[a-z0-9]+(?:\.[a-z0-9]+)*')) AS toks FROM low),
hit AS (SELECT *, list_filter({_terms_sql()}, lambda x: x IS NOT NULL) AS h FROM tok),
scored AS (SELECT *, CAST(coalesce(list_sum(list_transform(h, lambda x: x.w)), 0) AS BIGINT) AS score, array_to_string(list_sort(list_transform(h, lambda x: x.k)), ',') AS keywords FROM hit)"""


_ITEMS = "u AS (SELECT item_id, min_by(source_type, inserted_at) source_type, min_by(source_id, inserted_at) source_id, min_by(title, inserted_at) title, min_by(published_at, inserted_at) published_at, min_by(coalesce(summary, chr(0)), inserted_at) s0, min_by(coalesce(content_text, chr(0)), inserted_at) c0 FROM items GROUP BY item_id), src AS (SELECT item_id, source_type, source_id, title, published_at, nullif(s0, chr(0)) AS summary, nullif(c0, chr(0)) AS content_text FROM u)"


def unique_items(spark: SparkSession, d: str) -> DataFrame:
    """Each item as it was first inserted."""
    return state.first_of_few(table(spark, d, "items"), ["item_id"], [F.col("inserted_at")])


def canonical_items(spark: SparkSession, d: str) -> DataFrame:
    rows = records.canonical_items(table(spark, d, "raw_items"))
    return rows.select("raw_id", "reason", "item_id", "source_type", "source_id", "source_name", "creator", "title", "url", "published_at", "fetched_at", "summary")


_STRIP = "trim({}, chr(32)||chr(9)||chr(10)||chr(13)||chr(160))"


def _canonical_sql() -> str:
    s = lambda c: f"coalesce({_STRIP.format(c)}, '')"
    iso = lambda c: f"CASE WHEN regexp_matches({c}, '^\\d{{4}}-\\d{{2}}-\\d{{2}}([T ]\\d{{2}}:\\d{{2}}:\\d{{2}}(\\.\\d+)?(Z|[+-]\\d{{2}}:\\d{{2}})?)?$') THEN strftime(date_trunc('second', try_cast(regexp_replace({c}, '(Z|[+-]\\d{{2}}:\\d{{2}})$', '') AS TIMESTAMP)) - to_minutes(CASE WHEN regexp_matches({c}, ':\\d{{2}}[+-]\\d{{2}}:\\d{{2}}$') THEN CAST(substring({c}, -6, 3) AS INT) * 60 + CAST(substring({c}, -6, 1) || substring({c}, -2) AS INT) ELSE 0 END), '%Y-%m-%dT%H:%M:%SZ') END"
    return f"""WITH s AS (SELECT raw_id, {', '.join(f'{s(c)} AS {c}' for c in ('external_id', 'url', 'title', 'published_at', 'fetched_at', 'source_type', 'source_id', 'source_name', 'creator', 'summary'))} FROM raw_items),
t AS (SELECT *, {iso('published_at')} AS pub, {iso('fetched_at')} AS fet, coalesce(nullif(source_id, ''), 'unknown') AS sid, coalesce(nullif(source_name, ''), 'unknown') AS nm FROM s)
SELECT raw_id, CASE WHEN external_id = '' OR url = '' OR title = '' OR published_at = '' OR fetched_at = '' THEN 'missing_required_fields' WHEN pub IS NULL OR fet IS NULL THEN 'invalid_timestamps' END AS reason,
sha256(sid || '|' || external_id) AS item_id, CASE WHEN lower(source_type) = 'youtube' THEN 'youtube' ELSE 'newsletter' END AS source_type, sid AS source_id, nm AS source_name,
coalesce(nullif(creator, ''), nm) AS creator, title, url, pub AS published_at, fet AS fetched_at, summary FROM t"""


def reject_counts(spark: SparkSession, d: str) -> DataFrame:
    rows = records.canonical_items(table(spark, d, "raw_items"))
    return reports.counters(rows, "reason", ["invalid_field_types", "missing_required_fields", "invalid_timestamps"], ["batch_id"])


def json_reject_reasons(spark: SparkSession, d: str) -> DataFrame:
    """Typed checks of the stored JSON: a field that is no string, then missing fields."""
    rows = records.json_items(table(spark, d, "items").select("raw_item_json", F.col("item_id").alias("stored_id")), "raw_item_json")
    return rows.groupBy("reason").agg(F.count("*").alias("n"))


def cap_per_source(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "seen_items").where("published_at IS NOT NULL")
    order = [F.desc("published_at"), F.col("external_id"), F.col("dedup_key")]
    return select.cap_per_group(rows, ["source_id"], order, 50).select("source_id", "dedup_key", "published_at")


def recency_filter(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "raw_items")
    reason = records.recency_reason(F.coalesce(py_strip("published_at"), F.lit("")), F.col("url"), F.col("title"), F.lit("2018-01-01T00:00:00Z"))
    return reports.counters(rows.withColumn("reason", reason), "reason", ["too_old", "missing_url", "missing_title"], ["source_name"])


def seen_dedup(spark: SparkSession, d: str) -> DataFrame:
    """New keys of the raw records as written, the first record of each."""
    raw = table(spark, d, "raw_items").select("raw_id", "batch_id", F.sha2(F.concat(F.coalesce(py_strip("source_id"), F.lit("")), F.lit("|"), F.coalesce(py_strip("external_id"), F.lit(""))), 256).alias("dedup_key"))
    return state.insert_if_absent(raw, table(spark, d, "seen_items"), ["dedup_key"], [F.col("batch_id"), F.col("raw_id")]).select("dedup_key", "raw_id")


def relevance_score(spark: SparkSession, d: str) -> DataFrame:
    rows = unique_items(spark, d).withColumn("r", relevance(F.coalesce(py_strip("title"), F.lit("")), body_text("content_text", "summary"), compile_terms(GROUPS)))
    return rows.select("item_id", F.col("r.score").alias("score"), F.array_join("r.keywords", ",").alias("keywords"))


def _gated(spark: SparkSession, d: str) -> DataFrame:
    return records.gated(unique_items(spark, d), compile_terms(GROUPS), **GATES)


def gate_reasons(spark: SparkSession, d: str) -> DataFrame:
    rows = _gated(spark, d).where(F.coalesce("reason", F.lit("")) != "missing_required_fields")
    out = reports.counters(rows, "reason", ["content_too_short", "low_relevance"], ["source_type"])
    cats = rows.groupBy("source_type").agg(*[F.count_if(F.col("category") == c).alias(c) for c in ("standard", "relaxed", "trusted")])
    return out.join(cats, "source_type")


def quota_selection(spark: SparkSession, d: str) -> DataFrame:
    # Scored once: both cuts of the selection read what is written.
    rows = cut(_gated(spark, d).where("reason IS NULL").select("item_id", "source_type", "published_at", "score"))
    best = select.quota_select(rows, F.col("source_type") == "newsletter", [F.desc("published_at"), F.col("item_id")], 60, 100)
    return best.select("item_id", "source_type", "score", "rank")


def relevance_topk(spark: SparkSession, d: str) -> DataFrame:
    """The flagship: items to a scored, gated, ranked top 100."""
    rows = _gated(spark, d).where("reason IS NULL")
    return select.top(rows, [F.desc("score"), F.desc("published_at"), F.col("item_id")], 100).select("item_id", "title", "score", F.array_join("keywords", ",").alias("keywords"), "rank")


def unprocessed_candidates(spark: SparkSession, d: str) -> DataFrame:
    items, cands, rich = (table(spark, d, t) for t in ("items", "candidates", "enriched_items"))
    a = state.unprocessed(items.select("item_id", "source_type"), cands, ["item_id"]).distinct().groupBy("source_type").agg(F.count("*").alias("n")).withColumn("stage", F.lit("items"))
    b = state.unprocessed(cands.select("item_id", "source_type"), rich, ["item_id"]).distinct().groupBy("source_type").agg(F.count("*").alias("n")).withColumn("stage", F.lit("candidates"))
    return a.unionByName(b)


def retry_fold(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    out = state.fold_retries(e, "user_id", "ts", F.col("event_type") == "error", F.when(F.col("event_type") == "error", "asr_failed"), after=2, hours=24, tie="event_id")
    return out.select("user_id", "attempts_total", "consecutive_failures", "last_outcome", "last_fail_reason", utc_z("last_attempt_at").alias("last_attempt_at"), utc_z("next_eligible_at").alias("next_eligible_at"))


def retry_upsert(spark: SparkSession, d: str) -> DataFrame:
    """State of the first half of January, upserted with that of the second."""
    e = table(spark, d, "events").select("user_id", "ts", "event_id", "event_type")
    last = lambda x: state.first_per_key(x, ["user_id"], [-F.unix_micros(F.col("ts").cast("timestamp")), -F.col("event_id")])
    cut = F.lit("2024-01-16 00:00:00").cast("timestamp")
    out = state.upsert(last(e.where(F.col("ts") < cut)), last(e.where(F.col("ts") >= cut)), ["user_id"])
    return out.select("user_id", "event_id", "event_type")


def evidence_snippets(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "enriched_items").select("item_id", F.posexplode(media.snippets(F.col("enriched_text"))).alias("n", "s")).distinct()
    return rows.select("item_id", "n", F.col("s.text").alias("text"), F.col("s.offset").alias("offset"))


def evidence_texts(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "enriched_items").select("item_id", jsonv.evidence_texts("evidence_snippets").alias("t")).distinct()
    return rows.select("item_id", F.size("t").alias("n"), F.coalesce(F.get("t", F.lit(0)), F.lit("")).alias("first"))


def keyword_lists(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "candidates").select("item_id", "created_at", records.joined("matched_keywords").alias("keywords"))
    return rows.groupBy("keywords").agg(F.count("*").alias("n"))


def word_counts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", media.word_count("text").cast("long").alias("n_words"), F.coalesce(media.steps_valid("text"), F.lit(False)).alias("steps"))


_PAYLOAD = """concat('{"primary_hook": "', h, '", "alt_hooks": ["a", "b"], "script": {"sections": [{"label": "hook", "text": "', h, '"}, {"label": "setup", "text": "', t, '"}, {"label": "steps", "text": "- one\\\\n- two\\\\n- three"}, {"label": "cta", "text": "go"}], "word_count": 9, "estimated_seconds": ', sec, '}, "cta": "', cta, '", "disclaimer": ""}')"""


def script_validation(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    clean = F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), "[^A-Za-z ]+", " "))
    p = docs.select("doc_id", F.substring(clean, 1, 30).alias("h"), clean.alias("t"), (F.lit(30) + F.col("doc_id") % 60).cast("string").alias("sec"), F.when(F.col("doc_id") % 5 == 0, "no").otherwise("go").alias("cta"), F.when(F.col("doc_id") % 3 == 0, "thread").otherwise("reel").alias("form"))
    p = p.select("doc_id", "form", F.expr(_PAYLOAD).alias("payload"))
    return p.select("doc_id", jsonv.script_check("payload", "form").alias("c")).select("doc_id", F.col("c.valid").alias("valid"))


def video_ids(spark: SparkSession, d: str) -> DataFrame:
    urls = table(spark, d, "raw_items").select("url").distinct()
    got = urls.withColumn("video_id", media.video_id("url", ("vidtube.example", "www.vidtube.example"), "vdtu.example")).where("video_id IS NOT NULL")
    return got.groupBy("video_id").agg(F.count("*").alias("n_spellings"))


def idea_rows(spark: SparkSession, d: str) -> DataFrame:
    """Three-way left join with a minimum rating, ordered and limited: orders as ideas, their lines as scripts, customers as items."""
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", (1 + F.col("o_orderkey") % 10).alias("rating"), "o_orderdate")
    s = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.min("l_returnflag").alias("hook"))
    c = table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment")
    rows = o.where("rating >= 5").join(s, o.o_orderkey == s.l_orderkey, "left").join(c, o.o_custkey == c.c_custkey, "left")
    best = select.top(rows, [F.desc("rating"), F.desc("o_orderdate"), F.col("o_orderkey")], 500)
    return best.select("o_orderkey", "rating", F.coalesce("hook", F.lit("-")).alias("hook"), records.creator_or("c_name", "c_mktsegment").alias("creator"), "rank")


def capped_delivery(spark: SparkSession, d: str) -> DataFrame:
    """Per customer the first three orders not yet sent, in order; those without lines take no place."""
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice", ((F.col("o_orderstatus") == "F") & (F.col("o_orderkey") % 3 == 0)).alias("sent"))
    s = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")).distinct().withColumn("has", F.lit(True))
    rows = o.join(s, "o_orderkey", "left")
    scan = select.capped_prefix(rows, F.coalesce("has", F.lit(False)) & ~F.col("sent"), ["o_custkey"], [F.desc("o_totalprice"), F.col("o_orderkey")], 3)
    return scan.where("visited").groupBy("o_custkey").agg(F.count_if("selected").alias("n_selected"), F.count_if(F.expr("has IS NULL")).alias("n_missing"), F.count_if(F.expr("has AND sent")).alias("n_sent"))


def sheet_upsert(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    cur = o.where("o_orderkey % 2 = 0").select(F.col("o_orderkey").cast("string").alias("item_id"), F.lit("old").alias("title"), F.col("o_orderstatus").alias("status"), F.lit("kept").alias("notes"))
    new = o.where("o_orderkey % 3 = 0").select(F.col("o_orderkey").cast("string").alias("item_id"), F.col("o_orderpriority").alias("title"))
    return records.sheet_upsert(cur, new, "item_id", ["status", "notes"], {"status": "New", "notes": ""})


def delivery_messages(spark: SparkSession, d: str) -> DataFrame:
    """Scripts rendered from items, cut at a length with its mark."""
    rows = unique_items(spark, d).where("content_text IS NOT NULL")
    text = records.script_text(F.coalesce(py_strip("title"), F.lit("")), F.col("source_id"), F.col("content_text"), F.col("url"), 400)
    return rows.where("url IS NOT NULL AND source_id IS NOT NULL").select("item_id", text.alias("message"))


def prompts(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders")
    out = records.rendered("Rate {{TOPIC}} of {{KEY}}: {{TOPIC}}", {"TOPIC": F.col("o_orderpriority"), "KEY": F.col("o_orderkey").cast("string")})
    return rows.select("o_orderkey", out.alias("prompt"))


def proxy_order(spark: SparkSession, d: str) -> DataFrame:
    """How often each of seven attempts comes first."""
    rows = table(spark, d, "seen_items").select(F.get(media.rotated("external_id", [f"p{i}" for i in range(7)]), F.lit(0)).alias("first_attempt"))
    return rows.where("first_attempt IS NOT NULL").groupBy("first_attempt").agg(F.count("*").alias("n"))


def contract_report(spark: SparkSession, d: str) -> DataFrame:
    out = None
    for name in ("seen_items", "items", "candidates", "enriched_items"):
        v = contracts.violations(table(spark, d, name), contracts.CONTRACTS[name]).withColumn("table_name", F.lit(name))
        out = v if out is None else out.unionByName(v)
    return out


def transcript_assembly(spark: SparkSession, d: str) -> DataFrame:
    """Event types of each user as one text, in order: a list per key, assembled by sorted positions."""
    e = table(spark, d, "events").groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("ts", "event_id", "event_type"))).alias("s"))
    return e.select("user_id", F.md5(F.array_join(F.transform("s", lambda x: x["event_type"]), " ")).alias("text_md5"), F.size("s").cast("long").alias("n"))


def run_report(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "candidates")
    ts = strict_utc_z("published_at")
    return c.groupBy("created_at").agg(F.count("*").alias("n_rows"), F.countDistinct("item_id").alias("n_items"), F.count_if(ts.isNull()).alias("n_bad_time"), F.count_if(F.coalesce("relevance_score", F.lit(-1)) < 0).alias("n_bad_score"))


_NAMES = """canonical_items reject_counts json_reject_reasons cap_per_source recency_filter seen_dedup relevance_score gate_reasons quota_selection relevance_topk
unprocessed_candidates retry_fold retry_upsert evidence_snippets evidence_texts keyword_lists word_counts script_validation video_ids idea_rows
capped_delivery sheet_upsert delivery_messages prompts proxy_order contract_report transcript_assembly run_report""".split()


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {n: globals()[n] for n in _NAMES} | {n: getattr(stage_queries, n) for n in stage_queries.NAMES}


def _gated_sql() -> str:
    sid = "lower(trim(source_id))"
    return f"""WITH {_ITEMS}, {_scored_sql("src")},
full_rows AS (SELECT *, (SELECT count(*) FROM items i WHERE i.item_id = s.item_id AND ({' OR '.join(f"NOT regexp_matches(coalesce(i.{c}, ''), '[^ \\t\\n\\r]')" for c in records.ITEM_FIELDS)}) AND i.inserted_at = (SELECT min(inserted_at) FROM items j WHERE j.item_id = s.item_id)) AS holes FROM scored s),
gate AS (SELECT *, CASE WHEN holes > 0 THEN 'missing' WHEN length(body) < 120 THEN 'content_too_short' WHEN trim(source_type) = 'newsletter' AND NOT (score >= 1 OR {sid} IN ('tidal_ops_1', 'north_quay_1')) THEN 'low_relevance' WHEN trim(source_type) <> 'newsletter' AND score < 2 THEN 'low_relevance' END AS reason,
CASE WHEN score >= 2 THEN 'standard' WHEN score >= 1 THEN 'relaxed' ELSE 'trusted' END AS cat FROM full_rows)"""


def oracle_sql() -> dict[str, str]:
    gate = _gated_sql()
    return {
        "canonical_items": _canonical_sql(),
        "reject_counts": f"WITH c AS (SELECT r.batch_id, x.reason FROM raw_items r JOIN ({_canonical_sql()}) x USING (raw_id)) SELECT batch_id, count(*) AS n_rows, count(*) FILTER (reason IS NULL) AS n_passed, count(*) FILTER (reason = 'invalid_field_types') AS invalid_field_types, count(*) FILTER (reason = 'missing_required_fields') AS missing_required_fields, count(*) FILTER (reason = 'invalid_timestamps') AS invalid_timestamps FROM c GROUP BY 1",
        "cap_per_source": "SELECT source_id, dedup_key, published_at FROM (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY published_at DESC, external_id, dedup_key) AS k FROM seen_items WHERE published_at IS NOT NULL) WHERE k <= 50",
        "recency_filter": f"WITH r AS (SELECT source_name, CASE WHEN coalesce({_STRIP.format('published_at')}, '') < '2018-01-01T00:00:00Z' THEN 'too_old' WHEN NOT regexp_matches(coalesce(url, ''), '[^ \\t\\n\\r]') THEN 'missing_url' WHEN NOT regexp_matches(coalesce(title, ''), '[^ \\t\\n\\r]') THEN 'missing_title' END AS reason FROM raw_items) SELECT source_name, count(*) AS n_rows, count(*) FILTER (reason IS NULL) AS n_passed, count(*) FILTER (reason = 'too_old') AS too_old, count(*) FILTER (reason = 'missing_url') AS missing_url, count(*) FILTER (reason = 'missing_title') AS missing_title FROM r GROUP BY 1",
        "seen_dedup": f"WITH k AS (SELECT raw_id, batch_id, sha256(coalesce({_STRIP.format('source_id')}, '') || '|' || coalesce({_STRIP.format('external_id')}, '')) AS dedup_key FROM raw_items) SELECT dedup_key, arg_min(raw_id, (batch_id, raw_id)) AS raw_id FROM k ANTI JOIN seen_items USING (dedup_key) GROUP BY 1",
        "relevance_score": f"WITH {_ITEMS}, {_scored_sql('src')} SELECT item_id, score, keywords FROM scored",
        "gate_reasons": f"{gate} SELECT source_type, count(*) AS n_rows, count(*) FILTER (reason IS NULL) AS n_passed, count(*) FILTER (reason = 'content_too_short') AS content_too_short, count(*) FILTER (reason = 'low_relevance') AS low_relevance, count(*) FILTER (reason IS NULL AND source_type = 'newsletter' AND cat = 'standard') AS standard, count(*) FILTER (reason IS NULL AND source_type = 'newsletter' AND cat = 'relaxed') AS relaxed, count(*) FILTER (reason IS NULL AND source_type = 'newsletter' AND cat = 'trusted') AS trusted FROM gate WHERE coalesce(reason, '') <> 'missing' GROUP BY 1",
        "quota_selection": f"{gate}, p AS (SELECT *, row_number() OVER (PARTITION BY source_type = 'newsletter' ORDER BY published_at DESC, item_id) AS k FROM gate WHERE reason IS NULL), r AS (SELECT *, row_number() OVER (ORDER BY CASE WHEN source_type = 'newsletter' AND k <= 60 THEN 0 ELSE 1 END, published_at DESC, item_id) AS rank FROM p) SELECT item_id, source_type, score, rank FROM r WHERE rank <= 100",
        "relevance_topk": f"{gate}, r AS (SELECT *, row_number() OVER (ORDER BY score DESC, published_at DESC, item_id) AS rank FROM gate WHERE reason IS NULL) SELECT item_id, trim(title) AS title, score, keywords, rank FROM r WHERE rank <= 100",
        "unprocessed_candidates": "SELECT source_type, count(*) AS n, 'items' AS stage FROM (SELECT DISTINCT item_id, source_type FROM items ANTI JOIN candidates USING (item_id)) GROUP BY 1 UNION ALL SELECT source_type, count(*) AS n, 'candidates' AS stage FROM (SELECT DISTINCT item_id, source_type FROM candidates ANTI JOIN enriched_items USING (item_id)) GROUP BY 1",
        "retry_fold": "WITH e AS (SELECT *, sum(CASE WHEN event_type <> 'error' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS island FROM events), l AS (SELECT user_id, max(island) AS li, count(*) AS n, arg_max(event_type, (ts, event_id)) AS le, max(ts) AS lt FROM e GROUP BY 1), f AS (SELECT l.*, (SELECT count(*) FROM e WHERE e.user_id = l.user_id AND e.island = l.li AND e.event_type = 'error') AS c FROM l) SELECT user_id, n AS attempts_total, c AS consecutive_failures, CASE WHEN le = 'error' THEN 'failed' ELSE 'success' END AS last_outcome, CASE WHEN le = 'error' THEN 'asr_failed' END AS last_fail_reason, strftime(lt, '%Y-%m-%dT%H:%M:%SZ') AS last_attempt_at, CASE WHEN le = 'error' AND c >= 2 THEN strftime(lt + INTERVAL 24 HOUR, '%Y-%m-%dT%H:%M:%SZ') END AS next_eligible_at FROM f",
        "retry_upsert": "WITH l AS (SELECT *, row_number() OVER (PARTITION BY user_id, ts >= TIMESTAMP '2024-01-16' ORDER BY ts DESC, event_id DESC) AS k FROM events), b AS (SELECT * FROM l WHERE k = 1 AND ts >= TIMESTAMP '2024-01-16'), a AS (SELECT * FROM l WHERE k = 1 AND ts < TIMESTAMP '2024-01-16') SELECT user_id, event_id, event_type FROM b UNION ALL SELECT user_id, event_id, event_type FROM a ANTI JOIN b USING (user_id)",
        "evidence_snippets": "SELECT DISTINCT item_id, CAST(i AS INT) AS n, substring(enriched_text, CAST(i * 240 + 1 AS BIGINT), 240) AS text, CAST(i * 240 AS INT) AS \"offset\" FROM enriched_items, range(3) t(i) WHERE length(enriched_text) > i * 240",
        "evidence_texts": "WITH e AS (SELECT DISTINCT item_id, evidence_snippets AS j FROM enriched_items), x AS (SELECT item_id, list_filter(list_transform(CASE WHEN json_valid(j) AND json_type(j) = 'ARRAY' THEN from_json(j, '[\"JSON\"]') ELSE [] END, lambda v: substring(trim(regexp_replace(json_extract_string(v, '$.text'), '[ \\t\\n\\r\\f\\v\\x{a0}\\x{2000}-\\x{200a}\\x{3000}\\x{2028}\\x{2029}]+', ' ', 'g')), 1, 240)), lambda s: s <> '')[1:3] AS t FROM e) SELECT DISTINCT item_id, CAST(coalesce(len(t), 0) AS INT) AS n, coalesce(t[1], '') AS first FROM x",
        "keyword_lists": "WITH k AS (SELECT CASE WHEN json_valid(matched_keywords) AND json_type(matched_keywords) = 'ARRAY' THEN array_to_string(list_filter(list_transform(from_json(matched_keywords, '[\"VARCHAR\"]'), lambda s: trim(s)), lambda s: s <> ''), ', ') END AS keywords FROM candidates) SELECT keywords, count(*) AS n FROM k GROUP BY 1",
        "word_counts": r"SELECT doc_id, CAST(len(regexp_extract_all(coalesce(text, ''), '[A-Za-z0-9]+(?:[''-][A-Za-z0-9]+)*')) AS BIGINT) AS n_words, coalesce(len(l) BETWEEN 3 AND 6 AND len(list_filter(l, lambda x: NOT regexp_matches(x, '^- .*\S'))) = 0, false) AS steps FROM (SELECT *, list_filter(list_transform(string_split(regexp_replace(text, '\r\n|\r', chr(10), 'g'), chr(10)), lambda x: trim(x, chr(32)||chr(9)||chr(160)||chr(11)||chr(12))), lambda x: x <> '') AS l FROM documents)",
        "idea_rows": "WITH s AS (SELECT l_orderkey, min(l_returnflag) AS hook FROM lineitem GROUP BY 1), r AS (SELECT o.o_orderkey, 1 + o_orderkey % 10 AS rating, coalesce(hook, '-') AS hook, coalesce(nullif(trim(c_name), ''), nullif(trim(c_mktsegment), ''), 'unknown') AS creator, row_number() OVER (ORDER BY 1 + o_orderkey % 10 DESC, o_orderdate DESC, o_orderkey) AS rank FROM orders o LEFT JOIN s ON l_orderkey = o_orderkey LEFT JOIN customer ON c_custkey = o_custkey WHERE 1 + o_orderkey % 10 >= 5) SELECT * FROM r WHERE rank <= 500",
        "capped_delivery": "WITH r AS (SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus = 'F' AND o_orderkey % 3 = 0 AS sent, o_orderkey IN (SELECT l_orderkey FROM lineitem) AS has FROM orders), w AS (SELECT *, has AND NOT sent AS cnt, coalesce(sum(CASE WHEN has AND NOT sent THEN 1 ELSE 0 END) OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM r) SELECT o_custkey, count(*) FILTER (cnt) AS n_selected, count(*) FILTER (NOT has) AS n_missing, count(*) FILTER (has AND sent) AS n_sent FROM w WHERE before < 3 GROUP BY 1",
        "sheet_upsert": "SELECT CAST(o_orderkey AS VARCHAR) AS item_id, CASE WHEN o_orderkey % 2 = 0 THEN 'update' ELSE 'insert' END AS action, o_orderpriority AS title, CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus ELSE 'New' END AS status, CASE WHEN o_orderkey % 2 = 0 THEN 'kept' ELSE '' END AS notes FROM orders WHERE o_orderkey % 3 = 0",
        "delivery_messages": f"WITH u AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY inserted_at) AS k FROM items), m AS (SELECT item_id, 'Hook: ' || coalesce({_STRIP.format('title')}, '') || chr(10) || chr(10) || 'Setup: ' || source_id || chr(10) || chr(10) || 'Steps:' || chr(10) || content_text || chr(10) || chr(10) || 'CTA: ' || url AS t FROM u WHERE k = 1 AND content_text IS NOT NULL AND url IS NOT NULL AND source_id IS NOT NULL) SELECT item_id, CASE WHEN length(t) > 400 THEN substring(t, 1, 400) || '...(truncated)' ELSE t END AS message FROM m",
        "prompts": "SELECT o_orderkey, 'Rate ' || o_orderpriority || ' of ' || CAST(o_orderkey AS VARCHAR) || ': ' || o_orderpriority AS prompt FROM orders",
        "transcript_assembly": "SELECT user_id, md5(string_agg(event_type, ' ' ORDER BY ts, event_id)) AS text_md5, count(*) AS n FROM events GROUP BY 1",
        "run_report": "SELECT created_at, count(*) AS n_rows, count(DISTINCT item_id) AS n_items, count(*) FILTER (NOT coalesce(regexp_full_match(trim(published_at), '\\d{4}-\\d{2}-\\d{2}T\\d{2}:\\d{2}:\\d{2}Z'), false)) AS n_bad_time, count(*) FILTER (coalesce(relevance_score, -1) < 0) AS n_bad_score FROM candidates GROUP BY 1",
        "video_ids": r"WITH u AS (SELECT DISTINCT url, trim(url, chr(32)||chr(9)||chr(10)||chr(13)||chr(160)) AS t FROM raw_items), p AS (SELECT url, lower(regexp_extract(t, '^https?://([^/?#:]+)', 1)) AS host, regexp_extract(t, '^https?://[^/?#]*([^?#]*)', 1) AS path, '&' || regexp_extract(t, '^[^?#]*\?([^#]*)', 1) AS q FROM u), v AS (SELECT url, CASE WHEN host IN ('vidtube.example', 'www.vidtube.example') THEN coalesce(nullif(regexp_extract(q, '&v=([^&]+)', 1), ''), nullif(regexp_extract(path, '^/+(?i:shorts|embed)/+([^/]+)', 1), '')) WHEN host = 'vdtu.example' THEN regexp_extract(path, '^/+([^/]+)', 1) END AS video_id FROM p) SELECT video_id, count(*) AS n_spellings FROM v WHERE regexp_full_match(video_id, '[A-Za-z0-9_-]{11}') GROUP BY 1",
        "contract_report": _contract_sql(),
        "json_reject_reasons": _json_sql(),
        "script_validation": _script_sql(),
        "proxy_order": "SELECT 'p' || CAST(list_reduce(list_transform(string_split(sha256(external_id), ''), lambda h: CAST(strpos('0123456789abcdef', h) - 1 AS BIGINT)), lambda a, h: (a * 16 + h) % 7) AS VARCHAR) AS first_attempt, count(*) AS n FROM seen_items WHERE external_id IS NOT NULL GROUP BY 1",
    } | stage_queries.oracle_sql()


def _contract_sql() -> str:
    parts = []
    for name in ("seen_items", "items", "candidates", "enriched_items"):
        c = contracts.CONTRACTS[name]
        parts += [f"SELECT 'null {x}' AS rule, count(*) FILTER ({x} IS NULL) AS n, '{name}' AS table_name FROM {name}" for x in (*c.text, *c.whole)]
        parts.append(f"SELECT 'duplicate key' AS rule, CAST(coalesce(sum(k - 1), 0) AS BIGINT) AS n, '{name}' AS table_name FROM (SELECT count(*) AS k FROM {name} GROUP BY {', '.join(c.key)})")
    return " UNION ALL ".join(parts)


def _json_sql() -> str:
    fields = (*records.REQUIRED, *records.OPTIONAL)
    wrong = " OR ".join(f"coalesce(json_type(j, '$.{f}') <> 'VARCHAR', false)" for f in fields)
    strip = lambda f: f"coalesce(trim(json_extract_string(j, '$.{f}'), chr(32)||chr(9)||chr(10)||chr(13)||chr(160)), '')"
    missing = " OR ".join(f"{strip(f)} = ''" for f in records.REQUIRED)
    return f"""WITH v AS (SELECT CASE WHEN json_valid(raw_item_json) THEN raw_item_json END AS j FROM items WHERE regexp_matches(raw_item_json, '[^ \\t\\n\\r]'))
SELECT CASE WHEN j IS NULL THEN 'invalid_json' WHEN json_type(j) <> 'OBJECT' THEN 'not_an_object' WHEN {wrong} THEN 'invalid_field_types' WHEN {missing} THEN 'missing_required_fields'
WHEN try_cast({strip("published_at")} AS TIMESTAMPTZ) IS NULL OR try_cast({strip("fetched_at")} AS TIMESTAMPTZ) IS NULL THEN 'invalid_timestamps' END AS reason, count(*) AS n FROM v GROUP BY 1"""


def _script_sql() -> str:
    """The parts are known from how the payload is made; the words are counted in SQL."""
    return r"""WITH d AS (SELECT doc_id, trim(regexp_replace(coalesce(text, ''), '[^A-Za-z ]+', ' ', 'g'), ' ') AS t, 30 + doc_id % 60 AS sec, doc_id % 5 = 0 AS stop, doc_id % 3 = 0 AS prose FROM documents),
w AS (SELECT *, substring(t, 1, 30) AS h FROM d),
n AS (SELECT *, len(regexp_extract_all(h || ' ' || t || ' - one' || chr(10) || '- two' || chr(10) || '- three go', '[A-Za-z0-9]+(?:[''-][A-Za-z0-9]+)*')) AS words FROM w)
SELECT doc_id, trim(h) <> '' AND NOT stop AND CASE WHEN prose THEN words >= 180 AND sec BETWEEN 70 AND 110 ELSE words >= 120 AND sec BETWEEN 45 AND 70 END AS valid FROM n"""
