"""Queries of the later stages over the test tables, and what they equal in SQL.

Where the tables hold no payloads, ideas or feeds, both engines build the same text from a table's columns,
and each checks or reads it by its own means.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.functions import checks, media
from feedloom.functions.times import utc_z
from feedloom.operators import messages, records, select, sheets, state
from feedloom.plans import reports
from feedloom.sources import feeds
from feedloom.storage import cut, table

STRIP = "trim({}, chr(32)||chr(9)||chr(10)||chr(13)||chr(160))"
_TEXT = "regexp_matches(coalesce({}, ''), '[^ \\t\\n\\r]')"
_STAMP = "coalesce(regexp_full_match(" + STRIP.format("published_at") + ", '\\d{4}-\\d{2}-\\d{2}T\\d{2}:\\d{2}:\\d{2}Z'), false)"
_TYPE = "coalesce(lower(" + STRIP.format("source_type") + ") IN ('newsletter', 'youtube'), false)"


def _case(rules: list[tuple[str, str]]) -> str:
    return "CASE " + " ".join(f"WHEN NOT coalesce({ok}, false) THEN '{name}'" for name, ok in rules) + " END"


def _texts(*names: str) -> list[tuple[str, str]]:
    return [(n, _TEXT.format(n)) for n in names]


def _read(spark: SparkSession, d: str, sql: str, name: str) -> DataFrame:
    """The rows of a query over one table that both engines read."""
    table(spark, d, name).createOrReplaceTempView(f"feedloom_{name}")
    return spark.sql(sql.replace(f"FROM {name}", f"FROM feedloom_{name}"))


def candidate_failures(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "candidates").select("created_at", checks.candidate_failure().alias("failure"))
    return rows.groupBy("created_at", "failure").agg(F.count("*").alias("n"))


def enriched_failures(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "enriched_items").select("item_id", checks.enriched_failure().alias("failure"))


#: Candidates as ideas, dirty in many ways; both engines read it.
IDEAS = """SELECT item_id, created_at, CASE WHEN relevance_score % 5 = 0 THEN source_type ELSE lower(trim(source_type)) END AS platform,
CASE relevance_score % 4 WHEN 0 THEN 'reel' WHEN 1 THEN ' thread' WHEN 2 THEN 'other' ELSE 'memo' END AS recommended_format, url, title, published_at,
title AS topic, creator AS core_claim, source_name AS monetization_angle, matched_keywords AS workflow_steps, matched_keywords AS tools_mentioned,
CASE WHEN relevance_score % 11 = 0 THEN '[1]' ELSE '[]' END AS metrics_claims, CASE WHEN relevance_score % 7 = 0 THEN '{}' ELSE '[" "]' END AS assumptions,
concat('["a", "', CASE WHEN relevance_score % 9 = 0 THEN ' ' ELSE 'b' END, '", "c"]') AS hooks, CAST(relevance_score AS BIGINT) % 12 AS viral_rating FROM candidates"""


def _ideas(spark: SparkSession, d: str) -> DataFrame:
    return _read(spark, d, IDEAS, "candidates")


def idea_failures(spark: SparkSession, d: str) -> DataFrame:
    rows = _ideas(spark, d).select("item_id", "created_at", checks.idea_failure().alias("failure"))
    return rows.groupBy("created_at", "failure").agg(F.count("*").alias("n"), F.min("item_id").alias("first_item"))


#: Payloads as a text model might answer, one kind of damage per remainder of the key.
EXTRACTS = """SELECT doc_id, CASE WHEN doc_id % 13 = 1 THEN '{"topic": ' WHEN doc_id % 13 = 2 THEN '["topic"]' ELSE
concat('{"topic": ', CASE WHEN doc_id % 13 = 3 THEN '3' ELSE '"t"' END, ', "core_claim": "", "workflow_steps": ', CASE WHEN doc_id % 13 = 4 THEN '["1","2","3","4","5","6","7","8","9"]' WHEN doc_id % 13 = 5 THEN '["1", null]' ELSE concat('["', coalesce(lang, ''), '"]') END,
', "tools_mentioned": ', CASE WHEN doc_id % 13 = 6 THEN '{}' ELSE '[]' END, ', "monetization_angle": ', CASE WHEN doc_id % 13 = 7 THEN 'null' ELSE '" "' END, ', "metrics_claims": [], "assumptions": ["a", ""]',
CASE WHEN doc_id % 13 = 8 THEN ', "more": 1' WHEN doc_id % 13 = 9 THEN '' ELSE concat(', "content_type": "', CASE WHEN doc_id % 13 = 10 THEN 'blog' WHEN doc_id % 13 = 11 THEN ' news ' ELSE coalesce(kind, '') END, '"') END, '}') END AS payload FROM documents"""
SCORES = """SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'youtube' ELSE 'newsletter' END AS hint, CASE WHEN doc_id % 17 = 1 THEN '' WHEN doc_id % 17 = 2 THEN '7' ELSE
concat('{"viral_rating": ', CASE WHEN doc_id % 17 = 3 THEN '11' WHEN doc_id % 17 = 4 THEN 'true' WHEN doc_id % 17 = 5 THEN '"7"' ELSE CAST(1 + doc_id % 10 AS STRING) END, ', "rating_rationale": "', CASE WHEN doc_id % 17 = 6 THEN ' ' ELSE 'r' END, '", "hooks": ["a", "',
CASE WHEN doc_id % 17 = 7 THEN repeat('x', 141) WHEN doc_id % 17 = 8 THEN '' ELSE concat(' ', repeat('x', 140)) END, '"', CASE WHEN doc_id % 17 = 9 THEN '' ELSE ', "c"' END, '], "platform": "', CASE WHEN doc_id % 3 = 0 THEN 'youtube' ELSE 'newsletter' END,
'", "recommended_format": "', CASE WHEN doc_id % 17 = 10 THEN 'memo' ELSE 'reel' END, '"', CASE WHEN doc_id % 17 = 11 THEN ', "x": 1' ELSE '' END, '}') END AS payload FROM documents"""


def extract_failures(spark: SparkSession, d: str) -> DataFrame:
    rows = _read(spark, d, EXTRACTS, "documents")
    return rows.select("doc_id", checks.extract_failure("payload").alias("failure"))


def score_failures(spark: SparkSession, d: str) -> DataFrame:
    rows = _read(spark, d, SCORES, "documents")
    return rows.select("doc_id", checks.score_failure("payload", "hint").alias("failure"))


#: Orders as ideas with scripts whose sections are JSON, some of them broken.
SCRIPTED = """SELECT CAST(o_orderkey AS STRING) AS item_id, 1 + o_orderkey % 10 AS viral_rating, CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE o_orderpriority END AS topic, concat(' https://s.example/', CAST(o_orderkey AS STRING)) AS url,
CASE WHEN o_orderkey % 7 = 0 THEN ' ' ELSE o_orderstatus END AS primary_hook, concat('["", " ', o_orderpriority, '"', CASE WHEN o_orderkey % 23 = 0 THEN ', 1' ELSE '' END, ']') AS hooks, '["x ", "", "y"]' AS tools_mentioned, 'newsletter' AS platform, '' AS monetization_angle, '2024-01-01T00:00:00Z' AS published_at,
concat('[{"label": "hook", "text": "', o_orderpriority, '"}, {"text": " set ", "label": "', CASE WHEN o_orderkey % 11 = 0 THEN 'steps' ELSE 'setup' END, '"}, {"label": "steps", "text": "', CASE WHEN o_orderkey % 13 = 0 THEN ' ' ELSE '- a' END, '"}, {"label": "cta", "text": "go"', CASE WHEN o_orderkey % 17 = 0 THEN ', "x": 1' ELSE '' END, '}]') AS script_sections,
CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END AS creator, CASE WHEN o_orderkey % 3 = 0 THEN ' n ' END AS source_name FROM orders"""


def _scripted(spark: SparkSession, d: str) -> DataFrame:
    return _read(spark, d, SCRIPTED, "orders")


def message_rows(spark: SparkSession, d: str) -> DataFrame:
    out = messages.with_message(_scripted(spark, d), "2024-01-02T00:00:00Z", 40)
    return out.select("item_id", "reason", F.md5("message").alias("message_md5"))


def sheet_changes(spark: SparkSession, d: str) -> DataFrame:
    """Every third order into a sheet that holds every second one, with a column of people's own."""
    form = sheets.layout([*sheets.REQUIRED_HEADERS, "tools_mentioned", "mine"])
    o = table(spark, d, "orders").where("o_orderkey % 2 = 0")
    old = o.select(F.col("o_orderkey").cast("string").alias("item_id"), F.col("o_orderkey").alias("row_number"), F.array(*[F.lit(h) for h in form.headers[:8]], F.col("o_orderstatus"), F.lit("t"), F.lit("m")).alias("cells"))
    rows = sheets.sheet_rows(_scripted(spark, d).where("CAST(item_id AS BIGINT) % 3 = 0"), "2024-01-02T00:00:00Z")
    out = sheets.changes(rows.where("reason IS NULL").drop("reason"), sheets.unique_keys(old), form)
    return out.select("item_id", "action", "row_number", F.array_join("cells", "|").alias("cells"))


def delivery_scan(spark: SparkSession, d: str) -> DataFrame:
    """One scan of all ideas in order until 300 count; sent ones and those without a script take no place."""
    o = table(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("item_id"), (1 + F.col("o_orderkey") % 10).alias("viral_rating"), utc_z("o_orderdate").alias("published_at"), "o_orderstatus", "o_orderkey")
    sent = o.where("o_orderstatus = 'F' AND o_orderkey % 3 = 0").select("item_id", F.lit("chat").alias("channel"), F.lit("h").alias("webhook_hash"))
    other = o.where("o_orderkey % 5 = 0").select("item_id", F.lit("mail").alias("channel"), F.lit("h").alias("webhook_hash"))
    s = table(spark, d, "lineitem").select(F.col("l_orderkey").cast("string").alias("item_id")).distinct().withColumn("script", F.lit(True))
    rows = o.where(messages.at_least("viral_rating", 5)).join(s, "item_id", "left")
    rows = messages.already_sent(rows, sent.unionByName(other), "chat", "h")
    scan = select.capped_scan(rows, F.coalesce("script", F.lit(False)) & ~F.col("sent"), [("viral_rating", True), ("published_at", True), ("item_id", False)], 300)
    return scan.select("item_id", "viral_rating", "selected", F.col("script").isNull().alias("missing"), "sent")


def rating_bounds(spark: SparkSession, d: str) -> DataFrame:
    """How many ideas there are from a rating on, and without a bound."""
    o = table(spark, d, "orders").select(F.when(F.col("o_orderkey") % 9 != 0, 1 + F.col("o_orderkey") % 10).alias("r"))
    return o.agg(F.count_if(messages.at_least("r", None)).alias("n_all"), F.count_if(messages.at_least("r", 5)).alias("n_from_5"), F.count_if(messages.at_least("r", 11)).alias("n_from_11"))


NOW = "2024-01-30T12:00:00Z"


def _retries(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    fold = state.fold_retries(e, "user_id", "ts", F.col("event_type") == "error", F.when(F.col("event_type") == "error", "youtube_asr_failed"), after=1, hours=240, tie="event_id")
    return fold.select(F.col("user_id").cast("string").alias("item_id"), utc_z("next_eligible_at").alias("next_eligible_at"))


def _pool(spark: SparkSession, d: str) -> DataFrame:
    """One row per candidate item, its best, with validity and the cooldown of the retry state.

    An item shares the state of one of the 150 users; times are as the fold of all events leaves them.
    """
    c = table(spark, d, "candidates").where("item_id IS NOT NULL").withColumn("valid", checks.candidate_failure().isNull())
    low = lambda x: F.coalesce(F.lower(records.py_strip(x)), F.lit(""))
    c = c.select("item_id", low("source_type").alias("stype"), low("source_id").alias("sid"), F.coalesce("relevance_score", F.lit(-9)).alias("score"), F.coalesce("published_at", F.lit("")).alias("pub"), "valid")
    best = state.first_per_key(c, ["item_id"], [-F.col("score"), -F.col("valid").cast("int"), F.col("pub"), F.col("stype"), F.col("sid")])
    user = (F.conv(F.substring("id", 1, 4), 16, 10).cast("int") % 150).cast("string")
    pool = state.cooled_down(best.withColumnRenamed("item_id", "id").withColumn("item_id", user), _retries(spark, d), NOW).drop("item_id")
    down = F.transform(F.split(F.regexp_replace("pub", r"\D", ""), ""), lambda x: -F.when(x != "", x.cast("int")).otherwise(0))
    # The base order as a struct: comparable, so no global numbering of all candidates is needed.
    idx = F.struct((-F.col("score")).alias("a"), down.alias("b"), F.col("id").alias("c"))
    return cut(pool.select(idx.alias("idx"), "stype", "sid", "valid", "blocked"))


def _phased(spark: SparkSession, d: str, invalid: bool) -> DataFrame:
    picked = select.phased_select(_pool(spark, d), limit=60 if not invalid else 400, cap=2, floor_first=20, floor_second=10, invalid=invalid)
    return picked.select(F.col("idx.c").alias("item_id"), F.col("phase").cast("int").alias("phase"), "rank")


def phased_selection(spark: SparkSession, d: str) -> DataFrame:
    return _phased(spark, d, False)


def phased_with_invalid(spark: SparkSession, d: str) -> DataFrame:
    """The same with rows that fail the checks, which come in with the remainder."""
    return _phased(spark, d, True)


def pool_report(spark: SparkSession, d: str) -> DataFrame:
    """The pool by type and outcome, with different sources."""
    p = _pool(spark, d)
    ready = F.col("valid") & ~F.col("blocked")
    return p.groupBy("stype").agg(F.count("*").alias("n"), F.count_if(~F.col("valid")).alias("n_invalid"), F.count_if(F.col("valid") & F.col("blocked")).alias("n_blocked"), F.count_if(ready).alias("n_eligible"), F.count_distinct(F.when(ready, F.col("sid"))).alias("n_sources"))


def retry_next(spark: SparkSession, d: str) -> DataFrame:
    """Retry state after the first event of each user, brought forward by the second one."""
    e = table(spark, d, "events").withColumn("k", F.row_number().over(select.W.partitionBy("user_id").orderBy("ts", "event_id")))
    one = lambda k: e.where(F.col("k") == k).select(F.col("user_id").cast("string").alias("item_id"), F.lit("youtube").alias("source_type"), F.lit("s").alias("source_id"), F.when(F.col("event_type") == "error", "asr").when(F.col("event_type") == "click", "other").alias("reason"))
    empty = spark.createDataFrame([], state_schema())
    first = state.next_retries(empty, one(1), "2024-02-01T00:00:00Z", after=2, hours=24, reasons=["asr"])
    out = state.next_retries(first, one(2), "2024-02-02T00:00:00Z", after=2, hours=24, reasons=["asr"])
    return out.select("item_id", "attempts_total", "consecutive_failures", "last_outcome", "last_fail_reason", "last_attempt_at", "next_eligible_at")


def state_schema():
    from feedloom.plans.contracts import CONTRACTS

    return CONTRACTS["enrich_retry_state"].schema


def second_texts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", media.seconds_text("value").alias("seconds"), media.duration_failure(F.col("value") - 20, 60.0).alias("failure"))


def short_texts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").groupBy("kind").agg(*[F.count_if(media.text_failure("text", n).isNotNull()).alias(f"below_{n}") for n in (500, 800)])


def probe_objects(spark: SparkSession, d: str) -> DataFrame:
    """The last JSON object among the lines a tool printed."""
    lines = F.concat(F.lit('{"old": 1}\r\n'), F.col("raw_item_json"), F.lit("\n[1]\n{broken\n\n"))
    rows = table(spark, d, "items").select("item_id", media.last_object(lines).alias("j")).distinct()
    return rows.select("item_id", F.get_json_object("j", "$.external_id").alias("external_id"), F.get_json_object("j", "$.old").alias("old"))


def vtt_parse(spark: SparkSession, d: str) -> DataFrame:
    """Captions made of each user's events, read back as cues. Numbers, notes and empty cues are left out."""
    line = F.concat(F.col("event_id").cast("string"), F.lit("\n"), F.date_format("ts", "HH:mm:ss.SSS"), F.lit(" --> 99:00:00.000 align:start\n<c>"), F.col("event_type"), F.lit("</c>  and\r\nmore "), F.col("event_id").cast("string"), F.lit("\n\nNOTE x\n\n05:00.000 --> 06:00.000\n\n"))
    docs = table(spark, d, "events").groupBy("user_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ts", "event_id", line.alias("l")))), lambda x: x["l"]), "").alias("t"))
    cues = docs.select("user_id", F.posexplode(media.vtt_cues(F.concat(F.lit("﻿WEBVTT\n\n"), F.col("t")))).alias("n", "c"))
    return cues.select("user_id", "n", F.col("c.text").alias("text"), F.col("c.start").alias("start"))


def feed_parse(spark: SparkSession, d: str) -> DataFrame:
    """Feeds made of each customer's orders, RSS or Atom, read back as entries."""
    key = F.col("o_orderkey").cast("string")
    text = lambda tag, value: F.concat(F.lit(f"<{tag}>"), value, F.lit(f"</{tag}>"))
    rss = F.concat(F.lit("<item>"), text("title", F.concat(F.lit(" "), F.col("o_orderpriority"), F.lit(" \n x"))), text("link", F.concat(F.lit("https://r.example/"), key)), F.when(F.col("o_orderkey") % 2 == 0, text("guid", key)).otherwise(""), F.when(F.col("o_orderkey") % 3 > 0, text("pubDate", F.date_format("o_orderdate", "dd MMM yyyy HH:mm:ss '+0530'"))).otherwise(""), F.lit("</item>"))
    atom = F.concat(F.lit("<entry>"), text("title", F.col("o_orderpriority")), text("id", key), F.lit('<link rel="self" href="https://no.example/"/><link href="https://a.example/'), key, F.lit('"/>'), text("updated", F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")), F.lit("</entry>"))
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey", F.when(F.col("o_custkey") % 2 == 0, rss).otherwise(atom).alias("x"))
    docs = o.groupBy("o_custkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("o_orderkey", "x"))), lambda e: e["x"]), "").alias("x"))
    body = F.when(F.col("o_custkey") % 2 == 0, F.concat(F.lit("<rss><channel>"), F.col("x"), F.lit("</channel></rss>"))).otherwise(F.concat(F.lit('<?xml version="1.0"?>\n<feed xmlns="http://www.w3.org/2005/Atom"><author><name>Ann</name></author>'), F.col("x"), F.lit("</feed>")))
    src = docs.select(F.lit("newsletter").alias("source_type"), F.col("o_custkey").cast("string").alias("source_id"), F.lit("N").alias("source_name"), F.lit("2018-02-01T00:00:00Z").alias("fetched_at"), body.alias("body"))
    return feeds.entries(src).select("source_id", "feed_pos", "creator", "title", "url", "published_at", "external_id")


def ingest_report(spark: SparkSession, d: str) -> DataFrame:
    """Counters of each feed's records, and how many were seen before or are new (by the exact key)."""
    raw = table(spark, d, "raw_items").select("raw_id", "batch_id", "source_name", "url", "title", F.coalesce(records.py_strip("published_at"), F.lit("")).alias("pub"), F.sha2(F.concat(F.coalesce(records.py_strip("source_id"), F.lit("")), F.lit("|"), F.coalesce(records.py_strip("external_id"), F.lit(""))), 256).alias("dedup_key"))
    rows = raw.withColumn("reason", records.recency_reason(F.col("pub"), F.col("url"), F.col("title"), F.lit("2018-01-01T00:00:00Z")))
    new = state.insert_if_absent(rows.where("reason IS NULL").select("raw_id", "batch_id", "source_name", "dedup_key"), table(spark, d, "seen_items"), ["dedup_key"], [F.col("batch_id"), F.col("raw_id")])
    by = reports.counters(rows, "reason", ["too_old", "missing_url", "missing_title"], ["source_name"])
    emitted = new.groupBy(F.col("source_name").alias("__s")).agg(F.count("*").alias("emitted"))
    out = by.join(emitted, F.col("source_name").eqNullSafe(F.col("__s")), "left").na.fill(0, ["emitted"])
    return out.select("source_name", "n_rows", "too_old", "missing_url", "missing_title", (F.col("n_passed") - F.col("emitted")).alias("seen"), "emitted")


NAMES = """candidate_failures enriched_failures idea_failures extract_failures score_failures message_rows sheet_changes delivery_scan rating_bounds phased_selection
phased_with_invalid pool_report retry_next second_texts short_texts probe_objects vtt_parse feed_parse ingest_report""".split()


def _list(c: str, most: int | None = None) -> str:
    """SQL: the size of a JSON array of strings without its blank ones; NULL if it is no such array."""
    return f"CASE WHEN json_valid({c}) THEN CASE WHEN json_type({c}) = 'ARRAY' AND len(list_filter(from_json({c}, '[\"JSON\"]'), lambda x: json_type(x) <> 'VARCHAR')) = 0 THEN len(list_filter(from_json({c}, '[\"VARCHAR\"]'), lambda x: trim(x) <> '')) END END"


def _at(path: str, kind: str) -> str:
    return f"json_type(payload, '$.{path}') = '{kind}'"


def _strings(path: str) -> str:
    return f"({_at(path, 'ARRAY')} AND len(list_filter(CAST(json_extract(payload, '$.{path}[*]') AS JSON[]), lambda x: json_type(x) <> 'VARCHAR')) = 0)"


def _keys(*names: str) -> str:
    return "list_sort(json_keys(payload)) = [" + ", ".join(f"'{n}'" for n in sorted(names)) + "]"


def _payload_sql(source: str, rules: list[tuple[str, str]]) -> str:
    # JSON functions fail on text that is no JSON, so such text becomes null first.
    clean = f"SELECT * REPLACE (CASE WHEN json_valid(payload) THEN payload END AS payload) FROM ({source})"
    return f"SELECT doc_id, {_case([('json', 'payload IS NOT NULL'), *rules])} AS failure FROM ({clean})"


def oracle_sql() -> dict[str, str]:
    formats = "('shorts', 'tweet', 'linkedin', 'reel', 'thread', 'other')"
    word = lambda p: f"trim(json_extract_string(payload, '$.{p}'))"
    size = lambda p: f"json_array_length(payload, '$.{p}')"
    extract = [
        ("object", "json_type(payload) = 'OBJECT'"),
        ("keys", _keys(*checks.EXTRACT_TEXTS, *checks.EXTRACT_LISTS, "content_type")),
        *[(n, _at(n, "VARCHAR")) for n in checks.EXTRACT_TEXTS],
        ("workflow_steps", f"{_strings('workflow_steps')} AND {size('workflow_steps')} <= 8"),
        *[(n, _strings(n)) for n in checks.EXTRACT_LISTS[1:]],
        ("content_type", f"{word('content_type')} IN ('howto', 'case_study', 'tool_review', 'opinion', 'news', 'other')"),
    ]
    hook = "list_filter(CAST(json_extract_string(payload, '$.hooks[*]') AS VARCHAR[]), lambda h: length(trim(h)) NOT BETWEEN 1 AND 140)"
    score = [
        ("object", "json_type(payload) = 'OBJECT'"),
        ("keys", _keys("viral_rating", "rating_rationale", "hooks", "platform", "recommended_format")),
        ("viral_rating", f"json_type(payload, '$.viral_rating') IN ('UBIGINT', 'BIGINT') AND try_cast({word('viral_rating')} AS BIGINT) BETWEEN 1 AND 10"),
        ("rating_rationale", f"{word('rating_rationale')} <> ''"),
        ("hooks", f"{_strings('hooks')} AND {size('hooks')} = 3 AND len({hook}) = 0"),
        ("platform", f"{word('platform')} = hint"),
        ("recommended_format", f"{word('recommended_format')} IN {formats}"),
    ]
    idea = [
        *_texts("item_id", "platform", "recommended_format", "url", "title", "published_at"),
        ("published_at", _STAMP),
        ("platform", STRIP.format("platform") + " IN ('newsletter', 'youtube')"),
        ("recommended_format", f"trim(recommended_format) IN {formats}"),
        *[(n, f"{n} IS NOT NULL") for n in checks.EXTRACT_TEXTS],
        ("workflow_steps", f"({_list('workflow_steps')}) <= 8"),
        *[(n, f"({_list(n)}) IS NOT NULL") for n in checks.EXTRACT_LISTS[1:]],
        ("hooks", f"({_list('hooks')}) = 3"),
        ("viral_rating", "viral_rating BETWEEN 1 AND 10"),
    ]
    parts = "o_k % 11 <> 0 AND o_k % 13 <> 0 AND o_k % 17 <> 0"
    script = "'Hook: ' || pri || chr(10) || chr(10) || 'Setup: set' || chr(10) || chr(10) || 'Steps:' || chr(10) || '- a' || chr(10) || chr(10) || 'CTA: go'"
    scripted = f"SELECT *, CAST(item_id AS BIGINT) AS o_k, coalesce(nullif(trim(creator), ''), nullif(trim(source_name), ''), 'unknown') AS who, p AS pri FROM (SELECT s.*, o.o_orderpriority AS p FROM ({SCRIPTED}) s JOIN orders o ON CAST(o.o_orderkey AS VARCHAR) = s.item_id)"
    reason = f"CASE WHEN topic IS NULL THEN 'topic' WHEN trim(primary_hook) = '' THEN 'primary_hook' WHEN NOT ({parts}) THEN 'script_sections' END"
    message = f"CAST(viral_rating AS VARCHAR) || '/10 - ' || topic || chr(10) || 'Creator: ' || who || chr(10) || 'Hook: ' || trim(primary_hook) || chr(10) || 'Link: ' || trim(url) || chr(10) || 'Script:' || chr(10) || CASE WHEN length({script}) > 40 THEN substring({script}, 1, 40) || '...(truncated)' ELSE {script} END || chr(10) || 'Generated at 2024-01-02T00:00:00Z. Item: ' || item_id"
    old = "CASE WHEN o_k % 2 = 0 THEN {} ELSE {} END"
    status = old.format("st", "'New'")
    cells = f"item_id || '|' || who || '|' || trim(url) || '|' || topic || '|' || CAST(viral_rating AS VARCHAR) || '|' || CASE WHEN trim(primary_hook) <> '' THEN trim(primary_hook) ELSE trim(pri) END || '|newsletter|' || {script} || '|' || {status} || '|x, y|' || {old.format(chr(39) + 'm' + chr(39), chr(39) * 2)}"
    ev = "SELECT *, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS INT) AS k FROM events"
    steps = "CASE event_type WHEN 'error' THEN 'asr' WHEN 'click' THEN 'other' END"
    return {
        "candidate_failures": f"SELECT created_at, {_case([*_texts('item_id', 'source_type', 'source_id', 'url', 'title', 'published_at'), ('source_type', _TYPE), ('published_at', _STAMP), ('relevance_score', 'relevance_score >= 0')])} AS failure, count(*) AS n FROM candidates GROUP BY 1, 2",
        "enriched_failures": f"SELECT item_id, {_case([*_texts('item_id', 'source_type', 'url', 'title', 'published_at', 'enriched_text', 'enrichment_method'), ('source_type', _TYPE), ('published_at', _STAMP)])} AS failure FROM enriched_items",
        "idea_failures": f"SELECT created_at, failure, count(*) AS n, min(item_id) AS first_item FROM (SELECT item_id, created_at, {_case(idea)} AS failure FROM ({IDEAS})) GROUP BY 1, 2",
        "extract_failures": _payload_sql(EXTRACTS, extract),
        "score_failures": _payload_sql(SCORES, score),
        "message_rows": f"SELECT item_id, reason, CASE WHEN reason IS NULL THEN md5({message}) END AS message_md5 FROM (SELECT *, {reason} AS reason FROM ({scripted}))",
        "sheet_changes": f"SELECT item_id, {old.format(chr(39) + 'update' + chr(39), chr(39) + 'insert' + chr(39))} AS action, {old.format('o_k', 'NULL')} AS row_number, {cells} AS cells FROM (SELECT x.*, o.o_orderstatus AS st FROM ({scripted}) x JOIN orders o ON o.o_orderkey = x.o_k) WHERE o_k % 3 = 0 AND topic IS NOT NULL AND {parts} AND NOT (o_k % 23 = 0 AND o_k % 7 = 0)",
        "delivery_scan": "WITH r AS (SELECT CAST(o_orderkey AS VARCHAR) AS item_id, 1 + o_orderkey % 10 AS viral_rating, o_orderdate, o_orderstatus = 'F' AND o_orderkey % 3 = 0 AS sent, o_orderkey NOT IN (SELECT l_orderkey FROM lineitem) AS missing FROM orders WHERE 1 + o_orderkey % 10 >= 5), w AS (SELECT *, NOT sent AND NOT missing AS selected, coalesce(sum(CASE WHEN NOT sent AND NOT missing THEN 1 ELSE 0 END) OVER (ORDER BY viral_rating DESC, o_orderdate DESC, item_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM r) SELECT item_id, viral_rating, selected, missing, sent FROM w WHERE before < 300",
        "rating_bounds": "SELECT count(*) AS n_all, count(*) FILTER (r >= 5) AS n_from_5, count(*) FILTER (r >= 11) AS n_from_11 FROM (SELECT CASE WHEN o_orderkey % 9 <> 0 THEN 1 + o_orderkey % 10 END AS r FROM orders)",
        "phased_selection": _phased_sql(60, False),
        "phased_with_invalid": _phased_sql(400, True),
        "pool_report": f"WITH {_POOL} SELECT stype, count(*) AS n, count(*) FILTER (NOT valid) AS n_invalid, count(*) FILTER (valid AND blocked) AS n_blocked, count(*) FILTER (valid AND NOT blocked) AS n_eligible, count(DISTINCT CASE WHEN valid AND NOT blocked THEN sid END) AS n_sources FROM pool GROUP BY 1",
        "retry_next": f"WITH e AS ({ev}), s AS (SELECT a.user_id, a.r AS r1, b.user_id IS NOT NULL AS two, b.r AS r2 FROM (SELECT *, {steps} AS r FROM e WHERE k = 1) a LEFT JOIN (SELECT *, {steps} AS r FROM e WHERE k = 2) b USING (user_id)), l AS (SELECT *, CASE WHEN two THEN r2 ELSE r1 END AS r, CASE WHEN two THEN CASE WHEN r2 IS NULL THEN 0 WHEN r1 IS NULL THEN 1 ELSE 2 END ELSE CASE WHEN r1 IS NULL THEN 0 ELSE 1 END END AS c FROM s) SELECT CAST(user_id AS VARCHAR) AS item_id, CAST(CASE WHEN two THEN 2 ELSE 1 END AS BIGINT) AS attempts_total, CAST(c AS BIGINT) AS consecutive_failures, CASE WHEN r IS NULL THEN 'success' ELSE 'failed' END AS last_outcome, r AS last_fail_reason, CASE WHEN two THEN '2024-02-02T00:00:00Z' ELSE '2024-02-01T00:00:00Z' END AS last_attempt_at, CASE WHEN r = 'asr' AND c >= 2 THEN '2024-02-03T00:00:00Z' END AS next_eligible_at FROM l",
        "second_texts": "SELECT event_id, printf('%.3f', value) AS seconds, CASE WHEN value IS NULL THEN 'missing' WHEN value - 20 <= 0 THEN 'not_positive' WHEN value - 20 > 60 THEN 'too_long' END AS failure FROM events",
        "short_texts": "SELECT kind, count(*) FILTER (length(coalesce(text, '')) < 500) AS below_500, count(*) FILTER (length(coalesce(text, '')) < 800) AS below_800 FROM documents GROUP BY 1",
        "probe_objects": "SELECT DISTINCT item_id, json_extract_string(raw_item_json, '$.external_id') AS external_id, json_extract_string(raw_item_json, '$.old') AS old FROM items",
        "vtt_parse": f"SELECT user_id, k - 1 AS n, event_type || ' and more ' || CAST(event_id AS VARCHAR) AS text, epoch_us(ts) // 1000 % 86400000 / 1000.0::DOUBLE AS start FROM ({ev})",
        "feed_parse": "SELECT CAST(o_custkey AS VARCHAR) AS source_id, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS INT) AS feed_pos, CASE WHEN o_custkey % 2 = 0 THEN 'N' ELSE 'Ann' END AS creator, CASE WHEN o_custkey % 2 = 0 THEN o_orderpriority || ' x' ELSE o_orderpriority END AS title, CASE WHEN o_custkey % 2 = 0 THEN 'https://r.example/' ELSE 'https://a.example/' END || CAST(o_orderkey AS VARCHAR) AS url, CASE WHEN o_custkey % 2 = 1 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') WHEN o_orderkey % 3 > 0 THEN strftime(o_orderdate - INTERVAL 330 MINUTE, '%Y-%m-%dT%H:%M:%SZ') ELSE '2018-02-01T00:00:00Z' END AS published_at, CASE WHEN o_custkey % 2 = 1 OR o_orderkey % 2 = 0 THEN CAST(o_orderkey AS VARCHAR) ELSE sha256('https://r.example/' || CAST(o_orderkey AS VARCHAR)) END AS external_id FROM orders",
        "ingest_report": f"WITH r AS (SELECT *, CASE WHEN coalesce({STRIP.format('published_at')}, '') < '2018-01-01T00:00:00Z' THEN 'too_old' WHEN NOT {_TEXT.format('url')} THEN 'missing_url' WHEN NOT {_TEXT.format('title')} THEN 'missing_title' END AS reason, sha256(coalesce({STRIP.format('source_id')}, '') || '|' || coalesce({STRIP.format('external_id')}, '')) AS dedup_key FROM raw_items), n AS (SELECT source_name FROM (SELECT *, row_number() OVER (PARTITION BY dedup_key ORDER BY batch_id, raw_id) AS k FROM r ANTI JOIN seen_items USING (dedup_key) WHERE reason IS NULL) WHERE k = 1), e AS (SELECT source_name, count(*) AS emitted FROM n GROUP BY 1), b AS (SELECT source_name, count(*) AS n_rows, count(*) FILTER (reason = 'too_old') AS too_old, count(*) FILTER (reason = 'missing_url') AS missing_url, count(*) FILTER (reason = 'missing_title') AS missing_title, count(*) FILTER (reason IS NULL) AS p FROM r GROUP BY 1) SELECT b.source_name, n_rows, too_old, missing_url, missing_title, p - coalesce(emitted, 0) AS seen, coalesce(emitted, 0) AS emitted FROM b LEFT JOIN e ON b.source_name IS NOT DISTINCT FROM e.source_name",
    }


_POOL = rf"""c AS (SELECT item_id, coalesce(lower({STRIP.format('source_type')}), '') AS stype, coalesce(lower({STRIP.format('source_id')}), '') AS sid, coalesce(relevance_score, -9) AS score, coalesce(published_at, '') AS pub,
coalesce({' AND '.join(_TEXT.format(c) for c in ('item_id', 'source_id', 'url', 'title'))} AND {_TYPE} AND {_STAMP} AND relevance_score >= 0, false) AS valid FROM candidates WHERE item_id IS NOT NULL),
ev AS (SELECT *, sum(CASE WHEN event_type <> 'error' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS island FROM events),
until_ AS (SELECT user_id, max(ts) + INTERVAL 240 HOUR AS t, arg_max(event_type, (ts, event_id)) AS le FROM ev GROUP BY 1),
best AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, valid DESC, pub, stype, sid) AS k FROM c),
pool AS (SELECT b.*, coalesce(u.le = 'error' AND date_trunc('second', u.t) > TIMESTAMP '2024-01-30 12:00:00', false) AS blocked, regexp_replace(pub, '\D', '', 'g') AS digits FROM best b LEFT JOIN until_ u ON u.user_id = CAST('0x' || substring(item_id, 1, 4) AS INT) % 150 WHERE k = 1)"""


def _phased_sql(limit: int, invalid: bool) -> str:
    extra = " UNION ALL SELECT idx, item_id, stype, sid FROM n WHERE NOT valid" if invalid else ""
    return f"""WITH {_POOL}, n AS (SELECT *, row_number() OVER (ORDER BY score DESC, digits DESC, item_id) AS idx FROM pool),
r AS (SELECT *, row_number() OVER (PARTITION BY stype, sid ORDER BY idx) AS rk FROM n WHERE valid AND NOT blocked),
f0 AS (SELECT *, row_number() OVER (PARTITION BY stype ORDER BY idx) AS fr FROM r WHERE rk <= 2),
floor_ AS (SELECT idx, item_id, stype, sid, CASE WHEN stype = 'newsletter' THEN 1 ELSE 2 END AS phase FROM f0 WHERE (stype = 'newsletter' AND fr <= 20) OR (stype = 'youtube' AND fr <= 10)),
dv AS (SELECT idx, item_id, stype, sid, 3 AS phase FROM (SELECT *, row_number() OVER (ORDER BY idx) AS n FROM r ANTI JOIN floor_ USING (stype, sid) WHERE rk = 1) WHERE n <= {limit} - (SELECT count(*) FROM floor_)),
s1 AS (SELECT * FROM floor_ UNION ALL SELECT * FROM dv),
cnt AS (SELECT stype, sid, count(*) AS c FROM s1 GROUP BY ALL),
rm AS (SELECT r.*, row_number() OVER (PARTITION BY r.stype, r.sid ORDER BY r.idx) AS r2 FROM r ANTI JOIN s1 USING (idx)),
open_ AS (SELECT rm.idx, rm.item_id, rm.stype, rm.sid FROM rm LEFT JOIN cnt USING (stype, sid) WHERE r2 <= 2 - coalesce(c, 0){extra}),
rest AS (SELECT *, 4 AS phase, row_number() OVER (ORDER BY idx) AS n FROM open_),
al AS (SELECT idx, item_id, phase FROM s1 UNION ALL SELECT idx, item_id, phase FROM rest WHERE n <= {limit} - (SELECT count(*) FROM s1))
SELECT item_id, phase, rank FROM (SELECT *, row_number() OVER (ORDER BY phase, idx) AS rank FROM al) WHERE rank <= {limit}"""
