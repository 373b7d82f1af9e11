import json
import re

import pytest
from pyspark.sql import functions as F

from feedloom import cli
from feedloom.operators import sheets
from feedloom.plans import contracts, reports, stages
from feedloom.sources import adapters, fetching
from feedloom.sources.catalog import catalog

TS = "2024-03-01T00:00:00Z"
PROSE = "<p>" + "This is a sentence of an article about looms and how they are fed. " * 12 + "</p>"
FEED = "<rss><channel>{}</channel></rss>"
ENTRY = "<item><title>{t}</title><link>{u}</link><guid>{g}</guid><pubDate>{d}</pubDate></item>"


class Answer:
    status, headers = 200, {}

    def __init__(self, body):
        self.body = body

    def chunks(self):
        return [self.body.encode()]


def opener(pages):
    def open_(url, policy):
        if url not in pages:
            raise fetching.FetchError(f"none: {url}")
        return Answer(pages[url])

    return open_


def put(spark, root, name, rows):
    """Rows as mappings, other columns of the contract filled with text or 1."""
    c = contracts.CONTRACTS[name]
    full = [tuple(r.get(f.name, 1 if f.name in c.whole else None if f.name in c.nullable else "x") for f in c.schema) for r in rows]
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in c.schema)
    spark.createDataFrame(full, fields).write.mode("append").parquet(f"{root}/{name}")


def read(spark, root, name):
    return spark.read.parquet(f"{root}/{name}")


def test_ingest_counts_every_entry_once(spark, tmp_path):
    when = "Tue, 20 Feb 2024 10:0{}:00 +0000"
    entries = [ENTRY.format(t=f"T{i}", u=f"https://a.example/{i}", g=f"g{i}", d=when.format(i)) for i in range(5)]
    entries += [ENTRY.format(t="old", u="https://a.example/o", g="o", d="Tue, 20 Feb 2018 10:00:00 +0000"), ENTRY.format(t="", u="https://a.example/t", g="t", d=when.format(1)), ENTRY.format(t="n", u="", g="n", d=when.format(1))]
    cat = catalog(spark, {"newsletters": [{"id": "a", "name": "A", "feed_url": "https://a.example/f"}, {"id": "b", "name": "B", "feed_url": "https://b.example/f"}]})
    args = (spark, str(tmp_path), cat, opener({"https://a.example/f": FEED.format("".join(entries))}), TS)
    one = stages.ingest(*args, recency_days=30, per_source=3)
    assert {k: one.report[k] for k in ("sources", "failed", "parsed", "too_old", "missing_url", "missing_title", "seen", "emitted")} == {"sources": 2, "failed": 1, "parsed": 8, "too_old": 1, "missing_url": 1, "missing_title": 1, "seen": 0, "emitted": 3}
    assert sorted(r.external_id for r in one.rows.collect()) == ["g2", "g3", "g4"]
    two = stages.ingest(*args, recency_days=None, per_source=4)
    assert (two.report["too_old"], two.report["seen"], two.report["emitted"]) == (0, 3, 1)


CHOSEN = {"limit": 10, "cap": 5, "floor_first": 1, "floor_second": 1}
COOL = {"after": 1, "hours": 24, "reasons": ["newsletter_fetch_failed"]}


def candidates(spark, root):
    base = {"title": "T", "published_at": "2024-02-01T00:00:00Z", "relevance_score": 5}
    put(
        spark,
        root,
        "candidates",
        [
            base | {"item_id": "n1", "source_type": "Newsletter ", "source_id": "A", "url": "https://a.example/1"},
            base | {"item_id": "n2", "source_type": "newsletter", "source_id": "a", "url": "https://a.example/gone"},
            base | {"item_id": "n3", "source_type": "newsletter", "source_id": "a", "url": "https://a.example/short"},
            base | {"item_id": "n4", "source_type": "newsletter", "source_id": "a", "url": "https://a.example/none"},
            base | {"item_id": "y1", "source_type": "youtube", "source_id": "v", "url": "https://youtu.be/abcdefghijk"},
            base | {"item_id": "y2", "source_type": "youtube", "source_id": "v", "url": "https://youtu.be/nope"},
            base | {"item_id": "y3", "source_type": "youtube", "source_id": "v", "url": "https://youtu.be/kkkkkkkkkkk"},
            base | {"item_id": "bad", "source_type": "podcast", "source_id": "p", "url": "u"},
        ],
    )
    return opener({"https://a.example/1": PROSE, "https://a.example/short": PROSE[:150], "https://a.example/none": "<p>x</p>"})


def speech():
    def hear(url):
        if url.endswith("k" * 11):
            raise RuntimeError("no sound")
        return "spoken words " * 70

    return hear


def test_enrich_sorts_failures_and_cools_down(spark, tmp_path):
    root = str(tmp_path)
    open_ = candidates(spark, root)
    one = stages.enrich(spark, root, TS, open_, speech, chosen=CHOSEN, cooldown=COOL)
    r = one.report
    assert (r["available"], r["selected"], r["invalid_pool"], r["n_passed"], r["failed"], r["inserted"]) == (8, 8, 1, 2, 6, 2)
    assert {k: r[k] for k in stages.ENRICH_FAILURES if r[k]} == {k: 1 for k in ("invalid_candidate_row", "newsletter_fetch_failed", "newsletter_extract_failed", "newsletter_text_too_short", "youtube_video_id_parse_failed", "youtube_asr_failed")}
    assert (r["selected_sources"], r["newsletter_floor_met"], r["phase_1"], r["phase_2"]) == (2, True, 1, 1)
    rows = {x.item_id: x for x in read(spark, root, "enriched_items").collect()}
    assert rows.keys() == {"n1", "y1"} and len(json.loads(rows["n1"].evidence_snippets)) == 2 and len(json.loads(rows["y1"].evidence_snippets)) == 3
    assert json.loads(rows["n1"].evidence_snippets)[1]["meta"] == {"type": "article", "offset": 240, "timestamp": None}
    state = {x.item_id: x for x in read(spark, root, "enrich_retry_state").collect()}
    assert "bad" not in state and state["n2"].next_eligible_at == "2024-03-02T00:00:00Z" and state["y3"].next_eligible_at is None and state["n1"].last_outcome == "success"
    two = stages.enrich(spark, root, "2024-03-01T12:00:00Z", open_, speech, chosen=CHOSEN, cooldown=COOL)
    assert (two.report["available"], two.report["blocked"], two.report["inserted"]) == (6, 1, 0)
    state = {x.item_id: x for x in read(spark, root, "enrich_retry_state").collect()}
    assert (state["n2"].attempts_total, state["n3"].attempts_total, state["n3"].consecutive_failures) == (1, 2, 2)


def test_enrich_may_demand_full_success(spark, tmp_path):
    open_ = candidates(spark, str(tmp_path))
    with pytest.raises(stages.FullSuccessError):
        stages.enrich(spark, str(tmp_path), TS, open_, speech, chosen=CHOSEN, cooldown=COOL, full_success=True)
    assert {r.item_id for r in read(spark, str(tmp_path), "enriched_items").collect()} == {"n1", "y1"}


EXTRACT = {"topic": " t ", "core_claim": "c", "workflow_steps": ["a"], "tools_mentioned": [" x ", ""], "monetization_angle": "", "metrics_claims": [], "assumptions": [], "content_type": "news"}
SCORE = {"viral_rating": 7, "rating_rationale": "r", "hooks": [" a", "b", "c"], "platform": "newsletter", "recommended_format": "reel"}
SCRIPT = {
    "primary_hook": "h",
    "alt_hooks": [" a", "b"],
    "script": {"sections": [{"label": "hook", "text": "word " * 100}, {"label": "setup", "text": "more " * 30}, {"label": "steps", "text": "- a\n- b\n- c"}, {"label": "cta", "text": "go"}], "word_count": 999, "estimated_seconds": 60},
    "cta": "go",
    "disclaimer": "",
}


def ideas_client():
    def call(prompt, label):
        item = re.search(r"T_(\w+)", prompt).group(1)
        if item == label + "fails":
            raise adapters.ServiceError("down")
        if item == label + "nojson":
            return "{"
        if item == label + "wrong":
            return "{}"
        return json.dumps(EXTRACT if label == "extract" else SCORE)

    return call


def test_intelligence_counts_each_failure_once(spark, tmp_path):
    root, base = str(tmp_path), {"source_type": "newsletter", "published_at": "2024-02-01T00:00:00Z", "evidence_snippets": "nope"}
    kinds = [a + b for a in ("extract", "score") for b in ("fails", "nojson", "wrong")]
    put(spark, root, "enriched_items", [base | {"item_id": k, "title": f"T_{k}"} for k in ("good", *kinds)] + [base | {"item_id": "bad", "title": " "}])
    templates = ("{{TITLE}} {{SOURCE_TYPE}} {{URL}} {{CONTENT}}", " ".join("{{%s}}" % k for k in ("PLATFORM_HINT TITLE TOPIC CORE_CLAIM WORKFLOW_STEPS TOOLS_MENTIONED MONETIZATION_ANGLE METRICS_CLAIMS ASSUMPTIONS CONTENT_TYPE EVIDENCE_SNIPPETS".split())))
    out = stages.intelligence(spark, root, TS, ideas_client, templates, limit=20, most_chars=5, provider="p", model="m")
    r = out.report
    assert (r["available"], r["n_passed"], r["failed"], r["inserted"], r["already_there"]) == (8, 1, 7, 1, 0)
    assert r["extract_validation_failed"] == 2 and all(r[k] == 1 for k in ("extract_llm_failed", "extract_invalid_json", "score_llm_failed", "score_invalid_json", "score_validation_failed"))
    idea = read(spark, root, "ideas").first()
    assert (idea.item_id, idea.topic, json.loads(idea.tools_mentioned), json.loads(idea.hooks), idea.viral_rating, idea.llm_model) == ("good", "t", [" x ", ""], ["a", "b", "c"], 7, "m")
    assert contracts.missing_columns(read(spark, root, "ideas"), contracts.CONTRACTS["ideas"]) == []


IDEA = {"platform": "youtube", "recommended_format": "reel", "published_at": "2024-02-01T00:00:00Z", "workflow_steps": "[]", "tools_mentioned": '["x ", ""]', "metrics_claims": "[]", "assumptions": "[]", "hooks": '["a", "b", "c"]', "viral_rating": 5}


def test_generate_writes_checked_scripts(spark, tmp_path):
    root = str(tmp_path)
    put(spark, root, "ideas", [IDEA | {"item_id": k, "title": f"T_{k}"} for k in ("good", "fails", "nojson", "wrong")] + [IDEA | {"item_id": "bad", "hooks": '["a"]'}])

    def client():
        def call(prompt, label):
            item = re.search(r"T_(\w+)", prompt).group(1)
            if item == "fails":
                raise RuntimeError
            return {"nojson": "?", "wrong": json.dumps(SCRIPT | {"cta": "stop"})}.get(item, json.dumps(SCRIPT))

        return call

    names = "PLATFORM RECOMMENDED_FORMAT TITLE URL TOPIC CORE_CLAIM WORKFLOW_STEPS TOOLS_MENTIONED MONETIZATION_ANGLE METRICS_CLAIMS ASSUMPTIONS PRIOR_HOOKS".split()
    template = " ".join("{{%s}}" % n for n in names)
    r = stages.generate(spark, root, TS, client, template, limit=9).report
    assert (r["n_passed"], r["failed"], r["script_llm_failed"], r["script_invalid_json"], r["script_validation_failed"]) == (1, 4, 1, 1, 2)
    s = read(spark, root, "scripts").first()
    assert (s.item_id, s.word_count, s.estimated_seconds, json.loads(s.alt_hooks)) == ("good", 134, 60, ["a", "b"]) and [x["label"] for x in json.loads(s.script_sections)] == ["hook", "setup", "steps", "cta"]
    with pytest.raises(ValueError):
        stages.generate(spark, root, TS, client, template + "{{MORE}}", limit=9)


SECTIONS = json.dumps([{"label": k, "text": f"{k} text"} for k in ("hook", "setup", "steps", "cta")])


def scripted(spark, root):
    put(spark, root, "ideas", [IDEA | {"item_id": f"i{k}", "viral_rating": 9 - k, "url": f"u{k}", "topic": "t"} for k in range(5)])
    put(spark, root, "scripts", [{"item_id": f"i{k}", "primary_hook": " ", "script_sections": SECTIONS if k != 2 else "[]"} for k in (0, 2, 3, 4)])
    put(spark, root, "items", [{"item_id": "i0", "creator": " ", "source_name": "N"}])


class Sheet:
    def __init__(self, rows):
        self.rows = rows

    def fetch_all(self):
        return self.rows

    def append_row(self, values):
        self.rows.append(values)

    def update_row(self, row_number, values):
        self.rows[row_number - 1] = values


HEAD = ["item_id", "creator", "post_link", "topic", "viral_rating", "hook", "platform", "draft_script", "status", "notes", "mine"]


def test_persist_updates_in_place_and_appends(spark, tmp_path):
    root = str(tmp_path)
    scripted(spark, root)
    sheet = Sheet([["title row"], HEAD, ["", "no key"], ["i3", None, "old"] + [""] * 5 + ["Done", "hm", "keep"]])
    r = stages.persist(spark, root, TS, sheet, limit=4, header_row=2).report
    assert (r["available"], r["considered"], r["inserted"], r["updated"], r["missing_script"], r["invalid_payload"], r["first_error"]) == (5, 4, 1, 1, 1, 1, "script_sections")
    new = dict(zip(HEAD, sheet.rows[-1], strict=True))
    assert (new["item_id"], new["creator"], new["hook"], new["status"], new["notes"], new["viral_rating"]) == ("i0", "N", "a", "New", "", "9")
    assert new["draft_script"] == "Hook: hook text\n\nSetup: setup text\n\nSteps:\nsteps text\n\nCTA: cta text"
    old = dict(zip(HEAD, sheet.rows[3], strict=True))
    assert (old["post_link"], old["status"], old["notes"], old["mine"], old["creator"]) == ("u3", "Done", "hm", "keep", "unknown")
    assert stages.persist(spark, root, TS, None, limit=4, enabled=False).report["considered"] == 0
    with pytest.raises(sheets.SheetError, match="twice"):
        stages.persist(spark, root, TS, Sheet([HEAD, ["k"], ["k "]]), limit=4)
    for bad in ([], HEAD[1:], [*HEAD, "mine"], [*HEAD, "", " "]):
        with pytest.raises(sheets.SheetError):
            sheets.layout(bad)


def test_deliver_stops_at_the_limit_and_records_what_was_sent(spark, tmp_path):
    root = str(tmp_path)
    scripted(spark, root)
    spark.createDataFrame([(f"i{k}", "hook" if k else "h", SECTIONS) for k in range(5)], "item_id string, primary_hook string, script_sections string")
    posted = []

    class Ok:
        status_code, text = 200, ""

    def post(url, json, timeout):
        posted.append(json["text"])
        return Ok()

    dry = stages.deliver(spark, root, TS, "hook", post, limit=2, most_chars=10, dry_run=True).report
    # Blank hooks are errors of selected rows; i1 has no script and takes no place.
    assert (dry["available"], dry["selected"], dry["missing_script"], dry["sent"], dry["errors"], dry["first_error"]) == (5, 2, 1, 0, 2, "primary_hook") and not posted
    put(spark, root, "ideas", [IDEA | {"item_id": "z1", "viral_rating": 10, "url": "u", "topic": "t"}, IDEA | {"item_id": "z2", "viral_rating": 10, "url": "u", "topic": "t"}])
    put(spark, root, "scripts", [{"item_id": k, "primary_hook": "hook", "script_sections": SECTIONS} for k in ("z1", "z2")])
    one = stages.deliver(spark, root, TS, "hook", post, limit=1, most_chars=10, min_rating=9).report
    assert (one["available"], one["selected"], one["sent"], one["missing_script"]) == (3, 1, 1, 0)
    assert posted[0].split("\n")[:4] == ["10/10 - t", "Creator: unknown", "Hook: hook", "Link: u"] and "...(truncated)" in posted[0] and posted[0].endswith(f"Generated at {TS}. Item: z1")
    two = stages.deliver(spark, root, TS, "hook", post, limit=1, most_chars=10).report
    assert (two["already_sent"], two["sent"], len(posted)) == (1, 1, 2)
    assert stages.deliver(spark, root, TS, "hook", post, limit=1, most_chars=1, enabled=False).report["available"] == 0
    done = read(spark, root, "deliveries")
    with pytest.raises(contracts.ContractError):
        contracts.insert_strictly(done.limit(1), done, contracts.CONTRACTS["deliveries"])
    assert contracts.check(done, contracts.CONTRACTS["deliveries"]).count() == 2
    with pytest.raises(contracts.ContractError):
        contracts.check(done.unionByName(done), contracts.CONTRACTS["deliveries"])


def test_command_line_runs_stages(spark, tmp_path):
    good = {"source_id": "s", "external_id": "1", "url": "u", "title": "about looms", "published_at": "2020-01-01", "fetched_at": "2020-01-01T00:00:00Z", "summary": "loom " * 40}
    (tmp_path / "raw_items.jsonl").write_text("\n".join([json.dumps(good), "{", "", json.dumps(good)]) + "\n")
    (tmp_path / "terms.json").write_text(json.dumps({"a": {"weight": 2, "terms": ["loom*"]}}))
    args = ["run", "--root", str(tmp_path), "--terms", str(tmp_path / "terms.json"), "--run-ts", TS, "--report", str(tmp_path / "r.json")]
    assert cli.main(args, spark) == 0
    report = json.loads((tmp_path / "r.json").read_text())
    assert report["metrics"]["canonical_items_inserted"] == 1 and report["metrics"]["candidates_inserted"] == 1 and report["failed_rows"]["normalize"] == 1
    assert "| filter | completed |" in (tmp_path / "r.md").read_text()
    assert cli.main([*args, "--stop-after", "1"], spark) == 0 and cli.main([*args, "--stop-after", "3"], spark) == 2 and cli.main([*args, "--limit", "-1"], spark) == 2
    assert read(spark, str(tmp_path), "items").count() == 1
    assert reports.non_fatal({})["total"] == 0
    assert read(spark, str(tmp_path), "candidates").select(F.max("relevance_score")).first()[0] == 2
