import random

import pytest
from pyspark.sql import functions as F

from feedloom.operators import records, select, state
from feedloom.plans import contracts, pipeline
from feedloom.plans.reports import broken, counters
from feedloom.streaming.ingest import ingest_available


def greedy_phases(rows, limit, cap, nt, yt):
    nt = min(nt, limit)
    yt = min(yt, limit - nt)
    ok = [r for r in rows if r[3] and not r[4]]
    count, out, used = {}, [], set()

    def take(r, phase):
        out.append((r[0], phase))
        used.add(r[0])
        count[r[1:3]] = count.get(r[1:3], 0) + 1

    for t, n, p in (("newsletter", nt, 1), ("youtube", yt, 2)):
        k = 0
        for r in ok:
            if k < n and r[1] == t and count.get(r[1:3], 0) < cap:
                take(r, p)
                k += 1
    for r in ok:
        if len(out) < limit and r[1:3] not in count:
            take(r, 3)
    for r in ok:
        if len(out) < limit and r[0] not in used and count.get(r[1:3], 0) < cap:
            take(r, 4)
    return sorted(out, key=lambda x: (x[1], x[0]))


@pytest.mark.parametrize("seed", range(3))
def test_phases_equal_greedy(spark, seed):
    rng = random.Random(seed)
    rows = [(i, rng.choice(["newsletter", "youtube"]), rng.choice("abcde"), rng.random() < 0.9, rng.random() < 0.2) for i in range(60)]
    df = spark.createDataFrame(rows, "idx long, stype string, sid string, valid boolean, blocked boolean")
    limit, cap = rng.choice([5, 12, 30]), rng.choice([1, 2, 4])
    got = select.phased_select(df, limit=limit, cap=cap, floor_first=4, floor_second=3).orderBy("rank").collect()
    assert [(r.idx, r.phase) for r in got] == greedy_phases(rows, limit, cap, 4, 3)


@pytest.mark.parametrize(("quota", "limit"), [(0, 5), (3, 5), (9, 5), (50, 50), (2, 0)])
def test_quota_equals_greedy(spark, quota, limit):
    rows = [(i, i % 3 == 0) for i in range(30)]
    df = spark.createDataFrame(rows, "i int, nl boolean")
    got = [r.i for r in select.quota_select(df, F.col("nl"), [F.col("i")], quota, limit).orderBy("rank").collect()]
    first = [i for i, n in rows if n][: min(quota, limit)]
    assert got == first + [i for i, _ in rows if i not in first][: limit - len(first)]


def test_retry_fold_equals_loop(spark):
    rng = random.Random(4)
    events = [(rng.randrange(6), i, rng.random() < 0.5) for i in range(80)]
    df = spark.createDataFrame(events, "k int, at int, bad boolean").withColumn("ts", F.timestamp_seconds("at"))
    got = {r.k: r for r in state.fold_retries(df, "k", "ts", F.col("bad"), F.when(F.col("bad"), "x"), after=2, hours=1).collect()}
    want = {}
    for k, _, bad in events:
        n, c = want.get(k, (0, 0))
        want[k] = (n + 1, c + 1 if bad else 0)
    assert {k: (r.attempts_total, r.consecutive_failures) for k, r in got.items()} == want
    assert all((r.next_eligible_at is not None) == (r.consecutive_failures >= 2) for r in got.values())


def test_insert_if_absent_and_upsert(spark):
    s = spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int")
    new = spark.createDataFrame([("b", 2), ("c", 4), ("c", 3)], "k string, v int")
    assert [tuple(r) for r in state.insert_if_absent(new, s, ["k"], [F.col("v")]).collect()] == [("c", 3)]
    up = state.upsert(s, spark.createDataFrame([("b", 9)], "k string, v int"), ["k"])
    assert sorted(map(tuple, up.collect())) == [("a", 1), ("b", 9)]


@pytest.mark.parametrize("limit", [0, 1, 4, 100])
def test_capped_scan_equals_loop(spark, limit):
    rng = random.Random(limit)
    rows = [(rng.randrange(4), rng.choice("xyz"), i, rng.choice([True, False, None])) for i in range(60)]
    df = spark.createDataFrame(rows, "a int, b string, i int, ok boolean")
    got = select.capped_scan(df, F.col("ok"), [("a", True), ("b", False), ("i", True)], limit).collect()
    want, n = [], 0
    for r in sorted(rows, key=lambda r: (-r[0], r[1], -r[2])):
        if n >= limit:
            break
        want.append((r[2], bool(r[3])))
        n += bool(r[3])
    # Rows after the last one that counts take nothing: those before it are all visited.
    assert sorted((r.i, r.selected) for r in got) == sorted(want)


def test_first_of_few_equals_first_per_key(spark):
    rows = [("a", 2, "x"), ("a", 1, "y"), ("b", 1, "z"), (None, 3, "n"), (None, 2, "m")]
    df = spark.createDataFrame(rows, "k string, at int, v string")
    got = state.first_of_few(df, ["k"], [F.col("at")])
    assert sorted(r.v for r in got.collect()) == ["m", "y", "z"] == sorted(r.v for r in state.first_per_key(df, ["k"], [F.col("at")]).collect())
    assert state.first_of_few(df.limit(0), ["k"], [F.col("at")]).count() == 0


def test_cooldown_blocks_until_its_time(spark):
    rows = spark.createDataFrame([(x,) for x in ("past", "now", "later", "odd", "none", "new")], "item_id string")
    until = [("past", "2024-01-01T00:00:00Z"), ("now", "2024-01-02T00:00:00Z"), ("later", " 2024-01-02T00:00:01Z "), ("odd", "tomorrow"), ("none", None)]
    got = state.cooled_down(rows, spark.createDataFrame(until, "item_id string, next_eligible_at string"), "2024-01-02T00:00:00Z")
    assert {r.item_id for r in got.where("blocked").collect()} == {"later"} and got.count() == 6


def test_json_reasons_are_exclusive_and_ordered(spark):
    good = '{"external_id": "1", "url": "u", "title": "t", "published_at": "2020-01-01", "fetched_at": "2020-01-01T00:00:00Z"}'
    lines = [good, "{bad", "[]", good.replace('"t"', "42"), good.replace('"u"', '" "'), good.replace("2020-01-01\"", "x\"", 1), good.replace('"t"', "null"), "  "]
    got = records.json_items(spark.createDataFrame([(x,) for x in lines], "value string")).select("reason").collect()
    assert [r.reason for r in got] == [None, "invalid_json", "not_an_object", "invalid_field_types", "missing_required_fields", "invalid_timestamps", "invalid_field_types"]


def test_sheet_cells_and_prompts(spark):
    one = spark.range(1)
    assert one.select(records.cells(F.array(F.lit("a"), F.lit(None)), 3)).first()[0] == ["a", "", ""]
    assert one.select(records.rendered("{{A}} {{B}} {{A}}", {"A": F.lit("x"), "B": F.lit("y")})).first()[0] == "x y x"
    for template, values in (("{{A}}{{B}}", {"A": F.lit("x")}), ("{{A}}", {"A": F.lit("x"), "B": F.lit("y")}), (" ", {})):
        with pytest.raises(records.PromptError):
            records.rendered(template, values)
    for value in (F.lit(None).cast("string"), F.lit("{{LATER}}")):
        with pytest.raises(Exception, match="prompt"):
            one.select(records.rendered("{{A}}", {"A": value})).first()
    twice = spark.createDataFrame([("k", "t"), ("k", "u")], "item_id string, title string")
    with pytest.raises(Exception, match="twice"):
        records.sheet_upsert(twice, twice.limit(1), "item_id", [], {}).collect()
    assert one.select(records.script_text(*map(F.lit, "abcd"), 10)).first()[0] == "Hook: a\n\nS...(truncated)"


def test_reports_and_contracts(spark):
    df = spark.createDataFrame([("x",), (None,)], "reason string")
    row = counters(df, "reason", ["x", "y"]).first().asDict()
    assert row == {"n_rows": 2, "n_passed": 1, "x": 1, "y": 0} and not broken(row, ["n_passed", "x", "y"], "n_rows")
    seen = spark.createDataFrame([("k",) + ("a",) * 6, ("k",) + (None,) * 6], ", ".join(f"{c} string" for c in contracts.CONTRACTS["seen_items"].text))
    got = {r.rule: r.n for r in contracts.violations(seen, contracts.CONTRACTS["seen_items"]).collect()}
    assert got["duplicate key"] == 1 and got["null url"] == 1 and got["null dedup_key"] == 0
    assert contracts.missing_columns(seen.drop("url"), contracts.CONTRACTS["seen_items"]) == ["url"]


def test_pipeline_statuses(spark):
    ok = lambda: pipeline.StageResult(None, {})

    def bad():
        raise ValueError("no")

    assert pipeline.run([("a", ok), ("b", ok)]).status == "completed"
    assert pipeline.run([("a", ok), ("b", ok)], 1).status == "stopped"
    r = pipeline.run([("a", ok), ("b", bad), ("c", ok)])
    assert (r.status, r.failed_stage, r.stages["c"], r.exit_code, r.broken()) == ("failed", "b", "skipped", 2, [])


def test_streaming_ingest_is_idempotent(spark, tmp_path):
    good = '{"source_id": "s", "external_id": "%d", "url": "u", "title": "t", "published_at": "2020-01-01", "fetched_at": "2020-01-01T00:00:00Z"}'
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.jsonl").write_text("\n".join([good % 1, good % 2, good % 1]) + "\n")
    args = (spark, str(src), str(tmp_path / "seen"), str(tmp_path / "cp"), "2020-02-01T00:00:00Z")
    ingest_available(*args)
    (src / "b.jsonl").write_text(good % 2 + "\n" + good % 3 + "\n")
    ingest_available(*args)
    assert sorted(r.external_id for r in spark.read.parquet(str(tmp_path / "seen")).collect()) == ["1", "2", "3"]
