import pytest

from feedloom.functions.html import main_text
from feedloom.plans import config, reports
from feedloom.sources import adapters, fetching


class Answer:
    def __init__(self, status, chunks=(), headers=None):
        self.status, self.parts, self.headers = status, chunks, headers or {}

    def chunks(self):
        return self.parts


def opener(answers):
    left = list(answers)

    def open_(url, policy):
        a = left.pop(0)
        if isinstance(a, Exception):
            raise a
        return a

    return open_, left


@pytest.mark.parametrize("first", [Answer(429), Answer(503), Answer(700), fetching.TryAgain("reset")])
def test_fetch_tries_again_after_passing_failures(first):
    open_, left = opener([first, Answer(200, [b"a", b"b"])])
    slept = []
    assert fetching.fetch("u", fetching.Policy(), open_, slept.append) == b"ab" and not left and slept == [1.0]


@pytest.mark.parametrize("first", [Answer(404), fetching.FetchError("bad"), Answer(200, [], {"Content-Length": "99999999"}), Answer(200, [b"x" * 1024 * 1024] * 6)])
def test_fetch_gives_up_at_once_and_bounds_sizes(first):
    open_, left = opener([first, Answer(200, [b"late"])])
    with pytest.raises(fetching.FetchError):
        fetching.fetch("u", fetching.Policy(), open_, lambda s: None)
    assert len(left) == 1


def test_fetch_gives_up_after_all_attempts():
    open_, left = opener([Answer(500)] * 5)
    with pytest.raises(fetching.TryAgain):
        fetching.fetch("u", fetching.Policy(attempts=3), open_, lambda s: None)
    assert len(left) == 2


def test_paced_model_spaces_starts_and_backs_off():
    now, slept, answers = [0.0], [], [adapters.ServiceBusy("x"), adapters.ServiceBusy("x"), "yes", "two"]

    def sleep(s):
        slept.append(round(s, 3))
        now[0] += s

    def call(prompt, label):
        a = answers.pop(0)
        if isinstance(a, Exception):
            raise a
        return a

    model = adapters.Paced(call, per_minute=30, attempts=3, first=1, factor=4, most=3, clock=lambda: now[0], sleep=sleep)
    assert model("p", "l") == "yes" and slept == [2.0, 3.0] and model("p", "l") == "two" and slept[-1] == 2.0
    answers[:] = [" "]
    with pytest.raises(adapters.ServiceError):
        model("p", "l")


def test_errors_keys_and_providers():
    assert [type(adapters.error_of_status(s)).__name__ for s in (401, 403, 404, 429, 500, 400, 422)] == ["ServiceFatal"] * 3 + ["ServiceBusy"] * 2 + ["ServiceError"] * 2
    assert adapters.api_key({"K": " a "}, "K", "b") == ("a", "env") and adapters.api_key({"K": " "}, "K", "b") == ("b", "config")
    for bad in (lambda: adapters.api_key({}, "K"), lambda: adapters.text_model("x", {})):
        with pytest.raises(adapters.SetupError):
            bad()


def test_called_keeps_failures_to_their_rows(spark):
    def make():
        def call(x):
            if x == "bad":
                raise adapters.ServiceError("no")
            if x == "fatal":
                raise adapters.ServiceFatal("key")
            return x.upper()

        return call

    df = spark.createDataFrame([("a", "old"), ("bad", None), (None, None)], "x string, response string")
    assert sorted(map(tuple, adapters.called(df, make, ["x"]).collect()), key=str) == sorted([("a", "A", None), ("bad", None, "no"), (None, None, None)], key=str)
    with pytest.raises(Exception, match="key"):
        adapters.called(spark.createDataFrame([("fatal",)], "x string"), make, ["x"]).collect()


def test_messages_are_sent_or_an_error():
    class Posted:
        def __init__(self, status_code, text=""):
            self.status_code, self.text = status_code, text

    adapters.send_message("u", "t", lambda *_, **__: Posted(204))
    with pytest.raises(adapters.ServiceError, match="status 500: why"):
        adapters.send_message("u", "t", lambda *_, **__: Posted(500, " why "))
    with pytest.raises(adapters.ServiceError):
        adapters.send_message("u", "t", lambda *_, **__: 1 / 0)


def test_main_text_keeps_prose_only():
    prose = "This is a sentence of the article that is long enough to count as prose, beyond doubt."
    page = f"<html><head><title>x</title></head><body><nav>{prose}</nav><h1>Site</h1><div><a href='/'>{prose}</a></div><p>{prose}</p><h2>Head</h2><table><tr><td>{prose}</td></tr></table><p>{prose} &amp; more</p><script>{prose}</script><footer>{prose}</footer></body></html>"
    assert main_text(page) == f"{prose} Head {prose} & more" == main_text(page.encode())
    assert main_text(f"<body><p>{prose}</p><article><p>{prose}</p></article>") == prose
    assert main_text(None) is None and main_text("") is None and main_text("<p>short</p>") is None


def test_config_sections_and_paths(tmp_path):
    ok = {"cooldown_policy": {"enabled": True, "after_consecutive_failures": 2, "skip_for_hours": 5, "reasons": [" a "]}}
    assert config.cooldown_policy(ok, ["a", "invalid_candidate_row"]).reasons == ("a",)
    for bad in (["a", "a"], ["b"], ["invalid_candidate_row"], [], "a"):
        with pytest.raises(config.ConfigError):
            config.cooldown_policy({"cooldown_policy": ok["cooldown_policy"] | {"reasons": bad}}, ["a", "invalid_candidate_row"])
    with pytest.raises(config.ConfigError):
        config.selection_policy({"selection_policy": {"min_newsletters_per_run": 3, "min_youtube_per_run": 3, "max_items_per_source": 1, "source_diversity_first_pass": True}}, 5)
    with pytest.raises(config.ConfigError):
        config.newsletter_policy({"newsletter_policy": {"min_candidates_per_run": 9, "min_relevance_score": 1, "trusted_source_ids": ["A "], "trusted_sources_bypass_score": True}}, 5)
    assert config.override(" 7 ", "n") == 7 and config.override(None, "n") is None
    for bad in (True, -1, "x"):
        with pytest.raises(config.ConfigError):
            config.override(bad, "n")
    assert config.optional_number({"A": "2.5"}, "A") == 2.5 and config.optional_number({"A": " "}, "A") is None
    with pytest.raises(config.ConfigError):
        config.optional_number({"A": "0"}, "A")
    assert config.dated_path("o/", "raw", "2024-01-02T00:00:00Z", ".jsonl") == "o/raw_2024-01-02.jsonl" and config.dated_path("o", "r", "", "", "given") == "given"
    (tmp_path / "t.md").write_text(" \n")
    with pytest.raises(config.ConfigError):
        config.template(str(tmp_path / "t.md"))
    run = {"paths": {"sqlite_db": "d", "outputs_dir": "o"}, "caps": {"recency_days": None, "max_entries_per_source": 5}, "http": {"user_agent": "u", "connect_timeout_s": 1, "read_timeout_s": 2, "max_response_mb": 3, "retries": {"max_attempts": 4}}}
    assert config.run_config(run).http.most_bytes == 3 * 1024 * 1024 and config.run_config(run).recency_days is None
    on = {"enabled": True, "spreadsheet_id": "s", "worksheet_name": "w", "key_column": "item_id", "header_row": 1}
    assert config.sheet_config({"sheets": on | {"enabled": False}}).spreadsheet == "" and config.sheet_config({"sheets": on}).worksheet == "w"
    assert config.deliver_config({"deliver": {"enabled": True, "channel": "c", "dry_run": False, "max_items_default": 1, "min_viral_rating": None, "max_script_chars": 5}}).min_rating is None


def test_summary_of_a_run():
    done = {"ingest": {"emitted": 3, "failed": 1}, "deliver": {"sent": 2, "errors": 4}}
    assert reports.key_metrics(done)["messages_sent"] == 2 and reports.non_fatal(done)["total"] == 5
    text = reports.markdown({"status": "failed"}, {"ingest": "failed"}, {"ingest": "why"}, done)
    assert "| ingest | failed | why |" in text and "| total | 5 |" in text
    with pytest.raises(ValueError):
        reports.key_metrics({"ingest": {"emitted": True}})
