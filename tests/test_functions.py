import pytest
from pyspark.sql import functions as F

from feedloom.functions import jsonv, media, scoring, times
from feedloom.functions.text import collapse, py_strip


def one(spark, value, *columns):
    return tuple(spark.createDataFrame([(value,)], "v string").select(*columns).first())


@pytest.mark.parametrize("text", ["  a  b ", " x ", "\x1cq\x1f", "", "\t\n", None])
def test_strip_is_pythons(spark, text):
    got = one(spark, text, py_strip("v"), collapse("v"))
    assert got == ((None, None) if text is None else (text.strip(), " ".join(text.split())))


@pytest.mark.parametrize(
    ("text", "want"),
    [("2018-01-27T16:39:29+05:30", "2018-01-27T11:09:29Z"), ("2018-01-27", "2018-01-27T00:00:00Z"), ("2018-01-27 20:39:29", "2018-01-27T20:39:29Z"), ("2018-01-27T01:02:03.999Z", "2018-01-27T01:02:03Z"), ("10:15", None), ("2018-1-2", None), ("not-a-date", None), ("2018-13-01", None), (None, None)],
)
def test_iso(spark, text, want):
    assert one(spark, text, times.iso_to_utc_z("v")) == (want,)


def test_relevance_takes_greatest_weight_and_kinds(spark):
    terms = scoring.compile_terms({"a": {"weight": 1, "terms": ["make", "side hustle", "freelanc"]}, "b": {"weight": 5, "terms": ["make", "2.0"]}})
    df = spark.createDataFrame([("Make it", "inside hustlers freelancing 2.0"), ("make.com", "")], "t string, b string").select(scoring.relevance("t", "b", terms).alias("r"))
    rows = [(r.r.score, r.r.keywords) for r in df.collect()]
    assert rows == [(12, ["2.0", "freelanc*", "make", "side hustle"]), (0, [])]
    with pytest.raises(scoring.TermError):
        scoring.compile_terms({"a": {"weight": True, "terms": ["x"]}})
    with pytest.raises(scoring.TermError):
        scoring.compile_terms({"a": {"weight": 1, "terms": ["a* b"]}})


def test_json_lists_and_evidence(spark):
    assert one(spark, '[" a ", ""]', jsonv.string_list("v")) == (["a", ""],)
    for bad in ('["a", 1]', "{}", "[] x", "nope", None):
        assert one(spark, bad, jsonv.string_list("v")) == (None,)
    assert one(spark, '[{"text": " a  b "}, 3, {"text": 4}, {"x": 1}, {"text": "c"}]', jsonv.evidence_texts("v")) == (["a b", "c"],)
    assert one(spark, None, jsonv.evidence_texts("v")) == ([],)


@pytest.mark.parametrize(
    ("url", "want"),
    [("https://www.youtube.com/watch?v=&v=abcdefghijk", "abcdefghijk"), ("https://youtu.be/abcdefghijk?t=1", "abcdefghijk"), ("https://m.youtube.com/shorts/abcdefghijk/", "abcdefghijk"), ("https://youtube.com/embed/abcdefghijk", "abcdefghijk"), ("ftp://youtu.be/abcdefghijk", None), ("https://music.youtube.com/watch?v=abcdefghijk", None), ("https://youtu.be/short", None), (None, None)],
)
def test_video_id(spark, url, want):
    assert one(spark, url, media.video_id("v")) == (want,)


def test_captions_steps_words_and_rotation(spark):
    vtt = "WEBVTT\n\n00:01.500 --> 00:02.000\n<b>Hi</b>\nyou\n\n\n00:03.000 --> x\n\n"
    assert [tuple(x) for x in one(spark, vtt, media.vtt_cues("v"))[0]] == [("Hi you", 1.5)]
    for text, want in (("100:00:01", 360001.0), ("00:01.5", None), ("1:02", None), ("00:01,500", None), ("00:01.500 x", None)):
        assert one(spark, text, media.vtt_seconds(F.col("v"))) == (want,)
    for text, want in (("0.0625", "0.062"), ("2.0005", f"{2.0005:.3f}"), ("x", None), (None, None)):
        assert one(spark, text, media.seconds_text("v")) == (want,)
    assert one(spark, '{"a": 1}\n[2]\n{bad}\n', media.last_object("v")) == ('{"a": 1}',) and one(spark, "[1]", media.last_object("v")) == (None,)
    assert one(spark, "- a\r\n- b\n\n- c", media.steps_valid("v")) == (True,)
    assert one(spark, "- a\n- b", media.steps_valid("v")) == (False,)
    assert one(spark, "don't stop-it 3x", media.word_count("v")) == (3,)
    got = one(spark, "k", media.rotated("v", ["a", "b", "c"]))[0]
    assert sorted(got[:3]) == ["a", "b", "c"] and got[3] == ""
    import hashlib

    assert one(spark, "k", media.digest_mod(F.sha2("v", 256), 97)) == (int(hashlib.sha256(b"k").hexdigest(), 16) % 97,)


def test_caption_files_are_read(spark, tmp_path):
    from feedloom.sources.subtitles import read_captions

    (tmp_path / "a.vtt").write_text("WEBVTT\n\n00:01.000 --> 00:02.000\nHi\n\n00:03.000 --> 00:04.000\n<i>you</i>\n")
    assert [(r.n, r.text, r.start) for r in read_captions(spark, str(tmp_path)).orderBy("n").collect()] == [(0, "Hi", 1.0), (1, "you", 3.0)]
