"""Texts around videos and scripts: ids, captions, snippets, words, steps."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from feedloom.functions.text import col, collapse, py_strip

# Hosts of videos, and what a word is.
VIDEO_HOSTS = ("youtube.com", "www.youtube.com", "m.youtube.com")
SHORT_HOST = "youtu.be"
WORD = r"[A-Za-z0-9]+(?:['-][A-Za-z0-9]+)*"


def video_id(url: str | Column, hosts: Sequence[str] = VIDEO_HOSTS, short: str = SHORT_HOST) -> Column:
    """The 11 characters that name a video: first non-blank ``v``, then /shorts/, short host, /embed/."""
    u = py_strip(url)
    host = F.lower(F.regexp_extract(u, r"^https?://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    path = F.regexp_extract(u, r"^https?://[^/?#]*([^?#]*)", 1)
    query = F.regexp_extract(u, r"^[^?#]*\?([^#]*)", 1)
    values = F.filter(F.transform(F.split(query, "&"), lambda p: F.when(F.startswith(p, F.lit("v=")), F.trim(F.substring(p, 3, 1000)))), lambda v: v.isNotNull() & (v != ""))
    parts = F.filter(F.split(path, "/"), lambda p: p != "")
    after = lambda name: F.when((F.size(parts) > 1) & (F.lower(F.get(parts, F.lit(0))) == name), F.get(parts, F.lit(1)))
    on = host.isin(*hosts)
    found = F.coalesce(F.when(on, F.get(values, F.lit(0))), F.when(on, after("shorts")), F.when(host == short, F.get(parts, F.lit(0))), F.when(on, after("embed")))
    return F.when(found.rlike(r"^[A-Za-z0-9_-]{11}$"), found)


def word_count(c: str | Column) -> Column:
    return F.size(F.regexp_extract_all(F.coalesce(col(c), F.lit("")), F.lit(f"({WORD})"), F.lit(1)))


def snippets(c: str | Column, width: int = 240, most: int = 3) -> Column:
    """ARRAY<STRUCT(text, offset)>: the first windows of the text that are not empty."""
    t = col(c)
    return F.filter(F.transform(F.sequence(F.lit(0), F.lit(most - 1)), lambda i: F.struct(F.substring(t, i * width + 1, F.lit(width)).alias("text"), (i * width).alias("offset"))), lambda s: s["text"] != "")


def steps_valid(c: str | Column) -> Column:
    """Three to six lines that are not blank, each '- ' and some text."""
    lines = F.filter(F.transform(F.split(F.regexp_replace(col(c), "\r\n|\r", "\n"), "\n"), py_strip), lambda x: x != "")
    return F.size(lines).between(3, 6) & F.forall(lines, lambda x: F.startswith(x, F.lit("- ")) & (py_strip(F.substring(x, 3, 1_000_000)) != ""))


#: A caption time (fixed value): hours and thousandths may be left out, no field is shorter.
VTT_TIME = r"^(?:(\d{2,}):)?(\d{2}):(\d{2})(?:\.(\d{3}))?$"


def vtt_seconds(c: Column) -> Column:
    """[HH:]MM:SS[.mmm] as seconds; NULL if it is no time."""
    g = lambda k: F.coalesce(F.nullif(F.regexp_extract(c, VTT_TIME, k), F.lit("")).cast("double"), F.lit(0.0))
    return F.when(c.rlike(VTT_TIME), g(1) * 3600 + g(2) * 60 + g(3) + g(4) / 1000)


def seconds_text(c: str | Column) -> Column:
    """Seconds with three decimals as text, rounded by the number's exact value; NULL if it is none."""

    # Built-in functions round the shortest decimal of the number, which differs at ties.
    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        return pd.Series([None if x is None or x != x else f"{x:.3f}" for x in s], dtype=object)

    return run(col(c).try_cast("double"))


def last_object(c: str | Column) -> Column:
    """The last line of a text that is a JSON object, as text; NULL if there is none."""
    lines = F.reverse(F.filter(F.transform(F.split(col(c), "\r\n|\r|\n"), py_strip), lambda x: x.startswith("{") & x.endswith("}")))
    return F.get(F.filter(lines, lambda x: F.schema_of_variant(F.try_parse_json(x)).startswith("OBJECT")), F.lit(0))


def duration_failure(seconds: str | Column, most: float) -> Column:
    """Why audio is not taken: missing, not_positive or too_long; NULL if it is."""
    s = col(seconds).cast("double")
    return F.when(s.isNull() | F.isnan(s), "missing").when(s <= 0, "not_positive").when(s > most, "too_long")


def text_failure(c: str | Column, least: int) -> Column:
    """too_short for texts below ``least`` characters, nulls included."""
    return F.when(F.coalesce(F.length(col(c)), F.lit(0)) < least, "too_short")


def vtt_cues(c: str | Column) -> Column:
    """ARRAY<STRUCT(text, start)> of caption text: a cue begins at a time line and ends at a blank one."""
    lines = F.transform(F.split(F.regexp_replace(col(c), "\r\n|\r", "\n"), "\n"), lambda x: F.regexp_replace(py_strip(x), "^\\uFEFF+", ""))
    blocks = F.split(F.array_join(lines, "\n"), "\n{2,}")

    def cue(b: Column) -> Column:
        # Lines before the time line (a number, notes) are not spoken.
        rest = F.regexp_extract(b, r"(?s)^(?:(?:(?!-->)[^\n])*\n)*?([^\n]*-->.*)$", 1)
        spoken = collapse(F.regexp_replace(F.regexp_extract(rest, r"(?s)^[^\n]*\n(.*)$", 1), "<[^>]+>", " "))
        return F.struct(spoken.alias("text"), vtt_seconds(py_strip(F.substring_index(rest, "-->", 1))).alias("start"), (rest != "").alias("is_cue"))

    return F.transform(F.filter(F.transform(blocks, cue), lambda q: q["is_cue"] & (q["text"] != "")), lambda q: F.struct(q["text"].alias("text"), q["start"].alias("start")))


def digest_mod(hex_digest: Column, n: int) -> Column:
    """A hex digest as a number, modulo n."""
    digits = F.transform(F.split(hex_digest, ""), lambda h: F.conv(h, 16, 10).cast("long"))
    return F.aggregate(digits, F.lit(0).cast("long"), lambda a, h: F.when(h.isNull(), a).otherwise((a * 16 + h) % n))


def rotated(key: str | Column, attempts: Sequence[str]) -> Column:
    """``attempts`` from the place the key's sha256 names, round, then a direct attempt ('')."""
    n = len(attempts)
    if not n:
        return F.array(F.lit(""))
    a, at = F.array(*map(F.lit, attempts)), digest_mod(F.sha2(col(key), 256), n)
    return F.concat(F.slice(a, at + 1, n), F.slice(a, F.lit(1), at), F.array(F.lit("")))


__all__ = ["digest_mod", "duration_failure", "last_object", "rotated", "seconds_text", "snippets", "steps_valid", "text_failure", "video_id", "vtt_cues", "word_count"]
