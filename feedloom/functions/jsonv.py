"""JSON text checked by type, not coerced: Variant keeps what a field really was.

Duplicate keys: the session setting spark.sql.variant.allowDuplicateKeys decides (last wins if on).
Text after the value is refused, which parsing alone would not do.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedloom.functions.media import WORD, steps_valid
from feedloom.functions.text import col, collapse, py_strip


def parsed(c: str | Column) -> Column:
    """The value as VARIANT; NULL for text that is not one JSON value."""
    t = py_strip(c)
    closed = t.rlike(r'(?s)^(\{.*\}|\[.*\]|".*"|-?\d[\d.eE+-]*|true|false|null)$')
    return F.when(closed, F.try_parse_json(t))


def kind(v: Column, path: str = "$") -> Column:
    """STRING, BIGINT, BOOLEAN, VOID, ARRAY, OBJECT ...; NULL if absent."""
    return F.regexp_extract(F.schema_of_variant(F.try_variant_get(v, path, "variant")), r"^([A-Z]+)", 1)


def text_at(v: Column, path: str) -> Column:
    """The string at ``path`` if it is one, else NULL."""
    return F.when(kind(v, path) == "STRING", F.try_variant_get(v, path, "string"))


def string_list(c: str | Column) -> Column:
    """A JSON array of strings as ARRAY<STRING>, stripped; NULL if it is anything else."""
    v = parsed(c)
    items = F.try_variant_get(v, "$", "array<variant>")
    ok = (kind(v) == "ARRAY") & F.forall(items, lambda x: F.schema_of_variant(x) == "STRING")
    return F.when(ok, F.transform(items, lambda x: py_strip(F.try_variant_get(x, "$", "string"))))


def evidence_texts(c: str | Column, most: int = 3, width: int = 240) -> Column:
    """The first texts of an evidence array that are not blank, cut to a width; [] for anything else."""
    items = F.try_variant_get(parsed(c), "$", "array<variant>")
    texts = F.transform(items, lambda x: F.when(F.schema_of_variant(x).startswith("OBJECT"), text_at(x, "$.text")))
    good = F.filter(texts, lambda t: t.isNotNull() & (py_strip(t) != ""))
    return F.coalesce(F.slice(F.transform(good, lambda t: F.substring(collapse(t), 1, width)), 1, most), F.array().cast("array<string>"))


def wrong_types(v: Column, fields: list[str]) -> Column:
    """Whether a present field, JSON null included, is not a string."""
    bad = F.lit(False)
    for f in fields:
        k = kind(v, f"$.{f}")
        bad = bad | F.coalesce(k != "STRING", F.lit(False))
    return bad


# The order of sections.
LABELS = ("hook", "setup", "steps", "cta")
SECTION = "struct<label: string, text: string>"


def script_check(c: str | Column, form: str | Column) -> Column:
    """STRUCT(valid, words, seconds) of a script payload: exact keys, label order, texts, policies."""
    v = parsed(c)
    raw = v.cast("string")
    keys = lambda j, *names: F.array_sort(F.json_object_keys(j)) == F.array(*[F.lit(n) for n in sorted(names)])
    script = F.get_json_object(raw, "$.script")
    label = [text_at(v, f"$.script.sections[{i}].label") for i in range(4)]
    text = [py_strip(text_at(v, f"$.script.sections[{i}].text")) for i in range(4)]
    ok = (kind(v) == "OBJECT") & keys(raw, "primary_hook", "alt_hooks", "script", "cta", "disclaimer") & keys(script, "sections", "word_count", "estimated_seconds")
    for p in ("$.primary_hook", "$.alt_hooks[0]", "$.alt_hooks[1]"):
        t = py_strip(text_at(v, p))
        ok &= F.length(t).between(1, 140)
    ok &= (F.size(F.try_variant_get(v, "$.alt_hooks", "array<variant>")) == 2) & (F.size(F.try_variant_get(v, "$.script.sections", "array<variant>")) == 4)
    for i, name in enumerate(LABELS):
        ok &= (py_strip(label[i]) == name) & (F.length(text[i]) > 0) & keys(F.get_json_object(raw, f"$.script.sections[{i}]"), "label", "text")
    ok &= steps_valid(text[2]) & (kind(v, "$.script.word_count") == "BIGINT") & (kind(v, "$.script.estimated_seconds") == "BIGINT")
    ok &= (py_strip(text_at(v, "$.cta")) == text[3]) & text_at(v, "$.disclaimer").isNotNull()
    seconds = F.try_variant_get(v, "$.script.estimated_seconds", "bigint")
    words = F.size(F.regexp_extract_all(F.array_join(F.array(*text), " "), F.lit(f"({WORD})"), F.lit(1)))
    video, prose = col(form).isin("shorts", "reel"), col(form).isin("tweet", "thread", "linkedin", "other")
    ok &= (video & (words >= 120) & seconds.between(45, 70)) | (prose & (words >= 180) & seconds.between(70, 110))
    return F.struct(F.coalesce(ok, F.lit(False)).alias("valid"), words.cast("long").alias("words"), seconds.alias("seconds"))
