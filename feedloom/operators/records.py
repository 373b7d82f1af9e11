"""Records: canonical items with exclusive reject reasons, gates, and rendered rows and messages."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feedloom.functions.jsonv import kind, parsed, string_list, text_at, wrong_types
from feedloom.functions.scoring import Term, body_text, relevance
from feedloom.functions.text import first_text, non_blank, py_strip, sha_key
from feedloom.functions.times import iso_to_utc_z

# Fields and types of records.
REQUIRED = ["external_id", "url", "title", "published_at", "fetched_at"]
OPTIONAL = ["source_type", "source_id", "source_name", "creator", "summary"]
TYPES = ("newsletter", "youtube")


def canonical_items(raw: DataFrame, bad_types: Column | None = None) -> DataFrame:
    """Canonical columns and ``reason``: invalid_field_types, missing_required_fields, invalid_timestamps or NULL.

    ``raw`` holds the ten fields as strings, null if absent; other columns stay, unless they clash.
    """
    keep = [c for c in raw.columns if c not in (*REQUIRED, *OPTIONAL, "item_id", "content_text", "reason", "bad")]
    df = raw.withColumns({f"__{c}": F.coalesce(py_strip(c), F.lit("")) for c in (*REQUIRED, *OPTIONAL)})
    default = lambda c, d: F.when(F.col(f"__{c}") != "", F.col(f"__{c}")).otherwise(d)
    stype, sid, name = F.lower(default("source_type", F.lit("newsletter"))), default("source_id", F.lit("unknown")), default("source_name", F.lit("unknown"))
    df = df.withColumns({"__pub": iso_to_utc_z("__published_at"), "__fet": iso_to_utc_z("__fetched_at"), "__bad": bad_types if bad_types is not None else F.lit(False)})
    missing = F.lit(False)
    for c in REQUIRED:
        missing |= F.col(f"__{c}") == ""
    reason = F.when(F.col("__bad"), "invalid_field_types").when(missing, "missing_required_fields").when(F.col("__pub").isNull() | F.col("__fet").isNull(), "invalid_timestamps")
    return df.select(
        *keep,
        reason.alias("reason"),
        sha_key(sid, "__external_id").alias("item_id"),
        F.col("__external_id").alias("external_id"),
        F.when(stype.isin(*TYPES), stype).otherwise("newsletter").alias("source_type"),
        sid.alias("source_id"),
        name.alias("source_name"),
        default("creator", name).alias("creator"),
        F.col("__title").alias("title"),
        F.col("__url").alias("url"),
        F.col("__pub").alias("published_at"),
        F.col("__fet").alias("fetched_at"),
        F.col("__summary").alias("summary"),
        F.col("__summary").alias("content_text"),
    )


def json_items(lines: DataFrame, text: str = "value") -> DataFrame:
    """Canonical items of JSON lines, with the reasons invalid_json and not_an_object before the others.

    Blank lines are skipped. A field that is present but no string, null included, is a wrong type.
    """
    v = parsed(text)
    keep = [c for c in lines.columns if c != text]
    df = lines.where(py_strip(text) != "").withColumn("__v", v)
    df = df.withColumns({"__kind": kind(F.col("__v")), "bad": wrong_types(F.col("__v"), [*REQUIRED, *OPTIONAL])})
    df = df.select(*keep, "__kind", "bad", *[text_at(F.col("__v"), f"$.{c}").alias(c) for c in (*REQUIRED, *OPTIONAL)])
    out = canonical_items(df, F.col("bad"))
    return out.withColumn("reason", F.when(F.col("__kind").isNull(), "invalid_json").when(F.col("__kind") != "OBJECT", "not_an_object").otherwise(F.col("reason"))).drop("__kind")


ITEM_FIELDS = ["item_id", "source_type", "source_id", "source_name", "creator", "title", "url", "published_at", "fetched_at"]


def gated(items: DataFrame, terms: Sequence[Term], *, min_chars: int, min_score: int, newsletter_min: int, trusted: Sequence[str]) -> DataFrame:
    """``items`` with score, keywords, category and reason, by gates in order, cheap ones first.

    reason: missing_required_fields, content_too_short, low_relevance or NULL; category of passing
    newsletters: standard, relaxed or trusted.
    """
    df = items.withColumns({c: py_strip(c) for c in ITEM_FIELDS}).withColumn("__body", body_text("content_text", "summary"))
    whole = F.forall(F.array(*[F.col(c) for c in ITEM_FIELDS]), lambda x: x.isNotNull() & (x != ""))
    df = df.withColumn("__whole", whole)
    # As a generator's output the score is computed once: filters on it are not pushed below and repeat it.
    df = df.select("*", F.explode(F.array(relevance(F.coalesce("title", F.lit("")), "__body", list(terms)))).alias("__r"))
    score = F.col("__r.score")
    letter = F.col("source_type") == "newsletter"
    known = F.lower(py_strip("source_id")).isin(*trusted) if trusted else F.lit(False)
    category = F.when(letter & (score >= min_score), "standard").when(letter & (score >= newsletter_min), "relaxed").when(letter & known, "trusted")
    passed = F.when(letter, category.isNotNull()).otherwise(score >= min_score)
    reason = F.when(~F.col("__whole"), "missing_required_fields").when(F.length("__body") < min_chars, "content_too_short").when(~F.coalesce(passed, F.lit(False)), "low_relevance")
    return df.select(*items.columns, score.alias("score"), F.col("__r.keywords").alias("keywords"), F.when(reason.isNull(), category).alias("category"), reason.alias("reason"))


def recency_reason(published: Column, url: Column, title: Column, cutoff: Column) -> Column:
    """Why a feed entry is dropped: too_old, missing_url, missing_title or NULL, in this order."""
    return F.when(published < cutoff, "too_old").when(non_blank(url).isNull(), "missing_url").when(non_blank(title).isNull(), "missing_title")


def creator_or(creator: str | Column, source_name: str | Column) -> Column:
    return F.coalesce(first_text(creator, source_name), F.lit("unknown"))


def hook_or(primary: str | Column, hooks_json: str | Column) -> Column:
    """The primary hook, else the first of the list that is not blank; NULL if there is none."""
    return F.coalesce(non_blank(primary), F.get(F.filter(string_list(hooks_json), lambda x: x != ""), F.lit(0)))


def joined(list_json: str | Column) -> Column:
    return F.array_join(F.filter(string_list(list_json), lambda x: x != ""), ", ")


def script_text(hook: Column, setup: Column, steps: Column, cta: Column, most: int | None = None) -> Column:
    # The layout and the mark of a cut.
    text = F.concat(F.lit("Hook: "), hook, F.lit("\n\nSetup: "), setup, F.lit("\n\nSteps:\n"), steps, F.lit("\n\nCTA: "), cta)
    return text if most is None else F.when(F.length(text) > most, F.concat(F.substring(text, 1, most), F.lit("...(truncated)"))).otherwise(text)


def placeholders(template: str) -> set[str]:
    return set(re.findall(r"\{\{([A-Z0-9_]+)\}\}", template))


class PromptError(ValueError):
    """A template whose placeholders are not those that are given values."""


def rendered(template: str, values: Mapping[str, Column], exact: bool = True) -> Column:
    """A prompt: ``{{NAME}}`` replaced in sorted order (as given, without ``exact``).

    The template must have every name, and with ``exact`` no other; that is checked before the plan is
    made. Rows with a null value, or whose text still holds a placeholder afterwards, fail the job.
    """
    have, lacking = placeholders(template), sorted(set(values) - placeholders(template))
    if not template.strip() or lacking or (exact and have - set(values)):
        raise PromptError(f"placeholders lacking: {lacking}, without a value: {sorted(have - set(values))}")
    out = F.lit(template)
    for name in sorted(values) if exact else values:
        value = F.coalesce(values[name], F.raise_error(F.lit(f"prompt value {name} is null")).cast("string"))
        out = F.replace(out, F.lit("{{" + name + "}}"), value)
    left = out.rlike(r"\{\{[A-Z0-9_]+\}\}")
    return F.when(left, F.raise_error(F.lit("prompt holds a placeholder after all were replaced")).cast("string")).otherwise(out)


def cells(row: Column, header: int) -> Column:
    """A worksheet row padded or cut to the header's width, nulls as ''."""
    full = F.concat(F.transform(row, lambda x: F.coalesce(x, F.lit(""))), F.array_repeat(F.lit(""), header))
    return F.slice(full, 1, header)


def sheet_upsert(current: DataFrame, rows: DataFrame, key: str, kept: Sequence[str], fresh: dict[str, str]) -> DataFrame:
    """(key, action, columns): rows against a worksheet: updates keep the columns ``kept`` and unknown
    ones, inserts get ``fresh`` values. Blank keys of the sheet are ignored."""
    cur = current.where(non_blank(key).isNotNull())
    # A key that the sheet holds twice ends the job where it is met, instead of doubling its row.
    n = F.count("*").over(W.partitionBy(key))
    cur = cur.withColumn(key, F.when(n > 1, F.raise_error(F.concat(F.lit("key given twice in the sheet: "), F.col(key))).cast("string")).otherwise(F.col(key)))
    new = rows.select([F.col(c).alias(f"__n_{c}") for c in rows.columns])
    j = new.join(cur, F.col(f"__n_{key}") == cur[key], "left")
    out = [F.col(f"__n_{key}").alias(key), F.when(cur[key].isNull(), "insert").otherwise("update").alias("action")]
    for c in current.columns:
        if c == key:
            continue
        value = F.col(f"__n_{c}") if c in rows.columns and c not in kept else cur[c]
        out.append(F.when(cur[key].isNull(), F.lit(fresh[c]) if c in fresh else (F.col(f"__n_{c}") if c in rows.columns else F.lit(""))).otherwise(value).alias(c))
    return j.select(*out)


__all__ = ["canonical_items", "cells", "creator_or", "gated", "hook_or", "joined", "json_items", "recency_reason", "rendered", "script_text", "sheet_upsert"]
