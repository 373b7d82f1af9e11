"""Validity of rows and payloads as one Column: the name of the first check that fails, NULL if none."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedloom.functions.jsonv import kind, parsed, string_list, text_at
from feedloom.functions.text import col, non_blank, py_strip
from feedloom.functions.times import STAMP

# What stages accept.
SOURCE_TYPES = ("newsletter", "youtube")
FORMATS = ("shorts", "tweet", "linkedin", "reel", "thread", "other")
CONTENT_TYPES = ("howto", "case_study", "tool_review", "opinion", "news", "other")
EXTRACT_TEXTS = ("topic", "core_claim", "monetization_angle")
EXTRACT_LISTS = ("workflow_steps", "tools_mentioned", "metrics_claims", "assumptions")
MOST_STEPS, HOOKS, HOOK_CHARS, RATINGS = 8, 3, 140, (1, 10)
#: Checks in which a stage's runner counts a failed row.
EXTRACT_FAILURES = ("extract_llm_failed", "extract_invalid_json", "extract_validation_failed")
SCORE_FAILURES = ("score_llm_failed", "score_invalid_json", "score_validation_failed")
SCRIPT_FAILURES = ("script_llm_failed", "script_invalid_json", "script_validation_failed")


def first_failure(checks: Sequence[tuple[str, Column]]) -> Column:
    """The name of the first check that does not hold (a NULL check does not); NULL if all hold."""
    return F.coalesce(*[F.when(~F.coalesce(ok, F.lit(False)), name) for name, ok in checks])


def texts_present(names: Sequence[str]) -> list[tuple[str, Column]]:
    return [(n, non_blank(n).isNotNull()) for n in names]


def candidate_failure() -> Column:
    """Rows that enrichment takes: six texts, a known type in any case, an exact stamp, a score from 0."""
    return first_failure(
        [
            *texts_present(("item_id", "source_type", "source_id", "url", "title", "published_at")),
            ("source_type", F.lower(py_strip("source_type")).isin(*SOURCE_TYPES)),
            ("published_at", py_strip("published_at").rlike(STAMP)),
            ("relevance_score", F.col("relevance_score") >= 0),
        ]
    )


def enriched_failure() -> Column:
    """Rows that extraction takes: seven texts, a known type in any case, an exact stamp."""
    return first_failure(
        [
            *texts_present(("item_id", "source_type", "url", "title", "published_at", "enriched_text", "enrichment_method")),
            ("source_type", F.lower(py_strip("source_type")).isin(*SOURCE_TYPES)),
            ("published_at", py_strip("published_at").rlike(STAMP)),
        ]
    )


def filled_list(c: str | Column) -> Column:
    """A JSON array of strings, stripped, without blanks; NULL if it is anything else."""
    return F.filter(string_list(c), lambda x: x != "")


def idea_failure() -> Column:
    """Rows that script writing takes: texts, exact type and format, JSON lists, three hooks, a rating."""
    lists = {n: filled_list(n) for n in (*EXTRACT_LISTS, "hooks")}
    size = lambda n: F.coalesce(F.size(lists[n]), F.lit(-1))
    return first_failure(
        [
            *texts_present(("item_id", "platform", "recommended_format", "url", "title", "published_at")),
            ("published_at", py_strip("published_at").rlike(STAMP)),
            ("platform", py_strip("platform").isin(*SOURCE_TYPES)),
            ("recommended_format", py_strip("recommended_format").isin(*FORMATS)),
            *[(n, F.col(n).isNotNull()) for n in EXTRACT_TEXTS],
            ("workflow_steps", size("workflow_steps").between(0, MOST_STEPS)),
            *[(n, lists[n].isNotNull()) for n in EXTRACT_LISTS[1:]],
            ("hooks", size("hooks") == HOOKS),
            ("viral_rating", F.col("viral_rating").between(*RATINGS)),
        ]
    )


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, as a lambda's variable."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def has_keys(v: Column, names: Sequence[str]) -> Column:
    """Whether the object has these keys and no other."""
    return F.array_sort(F.json_object_keys(v.cast("string"))) == F.array(*map(F.lit, sorted(names)))


def list_at(v: Column, path: str) -> Column:
    """The array of strings at ``path``, as written; NULL if it is anything else."""
    items = F.try_variant_get(v, path, "array<variant>")
    ok = (kind(v, path) == "ARRAY") & F.forall(items, lambda x: F.schema_of_variant(x) == "STRING")
    return F.when(ok, F.transform(items, lambda x: F.try_variant_get(x, "$", "string")))


def extract_failure(payload: str | Column) -> Column:
    """What is wrong with an extraction: json, object, keys or a field; NULL if it holds."""

    def check(v: Column) -> Column:
        texts = [(n, text_at(v, f"$.{n}").isNotNull()) for n in EXTRACT_TEXTS]
        lists = [(n, list_at(v, f"$.{n}").isNotNull()) for n in EXTRACT_LISTS[1:]]
        steps = F.coalesce(F.size(list_at(v, "$.workflow_steps")), F.lit(-1))
        return first_failure(
            [
                ("json", v.isNotNull()),
                ("object", kind(v) == "OBJECT"),
                ("keys", has_keys(v, (*EXTRACT_TEXTS, *EXTRACT_LISTS, "content_type"))),
                *texts,
                ("workflow_steps", steps.between(0, MOST_STEPS)),
                *lists,
                ("content_type", py_strip(text_at(v, "$.content_type")).isin(*CONTENT_TYPES)),
            ]
        )

    return once(parsed(payload), check)


def score_failure(payload: str | Column, hint: str | Column) -> Column:
    """What is wrong with a score: json, object, keys or a field; its platform must be the hint."""

    def check(v: Column) -> Column:
        rating = F.when(kind(v, "$.viral_rating") == "BIGINT", F.try_variant_get(v, "$.viral_rating", "bigint"))
        hooks = list_at(v, "$.hooks")
        platform = py_strip(text_at(v, "$.platform"))
        return first_failure(
            [
                ("json", v.isNotNull()),
                ("object", kind(v) == "OBJECT"),
                ("keys", has_keys(v, ("viral_rating", "rating_rationale", "hooks", "platform", "recommended_format"))),
                ("viral_rating", rating.between(*RATINGS)),
                ("rating_rationale", py_strip(text_at(v, "$.rating_rationale")) != ""),
                ("hooks", (F.size(hooks) == HOOKS) & F.forall(hooks, lambda h: F.length(py_strip(h)).between(1, HOOK_CHARS))),
                ("platform", platform.isin(*SOURCE_TYPES) & (platform == col(hint))),
                ("recommended_format", py_strip(text_at(v, "$.recommended_format")).isin(*FORMATS)),
            ]
        )

    return once(parsed(payload), check)


def platform_hint(source_type: str | Column) -> Column:
    """The platform that a source type writes for; NULL for unknown types."""
    return F.when(col(source_type).isin(*SOURCE_TYPES), col(source_type))


def item_label(item_id: str | Column) -> Column:
    """An id for messages, also of rows that have none."""
    return F.coalesce(non_blank(item_id), F.lit("<unknown>"))


def section_texts(c: str | Column, labels: Sequence[str] = ("hook", "setup", "steps", "cta")) -> Column:
    """The texts of a script's sections, a JSON array of label and text in this order; NULL if it isn't."""

    def check(v: Column) -> Column:
        ok, texts = (kind(v) == "ARRAY") & (F.size(F.try_variant_get(v, "$", "array<variant>")) == len(labels)), []
        for i, name in enumerate(labels):
            part = F.try_variant_get(v, f"$[{i}]", "variant")
            text = py_strip(text_at(v, f"$[{i}].text"))
            ok &= (kind(part) == "OBJECT") & has_keys(part, ("label", "text")) & (py_strip(text_at(v, f"$[{i}].label")) == name) & (text != "")
            texts.append(text)
        return F.when(F.coalesce(ok, F.lit(False)), F.array(*texts))

    return once(parsed(c), check)
