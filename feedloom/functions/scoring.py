"""Weighted keyword relevance as one native expression.

Groups are compiled on the driver to a literal array of terms, each with its greatest weight; a
document is then scored without any join or Python.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedloom.functions.text import col, py_strip, py_ws

# Fixed value: what a token is.
TOKEN = r"[a-z0-9]+(?:\.[a-z0-9]+)*"
#: Older spellings of terms (fixed value).
ALIASES = {"freelanc": "freelanc*"}


class TermError(ValueError):
    """A keyword group or term that the grammar does not allow."""


@dataclass(frozen=True)
class Term:
    text: str
    kind: str  # phrase | prefix | token
    needle: str
    weight: int


def compile_terms(groups: Mapping[str, Mapping]) -> list[Term]:
    """Terms of all groups with their greatest weight, in code-point order."""
    if not isinstance(groups, Mapping) or not groups:
        raise TermError("keyword groups must be a non-empty mapping")
    best: dict[str, int] = {}
    for name, group in groups.items():
        weight, terms = (group.get("weight"), group.get("terms")) if isinstance(group, Mapping) else (None, None)
        if type(weight) is not int or weight < 1:
            raise TermError(f"{name}: weight must be an integer of at least 1")
        if not isinstance(terms, list) or not all(isinstance(t, str) for t in terms):
            raise TermError(f"{name}: terms must be a list of strings")
        cleaned = [" ".join(t.lower().split()) for t in terms]
        cleaned = [ALIASES.get(t, t) for t in cleaned if t]
        if not cleaned:
            raise TermError(f"{name}: no terms")
        for t in cleaned:
            best[t] = max(best.get(t, 0), weight)
    return [_classified(t, best[t]) for t in sorted(best)]


def _classified(term: str, weight: int) -> Term:
    body = term[:-1] if term.endswith("*") else term
    if not all(re.fullmatch(TOKEN, part) for part in body.split(" ")) or (body != term and " " in body):
        raise TermError(f"not a token, phrase or prefix: {term}")
    kind = "prefix" if body != term else "phrase" if " " in body else "token"
    return Term(term, kind, body, weight)


def body_text(content: str | Column, summary: str | Column) -> Column:
    """The content if there is any, else the summary, else ''."""
    return F.coalesce(F.nullif(py_strip(content), F.lit("")), F.nullif(py_strip(summary), F.lit("")), F.lit(""))


def relevance(title: str | Column, body: str | Column, terms: list[Term]) -> Column:
    """STRUCT(score, keywords): phrases match as substrings, prefixes any token, tokens whole tokens."""
    lit = F.array(*[F.struct(F.lit(t.text).alias("text"), F.lit(t.kind).alias("kind"), F.lit(t.needle).alias("needle"), F.lit(t.weight).alias("weight")) for t in terms])
    text = F.lower(F.concat(col(title), F.lit(" "), col(body)))
    tokens = F.array_distinct(F.regexp_extract_all(text, F.lit(f"({TOKEN})"), F.lit(1)))

    def scored(doc: Column) -> Column:
        def hit(t: Column) -> Column:
            prefix = F.exists(doc["tokens"], lambda w: F.startswith(w, t["needle"]))
            return F.when(t["kind"] == "phrase", F.contains(doc["text"], t["needle"])).when(t["kind"] == "prefix", prefix).otherwise(F.array_contains(doc["tokens"], t["needle"]))

        def summed(h: Column) -> Column:
            return F.struct(F.aggregate(h, F.lit(0).cast("long"), lambda a, t: a + t["weight"]).alias("score"), F.array_sort(F.transform(h, lambda t: t["text"])).alias("keywords"))

        return F.get(F.transform(F.array(F.filter(lit, hit)), summed), F.lit(0))

    # Lambda variables are computed once: the text and its tokens per document, the hits per document.
    return F.get(F.transform(F.array(F.struct(py_ws(text).alias("text"), tokens.alias("tokens"))), scored), F.lit(0))
