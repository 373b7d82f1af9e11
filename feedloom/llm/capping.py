"""Problem 1: holding each contributor to its best records, by parallel bisection.

The order of records is a list of *levels*, whole numbers of which a larger one is better. For every
contributor bounds of the cutoff are kept; each round counts the records above all midpoints of all
contributors in one aggregation and narrows the bounds, until they meet. Records that tie at the
cutoff go on to the next level; the last levels are the identifier itself, seven bytes at a time, as
many as ties need: a level is computed for the records only that still tie there.
Only counts per contributor and value are shuffled, so a contributor with a third of all rows costs
no more than others, and no contributor's records are sorted or gathered.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feedloom import storage
from feedloom.functions.text import non_blank, py_strip
from feedloom.functions.times import STAMP
from feedloom.llm import keys as K

#: Sections into which a round cuts each contributor's bounds: 1024 are ten halvings at once.
SECTIONS = 1024


def eligible(candidates: DataFrame, sources: DataFrame) -> DataFrame:
    """(item_id, source_id, source_type, relevance_score, published_at, created_at) of valid rows.

    Valid: item_id, source_id, url and title not blank, source_type newsletter or youtube once
    trimmed and lower-cased, published_at a UTC stamp in seconds, relevance_score >= 0. source_id is
    that of the catalogue, NULL if it spells none.
    """
    df = candidates.withColumns({"source_type": F.lower(py_strip("source_type")), "published_at": py_strip("published_at"), "__id": non_blank("source_id")})
    ok = F.col("source_type").isin("newsletter", "youtube") & F.col("published_at").rlike(STAMP) & (F.col("relevance_score") >= 0)
    for c in ("item_id", "url", "title"):
        ok &= non_blank(c).isNotNull()
    df = df.where(ok & F.col("__id").isNotNull()).drop("source_id")
    return K.spelled_source(df, "__id", sources, "source_id").select("item_id", "source_id", "source_type", F.col("relevance_score").cast("long").alias("relevance_score"), "published_at", "created_at")


def id_level(c: str, k: int) -> Column:
    """Bytes 7k to 7k + 6 of the text as a number of which more is better: ids in ascending order. The
    digits are the bytes plus one, to the base 257, so that an end comes before every byte."""
    part, value = F.substring(F.encode(F.col(c), "UTF-8"), 1 + 7 * k, 7), F.lit(0).cast("long")
    for i in range(1, 8):
        byte = F.conv(F.hex(F.substring(part, i, 1)), 16, 10).cast("long")
        value = value * 257 + F.when(F.octet_length(part) >= i, byte + 1).otherwise(0)
    return F.when(F.col(c).isNotNull(), -value)


def cutoffs(df: DataFrame, group: list[str], level: Callable[[int], Column], levels: int, limit: Column | int) -> DataFrame:
    """(group, cut): the records of a group to keep are those whose levels are >= cut, as arrays.

    ``level(k)``, k < ``levels``, is a whole number of a record of ``df``, none null. ``limit`` is a
    number or an expression over ``__n``, the size of the group, for shares. Groups within the limit
    get an empty cut. Records that tie in every level are kept or left out together, so give levels
    that tell all apart; levels beyond those that ties need are never computed.
    """
    sizes = df.groupBy(*group).agg(F.count("*").alias("__n"))
    need = (F.lit(limit) if isinstance(limit, int) else limit).cast("long")
    state = storage.cut(sizes.select(*group, F.when(F.col("__n") > need, need).alias("need"), F.array().cast("array<long>").alias("cut")))
    done, active = state.where("need IS NULL").select(*group, "cut"), df
    state = state.where("need IS NOT NULL")
    for k in range(levels):
        if state.isEmpty():
            break
        # Of the records only those that tie at the last level's cutoff.
        at = ["at"] if k else []
        s = state.select(*[F.col(g).alias(f"__{g}") for g in group], *at)
        active = active.join(s, [active[g].eqNullSafe(s[f"__{g}"]) for g in group])
        active = active.where(F.col("at") == level(k - 1)) if k else active
        active = storage.cut(active.select(*df.columns))
        counts = storage.cut(active.groupBy(*group, level(k).alias("v")).agg(F.count("*").alias("n")))
        span = counts.groupBy(*group).agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
        state = state.join(span, [state[g].eqNullSafe(span[g]) for g in group]).select(*[state[g] for g in group], "need", "cut", "lo", "hi")
        state = storage.cut(state.withColumn("found", F.when(F.col("need") == 0, F.col("hi") + 1)))
        while not state.where("found IS NULL AND lo < hi").isEmpty():
            state = storage.cut(_narrow(counts, state, group))
        done = done.unionByName(state.where("found IS NOT NULL").select(*group, F.concat("cut", F.array("found")).alias("cut")))
        # The rest ties at lo = hi: to the next level with what is still needed.
        state = state.where("found IS NULL").select(*group, "need", F.concat("cut", F.array("lo")).alias("cut"), F.col("lo").alias("at"))
    return storage.cut(done.unionByName(state.select(*group, "cut")))


def _narrow(counts: DataFrame, state: DataFrame, group: list[str]) -> DataFrame:
    """One round: counts by section of all contributors together, then the section of each cutoff.

    What is found: the bound between two sections above which just as many lie as are needed, else the
    section in which the last needed record lies, with the number needed of it.
    """
    s = state.select(*[F.col(g).alias(f"__{g}") for g in group], "need", "cut", "lo", "hi", "found")
    live = F.col("found").isNull() & (F.col("lo") < F.col("hi"))
    step = F.expr(f"(hi - lo) div {SECTIONS} + 1")
    j = counts.join(s, [counts[g].eqNullSafe(s[f"__{g}"]) for g in group]).where(live & F.col("v").between(F.col("lo"), F.col("hi")))
    # Whole division: doubles would not tell neighbouring levels apart.
    by = j.withColumn("step", step).groupBy(*group, F.expr("(v - lo) div step").alias("k")).agg(F.sum("n").alias("n"))
    # At most SECTIONS rows a contributor reach the window.
    above = by.withColumn("above", F.sum("n").over(W.partitionBy(*group).orderBy(F.desc("k"))))
    t = above.select(*[F.col(g).alias(f"__{g}") for g in group], "k", "n", "above")
    hit = t.join(state, [state[g].eqNullSafe(t[f"__{g}"]) for g in group]).where((F.col("above") >= F.col("need")) & (F.col("above") - F.col("n") < F.col("need")))
    exact = F.col("above") == F.col("need")
    low = F.col("lo") + step * F.col("k")
    new = hit.select(
        *group,
        F.when(exact, F.col("need")).otherwise(F.col("need") - F.col("above") + F.col("n")).alias("need"),
        "cut",
        low.alias("lo"),
        F.least(F.col("hi"), low + step - 1).alias("hi"),
        F.when(exact, low).alias("found"),
    )
    return new.unionByName(state.where(~live))


def cap_contributors(df: DataFrame, group: list[str], levels: dict[str, Column], id_col: str, limit: Column | int) -> DataFrame:
    """The rows of ``df`` within each group's limit, best first by ``levels``, then by ``id_col``.

    Levels that are null count as lowest. Rows that are equal in the order and the id count as one
    record: all are kept or none. Null groups and ids are groups and ids like others (a null id
    comes after all). An empty table stays empty.
    """
    names, ident = [f"__l{i}" for i in range(len(levels))], "__id"
    least = F.lit(-(2**62))
    work = df.withColumns({n: F.coalesce(c.cast("long"), least) for n, c in zip(names, levels.values(), strict=True)} | {ident: F.col(id_col).cast("string")})
    most = -(-(work.agg(F.max(F.octet_length(ident))).first()[0] or 0) // 7)
    level = lambda k: F.col(names[k]) if k < len(names) else F.coalesce(id_level(ident, k - len(names)), least)
    unique = work.select(*group, *names, ident).distinct()
    cut = cutoffs(unique, group, level, len(names) + max(most, 1), limit)
    # Only so many levels are compared as the deepest tie has.
    deep = cut.agg(F.max(F.size("cut"))).first()[0] or 0
    c = cut.select(*[F.col(g).alias(f"__g_{g}") for g in group], F.col("cut").alias("__cut"))
    own = F.array(*[level(k) for k in range(deep)]) if deep else F.array().cast("array<long>")
    kept = work.join(c, [work[g].eqNullSafe(c[f"__g_{g}"]) for g in group]).where(F.slice(own, F.lit(1), F.size("__cut")) >= F.col("__cut"))
    return kept.select(*df.columns)


def p1_kept(spark: SparkSession, d: str, limit: int = 6) -> DataFrame:
    """(created_at, source_id, item_id, relevance_score, published_at): best rows per source and run."""
    rows = eligible(storage.table(spark, d, "candidates"), storage.table(spark, d, "sources")).where("source_id IS NOT NULL")
    best = rows.groupBy("created_at", "source_id", "item_id").agg(F.max(F.struct("relevance_score", "published_at")).alias("b"))
    best = storage.cut(best.select("created_at", "source_id", "item_id", "b.relevance_score", "b.published_at"))
    digits = F.regexp_replace("published_at", r"\D", "").cast("long")
    return cap_contributors(best, ["created_at", "source_id"], {"score": F.col("relevance_score"), "published": digits}, "item_id", limit)


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return p1_kept(spark, d).select("item_id").distinct()


_VALID = r"""
WITH valid AS (
  SELECT item_id, trim(lower(source_type)) AS source_type, relevance_score, trim(published_at) AS published_at, created_at,
         regexp_replace(lower(source_id), '[^\p{L}\p{N}]+', '', 'g') AS sq
  FROM candidates
  WHERE regexp_matches(item_id, '\S') AND regexp_matches(source_id, '\S') AND regexp_matches(url, '\S') AND regexp_matches(title, '\S')
    AND trim(lower(source_type)) IN ('newsletter', 'youtube') AND relevance_score >= 0
    AND regexp_full_match(trim(published_at), '\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z')),
rows AS (
  SELECT v.*, s.source_id FROM valid v LEFT JOIN sources s ON v.sq = regexp_replace(lower(s.source_id), '[^\p{L}\p{N}]+', '', 'g'))
"""
SQL = {
    "p1_found": _VALID
    + """, best AS (
  SELECT *, row_number() OVER (PARTITION BY created_at, source_id, item_id ORDER BY relevance_score DESC, published_at DESC) AS k
  FROM rows WHERE source_id IS NOT NULL),
ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY created_at, source_id ORDER BY relevance_score DESC, published_at DESC, item_id) AS r
  FROM best WHERE k = 1)
SELECT DISTINCT item_id FROM ranked WHERE r <= 6"""
}
