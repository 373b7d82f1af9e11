"""Problem 7: mixing sources to target weights by Poisson replication.

Each source has a repetition rate. Every document draws its number of copies by inverting a Poisson
distribution, cut off at max_repeats, whose mean is that rate, with a uniform number hashed from its
id: the draw needs no state and is the same on any executor and in any retry. Lengths are heavy-tailed,
so the mean alone would miss the target by a long document or two. As copies only grow with the rate,
the rate is *calibrated*: in parallel rounds over all sources the tokens drawn at SECTIONS rates are
summed together, until the largest rate that stays within the target is known. What is still missing,
less than one document, is filled from documents that fit and have copies left, by a threshold on
another hash that is found the same way. Copies are exploded and shuffled globally by a hash.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom import storage
from feedloom.llm import keys as K
from feedloom.llm.tokens import token_count

#: Values tried together in a round, rounds of a search, and stages that fill what is missing.
SECTIONS, ROUNDS, FILLINGS = 32, 2, 2


def cut_poisson(mean: float, most: int) -> list[float]:
    """P(copies <= k), k = 0..most-1, of min(Poisson(lam), most) whose mean is ``mean``."""
    if most <= 0 or mean <= 0:
        return [1.0] * max(most, 0)
    if mean >= most:
        return [0.0] * most

    def table(lam: float) -> list[float]:
        total, out = 0.0, []
        for k in range(most):
            total += math.exp(k * math.log(lam) - lam - math.lgamma(k + 1))
            out.append(min(total, 1.0))
        return out

    # Ten deviations above the cut the mean falls short of it by less than any rate can tell.
    low, high = 0.0, most + 10 * math.sqrt(most) + 40
    for _ in range(80):
        lam = (low + high) / 2
        # E[min(X, m)] = sum over k < m of P(X > k)
        low, high = (lam, high) if sum(1 - p for p in table(lam)) < mean else (low, lam)
    return table((low + high) / 2)


def supply(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """Every target with available tokens, the tokens wanted and whether max_repeats suffices.

    ``sized(source, tokens)`` with the catalogue's ids. Nulls in weight, max_repeats and
    budget_tokens count as 0; a source without documents has 0 tokens. Repeated targets are each
    reported.
    """
    targets = targets.select("source", "weight", "max_repeats", "budget_tokens")
    have = sized.groupBy("source").agg(F.sum("tokens").alias("available"), F.count("*").alias("n_docs"))
    z = {c: F.coalesce(F.col(c), F.lit(0)) for c in ("weight", "max_repeats", "budget_tokens")}
    out = targets.join(have, targets["source"].eqNullSafe(have["source"]), "left").select(targets["source"], *[v.alias(c) for c, v in z.items()], F.coalesce("available", F.lit(0)).alias("available"), F.coalesce("n_docs", F.lit(0)).alias("n_docs"))
    out = out.withColumn("wanted", F.col("weight") * F.col("budget_tokens"))
    return out.withColumn("short", F.col("available") * F.col("max_repeats") < F.col("wanted"))


def uniform(*cols: str | Column, seed: int) -> Column:
    return (F.pmod(F.xxhash64(*cols, F.lit(seed)), F.lit(2**40)) + 0.5) / float(2**40)


def search(df: DataFrame, high: dict[str, float], room: dict[str, float], gain: Callable[[Column], Column], shaped: Callable[[str, float], object], shape: str) -> dict[str, float]:
    """For every source of ``high`` the largest value up to it, of SECTIONS in each of ROUNDS rounds, at
    which the tokens of ``df(source, tokens, u)``, times ``gain`` of the value as ``shaped``, stay within
    ``room``. A round is one aggregation over all sources; what is tried is a list by source."""
    spark, low, high = df.sparkSession, dict.fromkeys(high, 0.0), dict(high)
    for _ in range(ROUNDS if high else 0):
        value = {s: [low[s] + (high[s] - low[s]) * k / SECTIONS for k in range(1, SECTIONS + 1)] for s in low}
        tried = spark.createDataFrame([(s, [shaped(s, x) for x in v]) for s, v in value.items()], f"source string, tried array<{shape}>")
        sums = F.array(*[F.sum(F.col("tokens") * gain(F.get("tried", F.lit(k)))) for k in range(SECTIONS)])
        for r in df.join(F.broadcast(tried), "source").groupBy("source").agg(sums.alias("t")).collect():
            s, step = r.source, (high[r.source] - low[r.source]) / SECTIONS
            low[s] = max([low[s], *[v for v, t in zip(value[s], r.t, strict=True) if t <= room[s]]])
            high[s] = min(high[s], low[s] + step)
    return low


def drawn(sized: DataFrame, goals: list[dict], seed: int) -> DataFrame:
    """(doc_id, source, tokens, __row, copies, max_repeats): copies at the largest rates within the
    targets. Targets that all copies don't exceed take all copies."""
    spark = sized.sparkSession
    most = {r["source"]: int(r["max_repeats"]) for r in goals}
    rate = {r["source"]: min(r["wanted"] / r["available"], r["max_repeats"]) if r["available"] else 0.0 for r in goals}
    rows = storage.cut(sized.select("doc_id", "source", "tokens", "__row", uniform("doc_id", "__row", seed=seed).alias("u")))
    at = lambda steps: F.size(F.filter(steps, lambda p: p < F.col("u")))
    high = {s: min(4 * r, most[s]) for s, r in rate.items() if 0 < r < most[s]}
    rate |= search(rows, high, {r["source"]: r["wanted"] for r in goals}, at, lambda s, x: cut_poisson(x, most[s]), "array<double>")
    plan = spark.createDataFrame([(s, most[s], cut_poisson(float(rate[s]), most[s])) for s in most], "source string, max_repeats int, steps array<double>")
    return storage.cut(rows.join(F.broadcast(plan), "source").select("doc_id", "source", "tokens", "__row", at(F.col("steps")).alias("copies"), "max_repeats"))


def topped_up(state: DataFrame, goals: list[dict], seed: int) -> DataFrame:
    """``state`` with a further copy of rows that fit what their source still misses, have copies left
    and whose hash is below a threshold, the largest that stays within what is missing."""
    spark = state.sparkSession
    free = F.when(F.col("copies") < F.col("max_repeats"), F.col("tokens")).otherwise(0)
    # Tokens by power of two tell about how much fits, from which the search starts.
    sums = state.groupBy("source", F.floor(F.log2(F.col("tokens") + 1)).alias("size")).agg(F.sum(F.col("tokens") * F.col("copies")).alias("used"), F.sum(free).alias("free")).collect()
    missing = {r["source"]: float(r["wanted"]) for r in goals}
    for r in sums:
        missing[r.source] -= r.used
    room: dict[str, float] = {}
    for r in sums:
        if r.free and 2**r.size - 1 <= missing[r.source]:
            room[r.source] = room.get(r.source, 0) + r.free
    plan = F.broadcast(spark.createDataFrame([(s, missing[s]) for s in missing if missing[s] > 0], "source string, missing double"))
    u = F.when((F.col("tokens") > 0) & (F.col("tokens") <= F.col("missing")) & (F.col("copies") < F.col("max_repeats")), uniform("doc_id", "__row", seed=seed))
    rows = state.join(plan, "source").select("source", "tokens", u.alias("u")).where("u IS NOT NULL")
    below = search(rows, {s: min(1.0, 4 * missing[s] / t) for s, t in room.items()}, missing, lambda b: (F.col("u") < b).cast("int"), lambda _, x: x, "double")
    plan = F.broadcast(spark.createDataFrame([(s, missing[s], b) for s, b in below.items()], "source string, missing double, below double"))
    more = F.coalesce(u < F.col("below"), F.lit(False)).cast("int")
    return storage.cut(state.join(plan, "source", "left").select("doc_id", "source", "tokens", "__row", (F.col("copies") + more).alias("copies"), "max_repeats"))


def mixture(sized: DataFrame, targets: DataFrame, seed: int = 1) -> tuple[DataFrame, DataFrame]:
    """(mixture, report). mixture: (position_key, doc_id, copy, source, tokens) in shuffled order.

    A text here is a row of documents: each is used at most max_repeats times. Sources without a
    target are left out; of a target given twice each is reported, and the larger drawn. The report
    has actual tokens and shares next to the wanted ones. Targets fit the driver, as they are a list
    of sources; documents never do.
    """
    spark = sized.sparkSession
    report = supply(sized, targets)
    rows = [r.asDict() for r in report.collect()]
    largest = {r["source"]: r for r in sorted(rows, key=lambda r: r["wanted"]) if r["source"] is not None}
    state = drawn(sized, list(largest.values()), seed)
    for j in range(FILLINGS if largest else 0):
        state = topped_up(state, list(largest.values()), seed + 17 + j)
    dealt = state.where("copies > 0").select("doc_id", "source", "tokens", "__row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    order = ["position_key", "doc_id", "copy"]
    out = dealt.withColumn("position_key", F.xxhash64(F.lit(seed + 1), "doc_id", "__row", "copy"))
    # Written once, so the report counts what was dealt and shuffled.
    mixed = storage.cut(out.orderBy(order).drop("__row"))
    used = mixed.groupBy("source").agg(F.sum("tokens").alias("used"))
    fixed = spark.createDataFrame([tuple(r.values()) for r in rows], report.schema)
    total = F.sum("used")
    full = fixed.join(used, "source", "left").withColumn("used", F.coalesce("used", F.lit(0)))
    share = full.agg(total.alias("t")).first()["t"] or 0
    full = full.select("source", "weight", "max_repeats", "available", "wanted", "short", "used", (F.col("used") / F.lit(float(max(share, 1)))).alias("actual_share"))
    return mixed.orderBy(order), full


def sized_by_source(spark: SparkSession, d: str) -> DataFrame:
    """(doc_id, source, tokens, __row): documents whose source spells one of the catalogue's."""
    docs = storage.table(spark, d, "documents").select("doc_id", "text", F.col("source").alias("spelled"))
    docs = K.spelled_source(docs, "spelled", storage.table(spark, d, "sources"), "source").where("source IS NOT NULL")
    return storage.cut(docs.select("doc_id", "source", token_count("text").alias("tokens"), F.xxhash64("text", "spelled").alias("__row")))


def p7_mixture(spark: SparkSession, d: str) -> DataFrame:
    return mixture(sized_by_source(spark, d), storage.table(spark, d, "mix_targets"))[0]


def p7_report(spark: SparkSession, d: str) -> DataFrame:
    return mixture(sized_by_source(spark, d), storage.table(spark, d, "mix_targets"))[1]


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return p7_report(spark, d).where("short").select("source")


SQL: dict[str, str] = {}
