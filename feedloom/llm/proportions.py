"""Problem 4: a sample whose shares of categories follow targets.

Inclusion probabilities tilt exponentially, p = min(1, exp(sum of the multipliers of the item's
categories)); the multipliers are found by Newton iterations on the dual, whose moments and second
moments by category are aggregated over all items (by pattern of categories, so an item of several
categories is right in each). Floors and scarce categories are fixed first. The sample is drawn by
the pivotal method, in salted groups whose single undecided items meet in further rounds, so that
every category's count differs from its expectation by less than a few items.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom import storage
from feedloom.llm.capping import _VALID, eligible

#: Items that one task of the pivotal method decides at most.
UNITS = 50_000
CERTAIN = 40.0


def members(spark: SparkSession, d: str) -> DataFrame:
    """(item_id, source_type, source_id): the categories in which each item has an eligible row."""
    return eligible(storage.table(spark, d, "candidates"), storage.table(spark, d, "sources")).where("source_id IS NOT NULL").select("item_id", "source_type", "source_id").distinct()


def gaps(items: DataFrame, targets: DataFrame, category: list[str]) -> DataFrame:
    """Every target with ``required``, ``supply`` and ``short``: whether supply is below required.

    required is the larger of min_count and the share of sample_size, rounded up; nulls in
    target_ppm, min_count and sample_size count as 0. Categories without items have supply 0;
    repeated targets are reported each. No targets give no rows.
    """
    targets = targets.select(*category, "target_ppm", "min_count", "sample_size")
    supply = items.groupBy(*category).agg(F.countDistinct("item_id").alias("supply"))
    n = [F.coalesce(F.col(c).cast("long"), F.lit(0)) for c in ("target_ppm", "sample_size", "min_count")]
    out = targets.withColumn("required", F.greatest(n[2], F.floor((n[0] * n[1] + 999_999) / F.lit(1_000_000)).cast("long")))
    out = out.join(supply, [out[c].eqNullSafe(supply[c]) for c in category], "left").select(*[out[c] for c in out.columns], F.coalesce("supply", F.lit(0)).alias("supply"))
    return out.withColumn("short", F.col("supply") < F.col("required"))


def goals(report: list) -> tuple[np.ndarray, int]:
    """Expected count of each target: supply if short, else its floor or a common multiple of its share."""
    share = np.array([(r["target_ppm"] or 0) / 1e6 for r in report])
    floor = np.array([r["min_count"] or 0 for r in report], float)
    supply = np.array([r["supply"] for r in report], float)
    size = max((r["sample_size"] or 0 for r in report), default=0)
    fixed = np.full(len(report), np.nan)
    goal = np.zeros(len(report))
    for _ in range(len(report) + 1):
        free = np.isnan(fixed)
        left = max(0.0, size - np.nansum(fixed))
        scale = left / share[free].sum() if share[free].sum() > 0 else 0.0
        goal = np.where(free, share * scale, fixed)
        low, high = free & (goal < np.minimum(floor, supply)), free & (goal > supply)
        if not (low | high).any():
            break
        fixed[low] = np.minimum(floor, supply)[low]
        fixed[high] = supply[high]
    return goal, size


def tilt(patterns: DataFrame, goal: np.ndarray, supply: np.ndarray, rounds: int = 40, close: float = 1e-4) -> np.ndarray:
    """Multipliers such that expected counts meet ``goal``: Newton on the exponential-tilting dual.

    ``patterns(pattern array<int>, n)``: how many items lie in which categories. What comes to the
    driver each round are sums by pair of categories, bounded by the number of targets squared.
    """
    c = len(goal)
    sure, none = goal >= supply - 1e-9, goal <= 0
    live = ~(sure | none)
    # All start from the rate of the whole: it is Newton that tells categories apart.
    rate = goal[live].sum() / max(supply[live].sum(), 1) if live.any() else 1.0
    x = np.where(sure, CERTAIN, np.where(none, -CERTAIN, np.log(max(rate, 1e-9))))
    for _ in range(rounds):
        lam = F.array(*[F.lit(float(v)) for v in x])
        e = F.aggregate("pattern", F.lit(0.0), lambda a, i: a + F.get(lam, i))
        p = patterns.withColumn("e", e).withColumns({"mass": F.least(F.lit(1.0), F.exp("e")) * F.col("n"), "slope": F.when(F.col("e") < 0, F.exp("e") * F.col("n")).otherwise(0.0)})
        pairs = p.select(F.explode("pattern").alias("a"), "pattern", "mass", "slope").select("a", F.explode("pattern").alias("b"), "mass", "slope")
        rows = pairs.groupBy("a", "b").agg(F.sum("mass").alias("m"), F.sum("slope").alias("s")).collect()
        have, hess = np.zeros(c), np.zeros((c, c))
        for r in rows:
            hess[r.a, r.b] = r.s
            if r.a == r.b:
                have[r.a] = r.m
        miss = np.where(live, goal - have, 0)
        if np.abs(miss).max(initial=0) < close:
            break
        h = hess[np.ix_(live, live)] + 1e-6 * np.eye(live.sum())
        x[live] += np.clip(np.linalg.solve(h, miss[live]), -2, 2)
        x = np.clip(x, -CERTAIN, CERTAIN)
    return x


def pivotal(p: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, int, float]:
    """Which units are selected, and the one that stays undecided (-1 if none) with its probability."""
    chosen = p >= 1 - 1e-9
    at, mass = -1, 0.0
    for j in np.flatnonzero(~chosen & (p > 1e-12)):
        if at < 0:
            at, mass = j, p[j]
            continue
        both = mass + p[j]
        if both < 1:
            at, mass = (at if rng.random() < mass / both else j), both
        else:
            keep = rng.random() < (1 - p[j]) / (2 - both)
            chosen[at if keep else j] = True
            at, mass = (j if keep else at), both - 1
        if mass >= 1 - 1e-9:
            chosen[at] = True
            at, mass = -1, 0.0
        elif mass <= 1e-12:
            at, mass = -1, 0.0
    return chosen, int(at), float(mass)


def draw(items: DataFrame, patterns: DataFrame, x: np.ndarray, seed: int) -> DataFrame:
    """(item_id, pattern): the sample, by pivotal rounds over ever wider groups."""
    lam = F.array(*[F.lit(float(v)) for v in x])
    e = F.aggregate("pattern", F.lit(0.0), lambda a, i: a + F.get(lam, i))
    # Only patterns of more than UNITS items are dealt out, at most a row for every UNITS items.
    large = storage.cut(patterns.where(F.col("n") > UNITS).select("pattern", F.ceil(F.col("n") / UNITS).alias("salts")))
    units = items.withColumn("p", F.least(F.lit(1.0), F.exp(e))).join(storage.small_side(large, large.count()), "pattern", "left")
    units = units.select("item_id", "pattern", "p", F.pmod(F.xxhash64("item_id", F.lit(seed)), F.coalesce("salts", F.lit(1))).alias("salt"))

    def decide(last: bool):
        def run(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values("item_id", kind="stable").reset_index(drop=True)
            rng = np.random.default_rng([seed, len(pdf), int(pd.util.hash_pandas_object(pdf["item_id"][:1], index=False).iloc[0]) if len(pdf) else 0])
            chosen, at, mass = pivotal(pdf["p"].to_numpy(), rng)
            if at >= 0 and last:
                chosen[at] = rng.random() < mass
            out = pdf[chosen].assign(p=1.0)
            if at >= 0 and not last:
                out = pd.concat([out, pdf.iloc[[at]].assign(p=mass)])
            return out[["item_id", "pattern", "p"]]

        return run

    schema = "item_id string, pattern array<int>, p double"
    first = storage.cut(units.groupBy("pattern", "salt").applyInPandas(decide(False), schema))
    taken, open_ = first.where("p >= 1"), first.where("p < 1")
    for keys in (["pattern"], [F.get("pattern", F.lit(0)).alias("head")], []):
        nxt = storage.cut(open_.groupBy(*keys).applyInPandas(decide(not keys), schema))
        taken, open_ = taken.unionByName(nxt.where("p >= 1")), nxt.where("p < 1")
    return taken.select("item_id", "pattern")


def sample(items: DataFrame, targets: DataFrame, category: list[str], seed: int = 1) -> tuple[DataFrame, DataFrame]:
    """(sample, report). sample: (item_id, categories...) of every drawn item in each of its targets.

    report: :func:`gaps` with ``goal`` and ``sampled``. Items of categories without a target are not
    drawn; an item of several categories counts in each. Targets fit the driver, as they are a list
    of categories; items never do. Nothing to draw gives an empty sample and a full report.
    """
    spark, items = items.sparkSession, items.select("item_id", *category)
    report = gaps(items, targets, category).orderBy(*category).collect()
    goal, _ = goals(report)
    supply = np.array([r["supply"] for r in report], float)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in targets.select(*category).schema)
    index = spark.createDataFrame([(*[r[c] for c in category], i) for i, r in enumerate(report)], f"{fields}, i int")
    j = items.join(index, [items[c].eqNullSafe(index[c]) for c in category]).select("item_id", "i")
    per_item = storage.cut(j.groupBy("item_id").agg(F.array_sort(F.collect_set("i")).alias("pattern")))
    patterns = storage.cut(per_item.groupBy("pattern").agg(F.count("*").alias("n")))
    x = tilt(patterns, goal, supply) if len(report) else goal
    drawn = storage.cut(draw(per_item, patterns, x, seed).select("item_id", F.explode("pattern").alias("i")))
    counts = drawn.groupBy("i").agg(F.count("*").alias("sampled"))
    full = spark.createDataFrame([(i, *[r[c] for c in category], int(r["required"]), int(r["supply"]), bool(r["short"]), float(goal[i])) for i, r in enumerate(report)], f"i int, {fields}, required long, supply long, short boolean, goal double")
    return drawn.join(index, "i").drop("i"), full.join(counts, "i", "left").select(*category, "required", "supply", "short", "goal", F.coalesce("sampled", F.lit(0)).alias("sampled"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return p4_report(spark, d).where("short").select("source_type", "source_id")


def p4_sample(spark: SparkSession, d: str) -> DataFrame:
    return sample(storage.cut(members(spark, d)), storage.table(spark, d, "sample_targets"), ["source_type", "source_id"])[0]


def p4_report(spark: SparkSession, d: str) -> DataFrame:
    return sample(storage.cut(members(spark, d)), storage.table(spark, d, "sample_targets"), ["source_type", "source_id"])[1]


SQL = {
    "p4_found": _VALID
    + """, supply AS (SELECT source_type, source_id, count(DISTINCT item_id) AS n FROM rows WHERE source_id IS NOT NULL GROUP BY ALL)
SELECT t.source_type, t.source_id FROM sample_targets t LEFT JOIN supply s USING (source_type, source_id)
WHERE coalesce(s.n, 0) < greatest(t.min_count, (CAST(t.target_ppm AS BIGINT) * t.sample_size + 999999) // 1000000)"""
}
