"""Deterministic constrained top-k. Each works as windows whose global part sees only a bounded cut."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def cap_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], limit: int, place: str | None = None) -> DataFrame:
    """The first ``limit`` rows of each group, with their ``place`` from 1 if a name is given. Planned
    with a group limit below the shuffle."""
    name = place or "__k"
    out = df.withColumn(name, F.row_number().over(W.partitionBy(*group).orderBy(*order))).where(F.col(name) <= limit)
    return out if place else out.drop(name)


def top(df: DataFrame, order: Sequence[Column], limit: int, rank: str = "rank") -> DataFrame:
    """The first ``limit`` rows with their place. The sort is a distributed take-ordered."""
    if limit <= 0:
        return df.limit(0).withColumn(rank, F.lit(0).cast("long"))
    return df.orderBy(*order).limit(limit).withColumn(rank, F.row_number().over(W.orderBy(*order)).cast("long"))


def quota_select(df: DataFrame, preferred: Column, order: Sequence[Column], quota: int, limit: int, rank: str = "rank") -> DataFrame:
    """First ``quota`` preferred rows by ``order``, then others by ``order``, ``limit`` in all.

    At most quota + limit rows reach the final ordering; the rest is cut off distributedly.
    """
    marked = df.withColumn("__p", F.coalesce(preferred, F.lit(False)))
    first = top(marked.where("__p"), order, min(quota, limit), "__r").withColumn("__ph", F.lit(0))
    pool = top(marked, order, min(quota, limit) + limit, "__r").withColumn("__ph", F.lit(1))
    # A preferred row within the quota is in both cuts; its first phase counts.
    inner = max(0, min(quota, limit))
    place = F.row_number().over(W.partitionBy("__p").orderBy(*order))
    rest = pool.withColumn("__k", place).where(~(F.col("__p") & (F.col("__k") <= inner))).drop("__k")
    both = first.unionByName(rest).drop("__r")
    return top(both, [F.col("__ph"), *order], limit, rank).drop("__p", "__ph")


def phased_select(
    base: DataFrame, *, limit: int, cap: int, floor_first: int, floor_second: int, first: str = "newsletter", second: str = "youtube", diversity: bool = True, invalid: bool = False
) -> DataFrame:
    """Floors per type, then one per source not yet taken, then the remainder, with a cap per source.

    ``base(idx, stype, sid, valid, blocked)``, idx unique and the base order. Result: idx, phase
    (1, 2 floors, 3 diversity, 4 remainder) and rank by (phase, idx). Rows that are not valid come in
    only with ``invalid``, in phase 4. Each phase is cut per source and to its size before any global
    ordering.
    """
    nt, yt = min(floor_first, limit), min(floor_second, max(0, limit - min(floor_first, limit)))
    src = ["stype", "sid"]
    e = base.where("valid AND NOT coalesce(blocked, false)").select("idx", *src)
    e = e.withColumn("rk", F.row_number().over(W.partitionBy(*src).orderBy("idx"))).where(F.col("rk") <= max(cap, 1))
    within = e.where(F.col("rk") <= cap)
    floors = [top(within.where(F.col("stype") == t), [F.col("idx")], n, "r").withColumn("phase", F.lit(p)) for t, n, p in ((first, nt, 1), (second, yt, 2))]
    floor = floors[0].unionByName(floors[1]).select("idx", *src, "phase")
    n_floor = floor.agg(F.count("*").alias("n0"))
    heads = top(e.where("rk = 1").join(floor.select(*src).distinct(), src, "left_anti"), [F.col("idx")], limit if diversity and cap > 0 else 0, "r")
    div = heads.join(F.broadcast(n_floor)).where(F.col("r") <= F.lit(limit) - F.col("n0")).select("idx", *src, F.lit(3).alias("phase"))
    s1 = floor.unionByName(div)
    taken = s1.groupBy(*src).agg(F.count("*").alias("c"))
    rem = base.where("valid AND NOT coalesce(blocked, false)").select("idx", *src).join(s1.select("idx"), "idx", "left_anti")
    rem = rem.withColumn("r2", F.row_number().over(W.partitionBy(*src).orderBy("idx"))).where(F.col("r2") <= cap).join(taken, src, "left").where(F.col("r2") <= cap - F.coalesce("c", F.lit(0))).select("idx", *src)
    if invalid:
        rem = rem.unionByName(base.where("NOT coalesce(valid, false)").select("idx", *src))
    n_s1 = s1.agg(F.count("*").alias("n1"))
    last = top(rem, [F.col("idx")], limit, "r").join(F.broadcast(n_s1)).where(F.col("r") <= F.lit(limit) - F.col("n1")).select("idx", *src, F.lit(4).alias("phase"))
    return top(s1.unionByName(last), [F.col("phase"), F.col("idx")], limit)


def capped_prefix(df: DataFrame, counts: Column, group: Sequence[str], order: Sequence[Column], limit: int) -> DataFrame:
    """``df`` with ``visited`` and ``selected``: a scan in order that stops once ``limit`` rows count.

    Rows that do not count take no capacity but are visited while there is some. The running sum is
    over each group (give [] for one scan of a bounded cut).
    """
    before = F.coalesce(F.sum(F.when(counts, 1).otherwise(0)).over(W.partitionBy(*group).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return df.withColumn("visited", before < limit).withColumn("selected", F.col("visited") & F.coalesce(counts, F.lit(False)))


def capped_scan(df: DataFrame, counts: Column, order: Sequence[tuple[str, bool]], limit: int) -> DataFrame:
    """The rows one scan in ``order`` (column, descending) visits until ``limit`` rows count, with
    ``selected``. Rows that do not count take no capacity.

    The last row that counts is found by a bounded take-ordered, and a filter keeps what lies up to
    it: no row is numbered and no task sees all. The order must be total and its columns not null.
    """
    marked = df.withColumn("selected", F.coalesce(counts, F.lit(False)))
    if limit <= 0:
        return marked.limit(0)
    names = [c for c, _ in order]
    first = marked.where("selected").orderBy(*[F.desc(c) if down else F.asc(c) for c, down in order]).limit(limit).select(*names)
    last = first.orderBy(*[F.asc(c) if down else F.desc(c) for c, down in order]).limit(1)
    row, n = last.first(), first.count()
    if row is None or n < limit:
        return marked
    upto = F.lit(True)
    for c, down in reversed(list(order)):
        at = F.lit(row[c])
        upto = (F.col(c) > at if down else F.col(c) < at) | ((F.col(c) == at) & upto)
    return marked.where(upto)
