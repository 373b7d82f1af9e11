"""Idempotent state: first of a key, insert if absent, upsert, and the fold of retry events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

from pyspark.sql import functions as F

from feedloom import storage
from feedloom.functions.times import plus_hours, strict_utc_z, utc_z

def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first by ``order``; aggregated before the shuffle, so hot keys are cheap."""
    row = F.struct(*[df[c] for c in df.columns])
    best = df.groupBy(*keys).agg(F.min_by(row, F.struct(*order)).alias("__row"))
    return best.select("__row.*")

def first_of_few(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """:func:`first_per_key` for wide rows whose keys seldom repeat: only rows of repeated keys are
    compared and shuffled, others pass as they are. Reads ``df`` three times, once by its keys only."""
    twice = storage.cut(df.groupBy(*keys).agg(F.count("*").alias("__n")).where("__n > 1").select(*[F.col(k).alias(f"__{k}") for k in keys]))
    twice = storage.small_side(twice, twice.count())
    same = [df[k].eqNullSafe(F.col(f"__{k}")) for k in keys]
    return df.join(twice, same, "left_anti").unionByName(first_per_key(df.join(twice, same, "left_semi"), keys, order))

def unprocessed(df: DataFrame, done: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key is not in ``done`` (anti-join; null keys are unprocessed)."""
    return df.join(done.select(*keys), list(keys), "left_anti")

def insert_if_absent(new: DataFrame, state: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The rows to append: the first of each key that the state does not hold."""
    return first_per_key(unprocessed(new, state, keys), keys, order)

def upsert(state: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The next snapshot: updates replace whole rows; keys of ``updates`` must be unique."""
    return state.join(updates.select(*keys), list(keys), "left_anti").unionByName(updates)

def fold_retries(events: DataFrame, key: str, at: str, failed: Column, reason: Column, *, after: int, hours: int, reasons: Sequence[str] | None = None, tie: str | None = None) -> DataFrame:
    """State per key after all its events: attempts, failures since the last success, cooldown end.

    Needs no sequence of states: failures in a row are those after the last success, so two partial
    aggregations do.
    """
    order = F.struct(F.col(at), F.col(tie)) if tie else F.struct(F.col(at))
    marked = events.select(F.col(key), F.col(at), order.alias("__o"), F.coalesce(failed, F.lit(False)).alias("__f"), reason.alias("__r"))
    ok = F.max(F.when(~F.col("__f"), F.col("__o")))
    base = marked.groupBy(key).agg(F.count("*").alias("attempts_total"), ok.alias("__ok"), F.max("__o").alias("__last"), F.max_by("__f", "__o").alias("__lf"), F.max_by("__r", "__o").alias("__lr"))
    run = marked.join(base.select(key, "__ok"), key).where("__f AND (__ok IS NULL OR __o > __ok)").groupBy(key).agg(F.count("*").alias("consecutive_failures"))
    out = base.join(run, key, "left").withColumn("consecutive_failures", F.coalesce("consecutive_failures", F.lit(0)))
    cool = F.col("__lf") & F.col("__lr").isNotNull() & (F.col("consecutive_failures") >= after) & F.lit(hours > 0)
    if reasons is not None:
        cool &= F.col("__lr").isin(*reasons)
    last = F.col("__last").getField(at)
    return out.select(
        key,
        "attempts_total",
        "consecutive_failures",
        F.when(F.col("__lf"), "failed").otherwise("success").alias("last_outcome"),
        F.when(F.col("__lf"), F.col("__lr")).alias("last_fail_reason"),
        last.alias("last_attempt_at"),
        F.when(cool, last + F.make_dt_interval(F.lit(0), F.lit(hours))).alias("next_eligible_at"),
    )

def cooled_down(rows: DataFrame, retries: DataFrame, now: str) -> DataFrame:
    """``rows`` with ``blocked``: whether their item may not be tried again before a time after ``now``.

    No state, no time and times of another form block nothing. ``retries`` has one row per item.
    """
    until = retries.select(F.col("item_id").alias("__item"), strict_utc_z("next_eligible_at").alias("__until"))
    j = rows.join(until, F.col("item_id") == F.col("__item"), "left")
    return j.withColumn("blocked", F.coalesce(strict_utc_z(F.lit(now)) < F.col("__until"), F.lit(False))).drop("__item", "__until")


def next_retries(retries: DataFrame, outcomes: DataFrame, now: str, *, enabled: bool = True, after: int, hours: int, reasons: Sequence[str]) -> DataFrame:
    """The state's next snapshot after ``outcomes(item_id, source_type, source_id, reason)``, one an item.

    A NULL reason is a success and resets the count of failures in a row; ``after`` of them with one of
    ``reasons`` block the item for ``hours``.
    """
    old = retries.select(F.col("item_id").alias("__item"), F.col("attempts_total").alias("__n"), F.col("consecutive_failures").alias("__c"))
    j = outcomes.join(old, F.col("item_id") == F.col("__item"), "left")
    failed = F.col("reason").isNotNull()
    row = F.when(failed, F.coalesce("__c", F.lit(0)) + 1).otherwise(0)
    wait = failed & F.col("reason").isin(*reasons) & (row >= after) & F.lit(enabled and hours > 0)
    new = j.select(
        "item_id",
        "source_type",
        "source_id",
        F.when(failed, "failed").otherwise("success").alias("last_outcome"),
        F.col("reason").alias("last_fail_reason"),
        F.lit(now).alias("last_attempt_at"),
        F.when(wait, utc_z(plus_hours(strict_utc_z(F.lit(now)), hours))).alias("next_eligible_at"),
        F.lit(now).alias("updated_at"),
        (F.coalesce("__n", F.lit(0)) + 1).cast("long").alias("attempts_total"),
        row.cast("long").alias("consecutive_failures"),
    )
    return upsert(retries.select(new.columns), new, ["item_id"])

__all__ = ["cooled_down", "first_of_few", "first_per_key", "fold_retries", "insert_if_absent", "next_retries", "unprocessed", "upsert"]
