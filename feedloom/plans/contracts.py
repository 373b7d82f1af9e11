"""Table contracts: columns and types, and what must hold of their rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Contract:
    name: str
    key: tuple[str, ...]
    text: tuple[str, ...]
    whole: tuple[str, ...] = ()
    nullable: tuple[str, ...] = ()

    @property
    def schema(self) -> T.StructType:
        fields = [T.StructField(c, T.StringType(), c in self.nullable) for c in self.text]
        return T.StructType([*fields, *[T.StructField(c, T.LongType(), False) for c in self.whole]])


_ENTRY = ("source_type", "source_id", "source_name", "creator", "title", "url", "published_at", "fetched_at")
# Columns of the tables.
CONTRACTS = {
    c.name: c
    for c in (
        Contract("seen_items", ("dedup_key",), ("dedup_key", "external_id", "url", "source_type", "source_id", "published_at", "first_seen_at")),
        Contract("items", ("item_id",), ("item_id", "external_id", *_ENTRY, "summary", "content_text", "raw_item_json", "inserted_at")),
        Contract("candidates", ("item_id",), ("item_id", *_ENTRY, "matched_keywords", "content_text", "created_at"), ("relevance_score",)),
        Contract("enriched_items", ("item_id",), ("item_id", "source_type", "url", "title", "published_at", "enriched_text", "evidence_snippets", "enrichment_method", "enriched_at", "inserted_at")),
        Contract("enrich_retry_state", ("item_id",), ("item_id", "source_type", "source_id", "last_outcome", "last_fail_reason", "last_attempt_at", "next_eligible_at", "updated_at"), ("attempts_total", "consecutive_failures"), ("last_fail_reason", "next_eligible_at")),
        Contract(
            "ideas",
            ("item_id",),
            ("item_id", "source_type", "url", "title", "published_at", "topic", "core_claim", "workflow_steps", "tools_mentioned", "monetization_angle", "metrics_claims", "assumptions", "content_type", "rating_rationale", "hooks", "platform", "recommended_format", "llm_provider", "llm_model", "created_at"),
            ("viral_rating",),
        ),
        Contract("scripts", ("item_id",), ("item_id", "platform", "recommended_format", "primary_hook", "alt_hooks", "script_sections", "cta", "disclaimer", "llm_provider", "llm_model", "created_at"), ("word_count", "estimated_seconds")),
        Contract("deliveries", ("item_id", "channel", "webhook_hash"), ("item_id", "channel", "webhook_hash", "sent_at")),
    )
}


def missing_columns(df: DataFrame, c: Contract) -> list[str]:
    """Columns the contract names that ``df`` lacks or has with another type. Others are allowed."""
    have = {f.name: f.dataType for f in df.schema}
    ok = lambda f: f.name in have and (have[f.name] == f.dataType or (isinstance(f.dataType, T.LongType) and isinstance(have[f.name], T.IntegerType)))
    return [f.name for f in c.schema if not ok(f)]


def violations(df: DataFrame, c: Contract) -> DataFrame:
    """(rule, n): nulls per required column and rows beyond the first per key, zeros included."""
    required = [x for x in (*c.text, *c.whole) if x not in c.nullable and x in df.columns]
    nulls = df.agg(*[F.count_if(F.col(x).isNull()).alias(x) for x in required])
    nulls = nulls.select(F.explode(F.array(*[F.struct(F.lit(f"null {x}").alias("rule"), F.col(x).alias("n")) for x in required])).alias("v")).select("v.*")
    dup = df.groupBy(*c.key).agg(F.count("*").alias("k")).agg(F.coalesce(F.sum(F.col("k") - 1), F.lit(0)).alias("n")).select(F.lit("duplicate key").alias("rule"), "n")
    return nulls.unionByName(dup)


def ensure(spark: SparkSession, path: str, c: Contract) -> DataFrame:
    """The table at ``path``, created empty if it is not there."""
    try:
        return spark.read.parquet(path)
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
    spark.createDataFrame([], c.schema).write.parquet(path)
    return spark.read.parquet(path)


class ContractError(ValueError):
    """A table that breaks its contract."""


def check(df: DataFrame, c: Contract) -> DataFrame:
    """``df`` if it has the contract's columns and types, no null where none may be, and unique keys."""
    lacking = missing_columns(df, c)
    if lacking:
        raise ContractError(f"{c.name}: columns lacking or of another type: {', '.join(lacking)}")
    bad = violations(df, c).where("n > 0").orderBy("rule").collect()
    if bad:
        raise ContractError(f"{c.name}: " + ", ".join(f"{r.rule} ({r.n})" for r in bad))
    return df


def insert_strictly(new: DataFrame, state: DataFrame, c: Contract) -> DataFrame:
    """The rows to append to ``state``; a key that is there already, or twice in ``new``, is an error."""
    keys = list(c.key)
    twice = new.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").select(*keys)
    clash = new.select(*keys).join(state.select(*keys), keys, "left_semi").unionByName(twice).first()
    if clash is not None:
        raise ContractError(f"{c.name}: key given twice: {tuple(clash)}")
    return new.select(*[f.name for f in c.schema])
