"""Checks for settings: the driver's side of a run, no DataFrame."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from feedloom.sources.catalog import load_yaml
from feedloom.sources.fetching import Policy


class ConfigError(ValueError):
    """A setting that is missing or of the wrong kind."""


def section(data: Mapping[str, Any], name: str) -> Mapping[str, Any]:
    value = data.get(name)
    if not isinstance(value, Mapping):
        raise ConfigError(f"{name} must be a mapping")
    return value


def whole(data: Mapping[str, Any], name: str, least: int = 0, most: int | None = None) -> int:
    """A whole number; booleans are none."""
    value = data.get(name)
    if type(value) is not int or value < least or (most is not None and value > most):
        raise ConfigError(f"{name} must be a whole number from {least}" + (f" to {most}" if most is not None else ""))
    return value


def number(data: Mapping[str, Any], name: str, above: float = 0.0) -> float:
    value = data.get(name)
    if type(value) not in (int, float) or not value > above:
        raise ConfigError(f"{name} must be a number above {above}")
    return float(value)


def text(data: Mapping[str, Any], name: str) -> str:
    value = data.get(name)
    if not isinstance(value, str) or not value.strip():
        raise ConfigError(f"{name} must be a text that is not blank")
    return value.strip()


def flag(data: Mapping[str, Any], name: str) -> bool:
    value = data.get(name)
    if type(value) is not bool:
        raise ConfigError(f"{name} must be true or false")
    return value


def texts(data: Mapping[str, Any], name: str) -> list[str]:
    value = data.get(name)
    if not isinstance(value, list) or not all(isinstance(x, str) and x.strip() for x in value):
        raise ConfigError(f"{name} must be a list of texts")
    if len({x.strip().lower() for x in value}) < len(value):
        raise ConfigError(f"{name} must not repeat itself")
    return [x.strip().lower() for x in value]


def optional_text(env: Mapping[str, str], name: str) -> str | None:
    """A setting of the environment, stripped; blank counts as unset."""
    value = (env.get(name) or "").strip()
    return value or None


def optional_number(env: Mapping[str, str], name: str) -> float | None:
    """A positive number of the environment, None if it is unset."""
    value = optional_text(env, name)
    if value is None:
        return None
    try:
        return number({name: float(value)}, name)
    except ValueError as e:
        raise ConfigError(f"{name} must be a number above 0") from e


def override(value: object, name: str) -> int | None:
    """A whole number from 0 given on a command line, or None."""
    if value is None:
        return None
    if isinstance(value, str) and value.strip().isdigit():
        value = int(value.strip())
    return whole({name: value}, name)


@dataclass(frozen=True)
class NewsletterPolicy:
    quota: int
    least_score: int
    trusted: tuple[str, ...]
    bypass: bool


def newsletter_policy(data: Mapping[str, Any], most: int) -> NewsletterPolicy:
    p = section(data, "newsletter_policy")
    out = NewsletterPolicy(whole(p, "min_candidates_per_run"), whole(p, "min_relevance_score"), tuple(texts(p, "trusted_source_ids")), flag(p, "trusted_sources_bypass_score"))
    if out.quota > most:
        raise ConfigError(f"min_candidates_per_run must be at most {most}")
    return out


@dataclass(frozen=True)
class SelectionPolicy:
    floor_first: int
    floor_second: int
    cap: int
    diversity: bool


def selection_policy(data: Mapping[str, Any], most: int) -> SelectionPolicy:
    p = section(data, "selection_policy")
    out = SelectionPolicy(whole(p, "min_newsletters_per_run"), whole(p, "min_youtube_per_run"), whole(p, "max_items_per_source", 1), flag(p, "source_diversity_first_pass"))
    if out.floor_first + out.floor_second > most:
        raise ConfigError(f"the floors together must be at most {most}")
    return out


@dataclass(frozen=True)
class CooldownPolicy:
    enabled: bool
    after: int
    hours: int
    reasons: tuple[str, ...]


def cooldown_policy(data: Mapping[str, Any], allowed: Sequence[str]) -> CooldownPolicy:
    """``allowed`` are the failures of enrichment; a row that fails the checks itself never cools down."""
    p = section(data, "cooldown_policy")
    value = p.get("reasons")
    if not isinstance(value, list) or not value or not all(isinstance(x, str) and x.strip() for x in value):
        raise ConfigError("reasons must be a list of texts that is not empty")
    reasons = tuple(x.strip() for x in value)
    if len(set(reasons)) < len(reasons):
        raise ConfigError("reasons must not repeat itself")
    unknown = sorted(set(reasons) - (set(allowed) - {"invalid_candidate_row"}))
    if unknown:
        raise ConfigError(f"no reasons to cool down: {', '.join(unknown)}")
    return CooldownPolicy(flag(p, "enabled"), whole(p, "after_consecutive_failures", 1), whole(p, "skip_for_hours"), reasons)


@dataclass(frozen=True)
class ModelConfig:
    provider: str
    model: str
    per_minute: int
    attempts: int
    first_s: float
    factor: float
    most_s: float


def model_config(data: Mapping[str, Any]) -> ModelConfig:
    p = section(data, "llm")
    return ModelConfig(text(p, "provider"), text(p, "model"), whole(p, "requests_per_minute_soft", 1), whole(p, "retry_max_attempts", 1), number(p, "retry_backoff_initial_s"), number(p, "retry_backoff_multiplier"), number(p, "retry_backoff_max_s"))


@dataclass(frozen=True)
class SheetConfig:
    enabled: bool
    spreadsheet: str
    worksheet: str
    key: str
    header_row: int


def sheet_config(data: Mapping[str, Any]) -> SheetConfig:
    p = section(data, "sheets")
    on = flag(p, "enabled")
    return SheetConfig(on, text(p, "spreadsheet_id") if on else "", text(p, "worksheet_name") if on else "", text(p, "key_column"), whole(p, "header_row", 1))


@dataclass(frozen=True)
class DeliverConfig:
    enabled: bool
    channel: str
    dry_run: bool
    most_items: int
    min_rating: int | None
    most_chars: int


def deliver_config(data: Mapping[str, Any]) -> DeliverConfig:
    p = section(data, "deliver")
    rating = None if p.get("min_viral_rating") is None else whole(p, "min_viral_rating", 1, 10)
    return DeliverConfig(flag(p, "enabled"), text(p, "channel"), flag(p, "dry_run"), whole(p, "max_items_default"), rating, whole(p, "max_script_chars", 1))


@dataclass(frozen=True)
class RunConfig:
    """Settings of ingestion: where things lie, how much of a feed counts, how documents are fetched."""

    database: str
    outputs: str
    recency_days: int | None
    per_source: int
    http: Policy


def run_config(data: Mapping[str, Any]) -> RunConfig:
    paths, caps, http = section(data, "paths"), section(data, "caps"), section(data, "http")
    days = None if caps.get("recency_days") is None else whole(caps, "recency_days")
    policy = Policy(text(http, "user_agent"), number(http, "connect_timeout_s"), number(http, "read_timeout_s"), whole(http, "max_response_mb", 1), whole(section(http, "retries"), "max_attempts", 1))
    return RunConfig(text(paths, "sqlite_db"), text(paths, "outputs_dir"), days, whole(caps, "max_entries_per_source", 1), policy)


def load(path: str) -> Mapping[str, Any]:
    """A mapping from a JSON file, or a YAML one where the yaml package is there."""
    if path.endswith(".json"):
        with open(path, encoding="utf-8") as f:
            data = json.load(f)
    else:
        data = load_yaml(path)
    if not isinstance(data, dict):
        raise ConfigError(f"{path}: not a mapping")
    return data


def dated_path(folder: str, prefix: str, run_ts: str, suffix: str, given: str | None = None) -> str:
    """Where a run's output goes: the path given, else ``<prefix>_<date><suffix>`` in the folder."""
    return given or f"{folder.rstrip('/')}/{prefix}_{run_ts[:10]}{suffix}"


def template(path: str) -> str:
    """A prompt's text; empty files are an error."""
    with open(path, encoding="utf-8") as f:
        out = f.read()
    if not out.strip():
        raise ConfigError(f"prompt is empty: {path}")
    return out
