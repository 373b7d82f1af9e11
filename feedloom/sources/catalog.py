"""The list of sources, from a mapping as a YAML file holds it."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "source_id string, source_type string, name string, feed_url string, tags array<string>"


class CatalogError(ValueError):
    """A source list that cannot be used."""


def load_yaml(path: str) -> dict:
    """A YAML mapping; needs the optional yaml package."""
    try:
        import yaml
    except ImportError as e:
        raise CatalogError("reading YAML needs the yaml package; pass a mapping instead") from e
    with open(path, encoding="utf-8") as f:
        data = yaml.safe_load(f)
    if not isinstance(data, dict):
        raise CatalogError(f"{path}: not a mapping")
    return data


def catalog(spark: SparkSession, data: Mapping, channel_feed: str = "https://www.youtube.com/feeds/videos.xml?channel_id={}") -> DataFrame:
    """Sources with unique ids; feeds must be http(s); channels get their feed's address."""
    rows: list[tuple] = []
    for kind, field in (("newsletter", "feed_url"), ("youtube", "channel_id")):
        for entry in data.get("newsletters" if kind == "newsletter" else "youtube") or []:
            ident, name, where = (str(entry.get(k) or "").strip() for k in ("id", "name", field))
            if not (ident and name and where):
                raise CatalogError(f"{kind}: id, name and {field} must not be blank")
            url = channel_feed.format(where) if kind == "youtube" else where
            if not url.startswith(("http://", "https://")):
                raise CatalogError(f"{ident}: {field} must be http or https")
            tags = entry.get("tags") or []
            if not isinstance(tags, list) or not all(isinstance(t, str) and t.strip() for t in tags):
                raise CatalogError(f"{ident}: tags must be a list of strings")
            rows.append((ident, kind, name, url, [t.strip() for t in tags]))
    if len({r[0] for r in rows}) < len(rows):
        raise CatalogError("ids of sources must be unique")
    return spark.createDataFrame(rows, SCHEMA)
