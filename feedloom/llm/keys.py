"""Canonical spellings of source ids, page addresses and external ids, as Columns.

They give NULL for null and blank values, so that such values never match anything.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions.text import INVISIBLE, PYWS, col

#: Query parameters that name how a reader came to a page, not the page (fixed values).
TRACKING = r"(?i)^(utm_\w+|fbclid|gclid|dclid|msclkid|igshid|mc_cid|mc_eid|ref|ref_src|source|share_id|si|feature)(=|$)"
#: Hosts of videos: the short form has the id as its path (fixed values).
VIDEO_HOSTS = ("vidtube.example",)
SHORT_VIDEO_HOSTS = ("vdtu.example",)


def _clean(c: str | Column) -> Column:
    return F.nullif(F.regexp_replace(col(c), f"{PYWS}+|{INVISIBLE}+", ""), F.lit(""))


def squash(c: str | Column) -> Column:
    """An id as a reader takes it: letters and digits only, lower case."""
    return F.nullif(F.regexp_replace(F.lower(col(c)), r"[^\p{L}\p{N}]+", ""), F.lit(""))


def spelled_source(df: DataFrame, source_id: str, sources: DataFrame, out: str) -> DataFrame:
    """``df`` with ``out``: the catalogue's id that ``source_id`` spells, NULL if none.

    The catalogue is the fixed list of sources; Spark broadcasts it while it is small.
    """
    names = sources.select(F.col("source_id").alias(out), squash("source_id").alias("__squash"))
    names = names.groupBy("__squash").agg(F.min(out).alias(out))
    return df.withColumn("__squash", squash(source_id)).join(names, "__squash", "left").drop("__squash")


def _unreserved(c: Column) -> Column:
    """Percent escapes: those of unreserved characters decoded, the others in capitals."""
    # Only when an escape is present: split before each '%', decode piece by piece.
    pieces = F.split(c, "(?=%[0-9A-Fa-f]{2})")

    def one(p: Column) -> Column:
        code = F.upper(F.substring(p, 2, 2))
        ch = F.decode(F.unhex(code), "ISO-8859-1")
        return F.when(p.rlike("^%[0-9A-Fa-f]{2}"), F.concat(F.when(ch.rlike(r"^[A-Za-z0-9._~-]$"), ch).otherwise(F.concat(F.lit("%"), code)), F.substring(p, 4, 1_000_000))).otherwise(p)

    return F.when(c.contains("%"), F.array_join(F.transform(pieces, one), "")).otherwise(c)


def with_page_key(df: DataFrame, text: str, out: str, *, tracking: str = TRACKING, video_hosts: Sequence[str] = VIDEO_HOSTS, short_hosts: Sequence[str] = SHORT_VIDEO_HOSTS) -> DataFrame:
    """``df`` with ``out``: the page that the address in ``text`` names, whatever its spelling.

    Scheme, user, port, ``www.``/``m.``, fragment, closing slashes, tracking parameters, the order
    of the others, needless percent escapes and the case of the host don't count; the case of path
    and query does. All forms of a video's address give ``video:<id>``. The steps are columns of
    their own so that each is computed once. ``tracking`` matches the parameters that count nowhere;
    sites that tell pages apart by one of these names need a narrower pattern.
    """
    keep = df.columns
    df = df.withColumn("__u", F.regexp_replace(F.regexp_replace(_clean(F.replace(F.col(text), F.lit("&amp;"), F.lit("&"))), r"(?i)^([a-z][a-z0-9+.-]*:)?//", ""), r"#.*$", ""))
    df = df.withColumns({"__authority": F.regexp_extract("__u", r"^([^/?]*)", 1), "__path": _unreserved(F.regexp_extract("__u", r"^[^/?]*([^?]*)", 1)), "__query": F.regexp_extract("__u", r"^[^?]*\?(.*)$", 1)})
    df = df.withColumns(
        {
            "__host": F.regexp_replace(F.regexp_replace(F.lower("__authority"), r"^.*@|(:\d*)+$|\.$", ""), r"^((www|m|amp)\.)+", ""),
            "__path": F.regexp_replace(F.regexp_replace("__path", "/{2,}", "/"), r"(/index\.(html?|php))?/*$", ""),
            "__pairs": F.when(F.col("__query") != "", F.array_sort(F.filter(F.split("__query", "&"), lambda p: (p != "") & ~p.rlike(tracking)))),
        }
    )
    video = (
        F.when(F.col("__host").isin(*short_hosts), F.regexp_extract("__path", r"^/([^/]+)", 1))
        .when(F.col("__host").isin(*video_hosts) & (F.col("__path") == "/watch"), F.regexp_extract(F.concat(F.lit("&"), "__query"), r"&v=([^&]+)", 1))
        .when(F.col("__host").isin(*video_hosts), F.regexp_extract("__path", r"^/(?:embed|shorts|live|v|e)/([^/]+)$", 1))
    )
    df = df.withColumn("__video", video)
    page = F.concat("__host", "__path", F.when(F.size("__pairs") > 0, F.concat(F.lit("?"), F.array_join("__pairs", "&"))).otherwise(""))
    return df.withColumn(out, F.when(F.length("__video") > 0, F.concat(F.lit("video:"), "__video")).otherwise(F.nullif(page, F.lit("")))).select(*keep, out)


def with_entry_key(df: DataFrame, text: str, page: str, out: str) -> DataFrame:
    """``df`` with ``out``: the entry that the external id ``text`` names within its source.

    ``page`` is the same text's page key, which stands if the id is an address. Prefixes, braces and
    hyphens of UUIDs and the case of hexadecimal ids and tag hosts don't count, nor ``#``, ``post-``
    or leading zeros before a number; the case of video ids does.
    """
    keep = df.columns
    df = df.withColumn("__e", _clean(text))
    df = df.withColumns(
        {
            "__video": F.regexp_extract("__e", r"^(?:(?i:vt):)?(?:(?i:video):)?([A-Za-z0-9_-]{11})$", 1),
            "__hex": F.regexp_replace(F.regexp_replace(F.lower("__e"), r"^urn:uuid:", ""), r"[{}-]", ""),
            "__tag": F.regexp_replace("__e", r"(?i)^urn:(?=tag:)", ""),
            "__number": F.regexp_extract("__e", r"(?i)^(?:#|post-|post:|p=|id:)?0*(\d+)$", 1),
        }
    )
    key = (
        F.when(F.col("__e").contains("//"), F.col(page))
        .when(F.col("__number") != "", F.col("__number"))
        .when(F.col("__hex").rlike("^[0-9a-f]{16,}$"), F.col("__hex"))
        .when(F.col("__video") != "", F.concat(F.lit("video:"), "__video"))
        .when(F.col("__tag").rlike("(?i)^tag:"), F.concat(F.lower(F.regexp_extract("__tag", r"^([^,]*)", 1)), F.regexp_extract("__tag", r"^[^,]*(.*)$", 1)))
        .otherwise(F.col("__e"))
    )
    return df.withColumn(out, key).select(*keep, out)
