"""Feed documents (RSS 2.0, Atom) to entry rows, parsed in the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions.text import collapse, non_blank
from feedloom.functions.times import feed_date, utc_z

RSS = "channel struct<author: string, item: array<struct<title: string, link: string, guid: string, description: string, author: string, pubDate: string>>>"
ATOM = "author struct<name: string>, entry array<struct<title: string, id: string, link: array<struct<_href: string, _rel: string>>, summary: string, author: struct<name: string>, published: string, updated: string>>"


def _clean(c: Column) -> Column:
    return F.coalesce(collapse(c), F.lit(""))


def entries(feeds: DataFrame, body: str = "body", fetched_at: str = "fetched_at") -> DataFrame:
    """One row per entry of ``feeds(source_type, source_id, source_name, fetched_at, body)``.

    Columns: feed_pos, creator, title, url, published_at, external_id, summary and those of the feed
    but the body. Documents that are no feed give no rows. Links without rel or with rel alternate
    count; ids fall back to guid, then to the hash of the url; dates to the time of fetching.
    """
    keep = [c for c in feeds.columns if c != body]
    text = F.regexp_replace(F.col(body).cast("string"), r"(?s)^\s*(<\?xml.*?\?>)?\s*", "")
    text = F.regexp_replace(text, r"\sxmlns(:\w+)?=\"[^\"]*\"", "")
    df = feeds.withColumn("__t", text)
    rss = df.where(F.col("__t").startswith("<rss")).withColumn("d", F.from_xml("__t", RSS, {"rowTag": "rss", "mode": "PERMISSIVE"}))
    rss = rss.select(*keep, F.col("d.channel.author").alias("__fa"), F.posexplode("d.channel.item").alias("feed_pos", "e"))
    rss = rss.select(*keep, "__fa", "feed_pos", F.col("e.title").alias("t"), F.col("e.link").alias("l"), F.lit(None).cast("string").alias("i"), F.col("e.guid").alias("g"), F.col("e.description").alias("s"), F.col("e.author").alias("a"), F.col("e.pubDate").alias("p"), F.lit(None).cast("string").alias("u"))
    atom = df.where(F.col("__t").startswith("<feed")).withColumn("d", F.from_xml("__t", ATOM, {"rowTag": "feed", "mode": "PERMISSIVE"}))
    atom = atom.select(*keep, F.col("d.author.name").alias("__fa"), F.posexplode("d.entry").alias("feed_pos", "e"))
    href = F.get(F.filter("e.link", lambda x: non_blank(x["_href"]).isNotNull() & (non_blank(x["_rel"]).isNull() | (collapse(x["_rel"]) == "alternate"))), F.lit(0))["_href"]
    atom = atom.select(*keep, "__fa", "feed_pos", F.col("e.title").alias("t"), href.alias("l"), F.col("e.id").alias("i"), F.lit(None).cast("string").alias("g"), F.col("e.summary").alias("s"), F.col("e.author.name").alias("a"), F.col("e.published").alias("p"), F.col("e.updated").alias("u"))
    both = rss.unionByName(atom).withColumns({"url": _clean(F.col("l")), "title": _clean(F.col("t")), "summary": _clean(F.col("s"))})
    name = F.col("source_name")
    creator = F.when(F.col("source_type") == "youtube", name).otherwise(F.coalesce(non_blank("a"), non_blank("__fa"), name))
    ident = F.coalesce(F.nullif(_clean(F.col("i")), F.lit("")), F.nullif(_clean(F.col("g")), F.lit("")), F.when(F.col("url") != "", F.sha2("url", 256)), F.lit(""))
    when = F.coalesce(utc_z(feed_date("p")), utc_z(feed_date("u")), F.col(fetched_at))
    return both.select(*keep, "feed_pos", creator.alias("creator"), "title", "url", when.alias("published_at"), ident.alias("external_id"), "summary")
