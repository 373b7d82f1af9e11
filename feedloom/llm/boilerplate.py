"""Problem 3: the article of a page without menus, notices, side blocks and footers.

Pages of one host are streams of lines, lines are streams of tokens. Aligning a host's streams, as in
the inference of union-free regular expressions, gives its *wrapper*:

* a line whose tokens match on several pages is an invariant of the wrapper, optional if not on all;
* lines that match at both ends and differ between are one line with a *text slot*, if they are no
  sentence or list point, and many of the lines of that start end so;
* lines that match only at their start, with ever other ends, are open: headings and list points of
  articles look so, and are not part of the wrapper;
* runs of lines of one kind after an invariant header (teasers under "keep reading") are a repeated
  group that ends where the article's sentences go on.

A line whose tokens also occur as one sentence among others in a paragraph belongs to the articles,
however often it stands alone. Alignment is done by mergeable aggregates (counts per host and line
or line ends), so a host with a third of all pages is aggregated like others and every page counts.
Slots that are whole sentences are read as furniture only if their fixed tokens are those of a notice,
an advert, a note on author or publisher and the like (the cue lists below, general wording in the
corpus's languages), as articles repeat their sentences with other words in just the same way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feedloom import storage
from feedloom.functions.text import collapse, py_strip
from feedloom.llm import keys as K

#: Pages on which a line must match to be an invariant, and the share of the host's pages.
LEAST_PAGES, LEAST_SHARE = 3, 0.002
#: A line start with so many different ends is open; a line of it counts only on this share of all pages, or
#: as this share of all lines of the start.
OPEN_ENDS, SURE_SHARE, OWN_SHARE = 6, 0.03, 0.3
#: Times a line stands in paragraphs of its host, by times it stands alone, from which it is the article's.
BODY_SHARE = 0.1
#: Share of the lines with one start that must have one end to be lines with a text slot.
SLOT_SHARE = 0.05

# Cues (fixed values), matched in the lower-cased line with digits masked as '#'.
CONSENT = r"(cookie|consent|tracker|traceur|in your browser|asks for your permission|data notice|scripts are blocked|on your device|datenschutz|your privacy).*(accept|akzeptieren|accepter|aceptar|allow|reject|manage|preferences|got it|\bok$|save$|read on\.$|nur notwendige|continuer|never$|choices)"
SIGNUP = r"(sign up$|^sign in\b|\bsubscribe$|unsubscribe|enter your email|become a member for|in your inbox|leave the list|manage preferences|view in browser|update profile|^log in\b|create account|you receive this because)"
LEGAL = r"(©|^copyright #|all rights reserved\.?$|^privacy\b|^terms\b|^legal\b|privacy policy|imprint$|sitemap|is published from|^made with care by|advertise with us)"
SOCIAL = r"(^share\b.*(tweet|email|link|print)|^like \(#\)|^follow .* on (every network|\w+)$|copy link$|^back to top$|^leave a reply$|^report a mistake$|^#\+? comments?$|^f in x @$)"
ADVERT = r"(^sponsored by|^advertisement$|^advertise|^anzeige$|^publicidad$|^publicité$|try it free|save your seat|reserve a place|^from the shop|percent off$|^poll: .*\byes no\b|^free webinar|not sure$|partner content$|brought to you by|^watch: #+ minutes)"
AUTHOR = r"(^written by [^.]*\.? ?[^.]*(who answers|writes)|^about the author|\bhas (edited|written|run) .{1,60} since #+\.?$)"
META = r"(^#+ min read$|^listen to this article|^last updated|^published # (hours|minutes|days) ago|\bby staff$|^skip to content$|^menu search$|– front page$)"
NAVIGATION = r"( » | → |^← |^menu$)"
#: Headers of repeated groups of teasers.
TEASERS = r"^(keep reading|most read|you may also like|related posts|related articles|more from .{1,60}|popular this week|popular posts|read next|read more|recommended|trending)$"
CUES = "|".join((CONSENT, SIGNUP, LEGAL, SOCIAL, ADVERT, AUTHOR, META, NAVIGATION))
#: Every line that matches CUES holds one of these, so others, such as most paragraphs, need no search by patterns.
CUE_PARTS = (
    *("cookie", "consent", "tracker", "traceur", "in your browser", "asks for your permission", "data notice", "scripts are blocked", "on your device", "datenschutz"),
    *("sign up", "sign in", "subscribe", "enter your email", "become a member for", "in your inbox", "leave the list", "manage preferences", "view in browser", "update profile", "log in", "create account", "you receive this because"),
    *("©", "copyright #", "all rights reserved", "privacy", "terms", "legal", "imprint", "sitemap", "is published from", "made with care by", "advertise"),
    *("share", "like (#)", "follow ", "copy link", "back to top", "leave a reply", "report a mistake", " comment", "f in x @"),
    *("sponsored by", "anzeige", "publicidad", "publicité", "try it free", "save your seat", "reserve a place", "from the shop", "percent off", "poll: ", "free webinar", "not sure", "partner content", "brought to you by", "watch: #"),
    *("written by", "about the author", " since #"),
    *("min read", "listen to this article", "last updated", "published #", "by staff", "skip to content", "menu", "– front page"),
    *(" » ", " → ", "← "),
)
#: Several short parts with separators and no sentence: a menu written in one line.
MENU = r"^[\p{L}\p{N}&' -]{1,25}( ?[|·/•] ?[\p{L}\p{N}&' -]{1,25})+$|^\p{Lu}\p{L}+(  +\p{Lu}\p{L}+)+$"
#: What teasers carry behind their titles.
TEASER_TAIL = r" ?(\(#+ comments?\)|· #+ min)$|…$|\.\.\.$"
SENTENCE_END = r"[.!?:;][\"'”’)]*$"


#: Of lines longer than this, a hash and the words at both ends are shuffled instead of the text.
LONGEST = 240


def matched() -> Column:
    """What a line is matched by: its key, of a long line its two words at either end and a 64-bit hash of it."""
    brief = F.concat_ws(" ", head("key"), F.concat(F.lit("¶"), F.hex(F.xxhash64("key"))), tail("key"))
    return F.when(F.length("key") > LONGEST, brief).otherwise(F.col("key"))


def distinct_pages(pages: DataFrame) -> DataFrame:
    """(page, field, item_id, host, text): ``pages(field, item_id, url, text)`` without null texts;
    rows of equal field, id and text are one page. Pages without address share the host ''."""
    p = pages.where("text IS NOT NULL").withColumn("page", F.xxhash64("field", "item_id", "text"))
    p = p.groupBy("page").agg(F.min("field").alias("field"), F.min("item_id").alias("item_id"), F.min("url").alias("url"), F.min("text").alias("text"))
    p = K.with_page_key(p, "url", "__page").withColumn("host", F.coalesce(F.regexp_extract("__page", r"^([^/?]*)", 1), F.lit("")))
    return p.select("page", "field", "item_id", "host", "text")


def page_lines(pages: DataFrame) -> DataFrame:
    """(page, host, line_no, key, and what the line itself shows) of every non-blank line, however long.

    key is the line in lower case, white space collapsed, runs of digits as '#'.
    """
    rows = pages.select("page", "host", F.posexplode(F.split("text", "\n")).alias("at", "raw"))
    rows = rows.withColumn("line", collapse("raw")).withColumn("key", F.regexp_replace(F.lower("line"), r"\d+", "#"))
    part = F.exists(F.array(*map(F.lit, CUE_PARTS)), lambda x: F.col("key").contains(x))
    cue, header = part & F.col("key").rlike(CUES), F.col("key").rlike(TEASERS)
    tailed, cut_off = F.col("key").rlike(TEASER_TAIL), F.col("key").rlike(r"(…|\.\.\.)$")
    ended = F.col("line").rlike(SENTENCE_END) & ~cut_off
    menu = (F.col("line").rlike(r"[|·/•]") | F.col("raw").rlike(r"\S {2,}\S")) & F.trim("raw").rlike(MENU) & ~ended
    point = F.col("line").rlike(r"^([-*•]|\d+[.)]) ") | F.col("key").rlike(r"^(step|part) #") | F.col("key").rlike(r"^\S+( \S+){0,2}, \S+$")
    return rows.select("page", "host", (F.col("at") + 1).alias("line_no"), "key", (cue | header | menu).alias("shown"), header.alias("header"), tailed.alias("tailed"), ended.alias("ended"), point.alias("point")).where("key <> ''")


def aligned(lines: DataFrame) -> DataFrame:
    """(host, key, on, prose, head, tail): a host's lines, equal ones as one, and on how many lines of pages.

    key is as of :func:`matched`, head and tail are those of the line.
    A line that only one page has, however often, is on one. Sentences and list points are prose.
    """
    same = lines.withColumn("key", matched()).groupBy("host", "key").agg(F.count("*").alias("n"), (F.min("page") < F.max("page")).alias("several"), F.max(F.col("ended") | F.col("point")).alias("prose"))
    return same.select("host", "key", F.when(F.col("several"), F.col("n")).otherwise(1).alias("on"), "prose", head("key").alias("head"), tail("key").alias("tail"))


def invariants(lines: DataFrame) -> DataFrame:
    """(host, key): the lines of each host's wrapper, matching as a whole or around a text slot."""
    same = storage.cut(aligned(lines))
    size = storage.cut(lines.groupBy("host").agg(F.approx_count_distinct("page", 0.02).alias("pages")))
    often = same.join(size, "host").where((F.col("on") >= LEAST_PAGES) & (F.col("on") >= LEAST_SHARE * F.col("pages")))
    # Starts with ever other ends are open: headings and list points of articles.
    open_ = same.groupBy("host", "head").agg(F.countDistinct("tail").alias("ends"), F.sum("on").alias("all")).where(F.col("ends") >= OPEN_ENDS)
    found = often.join(open_, ["host", "head"], "left").where(F.col("ends").isNull() | (F.col("on") >= SURE_SHARE * F.col("pages")) | (F.col("on") >= OWN_SHARE * F.col("all")))
    found = storage.cut(found.select("host", "key", "on"))
    # Evidence for the articles: the line as one sentence among others of its host.
    spoken = sentences(lines).join(storage.small_side(found, found.count()), ["host", "key"])
    body = spoken.groupBy("host", "key").agg(F.count("*").alias("n"), F.first("on").alias("on")).where(F.col("n") >= BODY_SHARE * F.col("on"))
    whole = found.join(body, ["host", "key"], "left_anti").select("host", "key")
    return storage.cut(whole.unionByName(slotted(lines, same, size)).distinct())


def slotted(lines: DataFrame, same: DataFrame, size: DataFrame) -> DataFrame:
    """(host, key): the lines of each host that match at both ends around a text slot, and are furniture.

    On at least LEAST_PAGES pages and LEAST_SHARE of them, filled differently, never prose; and the end
    is that of SLOT_SHARE of all lines of the start, for headings of one start end ever otherwise.
    """
    ends = ["host", "head", "tail"]
    by_ends = storage.cut(same.groupBy(ends).agg(F.sum("on").alias("on"), F.count("*").alias("fillings"), F.max("prose").alias("prose")))
    starts = by_ends.groupBy("host", "head").agg(F.sum("on").alias("all"))
    likely = by_ends.where((F.col("on") >= LEAST_PAGES) & (F.col("fillings") >= 2) & ~F.col("prose") & (F.col("head") != F.col("tail")))
    likely = likely.join(starts, ["host", "head"]).where(F.col("on") >= SLOT_SHARE * F.col("all")).select(ends)
    mine = storage.cut(same.select("key", *ends).join(likely, ends))
    # A page may have several lines of one kind, so its pages are counted.
    on = lines.select("page", "host", matched().alias("key")).join(storage.small_side(mine, mine.count()), ["host", "key"])
    pages = on.groupBy(ends).agg(F.countDistinct("page").alias("on")).join(size, "host")
    sure = pages.where((F.col("on") >= LEAST_PAGES) & (F.col("on") >= LEAST_SHARE * F.col("pages"))).select(ends)
    return mine.join(sure, ends).select("host", "key")


def slots(lines: DataFrame) -> DataFrame:
    """(host, head, tail, on, fillings): lines of each host that match at both ends around a text slot."""
    ends = aligned(lines).groupBy("host", "head", "tail").agg(F.sum("on").alias("on"), F.count("*").alias("fillings"))
    return ends.where((F.col("on") >= 2) & (F.col("fillings") >= 2))


def head(key: str) -> Column:
    # Keys have single blanks, none at the ends.
    return F.substring_index(key, " ", 2)


def tail(key: str) -> Column:
    return F.substring_index(key, " ", -2)


def sentences(lines: DataFrame) -> DataFrame:
    """(host, key): the sentences of lines that hold several, as of :func:`matched`."""
    parts = F.split("key", r"(?<=[.!?]) +")
    every = lines.select("host", parts.alias("parts")).select("host", F.explode(F.when(F.size("parts") > 2, F.col("parts"))).alias("key"))
    return every.select("host", matched().alias("key"))


def furniture(pages: DataFrame) -> DataFrame:
    """(page, line_no, outside) of every non-blank line of ``pages``, as of :func:`distinct_pages`.

    A text that is all article has no line outside, one that is all furniture only such; an empty
    table gives none.
    """
    lines = storage.cut(page_lines(pages))
    inv = invariants(lines).withColumn("invariant", F.lit(True))
    own = lines.withColumn("key", matched()).join(storage.small_side(inv, inv.count()), ["host", "key"], "left").drop("host", "key")
    # Only small columns are shuffled to bring each page's lines together.
    every = W.partitionBy("page")
    # A text of one line is no stream to align.
    plain = F.col("shown") | (F.coalesce("invariant", F.lit(False)) & (F.count("*").over(every) > 1))
    own = own.withColumn("plain", plain)
    # Repeated groups: from a header to the first line that is a sentence of the article.
    own = own.withColumn("block", F.last(F.when(F.col("header"), F.col("line_no")), True).over(every.orderBy("line_no")))
    stop = ((F.col("ended") & ~F.col("tailed")) | F.col("point")) & ~F.col("plain")
    stopped = F.max(F.when(stop, 1).otherwise(0)).over(W.partitionBy("page", "block").orderBy("line_no"))
    own = own.withColumn("stopped", stopped)
    teaser = F.col("block").isNotNull() & (F.col("stopped") == 0)
    return own.select("page", "line_no", (F.col("plain") | F.col("tailed") | teaser).alias("outside"))


def newsletter_pages(spark: SparkSession, d: str) -> DataFrame:
    """Pages of both fields; everything spoken in youtube rows belongs, so they have no line outside."""
    enriched = storage.table(spark, d, "enriched_items").select(F.lit("enriched_text").alias("field"), "item_id", "source_type", "url", F.col("enriched_text").alias("text"))
    items = storage.table(spark, d, "items").select(F.lit("content_text").alias("field"), "item_id", "source_type", "url", F.col("content_text").alias("text"))
    both = enriched.unionByName(items)
    return both.where(F.coalesce(F.lower(py_strip("source_type")), F.lit("")) != "youtube").drop("source_type")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    pages = storage.cut(distinct_pages(newsletter_pages(spark, d)))
    out = furniture(pages).where("outside").select("page", F.col("line_no").cast("int").alias("line_no"))
    return out.join(pages.select("page", "field", "item_id"), "page").select("field", "item_id", "line_no").distinct()


def p3_articles(spark: SparkSession, d: str) -> DataFrame:
    """(field, item_id, article): each page without the lines outside its article."""
    pages = storage.cut(distinct_pages(newsletter_pages(spark, d)))
    out = furniture(pages).where("outside").groupBy("page").agg(F.collect_set("line_no").alias("gone"))
    kept = F.filter(F.transform(F.split("text", "\n"), lambda x, i: F.when(~F.array_contains(F.coalesce("gone", F.array().cast("array<int>")), i + 1), x)), lambda x: x.isNotNull())
    return pages.join(out, "page", "left").select("field", "item_id", F.array_join(kept, "\n").alias("article"))


def p3_slots(spark: SparkSession, d: str) -> DataFrame:
    """The text slots of each host's wrapper, with how often and how variously they are filled."""
    return slots(page_lines(distinct_pages(newsletter_pages(spark, d))))


SQL: dict[str, str] = {}
