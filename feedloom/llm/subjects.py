"""Problem 8: the subjects of each document, by propagating labels over a verified graph.

The graph has segments of documents (sentences, long ones cut) on one side and phrases (words and pairs
of neighbouring words) on the other: two documents are similar as far as they share phrases. It is
kept in this factored form, document - phrase - document, as pairs of documents that share a common
phrase grow with the square of the collection. An edge is *verified* if its phrase keeps to one
subject: at least PURITY of the label mass of what it occurs in, and occurs often enough. Pairs of
words that occur with any subject though one of their words keeps to one ("in your court") are figures
of speech: they take back the votes of their words.

Labels are propagated by joins of tables until few change. A round joins the edges with the verified
phrases (a segment takes the subject that clearly leads among its phrases) and back (each segment gives
its phrases its own subject, or its document's shares if it has none). Trusted seeds, labels on which
several labellers agree, are clamped in every round. A document keeps every subject that makes up at
least SHARE of its words: one, several or none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom import storage
from feedloom.functions.text import PYWS

SHARE, PURITY, SUPPORT, LEAD = 0.2, 0.6, 3, 0.6
#: A pair of words below this purity, of at least this mass, is a figure of speech.
MIXED, MIXED_SUPPORT = 0.4, 8
#: Rounds end when at most this share of the documents gets other subjects, or after ROUNDS.
CHANGED, ROUNDS = 0.02, 8
#: Words of a segment at most.
SEGMENT = 20
WORD = r"([\p{L}\p{Nl}\p{No}]{3,})"
BREAK = rf"(?<=[.!?…]){PYWS}+|\n+"


def seeds(labels: DataFrame, subjects: list[str]) -> DataFrame:
    """(doc_id, given array<int>, trusted): subjects that at least half of a document's labellers give.

    A labeller who found none, or gave only unknown subjects, counts as one that gives none; doubled
    labels count once. trusted: two labellers or more, all giving the same.
    """
    index = F.array_position(F.array(*[F.lit(s) for s in subjects]), F.col("subject")) - 1 if subjects else F.lit(None).cast("int")
    df = labels.where("doc_id IS NOT NULL").select("doc_id", F.coalesce("labeller", F.lit("")).alias("labeller"), F.when(index >= 0, index.cast("int")).alias("s"))
    each = df.groupBy("doc_id", "labeller").agg(F.array_sort(F.collect_set("s")).alias("set"))
    doc = each.groupBy("doc_id").agg(F.count("*").alias("n"), F.countDistinct("set").alias("kinds"), F.flatten(F.collect_list("set")).alias("all"))
    often = F.filter(F.array_distinct("all"), lambda s: F.size(F.filter("all", lambda x: x == s)) * 2 >= F.col("n"))
    return doc.select("doc_id", often.alias("given"), ((F.col("n") > 1) & (F.col("kinds") == 1)).alias("trusted"))


def segments(docs: DataFrame) -> DataFrame:
    """(rid, seg, w array<int>): the segments of ``docs(rid, text)``, their words coded by 31 bits of a hash.

    Of v different words about v^2 / 2^32 pairs share a code and count as one word.
    """
    part = docs.select("rid", F.posexplode(F.split(F.lower("text"), BREAK)).alias("at", "part"))
    code = lambda w: F.xxhash64(w).bitwiseAND(F.lit(2**31 - 1)).cast("int")
    words = part.select("rid", "at", F.transform(F.regexp_extract_all("part", F.lit(WORD), F.lit(1)), code).alias("w")).where("size(w) > 0")
    cut = F.transform(F.sequence(F.lit(0), F.expr(f"cast((size(w) - 1) div {SEGMENT} as int)")), lambda i: F.slice("w", i * SEGMENT + 1, F.lit(SEGMENT)))
    return words.select("rid", "at", F.posexplode(cut).alias("k", "w")).select("rid", F.shiftleft(F.col("at").cast("long"), 32).bitwiseOR(F.col("k")).alias("seg"), "w")


def edges(segs: DataFrame, *keep: str) -> DataFrame:
    """(keep..., phrase): the different phrases of each segment, words and pairs of neighbours. The code of
    a pair holds those of both words; made here, as shuffling and storing words alone takes far less."""
    words = F.transform("w", lambda x: x.cast("long"))
    pairs = F.zip_with(F.slice("w", 1, F.size("w") - 1), F.slice("w", 2, F.size("w")), lambda a, b: F.shiftleft(a.cast("long"), 32).bitwiseOR(b.cast("long")))
    pairs = F.when(F.size("w") > 1, pairs).otherwise(F.array().cast("array<bigint>"))
    return segs.select(*keep, F.explode(F.array_distinct(F.concat(words, pairs))).alias("phrase"))


def mass(given: DataFrame, k: int) -> DataFrame:
    """(phrase, m): label mass of each phrase by subject, place k for none. ``given`` has edges
    with ``d``, k + 1 shares; sums are partial before the shuffle, so a common phrase is one row a task."""
    sums = F.array(*[F.sum(F.get("d", F.lit(i))) for i in range(k + 1)])
    return given.groupBy("phrase").agg(sums.alias("m"))


def votes(by: DataFrame, k: int) -> DataFrame:
    """(phrase, subject, weight): the verified edges' votes; figures of speech have negative ones."""
    n = F.aggregate("m", F.lit(0.0), lambda a, x: a + x)
    # The words of a pair; a lone word has no first one.
    a, b = F.expr("shiftrightunsigned(phrase, 32)"), F.col("phrase").bitwiseAND(F.lit(2**32 - 1))
    by = by.select("phrase", F.nullif(a, F.lit(0)).alias("a"), b.alias("b"), n.alias("n"), (F.array_position("m", F.array_max("m")) - 1).cast("int").alias("subject"), ((F.array_max("m") + 0.1) / (n + 1.1)).alias("weight"))
    by = storage.cut(by)
    kept = by.where((F.col("subject") < k) & (F.col("n") >= SUPPORT) & (F.col("weight") >= PURITY)).select("phrase", "subject", "weight", "a")
    figures = by.where(F.col("a").isNotNull() & (F.col("n") >= MIXED_SUPPORT) & ((F.col("subject") == k) | (F.col("weight") < MIXED)))
    word = kept.where("a IS NULL").select(F.col("phrase").alias("word"), "subject", "weight")
    back = figures.select("phrase", F.explode(F.array_distinct(F.array("a", "b"))).alias("word")).join(word, "word").select("phrase", "subject", -F.col("weight"))
    return storage.cut(kept.select("phrase", "subject", "weight").union(back))


def shares(segs: DataFrame, table: DataFrame, docs: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """((rid, seg, best), (rid, doc_id, given, trusted, h)): the subject of every segment in which one
    clearly leads, and of every document the share of its words in segments of each subject."""
    table = storage.small_side(table, table.count())
    hits = edges(segs.withColumn("n", F.size("w")), "rid", "seg", "n").join(table, "phrase")
    sums = F.array(*[F.greatest(F.lit(0.0), F.sum(F.when(F.col("subject") == i, F.col("weight")).otherwise(0.0))) for i in range(k)])
    led = hits.groupBy("rid", "seg").agg(F.first("n").alias("n"), sums.alias("v"))
    top = F.array_max("v")
    led = led.where((top > 0) & (top >= LEAD * F.aggregate("v", F.lit(0.0), lambda a, x: a + x)))
    led = storage.cut(led.select("rid", "seg", "n", (F.array_position("v", top) - 1).cast("int").alias("best")))
    words = led.groupBy("rid").agg(F.array(*[F.sum(F.when(F.col("best") == i, F.col("n")).otherwise(0)) for i in range(k)]).alias("h"))
    none = F.array_repeat(F.lit(0.0), k)
    h = F.coalesce(F.transform("h", lambda x: x / F.col("total")), none)
    return led.drop("n"), storage.cut(docs.join(words, "rid", "left").select("rid", "doc_id", "given", "trusted", h.alias("h")))


def kept_subjects(k: int) -> Column:
    """The subjects of a document of :func:`shares`: those given if trusted, else those of enough words."""
    return F.when(F.col("trusted"), F.array_sort("given")).otherwise(F.filter(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.get("h", i) >= SHARE - 1e-9))


def spread(segs: DataFrame, led: DataFrame, state: DataFrame, k: int) -> DataFrame:
    """:func:`mass` of all segments, each with its own subject or its document's shares."""
    size = F.size("given")
    own = F.transform(F.sequence(F.lit(0), F.lit(k)), lambda i: F.when(size == 0, (i == k).cast("double")).otherwise(F.array_contains("given", i).cast("double") / size))
    rest = F.greatest(F.lit(0.0), 1 - F.aggregate("h", F.lit(0.0), lambda a, x: a + x))
    whole = state.select("rid", F.when(F.col("trusted"), F.col("given")).alias("clamp"), F.when(F.col("trusted"), own).otherwise(F.concat("h", F.array(rest))).alias("whole"))
    one = F.transform(F.sequence(F.lit(0), F.lit(k)), lambda i: (i == F.col("best")).cast("double"))
    mine = F.col("best").isNotNull() & (F.col("clamp").isNull() | F.array_contains("clamp", F.col("best")))
    told = segs.join(led, ["rid", "seg"], "left").join(whole, "rid").select("w", F.when(mine, one).otherwise(F.col("whole")).alias("d"))
    return mass(edges(told, "d"), k)


def assign_subjects(documents: DataFrame, areas: DataFrame, labels: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, subject, share): the subjects of ``documents(doc_id, text)``, one, several or no row.

    Null, blank and wordless texts have none, unless trusted labels give some; rows with equal doc_id
    are looked at each and their results united. No labels or no areas give no rows. The list of areas
    fits the driver; documents, segments and phrases are tables that never do.
    """
    spark = documents.sparkSession
    subjects = [r.subject for r in areas.where("subject IS NOT NULL").select("subject").distinct().orderBy("subject").collect()]
    k = len(subjects)
    if not k:
        return spark.createDataFrame([], documents.select("doc_id").schema.add("subject", "string").add("share", "double"))
    given = storage.cut(seeds(labels, subjects))
    texts = storage.cut(documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("rid", F.monotonically_increasing_id()))
    segs = storage.cut(segments(texts))
    docs = texts.select("rid", "doc_id").join(segs.groupBy("rid").agg(F.sum(F.size("w")).alias("total")), "rid", "left")
    docs = docs.join(storage.small_side(given, given.count()), "doc_id", "left").select("rid", "doc_id", "total", "given", F.coalesce("trusted", F.lit(False)).alias("trusted"))
    docs = storage.cut(docs)
    # Seeds give their subjects to every phrase they have, once a document.
    size = F.size("given")
    own = F.transform(F.sequence(F.lit(0), F.lit(k)), lambda i: F.when(size == 0, (i == k).cast("double")).otherwise(F.array_contains("given", i).cast("double") / size))
    told = docs.where("given IS NOT NULL").select("rid", own.alias("d"))
    told = edges(segs.join(storage.small_side(told, told.count()), "rid"), "rid", "d")
    by = mass(told.groupBy("rid", "phrase").agg(F.first("d").alias("d")), k)
    led, state = shares(segs, votes(by, k), docs, k)
    total = max(docs.count(), 1)
    for _ in range(rounds - 1):
        before = state.select("rid", kept_subjects(k).alias("before"))
        led, state = shares(segs, votes(spread(segs, led, state, k), k), docs, k)
        if state.join(before, "rid").where(kept_subjects(k) != F.col("before")).count() <= CHANGED * total:
            break
    names = F.array(*[F.lit(x) for x in subjects])
    return state.select("doc_id", "h", F.explode(kept_subjects(k)).alias("i")).select("doc_id", F.get(names, F.col("i")).alias("subject"), F.get("h", F.col("i")).alias("share"))


def _all(spark: SparkSession, d: str) -> DataFrame:
    return assign_subjects(storage.table(spark, d, "documents"), storage.table(spark, d, "subject_areas"), storage.table(spark, d, "subject_labels"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return _all(spark, d).select("doc_id", "subject").distinct()


def p8_composition(spark: SparkSession, d: str) -> DataFrame:
    """(subject, n_docs, mean_share): the corpus by subject; documents of several count in each."""
    return _all(spark, d).groupBy("subject").agg(F.countDistinct("doc_id").alias("n_docs"), F.avg("share").alias("mean_share"))


SQL: dict[str, str] = {}
