"""Problem 2: groups of items that are the same piece with small changes.

Texts are sets of sequences of three successive words; two are linked if they share at least half of
all distinct sequences in either. Exact copies (equal word sequences) are one class first. Then:

1. *Fingerprints.* A text's fingerprint is the bitmap of its hashed sequences. Bits can only coincide,
   so the Hamming distance of two fingerprints is at most the number of sequences not shared, which for
   linked texts is at most a third of both sizes together: too large a distance disproves a link.
2. *Pivot distance tables.* The distances of each fingerprint to many reference fingerprints (slices of
   the bit space, the same for all data) are computed once. By the triangle inequality the largest
   difference of two rows of the table is at most the distance, and so discards pairs unseen.
3. *Verification.* Survivors are compared exactly by their sequences.

Pairs to look at come from agreeing minima of hashed sequences in one of BANDS bands of ROWS minima:
references alone cannot propose pairs, as all unrelated fingerprints lie about equally far from any
reference (see the README for figures). A pair at similarity s is proposed with probability
1 - (1 - s^ROWS)^BANDS. The distance to one reference, the empty set, is the size; it goes along with
every band, so that texts of which one has over twice the sequences of the other never become a pair.
Each text is split into words once: one pass gives its class, its minima and its fingerprint.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom import storage

WORDS = re.compile(r"[^\W_]+")
N = 3
LEAST_WORDS = 40
SIMILARITY = 0.5
BANDS, ROWS = 80, 5
BITS, PIVOTS = 512, 32
#: Steps of size in a doubling, and the step's place above the running number of a text.
SIZE_STEPS, SIZE_BIT = 8, 52
#: Items of a class in one chunk, by which :func:`every_pair` deals out the pairs of large classes.
CHUNK = 128

_rng = np.random.default_rng(20240501)
_A = _rng.integers(0, 2**32, BANDS * ROWS, dtype=np.int64).astype(np.uint32) | np.uint32(1)
_B = _rng.integers(0, 2**32, BANDS * ROWS, dtype=np.int64).astype(np.uint32)
_MIX = _rng.integers(1, 2**63, (BANDS, ROWS), dtype=np.int64).astype(np.uint64) | np.uint64(1)


def words(text: str) -> list[str]:
    return WORDS.findall(text.lower())


def mix64(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_known: dict[str, int] = {}


def word_code(w: str) -> int:
    c = _known.get(w)
    if c is None:
        if len(_known) > 2_000_000:
            _known.clear()
        c = _known[w] = int.from_bytes(hashlib.blake2b(w.encode(), digest_size=8).digest(), "little")
    return c


def sequences(ws: list[str]) -> np.ndarray:
    """Sorted distinct 64-bit codes of the sequences of N words."""
    if len(ws) < N:
        return np.zeros(0, np.uint64)
    c = np.fromiter((word_code(w) for w in ws), np.uint64, len(ws))
    n = len(c) - N + 1
    h = c[:n] * np.uint64(0x9E3779B97F4A7C15)
    for k in range(1, N):
        h = mix64(h + c[k : k + n] * np.uint64(2 * k + 1))
    return np.unique(h)


def minima(codes: np.ndarray) -> np.ndarray:
    """Least value of each hash function over the codes, in blocks of codes."""
    out = np.full(BANDS * ROWS, 2**32 - 1, np.uint32)
    short = (codes >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(short), 2048):
        np.minimum(out, (short[None, at : at + 2048] * _A[:, None] + _B[:, None]).min(1), out=out)
    return out.astype(np.uint64)


def bands(codes: np.ndarray) -> np.ndarray:
    m = minima(codes).reshape(BANDS, ROWS)
    return mix64((mix64(m) * _MIX).sum(1, dtype=np.uint64)).astype(np.int64)


def fingerprint(codes: np.ndarray) -> np.ndarray:
    bits = np.zeros(BITS, np.uint8)
    bits[(codes >> np.uint64(20)) % np.uint64(BITS)] = 1
    return bits


#: References: the empty fingerprint, the full one, and full slices at two scales (fixed by rule).
_SLICES = np.array([[1 if (b * w // BITS) % w == j else 0 for b in range(BITS)] for w in (2, 4, 8, 16) for j in range(w)], np.uint8)


def pivot_row(bits: np.ndarray) -> np.ndarray:
    """Hamming distances to the PIVOTS references: bits set, and for each slice the distance to it."""
    total, inside = int(bits.sum()), _SLICES @ bits.astype(np.int32)
    return np.concatenate([[total, BITS - total], total + _SLICES.sum(1) - 2 * inside]).astype(np.int16)


def signatures(items: DataFrame) -> DataFrame:
    """(item_id, text_key, cls, n, band array<long>, bits binary, pivots binary) of every row of
    ``items(item_id, content_text)`` with at least LEAST_WORDS words; equal word sequences, equal cls.

    Null ids and null, blank and short texts give none.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for item, key, text in zip(b["item_id"], b["text_key"], b["text"], strict=True):
                ws = words(text)
                if len(ws) < LEAST_WORDS:
                    continue
                cls = int.from_bytes(hashlib.blake2b(" ".join(ws).encode(), digest_size=8).digest(), "little", signed=True)
                codes = sequences(ws)
                bits = fingerprint(codes)
                rows.append((item, key, cls, len(codes), bands(codes), np.packbits(bits).tobytes(), pivot_row(bits).tobytes()))
            yield pd.DataFrame(rows, columns=["item_id", "text_key", "cls", "n", "band", "bits", "pivots"])

    known = items.where("item_id IS NOT NULL AND content_text IS NOT NULL")
    texts = known.select("item_id", F.xxhash64("content_text").alias("text_key"), F.col("content_text").alias("text"))
    return texts.mapInPandas(run, "item_id string, text_key long, cls long, n int, band array<long>, bits binary, pivots binary")


def discard(pairs: DataFrame) -> DataFrame:
    """Pairs that neither the pivot tables nor the fingerprints disprove."""

    @F.pandas_udf("byte")
    def stage(na: pd.Series, nb: pd.Series, pa: pd.Series, pb: pd.Series, xa: pd.Series, xb: pd.Series) -> pd.Series:
        if not len(na):
            return pd.Series([], dtype="int8")
        n = (na + nb).to_numpy()
        # |A xor B| = |A| + |B| - 2 |A and B|, and |A and B| >= s / (1 + s) (|A| + |B|) if linked
        most = n * (1 - 2 * SIMILARITY / (1 + SIMILARITY)) + 1e-9
        width = len(pa.iloc[0]) // 2
        table = [np.frombuffer(b"".join(map(bytes, p)), np.int16).reshape(-1, width).astype(np.int32) for p in (pa, pb)]
        near = np.abs(table[0] - table[1]).max(1) <= most
        x = [np.frombuffer(b"".join(map(bytes, p)), np.uint8).reshape(-1, BITS // 8) for p in (xa, xb)]
        apart = np.unpackbits(x[0] ^ x[1], axis=1).sum(1)
        return pd.Series(np.where(near, np.where(apart <= most, 2, 1), 0).astype("int8"))

    return pairs.withColumn("stage", stage("na", "nb", "pa", "pb", "xa", "xb"))


def links(sig: DataFrame, items: DataFrame) -> DataFrame:
    """(a, b), a < b: the classes whose texts are linked. ``sig`` as stored by :func:`linked_classes`,
    one row per class."""
    # Small running numbers shuffle better than class codes, and 40 bits of a band's hash are enough.
    size = F.floor(F.log2("n") * SIZE_STEPS).cast("long")
    rows = sig.select(F.shiftleft(size, SIZE_BIT).bitwiseOR(F.col("id")).alias("id"), F.posexplode("band").alias("p", "v")).select(F.shiftleft(F.col("p").cast("long"), 40).bitwiseOR(F.col("v").bitwiseAND(F.lit(2**40 - 1))).alias("v"), "id")
    # Sort-merge joins stream large buckets, and AQE splits skewed ones. In order of id sizes grow.
    near = F.shiftright("y.id", SIZE_BIT) - F.shiftright("x.id", SIZE_BIT) <= SIZE_STEPS * -np.log2(SIMILARITY) + 1
    number = lambda c: F.col(c).bitwiseAND(F.lit(2**SIZE_BIT - 1))
    pairs = rows.alias("x").join(rows.alias("y"), "v").where((F.col("x.id") < F.col("y.id")) & near).select(number("x.id").alias("a"), number("y.id").alias("b")).distinct()
    light = sig.select("id", "cls", "n", "bits", "pivots", "text_key")
    left = light.select(F.col("id").alias("a"), F.col("cls").alias("ca"), F.col("n").alias("na"), F.col("bits").alias("xa"), F.col("pivots").alias("pa"), F.col("text_key").alias("ta"))
    right = light.select(F.col("id").alias("b"), F.col("cls").alias("cb"), F.col("n").alias("nb"), F.col("bits").alias("xb"), F.col("pivots").alias("pb"), F.col("text_key").alias("tb"))
    kept = discard(pairs.join(left, "a").join(right, "b")).where("stage = 2")
    return verify(storage.cut(kept.select(F.least("ca", "cb").alias("a"), F.greatest("ca", "cb").alias("b"), "ta", "tb")), items)


def verify(pairs: DataFrame, items: DataFrame) -> DataFrame:
    """(a, b) of the pairs (a, b, ta, tb) whose texts, of keys ta and tb, are linked."""

    @F.pandas_udf("boolean")
    def linked(x: pd.Series, y: pd.Series) -> pd.Series:
        memo: dict[str, np.ndarray] = {}

        def of(t: str) -> np.ndarray:
            if t not in memo:
                if len(memo) > 2000:
                    memo.clear()
                memo[t] = sequences(words(t))
            return memo[t]

        out = []
        for s, t in zip(x, y, strict=True):
            a, b = of(s), of(t)
            both = len(np.intersect1d(a, b, assume_unique=True))
            out.append(both >= SIMILARITY * (len(a) + len(b) - both) and both > 0)
        return pd.Series(out, dtype="bool")

    # Of all texts only those of some pair are shuffled.
    used = storage.cut(pairs.select(F.explode(F.array("ta", "tb")).alias("key")).distinct())
    texts = items.where("content_text IS NOT NULL").select(F.xxhash64("content_text").alias("key"), F.col("content_text").alias("text"))
    texts = storage.cut(texts.join(storage.small_side(used, used.count()), "key", "left_semi").groupBy("key").agg(F.min("text").alias("text")))
    one = pairs.join(texts.select(F.col("key").alias("ta"), F.col("text").alias("x")), "ta")
    two = one.join(texts.select(F.col("key").alias("tb"), F.col("text").alias("y")), "tb")
    return two.where(linked("x", "y")).select("a", "b")


def linked_classes(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(membership(item_id, cls), links(a, b)) of ``items(item_id, content_text)``; repeated rows count once."""
    spark, path = items.sparkSession, storage.scratch(items.sparkSession, "signatures")
    signatures(items).withColumn("id", F.monotonically_increasing_id()).write.parquet(path)
    sig = spark.read.parquet(path)
    member = storage.cut(sig.select("item_id", "cls").distinct())
    # One row stands for a class; those beside it are left out by their numbers, so no signature is shuffled.
    first = sig.groupBy("cls").agg(F.min("id").alias("first"), F.count("*").alias("rows")).where("rows > 1")
    more = storage.cut(sig.select("cls", "id").join(first, "cls").where("id <> first").select("id"))
    one = sig.join(storage.small_side(more, more.count()), "id", "left_anti")
    return member, storage.cut(links(one, items))


def every_pair(member: DataFrame, link: DataFrame) -> DataFrame:
    """(item_id_a, item_id_b): all pairs of different items in one class or in two linked ones.

    Classes are dealt into chunks of about CHUNK items, and pairs of chunks over the partitions, so a
    class of any size is written out by all cores. Only items in several classes (rows of one id with
    different texts) can give a pair twice, and only chunks of such are made distinct.
    """
    size = member.groupBy("cls").agg(F.count("*").alias("n"))
    linked = link.select(F.explode(F.array("a", "b")).alias("cls")).distinct().withColumn("linked", F.lit(True))
    busy = size.join(linked, "cls", "left").where("n > 1 OR linked").select("cls", F.ceil(F.col("n") / CHUNK).cast("int").alias("parts"))
    m = storage.cut(member.join(busy, "cls"))
    many = m.groupBy("item_id").agg(F.count("*").alias("n")).where("n > 1").select("item_id", F.lit(True).alias("many"))
    m = m.join(many, "item_id", "left").withColumn("many", F.coalesce("many", F.lit(False)))
    # Running numbers would sort a class in one task; a hash fills the chunks about evenly.
    m = m.withColumn("chunk", F.pmod(F.xxhash64("item_id"), F.col("parts")).cast("int"))
    chunks = storage.cut(m.groupBy("cls", "many", "chunk").agg(F.collect_list("item_id").alias("ids")))
    ends = chunks.select("cls", "many", "chunk", F.size("ids").alias("n"))

    def end(side: str, n: str) -> DataFrame:
        return ends.select(F.col("cls").alias(side), F.col("many").alias(f"m{side}"), F.col("chunk").alias(f"k{side}"), F.col("n").alias(n))

    across = link.join(end("a", "na"), "a").join(end("b", "nb"), "b")
    # Inside a class each two chunks meet once, and a chunk of several items itself.
    inside = end("a", "na").withColumn("b", F.col("a")).join(end("b", "nb"), "b")
    inside = inside.where("struct(ma, ka) < struct(mb, kb) OR (ma = mb AND ka = kb AND na > 1)")
    columns = ["a", "ma", "ka", "b", "mb", "kb"]
    blocks = storage.cut(across.select(columns).unionByName(inside.select(columns)))

    def expand(some: DataFrame) -> DataFrame:
        x = some.join(chunks.select(F.col("cls").alias("a"), F.col("many").alias("ma"), F.col("chunk").alias("ka"), F.col("ids").alias("p")), ["a", "ma", "ka"])
        x = x.join(chunks.select(F.col("cls").alias("b"), F.col("many").alias("mb"), F.col("chunk").alias("kb"), F.col("ids").alias("q")), ["b", "mb", "kb"])
        # Blocks of one chunk come together by the joins: deal them out again.
        x = x.repartition("a", "ma", "ka", "b", "mb", "kb")
        same = (F.col("a") == F.col("b")) & (F.col("ma") == F.col("mb")) & (F.col("ka") == F.col("kb"))
        x = x.select(same.alias("same"), "q", F.explode("p").alias("p")).select("same", "p", F.explode("q").alias("q"))
        return x.where("p < q OR (p > q AND NOT same)").select(F.least("p", "q").alias("item_id_a"), F.greatest("p", "q").alias("item_id_b"))

    return expand(blocks.where("NOT ma AND NOT mb")).unionByName(expand(blocks.where("ma OR mb")).distinct())


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return every_pair(*linked_classes(storage.table(spark, d, "items").select("item_id", "content_text")))


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(cls, group): connected components by passing the least label along links until none changes.

    Labels also jump to the label of their label, so long chains take few rounds.
    """
    both = storage.cut(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))))
    label = storage.cut(nodes.select("cls", F.col("cls").alias("group")))
    while True:
        low = both.join(label.withColumnRenamed("cls", "b"), "b").groupBy("a").agg(F.min("group").alias("low"))
        hop = label.join(low.withColumnRenamed("a", "cls"), "cls", "left").select("cls", "group", F.least("group", F.coalesce("low", "group")).alias("new"))
        far = hop.select(F.col("cls").alias("new"), F.col("new").alias("further"))
        step = storage.cut(hop.join(far, "new", "left").select("cls", "group", F.least("new", F.coalesce("further", "new")).alias("new")))
        changed = not step.where("new < group").isEmpty()
        label = step.select("cls", F.col("new").alias("group"))
        if not changed:
            return label


def p2_groups(spark: SparkSession, d: str) -> DataFrame:
    """(item_id, cls, group_id, n_links): every item of at least LEAST_WORDS words with its class, its
    group and the number of classes its class is linked to. group_id is the least class id of the group."""
    member, link = linked_classes(storage.table(spark, d, "items").select("item_id", "content_text"))
    group = components(member.select("cls").distinct(), link)
    n = link.select(F.explode(F.array("a", "b")).alias("cls")).groupBy("cls").agg(F.count("*").alias("n_links"))
    return member.join(group, "cls").join(n, "cls", "left").select("item_id", "cls", F.col("group").alias("group_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))


SQL: dict[str, str] = {}
