"""Problem 5: checking new batches against all history through a persisted vector index.

Every canonical key (an entry within its source, a page) becomes a small vector, the counts of its
character pairs in a fixed number of bins. An inverted file keeps the vectors in cells: a vector
lies in the cell of its nearest centroid, together with its distance from it (its *ring*) and the
full vector and key. A probe visits the cells whose distance bounds still allow a nearer match; with h
the home cell of q, and cell j holding vectors at lo_j to hi_j from its centroid c_j,

* |q, x| >= |q, c_j| - hi_j and >= lo_j - |q, c_j| for every x of cell j, and
* |q, x| >= (|q, c_j| - |q, c_h|) / 2, as x is nearer to c_j than to c_h.

:meth:`CellIndex.nearest` takes the nearest in the home cell first and then visits the cells whose
bound is below that distance, so no nearer match is possible elsewhere. Survivors are reranked exactly.
Batches ask for matches at distance 0 (:meth:`CellIndex.known`) by the same steps: cells and rings that the
bounds leave, stored vectors there at exact distance 0, and among these the key itself decides, as keys may
share a vector. New keys are appended to the cells before the next batches; stored keys are never placed or
written again. Batches that are small beside the history are asked together, consecutive ones in order
(:func:`rounds`), so that history is read a number of times that depends on neither its size nor theirs.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom import storage
from feedloom.llm import keys as K

DIM = 32
RINGS_PER_UNIT = 64
#: Cells grow with the root of the keys first stored: at least LEAST_CELLS, else the root over CELL_ROOT.
LEAST_CELLS, CELL_ROOT = 8, 12
#: Keys on which centroids are fitted, about, at most: a sample by hash. Every key is indexed.
FIT_ROWS = 20_000
#: Rows of a file of the index, about.
FILE_ROWS = 100_000
#: Rows asked in one round, at least, as a share of the keys stored (a batch that has more is a round of its own).
ROUND_SHARE = 0.1
#: Distances that one step of a task holds at once.
STEP_DISTANCES = 2_000_000
#: Stored keys and queries of one block of a search, about.
BLOCK_STORED, BLOCK_QUERIES = 50_000, 5_000


def pair_counts(texts: list[str]) -> np.ndarray:
    """(len(texts), DIM) counts of adjacent byte pairs, hashed to DIM bins, at most 255 each."""
    raw = [t.encode() for t in texts]
    sizes = np.fromiter(map(len, raw), np.int64, len(raw))
    data = np.frombuffer(b"".join(raw), np.uint8).astype(np.uint32)
    out = np.zeros((len(raw), DIM), np.int64)
    if len(data) > 1:
        owner = np.repeat(np.arange(len(raw)), sizes)
        same = owner[1:] == owner[:-1]
        bins = ((data[:-1] * np.uint32(257) + data[1:]) * np.uint32(2654435761) >> np.uint32(27)).astype(np.int64)
        out += np.bincount((owner[1:] * DIM + bins)[same], minlength=len(raw) * DIM).reshape(-1, DIM)
    return np.minimum(out, 255).astype(np.uint8)


def fit_centroids(vectors: np.ndarray, cells: int, rounds: int = 6) -> np.ndarray:
    """Lloyd's k-means from evenly spaced starting points; deterministic."""
    v = np.unique(vectors, axis=0).astype(np.float64)
    if not len(v):
        return np.zeros((1, DIM))
    c = v[np.linspace(0, len(v) - 1, min(cells, len(v))).astype(int)].copy()
    for _ in range(rounds):
        home = distances(v, c).argmin(1)
        n = np.bincount(home, minlength=len(c))
        total = np.zeros_like(c)
        np.add.at(total, home, v)
        c[n > 0] = total[n > 0] / n[n > 0, None]
    # Multiples of 1/256 keep every squared distance exact, so equal keys get one cell and ring in whatever batch they come.
    return np.round(c * 256) / 256


def distances(v: np.ndarray, c: np.ndarray) -> np.ndarray:
    v = v.astype(np.float64)
    return np.sqrt(np.maximum((v * v).sum(1)[:, None] - 2 * v @ c.T + (c * c).sum(1), 0))


def vectors(vec: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(map(bytes, vec)), np.uint8).reshape(-1, DIM)


def least(d: np.ndarray, near: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Lower bounds of the distance to any vector of a cell, from those to its centroid (``d``) and the nearest one."""
    return np.maximum(np.maximum(d - hi, lo - d), (d - near[:, None]) / 2)


def steps(batches: Iterator[pd.DataFrame], cells: int) -> Iterator[pd.DataFrame]:
    """``batches`` in pieces whose distances to ``cells`` centroids fit into memory, however many cells there are."""
    size = max(1, STEP_DISTANCES // max(1, cells))
    for b in batches:
        for at in range(0, len(b), size):
            yield b.iloc[at : at + size]


def entry_keys(df: DataFrame, sources: DataFrame, source_id: str, external_id: str, url: str) -> DataFrame:
    """(columns of ``df`` but those three, key): 'e:<source>|<entry>' and 'u:<page>' of every row.

    Nulls and blanks give no key. A source that spells none of the catalogue's is itself, squashed;
    without a source the external id gives none.
    """
    keep = [c for c in df.columns if c not in (source_id, external_id, url)]
    df = K.spelled_source(df, source_id, sources, "__source")
    df = df.withColumn("__source", F.coalesce("__source", F.concat(F.lit("?"), K.squash(source_id))))
    df = df.withColumn("__text", F.explode(F.array(F.struct(F.lit("e").alias("kind"), F.col(external_id).alias("text")), F.struct(F.lit("u").alias("kind"), F.col(url).alias("text")))))
    df = df.select(*keep, "__source", F.col("__text.kind").alias("__kind"), F.col("__text.text").alias("__text"))
    df = K.with_entry_key(K.with_page_key(df, "__text", "__page"), "__text", "__page", "__entry")
    key = F.when(F.col("__kind") == "u", F.concat(F.lit("u:"), "__page")).otherwise(F.concat(F.lit("e:"), "__source", F.lit("|"), "__entry"))
    # Exploding drops null keys; a filter would be pushed below all steps and repeat them there.
    return df.withColumn("key", key).select(*keep, F.explode(F.when(F.col("key").isNotNull(), F.array("key"))).alias("key"))


class CellIndex:
    """The persisted inverted file at ``path``: ``cells`` (Parquet by cell) and ``centroids``."""

    def __init__(self, spark: SparkSession, path: str, centroids: np.ndarray):
        self.spark, self.path, self.centroids = spark, path, centroids

    @classmethod
    def create(cls, key_table: DataFrame, path: str, *, cells: int | None = None, fit_rows: int = FIT_ROWS) -> CellIndex:
        """Fits cells on about ``fit_rows`` keys at most and stores all of ``key_table(key)``."""
        spark, n = key_table.sparkSession, key_table.count()
        share = F.pmod(F.xxhash64("key", F.lit(5)), F.lit(2**40)) < int(2**40 * min(1.0, fit_rows / max(n, 1)))
        sample = key_table.select("key").where(share).toPandas()["key"].sort_values().tolist()
        cells = cells or max(LEAST_CELLS, int(n**0.5 / CELL_ROOT))
        index = cls(spark, path, fit_centroids(pair_counts(sample), cells))
        spark.createDataFrame([(json.dumps(index.centroids.tolist()),)], "centroids string").coalesce(1).write.mode("overwrite").parquet(f"{path}/centroids")
        index.append(key_table)
        return index

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> CellIndex:
        return cls(spark, path, np.array(json.loads(spark.read.parquet(f"{path}/centroids").first()[0])))

    def placed(self, key_table: DataFrame) -> DataFrame:
        """``key_table`` with its home cell, ring and vec."""
        centroids, names = self.centroids, key_table.columns
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in key_table.schema)

        def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in steps(batches, len(centroids)):
                v = pair_counts(b["key"].tolist())
                d = distances(v, centroids)
                home = d.argmin(1)
                ring = np.floor(d[np.arange(len(d)), home] * RINGS_PER_UNIT)
                yield b.assign(cell=home.astype("int32"), ring=ring.astype("int32"), vec=[x.tobytes() for x in v])[[*names, "cell", "ring", "vec"]]

        return key_table.mapInPandas(place, f"{fields}, cell int, ring int, vec binary")

    def append(self, key_table: DataFrame) -> None:
        """Stores the keys of ``key_table``, placed or not: files of about FILE_ROWS by ranges of cell
        and ring, sorted, so that readers of some cells skip other files and row groups, and a hot cell is many files."""
        rows = key_table if "cell" in key_table.columns else storage.cut(self.placed(key_table.select("key")))
        files = max(1, -(-rows.count() // FILE_ROWS))
        rows.select("key", "ring", "vec", "cell").repartitionByRange(files, "cell", "ring", "key").sortWithinPartitions("cell", "ring").write.mode("append").parquet(f"{self.path}/cells")

    def stored(self) -> DataFrame:
        return self.spark.read.schema("key string, ring int, vec binary, cell int").parquet(f"{self.path}/cells")

    def bounds(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(cells, lo, hi): the cells that hold vectors, and between which distances from their centroids these lie."""
        by = self.stored().groupBy("cell").agg(F.min("ring").alias("lo"), F.max("ring").alias("hi")).collect()
        lo, hi = (np.array([getattr(r, f) + k for r in by], float) / RINGS_PER_UNIT for f, k in (("lo", 0), ("hi", 1)))
        return np.array([r.cell for r in by], int), lo, hi

    def probes(self, placed: DataFrame) -> DataFrame:
        """(key, vec, cell, ring): where the bounds allow a stored vector at distance 0 from those of
        ``placed(key, vec)``: in a cell whose centroid is as near as the home cell's, at the same distance from it."""
        centroids, (cells, lo, hi) = self.centroids, self.bounds()

        def probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in steps(batches, len(centroids)):
                if not len(cells):
                    continue
                d = distances(vectors(b["vec"]), centroids)
                near, d = d.min(1), d[:, cells]
                row, at = np.nonzero(least(d, near, lo, hi) <= 0)
                ring = np.floor(d[row, at] * RINGS_PER_UNIT)
                yield pd.DataFrame({"key": b["key"].to_numpy()[row], "vec": b["vec"].to_numpy()[row], "cell": cells[at].astype("int32"), "ring": ring.astype("int32")})

        return placed.select("key", "vec").mapInPandas(probe, "key string, vec binary, cell int, ring int")

    def known(self, placed: DataFrame) -> DataFrame:
        """(key): those of ``placed(key, vec)`` that are stored: of the vectors at exact distance 0 where
        :meth:`probes` leads, those with the same key. Keys without a probe are new by the bounds alone."""
        asked = storage.cut(self.probes(placed))
        # Files and row groups of other cells are not read; at most as many values as there are cells.
        cells = [r.cell for r in asked.select("cell").distinct().collect()]
        here = storage.small_side(asked.withColumnRenamed("key", "asked"), asked.count())
        # Whole vectors are compared: those at distance 0 are equal.
        same = self.stored().where(F.col("cell").isin(cells)).join(here, ["cell", "ring", "vec"])
        return same.where("key = asked").select("key").distinct()

    def nearest(self, queries: DataFrame) -> DataFrame:
        """(key, stored, distance): for every key of ``queries(key)`` the nearest stored one, the least
        of several. Exact: the bounds leave out cells only that hold nothing nearer. None if all is empty."""
        centroids, (cells, lo, hi) = self.centroids, self.bounds()
        q = storage.cut(self.placed(queries.select("key").distinct()))

        def visits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in steps(batches, len(centroids)):
                if not len(cells):
                    continue
                d = distances(vectors(b["vec"]), centroids)
                near, d = d.min(1), d[:, cells]
                bound = least(d, near, lo, hi)
                # First round (no distance yet): the cell of the least bound; second: all others below it.
                first = bound.argmin(1)
                if "distance" in b:
                    see = bound < b["distance"].to_numpy()[:, None] - 1e-6
                    see[np.arange(len(b)), first] = False
                    row, at = np.nonzero(see)
                else:
                    row, at = np.arange(len(b)), first
                yield pd.DataFrame({"key": b["key"].to_numpy()[row], "vec": b["vec"].to_numpy()[row], "cell": cells[at].astype("int32")})

        shape = "key string, vec binary, cell int"
        home = self.search(q.mapInPandas(visits, shape))
        rest = q.join(home.select("key", "distance"), "key").select("key", "vec", "distance").mapInPandas(visits, shape)
        both = home.unionByName(self.search(rest))
        return both.groupBy("key").agg(F.min(F.struct("distance", "stored")).alias("m")).select("key", F.col("m.stored").alias("stored"), F.col("m.distance").alias("distance"))

    def search(self, visits: DataFrame) -> DataFrame:
        """(key, stored, distance): the nearest stored key of each visited cell, exactly.

        Cells are cut into blocks of stored keys and of queries, and each two blocks of a cell meet in
        one task, however large the cell is.
        """
        visits = storage.cut(visits)
        asked = {r.cell: r.n for r in visits.groupBy("cell").agg(F.count("*").alias("n")).collect()}
        stored = self.stored().where(F.col("cell").isin(list(asked)))
        have = {r.cell: r.n for r in stored.groupBy("cell").agg(F.count("*").alias("n")).collect()}
        rows = [(c, -(-have.get(c, 1) // BLOCK_STORED), -(-n // BLOCK_QUERIES)) for c, n in asked.items()]
        # One row for each cell.
        parts = F.broadcast(self.spark.createDataFrame(rows, "cell int, parts int, asks int"))
        part = lambda by, of: F.pmod(F.xxhash64(by), F.col(of)).cast("int")
        every = lambda of: F.explode(F.sequence(F.lit(0), F.col(of) - 1))
        s = stored.join(parts, "cell").select("cell", part("key", "parts").alias("i"), every("asks").alias("j"), "key", "vec")
        v = visits.join(parts, "cell").select("cell", every("parts").alias("i"), part("key", "asks").alias("j"), "key", "vec")

        def rerank(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
            out = []
            if len(x) and len(y):
                x = x.sort_values("key", kind="stable")
                a = vectors(x["vec"]).astype(np.float32)
                names, norm = x["key"].to_numpy(), (a * a).sum(1)
                for at in range(0, len(y), 256):
                    part = y.iloc[at : at + 256]
                    q = vectors(part["vec"]).astype(np.float32)
                    # Whole numbers below 2^24 are exact in single precision.
                    d = norm[None, :] - 2 * (q @ a.T) + (q * q).sum(1)[:, None]
                    k = d.argmin(1)
                    out.append(pd.DataFrame({"key": part["key"].to_numpy(), "stored": names[k], "distance": np.sqrt(d[np.arange(len(part)), k].astype(float))}))
            return pd.concat(out) if out else pd.DataFrame({"key": pd.Series([], dtype=object), "stored": pd.Series([], dtype=object), "distance": pd.Series([], dtype=float)})

        keys = ["cell", "i", "j"]
        return storage.cut(s.groupBy(*keys).cogroup(v.groupBy(*keys)).applyInPandas(rerank, "key string, stored string, distance double"))


def order_key(batch: str, record: str) -> Column:
    return F.struct(F.col(batch).alias("batch"), F.col(record).alias("record"))


def new_keys(index: CellIndex, keys: DataFrame, *, record: str = "raw_id", batch: str = "batch_id", add: bool = True) -> DataFrame:
    """(key, ord, cell, ring, vec): keys that are not stored, with their first record; appended with ``add``."""
    # Partial aggregation keeps a hot key from gathering its rows in one task.
    first = storage.cut(index.placed(keys.groupBy("key").agg(F.min(order_key(batch, record)).alias("ord"))))
    fresh = storage.cut(first.join(index.known(first), "key", "left_anti"))
    if add:
        index.append(fresh)
    return fresh


def repeats(keys: DataFrame, fresh: DataFrame, record: str) -> DataFrame:
    """(record, repeated): whether a key of the record is not new, or an earlier record's."""
    own = fresh.groupBy(F.col("ord").getField("record").alias(record)).agg(F.count("*").alias("__own"))
    every = keys.select(record, "key").distinct().groupBy(record).agg(F.count("*").alias("__all"))
    return every.join(own, every[record].eqNullSafe(own[record]), "left").select(every[record], (F.coalesce("__own", F.lit(0)) < F.col("__all")).alias("repeated"))


def repeated_records(index: CellIndex, keys: DataFrame, *, record: str = "raw_id", batch: str = "batch_id", add: bool = True) -> DataFrame:
    """(record, repeated) of every record in ``keys`` (columns record, batch, key).

    A record is repeated if one of its keys is stored in the index or belongs to an earlier record
    (by batch, then record; nulls first). ``keys`` may hold one batch or many: within it order
    decides. With ``add``, keys seen for the first time are appended to the cells afterwards.
    Records without keys have no row, as they are never repeated; an empty table gives none. Rows
    that carry the same batch and record id are one record.
    """
    return repeats(keys, new_keys(index, keys, record=record, batch=batch, add=add), record)


def rounds(sizes: dict, stored: int) -> list[list]:
    """The batches of ``sizes`` (batch: rows) in order, nulls first, as lists of consecutive ones, each with
    ROUND_SHARE of the keys stored at least (the last may have fewer); rows asked count as stored after their round."""
    out, rows = [], 0
    for b in sorted(sizes, key=lambda b: (b is not None, b)):
        if not rows:
            out.append([])
        out[-1].append(b)
        rows += sizes[b]
        if rows >= ROUND_SHARE * stored:
            stored, rows = stored + rows, 0
    return out


def batch_by_batch(index: CellIndex, keys: DataFrame, *, record: str = "raw_id", batch: str = "batch_id") -> DataFrame:
    """(record, repeated) as :func:`repeated_records`, one of :func:`rounds` after the other, each checked
    against the cells as those before left them; within it order decides. The list of batches fits the driver."""
    fresh = None
    for some in rounds({r[0]: r[1] for r in keys.groupBy(batch).count().collect()}, index.stored().count()):
        named = [b for b in some if b is not None]
        here = F.col(batch).isNull() if len(named) < len(some) else F.lit(False)
        # They are consecutive, and blocks of other batches are skipped by their bounds.
        here = here | F.col(batch).between(named[0], named[-1]) if named else here
        one = new_keys(index, keys.where(here), record=record, batch=batch)
        fresh = one if fresh is None else fresh.unionByName(one)
        index = CellIndex.open(index.spark, index.path)
    return repeats(keys, fresh, record) if fresh is not None else repeated_records(index, keys, record=record, batch=batch)


def indexed(spark: SparkSession, d: str) -> tuple[CellIndex, DataFrame]:
    """The index over all of seen_items, and the keys of all raw records."""
    sources = storage.table(spark, d, "sources")
    seen = storage.table(spark, d, "seen_items").select("source_id", "external_id", "url")
    raw = storage.table(spark, d, "raw_items").select("raw_id", "batch_id", "source_id", "external_id", "url")
    history = storage.cut(entry_keys(seen, sources, "source_id", "external_id", "url").distinct())
    index = CellIndex.create(history, storage.scratch(spark, "cells"))
    return index, storage.cut(entry_keys(raw, sources, "source_id", "external_id", "url"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return batch_by_batch(*indexed(spark, d)).where("repeated").select("raw_id")


def p5_nearest(spark: SparkSession, d: str) -> DataFrame:
    """(raw_id, key, stored, distance): of every record whose raw_id is divisible by 20, each key with
    the nearest of all keys of seen_items; near but not equal ones are likely misspellings."""
    index, keys = indexed(spark, d)
    asked = keys.where("raw_id % 20 = 0").select("raw_id", "key").distinct()
    return asked.join(index.nearest(asked), "key").select("raw_id", "key", "stored", "distance")
