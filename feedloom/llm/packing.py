"""Problem 6: filling containers of fixed capacity with texts, none split that fits.

Only the histogram of lengths, at most one bin per token of capacity, comes to the driver. In passes,
shallow combinations of lengths, each repeated, that fill a window below the capacity are enumerated
from the longest lengths left; non-negative least squares gives how often each
should be used so that the histogram is used up; counts are rounded to what is there. What no pass
places is packed greedily, largest first into the smallest space left. The plan says, for each length,
which containers take its texts by rank; a join hands them out.
"""

from __future__ import annotations

import bisect
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feedloom import storage
from feedloom.llm.tokens import token_count

#: Unused share of the capacity that a combination may leave.
WINDOW = 0.01
#: Lengths that combinations of a pass start from and are filled with, and the share of the tokens,
#: from the longest length on, that anchors are taken from.
ANCHORS, FILLERS, TOP = 128, 24, 0.15
#: Passes end when one places less than this share of the tokens it found, or after PASSES.
LEAST_GAIN, PASSES = 0.005, 40
#: Rows that one task of a ranking sorts, about.
TASK_ROWS = 200_000


def nnls(rows: np.ndarray, times: np.ndarray, b: np.ndarray, rounds: int = 300) -> np.ndarray:
    """x >= 0 that minimises |A x - b|, by accelerated projected gradients with diagonal steps.

    Column j of A has ``times[j]`` in the places ``rows[j]`` (0 times where a column has fewer).
    """
    n = len(b)
    product = lambda x: np.bincount(rows.ravel(), (times * x[:, None]).ravel(), n)
    # A has no negative entries, so A'A is at most the diagonal matrix of its row sums.
    step = 1 / np.maximum((times * product(np.ones(len(rows)))[rows]).sum(1), 1e-9)
    x = np.zeros(len(rows))
    y, t = x.copy(), 1.0
    for _ in range(rounds):
        new = np.maximum(0, y - step * (times * (product(y) - b)[rows]).sum(1))
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y, x, t = new + (t - 1) / t2 * (new - x), new, t2
    return x


def kinds(have: Counter, turn: int) -> tuple[list[int], list[int]]:
    """(anchors, fillers) of a pass: of the longest lengths, which are hardest to place, those with the
    top share of the tokens, evenly; and the commonest lengths with some at even steps through all tokens."""
    lengths = np.array(sorted(have, reverse=True))
    mass = np.cumsum(lengths * np.array([have[n] for n in lengths]))
    top = max(1, int(np.searchsorted(mass, TOP * mass[-1], side="right")))
    anchors = lengths[np.unique(np.linspace(0, top - 1, min(ANCHORS, top)).astype(int))]
    common = [n for n, _ in have.most_common(FILLERS // 2)]
    at = (np.arange(FILLERS // 2) + (turn * 0.618) % 1) / (FILLERS // 2) * mass[-1]
    return anchors.tolist(), sorted({*common, *lengths[np.searchsorted(mass, at)].tolist()}, reverse=True)


def combinations(have: Counter, capacity: int, turn: int = 0) -> list[Counter]:
    """Lengths with how often each is taken, that end within the window: an anchor, a filler, each
    repeated, and a last length among all as the one that fills best."""
    lengths = sorted(have)
    spare = max(1, int(capacity * WINDOW))
    anchors, fillers = kinds(have, turn)
    out: set[tuple[tuple[int, int], ...]] = set()

    def close(parts: tuple[tuple[int, int], ...], rest: int) -> None:
        k = bisect.bisect_right(lengths, rest)
        if k and rest - lengths[k - 1] <= spare:
            out.add((*parts, (lengths[k - 1], 1)))
        elif rest <= spare:
            out.add(parts)

    for a in anchors:
        most = min(capacity // a, have[a])
        for times in {1, max(1, most // 2), most}:
            rest = capacity - a * times
            close(((a, times),), rest)
            for n in fillers:
                fit = min(rest // n, have[n])
                for many in {fit, (fit + 1) // 2} if fit else ():
                    close(((a, times), (n, many)), rest - n * many)
    found = []
    for parts in sorted(out):
        c: Counter = Counter()
        for n, k in parts:
            c[n] += k
        if all(have[n] >= k for n, k in c.items()):
            found.append(c)
    return found


def fitted(have: Counter, capacity: int, turn: int) -> list[tuple[Counter, int]]:
    """One pass: combinations and how often each is used, within what there is."""
    found = combinations(have, capacity, turn)
    if not found:
        return []
    index = {n: i for i, n in enumerate(sorted({n for c in found for n in c}))}
    width = max(map(len, found))
    rows, times = np.zeros((len(found), width), int), np.zeros((len(found), width))
    for j, c in enumerate(found):
        for i, (n, k) in enumerate(c.items()):
            rows[j, i], times[j, i] = index[n], k
    x = nnls(rows, times, np.array([have[n] for n in index], float))
    left, out = Counter(have), []
    for j in np.argsort(-x, kind="stable"):
        if x[j] < 0.5:
            break
        many = min(int(x[j] + 0.5), *(left[n] // k for n, k in found[j].items()))
        if many > 0:
            out.append((found[j], many))
            for n, k in found[j].items():
                left[n] -= k * many
    return out


def plan(histogram: dict[int, int], capacity: int, placed: list[int] | None = None) -> list[tuple[int, int, int, int]]:
    """(length, first rank, how many, first container): each run goes to successive containers.

    Lengths are 1..capacity. Every unit of the histogram is in exactly one run. The pieces that least
    squares places are added to ``placed``.
    """
    have = Counter({n: c for n, c in histogram.items() if c > 0})
    used: Counter = Counter()
    runs: list[tuple[int, int, int, int]] = []
    container = 0

    def put(parts: Counter, many: int) -> None:
        nonlocal container
        for length, times in parts.items():
            for _ in range(times):
                runs.append((length, used[length], many, container))
                used[length] += many
            have[length] -= times * many
            if not have[length]:
                del have[length]
        container += many

    for turn in range(PASSES):
        before = sum(n * c for n, c in have.items())
        for parts, many in fitted(have, capacity, turn) if have else ():
            put(parts, many)
            if placed is not None:
                placed.append(many * sum(parts.values()))
        if before - sum(n * c for n, c in have.items()) <= LEAST_GAIN * before:
            break
    # What is left: largest first, each container then filled with the largest that still fits.
    keys = sorted(have)
    while keys:
        rest, parts = capacity, Counter()
        while keys:
            k = bisect.bisect_right(keys, rest)
            while k and have[keys[k - 1]] - parts[keys[k - 1]] <= 0:
                k -= 1
            if not k:
                break
            n = keys[k - 1]
            many = max(1, min(rest // n, have[n] - parts[n]))
            parts[n] += many
            rest -= n * many
        put(parts, min(have[n] // k for n, k in parts.items()))
        keys = [n for n in keys if n in have]
    return runs


def ranked(pieces: DataFrame, by: list[str], order: list[str], rows: int) -> DataFrame:
    """``pieces`` with ``rank`` 0.. within ``by``; a value is dealt over so many tasks that ``rows``
    rows of it, the most of any, leave each about TASK_ROWS."""
    spread = max(1, -(-rows // TASK_ROWS))
    salted = pieces.withColumn("__salt", F.pmod(F.xxhash64(*order), F.lit(spread)))
    counts = salted.groupBy(*by, "__salt").agg(F.count("*").alias("__n"))
    before = F.sum("__n").over(W.partitionBy(*by).orderBy("__salt").rowsBetween(W.unboundedPreceding, -1))
    offsets = counts.select(*by, "__salt", F.coalesce(before, F.lit(0)).alias("__before"))
    within = salted.withColumn("__k", F.row_number().over(W.partitionBy(*by, "__salt").orderBy(*order)))
    return within.join(offsets, [*by, "__salt"]).withColumn("rank", F.col("__before") + F.col("__k") - 1).drop("__salt", "__before", "__k")


def pack(sized: DataFrame, containers: DataFrame) -> DataFrame:
    """(container, capacity_tokens, container_no, doc_id, piece_no, n_pieces, tokens).

    ``sized(doc_id, tokens)``. Per capacity every document comes out once, as one piece; one longer
    than the capacity comes out as full pieces in containers of their own plus the remainder, which
    is packed like others. Documents without tokens come out with container_no NULL and 0 tokens.
    Rows with equal doc_id are documents of their own. Containers without a positive capacity are
    left out; no containers, or no documents, give no rows.
    """
    spark = sized.sparkSession
    caps = [(r.container, int(r.capacity_tokens)) for r in containers.select("container", "capacity_tokens").distinct().collect() if (r.capacity_tokens or 0) > 0]
    schema = "container string, capacity_tokens int"
    if not caps:
        return spark.createDataFrame([], f"{schema}, container_no long, doc_id long, piece_no int, n_pieces int, tokens int")
    kinds = F.array(*[F.struct(F.lit(n).alias("container"), F.lit(c).alias("capacity_tokens")) for n, c in caps])
    units = sized.withColumn("__row", F.monotonically_increasing_id()).withColumn("__kind", F.explode(kinds)).select("doc_id", "tokens", "__row", "__kind.container", "__kind.capacity_tokens")
    cap = F.col("capacity_tokens")
    whole = F.when(F.col("tokens") > cap, F.floor(F.col("tokens") / cap)).otherwise(0)
    rest = F.col("tokens") - whole * cap
    units = storage.cut(units.withColumns({"whole": whole.cast("int"), "rest": rest.cast("int")}))
    histogram = units.where("rest > 0").groupBy("container", "rest").agg(F.count("*").alias("n")).collect()
    runs = []
    bins: dict[str, int] = {}
    for name, size in caps:
        mine = plan({r.rest: r.n for r in histogram if r.container == name}, size)
        runs += [(name, length, at, many, first) for length, at, many, first in mine]
        bins[name] = max((first + many for *_, many, first in mine), default=0)
    most = max((r.n for r in histogram), default=0)
    slots = spark.createDataFrame(runs, "container string, rest int, at long, many long, first long")
    parts = ranked(units.where("rest > 0"), ["container", "rest"], ["doc_id", "__row"], most)
    # A range join on the runs of a length, made an equi-join by the run each rank falls in.
    bounds = slots.groupBy("container", "rest").agg(F.array_sort(F.collect_list(F.struct("at", "many", "first"))).alias("runs"))
    run = F.element_at(F.filter("runs", lambda r: r["at"] <= F.col("rank")), -1)
    # A row for each length up to the capacities; beyond the bound the join shuffles.
    bounds = storage.small_side(bounds, len({(name, length) for name, length, *_ in runs}))
    placed = parts.join(bounds, ["container", "rest"]).withColumn("run", run)
    n = (F.col("whole") + F.when(F.col("rest") > 0, 1).otherwise(0)).cast("int")
    out = placed.select("container", "capacity_tokens", (F.col("run.first") + F.col("rank") - F.col("run.at")).alias("container_no"), "doc_id", F.col("whole").alias("piece_no"), n.alias("n_pieces"), F.col("rest").alias("tokens"))
    # Full pieces of long documents: containers after the packed ones.
    pieces = units.where("whole > 0").groupBy("container").agg(F.sum("whole").alias("n")).collect()
    full = units.where("whole > 0").select("*", F.explode(F.sequence(F.lit(0), F.col("whole") - 1)).alias("piece_no"))
    base = F.create_map(*[F.lit(v) for kv in bins.items() for v in kv])
    full = ranked(full, ["container"], ["doc_id", "__row", "piece_no"], max((r.n for r in pieces), default=0)).select("container", "capacity_tokens", (base[F.col("container")] + F.col("rank")).alias("container_no"), "doc_id", "piece_no", n.alias("n_pieces"), F.col("capacity_tokens").alias("tokens"))
    empty = units.where("tokens = 0").select("container", "capacity_tokens", F.lit(None).cast("long").alias("container_no"), "doc_id", F.lit(0).alias("piece_no"), F.lit(0).alias("n_pieces"), F.lit(0).alias("tokens"))
    return out.unionByName(full).unionByName(empty)


def sized_documents(spark: SparkSession, d: str) -> DataFrame:
    return storage.cut(storage.table(spark, d, "documents").select("doc_id", token_count("text").alias("tokens")))


def p6_packed(spark: SparkSession, d: str) -> DataFrame:
    return pack(sized_documents(spark, d), storage.table(spark, d, "containers"))


def p6_report(spark: SparkSession, d: str) -> DataFrame:
    """Containers used, tokens and share of space used, per kind of container."""
    used = p6_packed(spark, d).where("container_no IS NOT NULL").groupBy("container", "capacity_tokens")
    out = used.agg(F.countDistinct("container_no").alias("n_containers"), F.sum("tokens").alias("tokens"), F.count("*").alias("n_pieces"))
    return out.withColumn("filled", F.col("tokens") / (F.col("n_containers") * F.col("capacity_tokens")))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """Documents that the packing had to split for the container ``wide``."""
    wide = storage.table(spark, d, "containers").where("container = 'wide'")
    # Written with every container number, so that the rows are those of the packing.
    return storage.cut(pack(sized_documents(spark, d), wide)).where("n_pieces > 1").select("doc_id").distinct()


SQL: dict[str, str] = {}
