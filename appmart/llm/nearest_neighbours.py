"""Approximate nearest neighbours (operator 13), by balanced posting lists.

* **Lists.** Equal vectors are one entry. A bounded sample of the entries
  (``SAMPLE`` of them, ``SAMPLE_BYTES`` at most, chosen by hash) is halved again
  and again by two-means with the cut at the median, so all leaves are equally
  large; their means are the centroids, about one for every ``LIST_ENTRIES``
  entries of the whole table as far as the sample carries that.
* **Graph.** The centroids are searched by a graph held in memory: each one's
  nearest centroids, without those that a nearer one hides, and the way back.
  Best-first search walks it for a batch of vectors at once.
* **Replicas.** Every entry goes to its nearest centroid's list and, if it lies at
  a boundary, to others: those at most ``BOUNDARY`` times as far and nearer to the
  entry than to each centroid taken before.
* **Pruning.** A query reads the lists whose centroid is at most ``ratio`` times
  as far as its nearest one, and as many as hold ``neighbours`` entries. The ratio
  is measured, not set: the least one by which sampled queries find the share
  ``TARGET`` of their true neighbours in the sample. The whole table is denser, so
  neighbours lie nearer and the share is, if anything, higher.
* **Scan.** Lists and their queries meet in blocks of about ``BLOCK`` entries and
  ``BLOCK`` queries, however long a list is, so no hot list makes a hot task. The
  nearest lists come first; their k-th distance bounds what the others return.
  Distances are computed from the differences, in double precision.

What depends on the table's size: the number of centroids, up to a quarter of the
sample (16,384 at 64 dimensions, 8 MB in memory); beyond it lists grow and are
read in more blocks. The driver holds the sample and one count per list.

Cases: vectors that are null, zero, or hold null or non-finite entries take no
part, and neither do those of another length than the commonest (of several the
greatest). Rows with null ids take no part. A repeated row is a row of its own: it
is a candidate of its twin, and as a query it has its own ten rows. Ties go to the
smaller id. A table of one row has no neighbours and no result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .store import materialise

LIST_ENTRIES = 256
SAMPLE, SAMPLE_BYTES = 1 << 16, 32 << 20
SAMPLE_PER_LIST = 4
BOUNDARY, MOST_REPLICAS = 1.15, 8
DEGREE = 24
BLOCK = 512
TARGET, TRIALS = 0.985, 300
#: Lists that bound the k-th distance before the rest is read.
FIRST_LISTS = 4
BATCH = 256


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of a and b; rounded, so only for choosing."""
    return np.maximum((a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1) - 2 * a @ b.T, 0)


def distances(query: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Euclidean distance of pairs of rows, from their differences."""
    off = query - rows
    return np.sqrt((off * off).sum(axis=-1))


class Lists:
    """Centroids and their graph."""

    def __init__(self, sample: np.ndarray, lists: int, degree: int = DEGREE):
        self.centroids = self._leaves(sample, lists)
        k = len(self.centroids)
        near = np.empty((k, min(k, 2 * degree + 1)), dtype=np.int64)
        for at in range(0, k, 1024):
            d2 = _squares(self.centroids[at:at + 1024], self.centroids)
            d2[np.arange(len(d2)), np.arange(at, at + len(d2))] = -1  # itself first
            part = np.argpartition(d2, near.shape[1] - 1, axis=1)[:, :near.shape[1]] if near.shape[1] < k else (
                np.tile(np.arange(k), (len(d2), 1)))
            near[at:at + 1024] = np.take_along_axis(part, np.argsort(np.take_along_axis(d2, part, 1), 1), 1)
        links: list[set[int]] = [set() for _ in range(k)]
        for c in range(k):
            own = near[c, 1:]
            between, far = _squares(self.centroids[own], self.centroids[own]), _squares(
                self.centroids[c:c + 1], self.centroids[own])[0]
            taken: list[int] = []
            for j in range(len(own)):
                if len(taken) < degree // 2 and all(between[j, t] > far[j] for t in taken):
                    taken.append(j)
            # The nearest ones stay even if hidden; links go both ways, and a ring keeps all in reach.
            for t in {*taken, *range(min(len(own), degree // 4))}:
                links[c].add(int(own[t]))
                links[int(own[t])].add(c)
            if k > 1:
                links[c].add((c + 1) % k)
                links[(c + 1) % k].add(c)
        self.links = np.full((k, max(map(len, links), default=0) or 1), -1, dtype=np.int64)
        for c, own in enumerate(links):
            self.links[c, :len(own)] = sorted(own)
        self.entry = int(np.argmin(((self.centroids - self.centroids.mean(axis=0)) ** 2).sum(axis=1)))

    @staticmethod
    def _leaves(sample: np.ndarray, lists: int) -> np.ndarray:
        """Means of ``lists`` equally large parts of the sample."""
        rng, parts = np.random.default_rng(0), [(np.arange(len(sample)), lists)]
        out = []
        while parts:
            own, k = parts.pop()
            x = sample[own]
            if k <= 1 or len(own) < 2:
                out.append(x.mean(axis=0))
                continue
            a, b = x[rng.choice(len(x), 2, replace=False)]
            share = len(own) * (k // 2) // k
            for _ in range(6):
                lean = ((x - a) ** 2).sum(axis=1) - ((x - b) ** 2).sum(axis=1)
                order = np.argpartition(lean, share)
                a, b = x[order[:share]].mean(axis=0), x[order[share:]].mean(axis=0)
            parts += [(own[order[:share]], k // 2), (own[order[share:]], k - k // 2)]
        return np.array(out)

    def search(self, x: np.ndarray, least: int, ratio: float) -> tuple[np.ndarray, np.ndarray]:
        """Squared distances to all centroids that the graph walk met (infinite elsewhere), and which it went through.

        The walk of a vector ends when its nearest centroid not yet gone through is farther than
        ``ratio`` times the nearest of all, and than ``least`` others gone through.
        """
        m, k = len(x), len(self.centroids)
        rows = np.arange(m)
        met, through = np.full((m, k), np.inf), np.zeros((m, k), dtype=bool)
        met[:, self.entry] = ((x - self.centroids[self.entry]) ** 2).sum(axis=1)
        best, gone = met[:, self.entry].copy(), np.zeros(m, dtype=np.int64)
        open_ = met.copy()  # met and not yet gone through
        while len(rows):
            pick = np.argmin(open_[rows], axis=1)
            d2 = open_[rows, pick]
            on = np.isfinite(d2) & ((d2 <= ratio * ratio * best[rows]) | (gone[rows] < least))
            rows, pick = rows[on], pick[on]
            if not len(rows):
                break
            through[rows, pick], open_[rows, pick] = True, np.inf
            gone[rows] += 1
            side = self.links[pick]
            fresh = (side >= 0) & np.isinf(met[rows[:, None], side]) & ~through[rows[:, None], side]
            at, col = np.nonzero(fresh)
            r, c = rows[at], side[at, col]
            far = ((x[r] - self.centroids[c]) ** 2).sum(axis=1)
            met[r, c] = open_[r, c] = far
            np.minimum.at(best, r, far)
        return met, through

    def assign(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, list, whether it is the row's nearest) of every copy of the rows."""
        out = []
        for at in range(0, len(x), BATCH):
            own = x[at:at + BATCH]
            met, _ = self.search(own, MOST_REPLICAS, BOUNDARY)
            top = min(MOST_REPLICAS, met.shape[1])
            near = np.argpartition(met, top - 1, axis=1)[:, :top]
            d2 = np.take_along_axis(met, near, 1)
            order = np.lexsort((near, d2), axis=1)
            near, d2 = np.take_along_axis(near, order, 1), np.take_along_axis(d2, order, 1)
            good = d2 <= BOUNDARY ** 2 * d2[:, :1]
            spot = self.centroids[near]
            for j in range(1, top):
                hidden = ((spot[:, :j] - spot[:, j:j + 1]) ** 2).sum(axis=2) < d2[:, j:j + 1]
                good[:, j] &= ~(hidden & good[:, :j]).any(axis=1)
            r, c = np.nonzero(good)
            out.append((at + r, near[r, c], c == 0))
        if not out:
            return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)
        return tuple(np.concatenate(v) for v in zip(*out))

    def probe(self, x: np.ndarray, ratio: float, sizes: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, list, place in the row's order of lists) of the lists that each row reads."""
        out = []
        for at in range(0, len(x), BATCH):
            met, through = self.search(x[at:at + BATCH], 2 * FIRST_LISTS, ratio)
            order = np.argsort(met, axis=1, kind="stable")
            d2 = np.take_along_axis(met, order, 1)
            full = np.cumsum(np.where(np.isinf(d2), 0, sizes[order]), axis=1)
            enough = np.concatenate([np.zeros((len(met), 1), bool), full[:, :-1] >= wanted], axis=1)
            read = np.isfinite(d2) & ((d2 <= ratio * ratio * d2[:, :1]) | ~enough)
            short = full[:, -1] < wanted
            if short.any():  # the lists met are too thin: all lists
                all_far = _squares(x[at:at + BATCH][short], self.centroids)
                order[short] = np.argsort(all_far, axis=1, kind="stable")
                read[short] = True
            r, c = np.nonzero(read)
            out.append((at + r, order[r, c], c))
        return tuple(np.concatenate(v) for v in zip(*out))

    def measured_ratio(self, sample: np.ndarray, neighbours: int) -> float:
        """The least ratio by which the first TRIALS sampled rows find the share TARGET of their neighbours in the sample."""
        if len(self.centroids) == 1:
            return 1.0
        tries, top = sample[:TRIALS], min(neighbours, len(sample) - 1)
        found = np.empty((len(tries), top), dtype=np.int64)
        for at in range(0, len(tries), 32):
            d2 = _squares(tries[at:at + 32], sample)
            d2[np.arange(len(d2)), np.arange(at, at + len(d2))] = np.inf
            found[at:at + 32] = np.argpartition(d2, top - 1, axis=1)[:, :top]
        members, which = np.unique(found, return_inverse=True)
        row, own, _ = self.assign(sample[members])
        far = np.sqrt(_squares(tries, self.centroids))
        far /= np.maximum(far.min(axis=1, keepdims=True), 1e-300)
        first = np.searchsorted(row, np.arange(len(members)))
        # Each query's nearest list of each of its neighbours.
        needed = [np.minimum.reduceat(q[own], first)[w] for q, w in zip(far, which.reshape(found.shape))]
        return float(np.quantile(needed, TARGET)) * (1 + 1e-9)


def _vectors(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(len(column), -1)


def valid_rows(table: DataFrame, key: str, column: str) -> DataFrame:
    """(rid, id, v) of the rows that take part, stored; v in double precision, rid a number of the row."""
    v = F.col(column)
    sound = F.coalesce(F.forall(v, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")),
                                                        F.lit(False))), F.lit(False))
    rows = table.filter(sound & F.exists(v, lambda c: c != 0) & F.col(key).isNotNull())
    sizes = rows.groupBy(F.size(v).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    # Adding 0.0 turns -0.0 to 0.0, so equal vectors are equal as keys.
    return materialise(rows.filter(F.size(v) == (sizes["d"] if sizes else 0)).select(
        F.monotonically_increasing_id().alias("rid"), F.col(key).cast("long").alias("id"),
        F.transform(v, lambda c: c.cast("double") + F.lit(0.0)).alias("v")), "valid-rows")


def _sample(entries: DataFrame, n: int, d: int) -> np.ndarray:
    """Entries chosen and ordered by hash: all, or about SAMPLE of them."""
    bound = max(64, min(SAMPLE, SAMPLE_BYTES // (8 * d)))
    steps = 1 << 30
    some = entries if n <= bound else entries.filter(
        F.pmod(F.xxhash64(F.lit(11), "v"), F.lit(steps)) < int(0.95 * bound / n * steps))
    found = some.select(F.xxhash64(F.lit(12), "v").alias("h"), "v").orderBy("h", "v").toArrow()
    return _vectors(found["v"].combine_chunks()) if found.num_rows else np.empty((0, d))


_HITS = "v array<double>, id long, rid long, score double"


def search(table: DataFrame, queries: Column, key: str = "vec_id", column: str = "embedding", neighbours: int = 10,
           list_entries: int = LIST_ENTRIES) -> DataFrame:
    """``neighbours`` nearest rows of each row for which ``queries`` (over ``key``) holds: query_id, rank, ``key``, score."""
    if key in ("query_id", "rank", "score", "rid", "v"):
        raise ValueError(f"the key may not be called {key}")
    rows = valid_rows(table.select(key, column), key, column)
    spark = rows.sparkSession
    empty = spark.createDataFrame([], f"query_id long, rank int, `{key}` long, score double")
    shape = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("d")).first()
    if not shape["n"]:
        return empty
    # A query needs at most the `neighbours` + 1 smallest ids of each vector: its own may be among them.
    least = Window.partitionBy("v").orderBy("id", "rid")
    entries = materialise(rows.withColumn("k", F.row_number().over(least)).filter(F.col("k") <= neighbours + 1)
                          .groupBy("v").agg(F.sort_array(F.collect_list(F.struct("id", "rid"))).alias("ids")), "entries")
    n = entries.count()
    sample = _sample(entries, n, shape["d"])
    if n < 2 and shape["n"] < 2:
        return empty
    lists = Lists(sample, max(1, min(-(-n // list_entries), len(sample) // SAMPLE_PER_LIST)))
    ratio = lists.measured_ratio(sample, neighbours)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                r, own, nearest = lists.assign(_vectors(b.column(0)))
                again = pa.array(r)
                yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(nearest), b.column(0).take(again),
                                                  b.column(1).take(again)], names=["list", "nearest", "v", "ids"])

    ids = "array<struct<id:bigint,rid:bigint>>"
    postings = materialise(entries.mapInArrow(assign, f"list long, nearest boolean, v array<double>, ids {ids}"),
                           "postings")
    counts = {r["list"]: (r["n"], r["own"]) for r in postings.groupBy("list").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("nearest").cast("int")).alias("own")).collect()}
    sizes = np.array([counts.get(c, (0, 0))[1] for c in range(len(lists.centroids))])

    asked = materialise(rows.withColumnRenamed("id", key).filter(queries).withColumnRenamed(key, "id"), "asked")

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                r, own, place = lists.probe(_vectors(b.column(0)), ratio, sizes, neighbours + 1)
                yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(place < FIRST_LISTS),
                                                  b.column(0).take(pa.array(r))], names=["list", "first", "v"])

    probes = materialise(asked.select("v").distinct().mapInArrow(probe, "list long, first boolean, v array<double>"),
                         "probes")
    load = {r["list"]: r["n"] for r in probes.groupBy("list").agg(F.count(F.lit(1)).alias("n")).collect()}
    # Blocks of a list: its entries are cut in `ep` parts and its queries in `qp`; each pair of parts is one group.
    cuts = spark.createDataFrame([(c, -(-counts[c][0] // BLOCK), -(-m // BLOCK)) for c, m in load.items() if c in counts],
                                 "list long, ep int, qp int")
    held = postings.join(F.broadcast(cuts), "list").select(
        "list", F.pmod(F.xxhash64("v"), "ep").cast("int").alias("e"), F.explode(F.sequence(F.lit(0), F.col("qp") - 1)).alias("q"),
        "v", "ids")

    def scan(wanted: DataFrame) -> DataFrame:
        """The hits of the probes (list, v, bound) in their lists."""
        sides = wanted.join(F.broadcast(cuts), "list").select(
            "list", F.explode(F.sequence(F.lit(0), F.col("ep") - 1)).alias("e"),
            F.pmod(F.xxhash64("v"), "qp").cast("int").alias("q"), "v", "bound")

        def block(query: pa.Table, entry: pa.Table) -> pa.Table:
            out: dict[str, list] = {"v": [], "id": [], "rid": [], "score": []}
            if query.num_rows and entry.num_rows:
                asked_v, held_v = query["v"].combine_chunks(), entry["v"].combine_chunks()
                x, y, bound = _vectors(asked_v), _vectors(held_v), query["bound"].to_numpy()
                d2 = _squares(x, y)
                top = min(neighbours + 1, len(y))
                edge = np.partition(d2, top - 1, axis=1)[:, top - 1]
                # Rounding of the product form, so that no row within the bound is lost.
                slack = 1e-12 * ((x * x).sum(axis=1) + (y * y).sum(axis=1).max())
                r, c = np.nonzero(d2 <= (np.minimum(edge, bound * bound) + slack)[:, None])
                score = distances(x[r], y[c])
                near = score <= bound[r]
                r, c, score = r[near], c[near], score[near]
                members = entry["ids"].combine_chunks().take(pa.array(c))
                each = np.diff(members.offsets.to_numpy())
                again = pa.array(np.repeat(r, each))
                flat = members.flatten()
                return pa.table({"v": asked_v.take(again), "id": flat.field("id"), "rid": flat.field("rid"),
                                 "score": pa.array(np.repeat(score, each))}, schema=hits)
            return pa.table(out, schema=hits)

        keys = ["list", "e", "q"]
        return sides.groupBy(*keys).cogroup(held.groupBy(*keys)).applyInArrow(block, _HITS)

    hits = pa.schema([("v", pa.list_(pa.float64())), ("id", pa.int64()), ("rid", pa.int64()), ("score", pa.float64())])
    order = Window.partitionBy("v").orderBy("score", "id", "rid")

    def nearest(found: DataFrame) -> DataFrame:
        """The neighbours + 1 nearest rows of each vector; a row found in several lists counts once."""
        return found.distinct().withColumn("k", F.row_number().over(order)).filter(F.col("k") <= neighbours + 1)

    early = materialise(nearest(scan(probes.filter("first").withColumn("bound", F.lit(float("inf"))))), "early-hits")
    bounds = early.groupBy("v").agg(F.count(F.lit(1)).alias("m"), F.max("score").alias("far")).select(
        "v", F.when(F.col("m") > neighbours, F.col("far")).otherwise(float("inf")).alias("bound"))
    late = scan(probes.filter("not first").join(bounds, "v").select("list", "v", "bound"))
    best = nearest(early.drop("k").unionByName(late)).groupBy("v").agg(
        F.sort_array(F.collect_list(F.struct("score", "id", "rid"))).alias("best"))
    # Each query row leaves itself out; what is left of the first neighbours + 1 holds its neighbours.
    others = F.slice(F.filter("best", lambda h: h["rid"] != F.col("rid")), 1, neighbours)
    return asked.join(best, "v").select(F.col("id").alias("query_id"), F.posexplode(others).alias("at", "hit")).select(
        "query_id", (F.col("at") + 1).alias("rank"), F.col("hit.id").alias(key), F.col("hit.score").alias("score"))
