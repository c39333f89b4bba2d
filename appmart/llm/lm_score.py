"""Scores of a hashed maximum-entropy language model, beside an add-one unigram base.

P(token | history) = P(class | history) P(share | class, history) P(token | share).
The first two factors are softmaxes over hashed features of the history: the
previous token (bigram), the two previous ones (trigram) and the one before
the previous (skip), in the second factor each together with the class. The
frequent tokens are binned into classes of like probability mass, each class
into shares likewise; all other tokens form the last class, which is one
share. Within a share the maximum-entropy solution without history features is
the relative frequency, in the last class add-one smoothed with one portion
for unseen tokens. Classes and shares without a token have no probability, so
the model sums to one.

The hashed tables grow with the training tokens, up to MAX_BUCKETS entries each.

Training: every task runs AdaGrad minibatches over its documents from the
weights of the last round. A row of weights moves by the mean of the tasks'
moves, each counted by the tokens that met the row there, so a history that
few tasks have is not thinned out by the others. The moves are added in two
steps of grouping, so what meets in one place is bounded. Each round takes its
own share of the training documents, together all of them.

Counts cover all training tokens. Only the frequent ones (at most
MAX_FREQUENT, a cut by count) are broadcast; the counts of all others are
joined. Documents are tokenised in numpy batches.

Defined results: null or empty texts are a single end token; a null doc_id is
not held out; repeated rows are scored alike and counted each; empty tables
give an empty result, no training rows N = V = 0.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, LongType

from .store import materialise
from .tokens import mix, text_chunks, words

#: Classes, and shares of a class.
CLASSES = 16
#: Entries of each hashed table: one per TOKENS_A_BUCKET training tokens, between these. A task holds two tables of
#: 64 bytes an entry for each feature and factor, 50 MB in all at most, however large the corpus.
MIN_BUCKETS, MAX_BUCKETS, TOKENS_A_BUCKET = 1 << 14, 1 << 16, 1024
#: Features of a history.
TABLES = 3
#: A training task has this many tokens or more, if there are tasks for all cores; each sends a model's moves.
TASK_TOKENS = 1 << 23
ROUNDS = 2
MAX_FREQUENT = 1 << 19
MINIBATCH = 1 << 14
RATE = 0.3
END, START = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 7, is 2."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(7)) == 2, F.lit(False))


def _tokens(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per chunk of rows: all token hashes with an end after every row, and where rows begin."""
    for _, data, offsets in text_chunks(texts):
        h, first = words(data, offsets)
        rows = len(first) - 1
        out = np.empty(len(h) + rows, dtype=np.uint64)
        ends = first[1:] + np.arange(rows)
        word = np.ones(len(out), dtype=bool)
        word[ends] = False
        out[word], out[ends] = h, END
        yield out, np.concatenate([[0], ends + 1])


def _signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def count_tokens(docs: DataFrame) -> DataFrame:
    """(h, c) of every token of the training rows of ``docs`` (text, held_out); stored."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [t for t, _ in _tokens(batch.column(0))]
            h, c = np.unique(np.concatenate(found) if found else np.empty(0, np.uint64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(_signed(h)), pa.array(c.astype(np.int64))], ["h", "c"])
    partial = docs.filter(~F.col("held_out")).select("text").mapInArrow(count, "h long, c long")
    return materialise(partial.groupBy("h").agg(F.sum("c").alias("c")), "lm-counts")


def frequent(counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes and counts of the most frequent tokens: all with at least the
    smallest count that leaves at most MAX_FREQUENT of them."""
    scale = F.floor(F.log2("c") * 4)
    sizes = sorted(((r["s"], r["n"], r["least"]) for r in counts.groupBy(scale.alias("s")).agg(
        F.count(F.lit(1)).alias("n"), F.min("c").alias("least")).collect()), reverse=True)
    total, least = 0, None
    for _, n, low in sizes:
        if total + n > MAX_FREQUENT:
            break
        total, least = total + n, low
    if least is None:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    rows = counts.filter(F.col("c") >= least).toPandas()
    h, c = rows["h"].to_numpy(np.int64).view(np.uint64), rows["c"].to_numpy(np.int64)
    order = np.argsort(h)
    return h[order], c[order]


def bins_of(counts: np.ndarray, bins: int) -> np.ndarray:
    """Bin 0 to ``bins`` - 1 of each token: by falling count, like mass of square-rooted counts in each."""
    order = np.lexsort((np.arange(len(counts)), -counts))
    mass = np.cumsum(np.sqrt(counts[order].astype(np.float64)))
    out = np.empty(len(counts), dtype=np.int64)
    if len(counts):
        out[order] = np.minimum((mass - mass[0]) / mass[-1] * bins, bins - 1).astype(np.int64)
    return out


class Classes:
    """Class and share of the frequent tokens by their place, the last entry for all others; which of them exist."""

    def __init__(self, counts: np.ndarray):
        cls, share = bins_of(counts, CLASSES - 1), np.zeros(len(counts), dtype=np.int64)
        for k in range(CLASSES - 1):
            share[cls == k] = bins_of(counts[cls == k], CLASSES)
        self.cls, self.share = np.append(cls, CLASSES - 1), np.append(share, 0)
        self.shares = np.zeros((CLASSES, CLASSES), dtype=bool)
        self.shares[self.cls, self.share] = True
        self.classes = self.shares.any(axis=1)
        self.split = self.shares.sum(axis=1) > 1


def table_size(tokens: int) -> int:
    """Entries of each hashed table for so many training tokens."""
    return min(MAX_BUCKETS, max(MIN_BUCKETS, 1 << max(0, tokens // TOKENS_A_BUCKET).bit_length()))


def _look_up(h: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Place of each token among ``known``, -1 for others."""
    if not len(known):
        return np.full(len(h), -1)
    at = np.minimum(np.searchsorted(known, h), len(known) - 1)
    return np.where(known[at] == h, at, -1)


def _features(tokens: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Hashes (TABLES x tokens) of the history of each token; histories begin anew in every row."""
    one = np.empty_like(tokens)
    one[1:], one[first[:-1]] = tokens[:-1], START
    two = np.empty_like(tokens)
    two[1:], two[first[:-1]] = one[:-1], START
    return np.stack([mix(one), mix(mix(two) + one), mix(two ^ np.uint64(0x9E3779B97F4A7C15))])


def _weight_rows(buckets: int) -> int:
    """Rows of the weights: both factors' tables, then the biases of the classes and of each class's shares."""
    return 2 * TABLES * buckets + 1 + CLASSES


def _class_rows(hashed: np.ndarray, buckets: int) -> np.ndarray:
    """Weight rows of the first factor, the bias last."""
    n = hashed.shape[1]
    rows = (hashed & np.uint64(buckets - 1)).astype(np.int64) + buckets * np.arange(TABLES)[:, None]
    return np.concatenate([rows, np.full((1, n), 2 * TABLES * buckets)])


def _share_rows(hashed: np.ndarray, cls: np.ndarray, buckets: int) -> np.ndarray:
    """Weight rows of the second factor in classes ``cls``, the bias last."""
    both = mix(hashed + (cls.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
    rows = (both & np.uint64(buckets - 1)).astype(np.int64) + buckets * np.arange(TABLES, 2 * TABLES)[:, None]
    return np.concatenate([rows, (2 * TABLES * buckets + 1 + cls)[None]])


def _odds(weights: np.ndarray, rows: np.ndarray, there: np.ndarray) -> np.ndarray:
    """Log odds of each outcome, less the largest of its token; of those not ``there`` -inf."""
    z = weights.take(rows[0], axis=0)
    for table in rows[1:]:
        z += weights.take(table, axis=0)
    if not there.all():
        z = np.where(there, z, np.float32(-np.inf))
    return z - z.max(axis=1, keepdims=True)


def _log_probability(weights: np.ndarray, rows: np.ndarray, there: np.ndarray, outcome: np.ndarray) -> np.ndarray:
    z = _odds(weights, rows, there)
    return z[np.arange(len(z)), outcome] - np.log(np.exp(z).sum(axis=1))


def _step(weights: np.ndarray, squares: np.ndarray, hits: np.ndarray, rows: np.ndarray, there: np.ndarray,
          target: np.ndarray, buckets: int) -> None:
    """One AdaGrad minibatch of one factor; ``hits`` counts the tokens that met each row."""
    gap = np.exp(_odds(weights, rows, there))
    gap /= gap.sum(axis=1, keepdims=True)
    gap[np.arange(len(target)), target] -= 1
    for table in rows:
        order = np.argsort((table & (buckets - 1)).astype(np.uint16), kind="stable")  # 16 bits sort by radix
        sorted_rows = table[order]
        begin = np.flatnonzero(np.concatenate([[True], sorted_rows[1:] != sorted_rows[:-1]]))
        g = np.add.reduceat(gap.take(order, axis=0), begin, axis=0)
        at = sorted_rows[begin]
        total = squares.take(at, axis=0)
        total += g * g
        squares[at] = total
        g *= np.float32(-RATE)
        g /= np.sqrt(total)
        g += weights.take(at, axis=0)
        weights[at] = g
        hits[at] += np.diff(np.append(begin, len(table)))


def _train_pass(weights: np.ndarray, squares: np.ndarray, hits: np.ndarray, hashed: np.ndarray, at: np.ndarray,
                known: Classes, buckets: int) -> None:
    """AdaGrad over one chunk, in minibatches; ``at`` are the tokens' places among the frequent ones."""
    for a in range(0, len(at), MINIBATCH):
        h, y, share = hashed[:, a:a + MINIBATCH], known.cls[at[a:a + MINIBATCH]], known.share[at[a:a + MINIBATCH]]
        _step(weights, squares, hits, _class_rows(h, buckets), known.classes, y, buckets)
        some = np.flatnonzero(known.split[y])
        if len(some):
            h, y = h[:, some], y[some]
            _step(weights, squares, hits, _share_rows(h, y, buckets), known.shares[y], share[some], buckets)


def log_history(weights: np.ndarray, hashed: np.ndarray, at: np.ndarray, known: Classes, buckets: int) -> np.ndarray:
    """log P(class | history) + log P(share | class, history) of each token."""
    out = np.empty(len(at))
    for a in range(0, len(at), MINIBATCH):
        h, y, share = hashed[:, a:a + MINIBATCH], known.cls[at[a:a + MINIBATCH]], known.share[at[a:a + MINIBATCH]]
        p = _log_probability(weights, _class_rows(h, buckets), known.classes, y).astype(np.float64)
        some = np.flatnonzero(known.split[y])
        if len(some):
            rows = _share_rows(h[:, some], y[some], buckets)
            p[some] += _log_probability(weights, rows, known.shares[y[some]], share[some])
        out[a:a + MINIBATCH] = p
    return out


def train(docs: DataFrame, known: np.ndarray, classes: Classes, tokens: int) -> np.ndarray:
    """Weights (_weight_rows x CLASSES) after ROUNDS rounds over ``docs`` (text, held_out, turn) of ``tokens`` training
    tokens."""
    sc, buckets = docs.sparkSession.sparkContext, table_size(tokens)
    weights = np.zeros((_weight_rows(buckets), CLASSES), dtype=np.float32)
    vocabulary = sc.broadcast((known, classes))
    block = 1 << 12
    tasks = max(sc.defaultParallelism, tokens // ROUNDS // TASK_TOKENS)
    slots = max(1, math.isqrt(tasks))
    for number in range(ROUNDS):
        start = sc.broadcast(weights)

        def local(batches: Iterator[pa.RecordBatch], start=start) -> Iterator[pa.RecordBatch]:
            known, classes = vocabulary.value
            mine = start.value.copy()
            squares, hits = np.full(mine.shape, 1e-2, dtype=np.float32), np.zeros((len(mine), 1), dtype=np.float32)
            seen = hits[:, 0]
            for batch in batches:
                for tokens, first in _tokens(batch.column(0)):
                    _train_pass(mine, squares, seen, _features(tokens, first), _look_up(tokens, known), classes, buckets)
            slot = TaskContext.get().partitionId() % slots
            for k, a in enumerate(range(0, len(mine), block)):
                met = hits[a:a + block]
                if met.any():
                    moves = np.concatenate([(mine[a:a + block] - start.value[a:a + block]) * met, met], axis=1)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([k], pa.int32()), pa.array([slot], pa.int32()), pa.array([moves.tobytes()], pa.binary())],
                        ["block", "slot", "moves"])

        def added(table: pa.Table) -> pa.Table:
            total = sum(np.frombuffer(w.as_py(), np.float32).astype(np.float64) for w in table.column("moves"))
            return pa.table({"block": table.column("block")[:1], "slot": table.column("slot")[:1],
                             "moves": pa.array([total.astype(np.float32).tobytes()], pa.binary())})
        kind = "block int, slot int, moves binary"
        turn = docs.filter(~F.col("held_out") & (F.col("turn") == number)).select("text").coalesce(tasks)
        summed = turn.mapInArrow(local, kind).groupBy("block", "slot").applyInArrow(added, kind)
        weights = weights.copy()
        for p in summed.groupBy("block").applyInArrow(added, kind).collect():  # the model's moves
            moves = np.frombuffer(p["moves"], np.float32).reshape(-1, CLASSES + 1)
            a = p["block"] * block
            weights[a:a + len(moves)] += moves[:, :-1] / np.maximum(moves[:, -1:], 1)
        start.unpersist()
    return weights


def score(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    rows = docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"),
                       F.pmod(F.xxhash64("text", "doc_id"), F.lit(ROUNDS)).alias("turn"))
    counts = count_tokens(rows)
    sums = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    n, v = sums["n"], sums["v"]
    known, known_counts = frequent(counts)
    classes = Classes(known_counts)
    buckets, weights = table_size(n), train(rows, known, classes, n)
    rest = np.log10(n - known_counts.sum() + v - len(known) + 1)
    leaf = classes.cls[:-1] * CLASSES + classes.share[:-1]
    mass = np.bincount(leaf, weights=known_counts, minlength=CLASSES * CLASSES)
    # By place among the frequent tokens; the last entry is for all others, whose counts are joined below.
    log_base = np.append(np.log10(known_counts + 1), 0.0)
    log_within = np.append(np.log10(known_counts) - np.log10(mass[leaf]), -rest)
    shared = spark.sparkContext.broadcast((known, classes, log_base, log_within, weights))

    def evaluate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, classes, log_base, log_within, weights = shared.value
        for batch in batches:
            size, seen, base, model, rare, times = [], [], [], [], [], []
            for tokens, first in _tokens(batch.column(2)):
                at = _look_up(tokens, known)
                p = log_history(weights, _features(tokens, first), at, classes, buckets)
                begin = first[:-1]
                size += np.diff(first).tolist()
                seen += np.add.reduceat((at >= 0).astype(np.int64), begin).tolist()
                base += np.add.reduceat(log_base[at], begin).tolist()
                model += np.add.reduceat(p / np.log(10) + log_within[at], begin).tolist()
                for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
                    h, k = np.unique(tokens[a:b][at[a:b] < 0], return_counts=True)
                    rare.append(_signed(h))
                    times.append(k)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(size, pa.int64()), pa.array(seen, pa.int64()),
                 pa.array(base, pa.float64()), pa.array(model, pa.float64()), pa.array(rare, pa.list_(pa.int64())),
                 pa.array(times, pa.list_(pa.int64()))],
                ["doc_id", "held_out", "n_tokens", "seen", "base", "model", "rare", "times"])
    whole = rows.select("doc_id", "held_out", "text").mapInArrow(
        evaluate, rows.select("doc_id", "held_out").schema.add("n_tokens", "long").add("seen", "long")
        .add("base", "double").add("model", "double").add("rare", ArrayType(LongType())).add("times", ArrayType(LongType())))
    stored = materialise(whole.withColumn("rid", F.monotonically_increasing_id()), "lm-scored")
    others = stored.select("rid", F.explode(F.arrays_zip("rare", "times")).alias("x")).select(
        "rid", F.col("x.rare").alias("h"), F.col("x.times").alias("k"))
    found = others.join(counts, "h").groupBy("rid").agg(
        F.sum("k").alias("also"), F.sum(F.col("k") * F.log10(F.col("c") + 1)).alias("more"))
    more = F.coalesce("more", F.lit(0.0))
    return stored.drop("rare", "times").join(found, "rid", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("seen") + F.coalesce("also", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + more - F.col("n_tokens") * float(np.log10(n + v + 1))).alias("base_score"),
        (F.col("model") + more).alias("score"))
