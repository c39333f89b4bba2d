"""Soft-membership mixing of documents to target domain weights.

Domains come from the labels table: clean, poor (low quality) and toxic. A
softmax classifier fitted on a bounded sample of labelled documents predicts
each document's domain posteriors p_d. Nonnegative rates r_d are then fitted so
that the expected domain token totals, the sum of r_d tokens_d p_d, match the
targets in least squares.

The fit is projected gradient descent over all documents. With documents
weighted by tokens and totals by the inverse Gram matrix of the posteriors
the Lipschitz constant is one, so steps need no tuning:
``r_d <- max(0, r_d - p_d . g)``, ``g = Gram^-1 (totals(r) - targets)``.
A step is one aggregation; only the K totals reach the driver, and r_d is an
expression over the stored posteriors and the past g, so nothing per document
is kept between steps.

The targets' total is what makes the first domain's target its present total.
A domain without labelled rows has posterior zero and its weight goes to the
others; without any label every document is of the first domain.

Defined results: null or empty texts have no tokens and keep the rate of their
posteriors; unlabelled documents are predicted like labelled ones; a document
labelled twice counts twice in the sample; repeated rows are rows of their
own; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from .store import materialise
from .tokens import PUNCTUATION, hash_spans, text_chunks, word_spans, words

DOMAINS = ("clean", "poor", "toxic")
TARGETS = {"clean": 0.95, "poor": 0.05, "toxic": 0.0}
#: Bound of the training sample: labelled documents per domain.
SAMPLE_PER_DOMAIN = 2500
VOCABULARY = 256
PREFIXES = (4, 5)
RIDGE = 3e-4
STEPS = 25
_SYMBOLS = np.zeros(256, dtype=bool)
_SYMBOLS[[ord(c) for c in "#*$%&|<>{}[]_=~^\\"]] = True
_BYTES = np.arange(256)
_CAPITALS = (_BYTES >= 65) & (_BYTES <= 90)
_DIGITS = (_BYTES >= 48) & (_BYTES <= 57)
SHAPES = 5


def _documents(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per text: number of words, hashes of its distinct runs of letters and digits and of
    their first letters (PREFIXES bytes), and shape features."""
    for _, data, offsets in text_chunks(texts):
        _, whole = words(data, offsets)
        start, length, first = word_spans(data, offsets, PUNCTUATION)
        h = [hash_spans(data, start, length)]
        h += [hash_spans(data, start, np.minimum(length, k)) + np.uint64(k) for k in PREFIXES]
        marks = [np.concatenate([[0], np.cumsum(m[data])]) for m in (_SYMBOLS, _CAPITALS, _DIGITS)]
        for i in range(len(offsets) - 1):
            a, b, n = offsets[i], offsets[i + 1], int(whole[i + 1] - whole[i])
            distinct = np.unique(np.concatenate([x[first[i]:first[i + 1]] for x in h]))
            one = len(np.unique(h[0][first[i]:first[i + 1]]))
            size = max(1, b - a)
            yield n, distinct, np.array([*((m[b] - m[a]) / size for m in marks), one / max(1, first[i + 1] - first[i]),
                                         min(size / max(1, n), 40) / 10], dtype=np.float32)


class Classifier:
    """Softmax regression on the presence of selected words and on shape features."""

    def __init__(self, vocabulary: np.ndarray, mean: np.ndarray, scale: np.ndarray, weights: np.ndarray,
                 bias: np.ndarray) -> None:
        self.vocabulary, self.mean, self.scale, self.weights, self.bias = vocabulary, mean, scale, weights, bias

    def arrays(self) -> tuple[np.ndarray, ...]:
        """What ``__init__`` takes; plain arrays can be broadcast."""
        return self.vocabulary, self.mean, self.scale, self.weights, self.bias

    def posterior(self, distinct: np.ndarray, shape: np.ndarray) -> np.ndarray:
        z = self.bias + ((shape - self.mean) / self.scale) @ self.weights[-SHAPES:]
        if len(self.vocabulary) and len(distinct):
            at = np.minimum(np.searchsorted(self.vocabulary, distinct), len(self.vocabulary) - 1)
            z = z + self.weights[at[self.vocabulary[at] == distinct]].sum(axis=0)
        e = np.exp(z - z.max())
        return e / e.sum()


def fit(y: np.ndarray, present_words: np.ndarray, shape: np.ndarray, vocabulary: np.ndarray,
        prior: np.ndarray) -> Classifier:
    """Fit on a domain-balanced sample: domains, which words of the vocabulary each row has, shapes; ``prior`` are the
    labelled shares."""
    present = np.unique(y)
    mean, scale = shape.mean(axis=0), shape.std(axis=0) + 1e-3
    x = np.hstack([present_words.astype(np.float32), ((shape - mean) / scale).astype(np.float32)])
    target = np.eye(len(DOMAINS), dtype=np.float32)[y]
    w = np.zeros((x.shape[1], len(DOMAINS)), dtype=np.float32)
    bias = np.where(np.isin(np.arange(len(DOMAINS)), present), 0.0, -50.0).astype(np.float32)
    first, second = np.zeros((len(w) + 1, len(DOMAINS))), np.zeros((len(w) + 1, len(DOMAINS)))
    for step in range(1, 301):  # Adam on the mean log loss with a small ridge
        z = x @ w + bias
        e = np.exp(z - z.max(axis=1, keepdims=True))
        gap = (e / e.sum(axis=1, keepdims=True) - target) / len(y)
        g = np.vstack([x.T @ gap + RIDGE * w, gap.sum(axis=0)])
        first, second = 0.9 * first + 0.1 * g, 0.99 * second + 0.01 * g * g
        move = 0.05 * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.99 ** step)) + 1e-9)
        w -= move[:-1].astype(np.float32)
        bias -= move[-1].astype(np.float32) * np.isin(np.arange(len(DOMAINS)), present)
    sampled = np.bincount(y, minlength=len(DOMAINS)) / len(y)
    bias = bias + np.where(sampled > 0, np.log(np.maximum(prior, 1e-9) / np.maximum(sampled, 1e-9)), 0)
    return Classifier(vocabulary, mean, scale, w.astype(np.float64), bias)


def train(docs: DataFrame, labels: DataFrame) -> Classifier | None:
    """Fit on the labelled documents of ``docs``, at most SAMPLE_PER_DOMAIN a domain (lowest id hashes); None without any."""
    domain = F.when(F.col("toxic") == 1, 2).when(F.col("quality") == 0, 1).otherwise(0)
    known = labels.filter(F.col("doc_id").isNotNull()).select(
        F.col("doc_id").alias("_id"), domain.alias("domain"), F.xxhash64("doc_id").alias("_h"))
    ids = docs.select(F.col("doc_id").alias("_id"))
    found = materialise(known.join(ids, "_id", "left_semi"), "mixing-labelled")
    counts = {r["domain"]: r["n"] for r in found.groupBy("domain").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return None
    picked = None
    for k in sorted(counts):
        some = found.filter(F.col("domain") == k).orderBy("_h", "_id").limit(SAMPLE_PER_DOMAIN).select("_id", "domain")
        picked = some if picked is None else picked.unionByName(some)
    picked = F.broadcast(materialise(picked, "mixing-sample"))  # at most 3 x SAMPLE_PER_DOMAIN rows

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(_documents(batch.column(2)))
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1),
                pa.array([r[1].view(np.int64) for r in rows], pa.list_(pa.int64())),
                pa.array([r[2].tobytes() for r in rows], pa.binary())], ["domain", "h", "w", "s"])
    sample = materialise(docs.select(F.col("doc_id").alias("_id"), "text").join(picked, "_id").select(
        "domain", F.xxhash64("_id").alias("h"), "text").mapInArrow(
        features, "domain int, h long, w array<long>, s binary"), "mixing-features")
    words_ = vocabulary_of(sample)

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            has = np.zeros((batch.num_rows, VOCABULARY), dtype=bool)
            lists = batch.column(2)
            flat, ends = lists.flatten().to_numpy(), np.diff(lists.offsets.to_numpy())
            owner, flat = np.repeat(np.arange(len(lists)), ends), flat.view(np.uint64)
            if len(words_) and len(flat):
                at = np.minimum(np.searchsorted(words_, flat), len(words_) - 1)
                hit = words_[at] == flat
                has[owner[hit], at[hit]] = True
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1),
                pa.array([x.tobytes() for x in np.packbits(has, axis=1)], pa.binary()), batch.column(3)],
                ["domain", "h", "w", "s"])
    # Rows of a fixed width, and as many: repeated ids do not add to them.
    small = materialise(sample.mapInArrow(chosen, "domain int, h long, w binary, s binary"), "mixing-chosen")
    rows = [r for k in sorted(counts) for r in
            small.filter(F.col("domain") == k).orderBy("h", "w", "s").limit(SAMPLE_PER_DOMAIN).collect()]
    if not rows:
        return None
    total = sum(counts.values())
    prior = np.array([counts.get(k, 0) / total for k in range(len(DOMAINS))])
    has = np.unpackbits(np.array([np.frombuffer(r["w"], np.uint8) for r in rows]), axis=1)[:, :len(words_)]
    return fit(np.array([r["domain"] for r in rows]), has, np.array([np.frombuffer(r["s"], np.float32) for r in rows]),
               words_, prior)


def vocabulary_of(sample: DataFrame) -> np.ndarray:
    """The VOCABULARY words whose share of documents differs most between domains, in standard deviations; sorted.

    Counted and chosen in Spark, so however long the sampled texts are, only these come to the driver.
    """
    sizes = {r["domain"]: r["n"] for r in sample.groupBy("domain").agg(F.count(F.lit(1)).alias("n")).collect()}
    seen = sample.select("domain", F.explode("w").alias("word")).groupBy("word").agg(*[
        (F.count_if(F.col("domain") == k) / float(n)).alias(f"r{k}") for k, n in sorted(sizes.items())])
    rates = [F.col(f"r{k}") for k in sorted(sizes)]
    overall = sum(rates[1:], rates[0]) / float(len(rates))
    spread = (F.greatest(*rates) - F.least(*rates)) if len(rates) > 1 else F.lit(0.0)
    best = seen.select("word", (spread / F.sqrt(overall * (1 - overall) + 1e-3)).alias("score")).orderBy(
        F.desc("score"), F.col("word").bitwiseXOR(F.lit(-1 << 63))).limit(VOCABULARY).collect()
    return np.sort(np.array([r["word"] for r in best], dtype=np.int64).view(np.uint64))


def posteriors(docs: DataFrame, model: Classifier | None, keep: list[str] | None = None) -> DataFrame:
    """``d`` (struct of ``keep``, by default all columns), ``u`` (uniform hash), ``tokens`` and p0, p1, ... of every row; stored."""
    keep = docs.columns if keep is None else keep
    whole = "text" in keep
    shared = docs.sparkSession.sparkContext.broadcast(model.arrays() if model else None)
    packed = docs.select(F.struct(*keep).alias("d"), *([] if whole else ["text"]), (
        F.pmod(F.xxhash64(F.col("doc_id"), F.col("text")), F.lit(1 << 30)) / float(1 << 30)).alias("u"))
    schema = packed.select("d", "u").schema.add("tokens", "long")
    for k in range(len(DOMAINS)):
        schema = schema.add(f"p{k}", "double")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Classifier(*shared.value) if shared.value else None
        for batch in batches:
            d = batch.column("d")
            texts = pc.struct_field(d, "text") if whole else batch.column("text")
            sure = np.eye(len(DOMAINS))[0]
            rows = [(n, model.posterior(w, s) if model else sure) for n, w, s in _documents(texts)]
            p = np.array([r[1] for r in rows]).reshape(-1, len(DOMAINS))
            yield pa.RecordBatch.from_arrays(
                [d, batch.column("u"), pa.array([r[0] for r in rows], pa.int64()),
                 *(pa.array(p[:, k]) for k in range(len(DOMAINS)))],
                ["d", "u", "tokens", *(f"p{k}" for k in range(len(DOMAINS)))])
    return materialise(packed.mapInArrow(score, schema), "mixing-posteriors")


def fit_rates(scored: DataFrame, targets: dict[str, float]) -> tuple[Column, np.ndarray, np.ndarray]:
    """The rate expression over p0, p1, ..., the reached totals and the targets."""
    ps = [F.col(f"p{k}") for k in range(len(DOMAINS))]

    def totals(rate: Column) -> np.ndarray:
        row = scored.agg(*[F.sum(F.col("tokens") * rate * p).alias(f"t{k}") for k, p in enumerate(ps)]).first()
        return np.array([x or 0.0 for x in row])
    gram_row = scored.agg(*[F.sum(F.col("tokens") * a * b) for a in ps for b in ps]).first()
    gram = np.array([x or 0.0 for x in gram_row]).reshape(len(ps), len(ps))
    rate = F.lit(1.0)
    now = totals(rate)
    share = np.array([targets[d] for d in DOMAINS]) * (now > 1e-9)
    want = now[0] * share / share[0] if share[0] > 0 else now
    inverse = np.linalg.pinv(gram, rcond=1e-9)
    for _ in range(STEPS):
        step = inverse @ (now - want)
        if np.abs(now - want).max() <= 1e-6 * max(want.sum(), 1):
            break
        rate = F.greatest(F.lit(0.0), rate - sum((p * float(g) for p, g in zip(ps, step)), F.lit(0.0)))
        now = totals(rate)
    return rate, now, want


def mix(docs: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS, keep: list[str] | None = None) -> DataFrame:
    """Every row of ``docs``: d, tokens, p0.., rate and copies (long): the rate rounded
    up or down by the row's uniform hash, so expected copies equal the rate."""
    scored = posteriors(docs, train(docs, labels), keep)
    rate, _, _ = fit_rates(scored, targets)
    rated = scored.withColumn("rate", rate)
    return rated.withColumn("copies", F.floor(F.col("rate") + F.col("u")))


def mixed(docs: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS) -> DataFrame:
    """The rows of ``docs`` as often as the mixture takes them, with their columns."""
    rows = mix(docs, labels, targets).filter("copies > 0")
    return rows.select("d", F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("_k")).select("d.*")
