"""Toxicity by non-negative positive-unlabelled learning.

Method: numpy classifiers are trained from confirmed toxic examples and
unlabelled text.  With class prior p, positives P and unlabelled U the risk is

    p * E_P[loss(f)] + max(0, E_U[loss(-f)] - p * E_P[loss(-f)])

so U, which holds toxic texts too, isn't taken for clean, and the second part,
which would fall below 0 by overfitting, is held at 0 (then its gradient is
reversed).  The loss is logistic, so scores are probabilities.

* Features are the presence of words and word beginnings (3 to 6 bytes), in
  ASCII lower case, hashed to ``1 << HASH_BITS`` numbers.  Long texts count a
  feature once, like short ones.
* The classifiers see a bounded, documented sample: at most ``MAX_POSITIVE``
  positives and about ``MAX_UNLABELLED`` other rows, by hash of the id.
  ``MAX_FEATURES`` features that stand out in P against U are kept; their
  counts are one aggregation.  ``MODELS`` classifiers train in parallel tasks
  on resampled rows and their mean scores.
* Every document is scored whole, in one pass without a shuffle.
* The class prior, the share of toxic texts in U, is estimated from P and U
  alone (``estimate_prior``): labels say nothing of it, as they may be of toxic
  texts only or of any other choice.  A caller who knows it gives it.

Cases: null and empty texts have no features and get the score of the bias; a
label table without toxic rows scores 0 throughout, and so, with a warning,
does one whose toxic rows are not among the documents or have nothing in
common; rows without an id are scored and never learnt from; repeated rows score alike; of repeated labels
one toxic is enough; an empty table gives an empty table; other columns are
not looked at.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sortproof._pickling import ship_by_value
from sortproof.session import scratch_path, write_and_read
from sortproof.llm.utf8 import blocks, flat, span_hashes

HASH_BITS = 20
BEGINNINGS = (3, 4, 5, 6)
#: Bounds of the sample that the classifiers are fitted on.
MAX_POSITIVE = 6000
MAX_UNLABELLED = 18_000
MAX_FEATURES = 4096
#: A feature is kept if it is in so many positives and so many times as frequent there as in U.
MIN_POSITIVES = 3
MIN_LIFT = 2.5
MODELS = 3
STEPS = 600
RATE = 0.05
DECAY = 1e-4
#: The part of P that a set must hold to bound the prior, and what the prior is kept within.
PRIOR_REACH = 0.3
PRIOR_BOUNDS = (0.001, 0.9)
#: At this score a text counts as toxic.
THRESHOLD = 0.7
SEED = 5

# Bytes of words are letters and digits of ASCII and all bytes above it.
_IN_WORD = np.zeros(256, bool)
_IN_WORD[list(b"0123456789abcdefghijklmnopqrstuvwxyz") + list(range(128, 256))] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def feature_pairs(texts: pa.Array, hash_bits: int = HASH_BITS) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) of all words and word beginnings, repeats included."""
    data, offsets = flat(texts)
    data = _LOWER[data]
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = _IN_WORD[data]
    begins, stops = inside[1:-1] & ~inside[:-2], inside[1:-1] & ~inside[2:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    begins[edges] |= inside[edges + 1]
    stops[edges - 1] |= inside[edges]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    row = np.searchsorted(offsets, starts, "right") - 1
    rows, features = [row], [span_hashes(data, starts, ends)]
    for size in BEGINNINGS:
        longer = np.flatnonzero(ends - starts > size)
        rows.append(row[longer])
        features.append(span_hashes(data, starts[longer], starts[longer] + size))
    shift = np.uint64(64 - hash_bits)
    return np.concatenate(rows), (np.concatenate(features) >> shift).astype(np.int32)


def held_out(doc_id: Column) -> Column:
    """Rows of the test fold: crc32 of the id as text leaves 1 modulo 3."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def _sample_features(sample: DataFrame) -> DataFrame:
    """``positive, features`` (distinct, sorted) of the sample's rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch, "text"):
                row, feature = feature_pairs(block.column("text"))
                pairs = np.unique((row.astype(np.int64) << 32) | feature)
                at = np.searchsorted(pairs >> 32, np.arange(block.num_rows + 1))
                lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(pairs & 0xFFFFFFFF, pa.int32()))
                yield pa.RecordBatch.from_arrays([block.column("positive"), lists], ["positive", "features"])

    return sample.select("positive", "text").mapInArrow(run, "positive boolean, features array<int>")


def pu_gradient(
    f: np.ndarray, positive: np.ndarray, prior: float
) -> tuple[float, np.ndarray]:
    """Non-negative PU risk of the margins ``f`` and the gradient to follow, per row."""
    n_p, n_u = max(1, int(positive.sum())), max(1, int((~positive).sum()))
    loss = lambda z: np.logaddexp(0, -z)
    slope = lambda z: -1 / (1 + np.exp(np.clip(z, -30, 30)))
    fp, fu = f[positive], f[~positive]
    first = prior * loss(fp).mean() if len(fp) else 0.0
    second = (loss(-fu).mean() if len(fu) else 0.0) - (prior * loss(-fp).mean() if len(fp) else 0.0)
    grad = np.zeros(len(f))
    if second >= 0:
        grad[positive] = prior * slope(fp) / n_p + prior * slope(-fp) / n_p
        grad[~positive] = -slope(-fu) / n_u
    else:  # climb back: the part held at 0, reversed
        grad[positive] = -prior * slope(-fp) / n_p
        grad[~positive] = slope(-fu) / n_u
    return first + max(0.0, second), grad


def estimate_prior(row: np.ndarray, feature: np.ndarray, positive: np.ndarray, n_features: int) -> float:
    """Share of positives among the unlabelled rows.

    Rows are scored by the log lifts of their features, learnt on the other
    half of the rows.  Of any set of texts, U's share of it is at least the
    prior times P's share; the sets here are the texts above a score, and the
    least ratio of the two shares, each with one standard error added, is the
    estimate (too low a prior costs recall, the error goes with the size of the
    sample).  Sets with less than ``PRIOR_REACH`` of P are too small to tell.
    """
    n, ratios = len(positive), []
    half = np.zeros(n, bool)
    for kind in (positive, ~positive):
        half[np.flatnonzero(kind)[1::2]] = True
    for test in (half, ~half):
        learnt = ~test[row]
        counts = [np.bincount(feature[learnt & (positive[row] == k)], minlength=n_features) + 0.5 for k in (True, False)]
        sizes = [1 + (~test & (positive == k)).sum() for k in (True, False)]
        lift = np.log(counts[0] / sizes[0]) - np.log(counts[1] / sizes[1])
        score = np.bincount(row, lift[feature], n)
        in_p, in_u = np.sort(score[test & positive])[::-1], np.sort(score[test & ~positive])
        if not len(in_p) or not len(in_u):
            continue
        share_p = np.arange(1, len(in_p) + 1) / len(in_p)
        share_u = (len(in_u) - np.searchsorted(in_u, in_p, "left") + 0.5) / (len(in_u) + 1)
        n_above = np.arange(1, len(in_p) + 1), len(in_u) - np.searchsorted(in_u, in_p, "left") + 0.5
        upper = share_u / share_p * (1 + np.sqrt(1 / n_above[0] + 1 / n_above[1]))
        ratios.append(upper[share_p >= PRIOR_REACH].min())
    return float(np.clip(np.mean(ratios), *PRIOR_BOUNDS)) if ratios else PRIOR_BOUNDS[0]


def train(
    row: np.ndarray, feature: np.ndarray, positive: np.ndarray, n_features: int, prior: float, steps: int = STEPS
) -> np.ndarray:
    """Weights of the features and, last, the bias, by Adam on the whole sample."""
    w, n = np.zeros(n_features + 1), len(positive)
    w[-1] = np.log(prior / (1 - prior))
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, steps + 1):
        f = w[-1] + np.bincount(row, w[feature], n)
        _, g = pu_gradient(f, positive, prior)
        grad = np.append(np.bincount(feature, g[row], n_features) + DECAY * w[:-1], g.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        w = w - RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return w


def _nothing(why: str) -> None:
    warnings.warn(f"toxic labels but no model, all scores are 0: {why}", stacklevel=3)


def _learn(
    docs: DataFrame, labels: DataFrame, max_positive: int, max_unlabelled: int, prior: float | None
) -> np.ndarray | None:
    """Table of weights by feature, one column per classifier, the biases in its last row; None without positives."""
    spark = docs.sparkSession
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.where(F.col("toxic") == 1)
    if known.isEmpty():
        return None
    order = F.xxhash64(F.lit(SEED), "doc_id")
    chosen = known.orderBy(order, "doc_id").limit(max_positive).select("doc_id", F.lit(True).alias("positive"))
    pool = docs.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).select("doc_id", "text")
    share = min(1.0, max_unlabelled / max(1, pool.count()))
    drawn = F.xxhash64(F.lit(SEED + 1), "doc_id")
    in_share = F.lit(True) if share >= 1 else drawn < F.lit(int(share * 2.0**64) - 2**63)
    positives = pool.join(F.broadcast(chosen), "doc_id")  # max_positive ids at most
    unlabelled = pool.where(in_share).withColumn("positive", F.lit(False))
    features = _sample_features(positives.select("positive", "text").unionByName(unlabelled.select("positive", "text")))
    features = features.select(F.monotonically_increasing_id().alias("row"), "positive", "features")
    features = write_and_read(features, scratch_path(spark, "toxicity-sample"))
    n_p, n_u = features.agg(F.count_if("positive"), F.count_if(~F.col("positive"))).first()
    if not n_p or not n_u:
        return _nothing("no labelled or no other document outside the test fold")
    in_p, in_u = F.col("p") / n_p, (F.col("u") + 1) / n_u
    lift = in_p / in_u
    kept = [
        r["feature"]
        for r in features.select("positive", F.explode("features").alias("feature"))
        .groupBy("feature").agg(F.count_if("positive").alias("p"), F.count_if(~F.col("positive")).alias("u"))
        .where((F.col("p") >= MIN_POSITIVES) & (lift >= MIN_LIFT))
        .orderBy((in_p * F.log(lift)).desc(), "feature").limit(MAX_FEATURES).collect()
    ]
    if not kept:
        return _nothing("the toxic documents have no features of their own")
    known_features = np.sort(np.array(kept, np.int64))
    wanted = set(kept)

    def narrow(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch["features"] = [[int(x) for x in xs if int(x) in wanted] for xs in batch["features"]]
            yield batch

    rows = features.mapInPandas(narrow, "row long, positive boolean, features array<int>").orderBy("row").collect()
    positive = np.array([r["positive"] for r in rows])
    row = np.repeat(np.arange(len(rows)), [len(r["features"]) for r in rows])
    feature = np.searchsorted(known_features, np.array([x for r in rows for x in r["features"]], np.int64))
    if prior is None:
        prior = estimate_prior(row, feature, positive, len(known_features))

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for model in batch["id"]:
                draw = np.random.default_rng([SEED, model]).poisson(1.0, len(positive)) if model else np.ones(len(positive), int)
                times = draw[row]
                # rows drawn several times repeat, rows not drawn go
                start = np.cumsum(draw) - draw
                new_row = np.repeat(start[row], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                w = train(new_row, np.repeat(feature, times), np.repeat(positive, draw), len(known_features), prior)
                yield pd.DataFrame({"model": [model], "w": [w.tolist()]})

    fitted = spark.range(MODELS, numPartitions=MODELS).mapInPandas(fit, "model long, w array<double>").orderBy("model").collect()
    table = np.zeros(((1 << HASH_BITS) + 1, len(fitted)), np.float32)
    for i, r in enumerate(fitted):
        table[known_features, i] = r["w"][:-1]
        table[-1, i] = r["w"][-1]
    return table


def score_texts(texts: pa.Array, weights: np.ndarray) -> np.ndarray:
    """Mean probability of the classifiers for each text."""
    row, feature = feature_pairs(texts)
    live = np.flatnonzero((weights[feature] != 0).any(1))
    pairs = np.unique((row[live].astype(np.int64) << 32) | feature[live])
    total = np.zeros(len(texts))
    for i in range(weights.shape[1]):
        f = weights[-1, i] + np.bincount(pairs >> 32, weights[pairs & 0xFFFFFFFF, i], len(texts))
        total += 1 / (1 + np.exp(-np.clip(f, -50, 50)))
    return total / weights.shape[1]


def score_toxicity(
    docs: DataFrame, labels: DataFrame, max_positive: int = MAX_POSITIVE, max_unlabelled: int = MAX_UNLABELLED,
    prior: float | None = None,
) -> DataFrame:
    """``doc_id`` and ``score`` (0 to 1, higher: toxic likelier) of every document of ``doc_id, text``.

    ``labels`` has ``doc_id`` and ``toxic`` (0 or 1); only its toxic rows
    outside the test fold are learnt from.  ``prior`` is the share of toxic
    documents, if it is known.
    """
    source = docs.select("doc_id", "text")
    weights = _learn(source, labels.select("doc_id", "toxic"), max_positive, max_unlabelled, prior)
    if weights is None:
        return source.select("doc_id", F.lit(0.0).alias("score"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch, "text"):
                scores = score_texts(block.column("text"), weights)
                yield pa.RecordBatch.from_arrays([block.column("doc_id"), pa.array(scores)], ["doc_id", "score"])

    return source.mapInArrow(run, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, score double")


def toxicity_digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Score and prediction per document, and whether it is of the test fold."""
    return score_toxicity(docs, labels).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"),
    )


ship_by_value(__name__)
