"""Toxic text by non-negative positive-unlabelled learning.

Confirmed toxic texts are the positives; everything else, labelled or not, is unlabelled text of
which a share, the class prior, is toxic too. A linear model over the words of a text is trained
in numpy on the risk

    prior * R(positives, +)  +  max(0, R(unlabelled, -) - prior * R(positives, -))

with logistic losses. The subtraction removes what hidden toxic texts add to the loss of the
unlabelled sample. Where the corrected part goes below zero, which a flexible model reaches by
memorising the positives, a step goes the other way instead.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog_marts.llm.held import release
from catalog_marts.llm.text import PUNCTUATION, hash_words, pieces, utf8

BITS = 18  # words fall into 2**18 features
MAX_POSITIVE, MAX_UNLABELLED = 8_000, 16_000  # bounds of the training sample, in texts
MAX_FEATURES = 16_384  # of a text of the sample
MIN_Z = 4.0  # a feature is used where its shares in the two samples differ by as many deviations
MIN_TEXTS = 3  # and where as many texts of the larger share have it
STEPS, RATE, L2 = 300, 0.05, 2e-4


class ToxicModel(NamedTuple):
    weights: np.ndarray
    bias: float
    prior: float


def features(column: pa.Array, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) of the distinct lower-cased words of each text; ``wanted`` selects features."""
    data, offsets = utf8(column)
    words = hash_words(data, offsets, lower=True, breaks=PUNCTUATION)
    feature = (words.hashes >> np.uint64(64 - BITS)).astype(np.int64)
    text = np.repeat(np.arange(len(column)), np.diff(words.bounds))
    if wanted is not None:
        keep = wanted[feature]
        text, feature = text[keep], feature[keep]
    both = np.unique((text << BITS) | feature)
    return both >> BITS, both & ((1 << BITS) - 1)


def train(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float) -> ToxicModel:
    """Fit on the feature lists of two samples; empty samples give a model that scores 0."""
    size = 1 << BITS
    if not positive or not unlabelled or not 0 < prior < 1:
        return ToxicModel(np.zeros(size, np.float32), -np.inf, prior)

    def flat(texts):
        return np.repeat(np.arange(len(texts)), [len(x) for x in texts]), np.concatenate(texts)

    (row_p, col_p), (row_u, col_u) = flat(positive), flat(unlabelled)
    n_p, n_u = len(positive), len(unlabelled)
    count_p, count_u = np.bincount(col_p, minlength=size), np.bincount(col_u, minlength=size)
    share_p, share_u = count_p / n_p, count_u / n_u
    deviation = np.sqrt((share_u + 1 / n_u) * (1 / n_p + 1 / n_u))
    enough = np.where(share_p > share_u, count_p, count_u) >= MIN_TEXTS
    used = np.flatnonzero(enough & (np.abs(share_p - share_u) >= MIN_Z * deviation))
    place = np.full(size, -1)
    place[used] = np.arange(len(used))
    row_p, col_p = row_p[place[col_p] >= 0], place[col_p[place[col_p] >= 0]]
    row_u, col_u = row_u[place[col_u] >= 0], place[col_u[place[col_u] >= 0]]

    weights, k = np.zeros(len(used) + 1), len(used)  # the last one is the bias
    weights[k] = np.log(prior / (1 - prior))
    first, second = np.zeros(k + 1), np.zeros(k + 1)
    for step in range(1, STEPS + 1):
        z_p = np.bincount(row_p, weights[col_p], n_p) + weights[k]
        z_u = np.bincount(row_u, weights[col_u], n_u) + weights[k]
        as_negative = np.logaddexp(0, z_u).mean() - prior * np.logaddexp(0, z_p).mean()
        if as_negative >= 0:  # positives: prior * (loss(+) - loss(-)), whose slope is constant
            slope_p, slope_u = np.full(n_p, -prior / n_p), _sigmoid(z_u) / n_u
        else:
            slope_p, slope_u = prior * _sigmoid(z_p) / n_p, -_sigmoid(z_u) / n_u
        slope = np.append(
            np.bincount(col_p, slope_p[row_p], k) + np.bincount(col_u, slope_u[row_u], k) + L2 * weights[:k],
            slope_p.sum() + slope_u.sum(),
        )
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope**2
        weights -= RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    all_weights = np.zeros(size, np.float32)
    all_weights[used] = weights[:k]
    return ToxicModel(all_weights, float(weights[k]), prior)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):  # far below zero the score is 0
        return 1 / (1 + np.exp(-z))


def _held_out(key: str, folds: int):
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % folds == 0, F.lit(False))


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
    label: str = "toxic", folds: int = 5,
    max_positive: int = MAX_POSITIVE, max_unlabelled: int = MAX_UNLABELLED, max_features: int = MAX_FEATURES,
) -> ToxicModel:
    """Train on rows whose ``crc32(key) % folds`` is not 0; the others are held out.

    Positives: at most ``max_positive`` texts with a label of 1; unlabelled: at most
    ``max_unlabelled`` other texts, whatever their label; both are those with the smallest hash
    of their key, so reruns agree. The prior is the share of label 1 among all labelled keys
    that are not held out. The driver receives only the feature numbers of these texts, one text
    per key and at most ``max_features`` of a text (those with the smallest numbers, which are
    hashes).

    A key with several labels is positive if one of them is 1; of a key with several texts one is
    taken; null labels and null keys are left out. Without positives, or without any other text,
    every score is 0.
    """
    marks = labels.select(F.col(key).alias("_k"), F.col(label).cast("int").alias("_y"))
    marks = marks.where("_k is not null and _y is not null").where(~_held_out("_k", folds))
    marks = marks.groupBy("_k").agg(F.max("_y").alias("_y"))
    prior = marks.agg(F.avg((F.col("_y") == 1).cast("double"))).first()[0]
    keys = docs.select(F.col(key).alias("_k")).where("_k is not null").where(~_held_out("_k", folds))
    keys = keys.distinct().join(marks, "_k", "left").select("_k", (F.coalesce("_y", F.lit(0)) == 1).alias("_p"))
    order = F.xxhash64("_k")
    sample = keys.where("_p").orderBy(order, "_k").limit(max_positive).unionByName(
        keys.where("not _p").orderBy(order, "_k").limit(max_unlabelled)
    )
    texts = docs.select(F.col(key).alias("_k"), F.col(text).alias("_t"))
    texts = texts.join(F.broadcast(sample), "_k").select("_k", "_p", "_t")  # bounded by the two limits

    def listed(batches):
        release()
        for batch in batches:
            for part in pieces(batch, "_t"):
                row, feature = features(part.column("_t"))
                ends = np.searchsorted(row, np.arange(len(part) + 1))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(feature, pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column("_k"), part.column("_p"), lists], ["_k", "_p", "_f"])

    kind = texts.schema["_k"].dataType.simpleString()
    found = texts.mapInArrow(listed, f"_k {kind}, _p boolean, _f array<int>")
    found = found.select("_k", "_p", F.slice("_f", 1, max_features).alias("_f"))
    found = found.groupBy("_k").agg(F.max("_p").alias("_p"), F.min("_f").alias("_f")).drop("_k").toArrow()
    split = {True: [], False: []}
    for positive, numbers in zip(found["_p"].to_pylist(), found["_f"], strict=True):
        split[positive].append(numbers.values.to_numpy())
    for lists in split.values():
        lists.sort(key=lambda x: (len(x), x.tobytes()))  # sums don't depend on how rows arrive
    return train(split[True], split[False], prior or 0.0)


def score_toxicity(docs: DataFrame, model: ToxicModel, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with a score from 0 to 1 for every whole text; null and empty texts get the score
    of a text without words. Other columns pass through; a column of the name ``out`` is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias))

    def score(column: pa.Array) -> pa.Array:
        release()
        weights, bias = shared.value
        wanted = weights != 0
        scores = []
        for part in pieces(pa.RecordBatch.from_arrays([column], ["text"])):
            row, feature = features(part.column(0), wanted)
            scores.append(_sigmoid(np.bincount(row, weights[feature], len(part)) + bias))
        return pa.array(np.concatenate(scores) if scores else np.empty(0), pa.float64())

    return docs.withColumn(out, F.arrow_udf(score, "double")(F.col(text)))


def toxicity(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
    label: str = "toxic", folds: int = 5,
) -> DataFrame:
    """Fit, then ``key``, ``held_out``, ``score`` and ``predicted`` (score >= 0.5) of every row."""
    model = fit_toxicity(docs, labels, key, text, label, folds)
    scored = score_toxicity(docs.select(F.col(key), F.col(text)), model, text)
    return scored.select(
        F.col(key), _held_out(key, folds).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
