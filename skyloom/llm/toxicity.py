"""Toxicity by multiple-instance learning: sentences are scored, documents are labelled.

A document is toxic when one of its sentences is: its score is the noisy-or of its
sentences' probabilities and a leak, 1 - (1 - leak) prod(1 - p). With logistic weights of
the words and word stems that tell toxic documents apart, a sentence of log-odds x stands
for 1 - p = (1 - sigmoid(x)) / (1 - sigmoid(bias)): one without such words has p = 0, so more
clean text is no evidence of toxicity, and sigmoid(bias) is the leak. The weights
are fitted through this noisy-or from document labels alone, and the sentences with a
high probability are the offending ones.

1. At most ``SAMPLE`` labelled training rows, those whose id and text hash lowest, are
   taken. Features (words, and their first four, five and six letters) are counted over them,
   and the ``MOST_FEATURES`` with the highest log-likelihood ratio stay that occur mostly in
   toxic documents and in ``LEAST_DOCUMENTS`` of these at least. All three are arguments of
   ``train``; they bound the model, not what it is applied to.
2. Weights are fitted on the driver to these documents, held as their sentences' kept
   features.
3. Every document is scored whole; only the fitted weights, whose number is fixed, are
   broadcast.

Labels are learned from rows that the caller's fold names; nothing but the text enters a
score. Defined cases: null and empty texts have no sentence, so they
have the lowest score, the leak; texts are read whole, whatever their length; unlabelled documents and labels that are null are not trained on;
of several labels of one doc_id the largest counts; without any labels of both kinds
every score is the share of toxic labels (0.0 when there are none); equal rows have equal
scores; an empty table gives an empty result; further columns are carried along or
ignored, whatever their names.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyloom.llm.encoding import text_slices
from skyloom.llm.simhash import text_key
from skyloom.llm.memory import plain_task
from skyloom.session import materialise

#: Features of the model, training documents it is fitted to, and rows counted at once.
MOST_FEATURES = 3_000
SAMPLE = 50_000
_HELD = 150_000
STEMS = (4, 5, 6)
#: Training documents that must be toxic and hold a feature.
LEAST_DOCUMENTS = 4
#: Weight decay of a feature that one toxic document has.
RESTRAINT = 2e-4
THRESHOLD = 0.3
_SENTENCE = re.compile(r"[.!?\n]+")
_WORD = re.compile(r"[^\W\d_]+")


def in_training_fold(doc_id: Column) -> Column:
    """Rows to learn from: crc32 of the id as text, modulo four, is not two."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 != 2, F.lit(False))


def word_features(word: str) -> list[str]:
    return [word, *[f"{word[:n]}-" for n in STEMS if len(word) > n]]


def _labelled(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """(text, toxic) of a bounded sample of the training rows; of equal rows one."""
    known = (
        labels.where(F.col("toxic").isNotNull() & in_training_fold(F.col("doc_id")))
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    )
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text_key(F.col("text")).alias("key"), "text"
    ).where(in_training_fold(F.col("doc_id")))
    # ids and hashes of labelled rows, without their texts
    keys = rows.groupBy("doc_id", "key").agg(F.count("*").alias("copies")).join(known, "doc_id")
    keys = keys.orderBy(F.xxhash64("doc_id", "key"), "doc_id", "key").limit(sample)
    keys = materialise(keys, "sample")
    # at most ``sample`` rows
    chosen = rows.join(F.broadcast(keys), ["doc_id", "key"])
    if (keys.agg(F.max("copies")).first()[0] or 0) > 1:
        chosen = chosen.groupBy("doc_id", "key").agg(F.first("text").alias("text"), F.first("toxic").alias("toxic"))
    return chosen.select("text", "toxic")


def _feature_counts(rows: DataFrame) -> DataFrame:
    """(feature, toxic, clean): documents that hold each feature."""

    @plain_task
    def run(batches: Iterator):
        import pyarrow as pa

        counts: tuple[Counter, Counter] = (Counter(), Counter())

        def taken():
            names = list(counts[0].keys() | counts[1].keys())
            batch = pa.RecordBatch.from_pydict(
                {
                    "feature": pa.array(names, pa.string()),
                    "toxic": pa.array([counts[1][n] for n in names], pa.int64()),
                    "clean": pa.array([counts[0][n] for n in names], pa.int64()),
                }
            )
            counts[0].clear()
            counts[1].clear()
            return batch

        for batch in batches:
            for text, toxic in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                seen = set(_WORD.findall((text.as_py() or "").lower()))
                counts[int(toxic > 0)].update({f for w in seen for f in word_features(w)})
                if len(counts[0]) + len(counts[1]) > _HELD:
                    yield taken()
        yield taken()

    found = rows.select("text", "toxic").mapInArrow(run, "feature string, toxic long, clean long")
    return found.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _telling(
    counts: DataFrame, n_toxic: int, n_clean: int, most_features: int, least_documents: int
) -> tuple[dict[str, int], np.ndarray]:
    """The kept features and their numbers; the toxic documents that hold each."""

    def term(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    total = float(n_toxic + n_clean)
    seen = F.col("toxic") + F.col("clean")
    gain = 2 * (
        term(F.col("toxic"), seen * (n_toxic / total))
        + term(F.col("clean"), seen * (n_clean / total))
        + term(n_toxic - F.col("toxic"), (total - seen) * (n_toxic / total))
        + term(n_clean - F.col("clean"), (total - seen) * (n_clean / total))
    )
    ahead = F.col("toxic") * n_clean > 3 * F.col("clean") * n_toxic
    best = (
        counts.where(ahead & (F.col("toxic") >= least_documents))
        .select("feature", "toxic", gain.alias("gain"))
        .where(F.col("gain") > 15)
        .orderBy(F.desc("gain"), "feature")
        .limit(most_features)
    )
    rows = best.collect()
    return {r.feature: k for k, r in enumerate(rows)}, np.array([r.toxic for r in rows], float)


def sentences(text: str | None) -> list[str]:
    return [s for s in _SENTENCE.split(text or "") if s and not s.isspace()]


def _found(sentence: str, number: dict[str, int], cache: dict[str, tuple]) -> set[int]:
    """Numbers of the features in a sentence."""
    out: set[int] = set()
    for word in _WORD.findall(sentence):
        known = cache.get(word)
        if known is None:
            if len(cache) > _HELD:
                cache.clear()
            known = cache[word] = tuple(number[f] for f in word_features(word) if f in number)
        if known:
            out.update(known)
    return out


def _bags(rows: DataFrame, features) -> DataFrame:
    """(toxic, bags): the features of each sentence that has any."""

    @plain_task
    def run(batches: Iterator):
        import pyarrow as pa

        number, cache = features.value, {}
        for batch in batches:
            bags = []
            for text in batch.column(0):
                found = [_found(s, number, cache) for s in sentences((text.as_py() or "").lower())]
                bags.append([sorted(f) for f in found if f])
            yield pa.RecordBatch.from_pydict(
                {
                    "toxic": batch.column(1),
                    "bags": pa.array(bags, pa.list_(pa.list_(pa.int32()))),
                }
            )

    return rows.select("text", "toxic").mapInArrow(run, "toxic int, bags array<array<int>>")


def _softplus(x: np.ndarray) -> np.ndarray:
    return np.logaddexp(0.0, x)


class NoisyOr:
    """Sentence weights behind document labels."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights, bias

    @staticmethod
    def log_likelihood(
        theta: np.ndarray, documents: list[tuple[int, list[list[int]]]]
    ) -> tuple[float, np.ndarray]:
        """Weighted log-likelihood of (label, bags) under weights and bias ``theta``, and its gradient."""
        n_features = len(theta) - 1
        label = np.array([d[0] > 0 for d in documents], float)
        extra = np.array([len(d[1]) - 1 for d in documents], float)
        owner = np.array([k for k, d in enumerate(documents) for _ in d[1]], np.int64)
        bags = [b for d in documents for b in d[1]]
        row = np.repeat(np.arange(len(bags)), [len(b) for b in bags])
        col = np.array([f for b in bags for f in b], np.int64)
        return NoisyOr._likelihood(theta, label, extra, owner, row, col, len(bags), n_features)

    @staticmethod
    def _likelihood(theta, label, extra, owner, row, col, n_bags, n_features):
        share = min(max(label.mean(), 1e-4), 1 - 1e-4)
        # positive and negative documents weigh the same in total
        weight = np.where(label > 0, 0.5 / share, 0.5 / (1 - share))
        weight *= np.where(label > 0, min(1.0, 4 * share), 1.0) / len(label)
        score = theta[-1] + np.bincount(row, theta[col], n_bags)
        # log of the chance that neither the leak nor a sentence is toxic
        none = -np.bincount(owner, _softplus(score), len(label)) + extra * _softplus(theta[-1])
        none = np.minimum(none, -1e-12)
        value = float((weight * np.where(label > 0, np.log(-np.expm1(none)), none)).sum())
        # d(value) / d(none)
        slope = weight * np.where(label > 0, -np.exp(none) / -np.expm1(none), 1.0)
        by_sentence = -slope[owner] / (1 + np.exp(-score))
        gradient = np.zeros_like(theta)
        gradient[:-1] = np.bincount(col, by_sentence[row], n_features)
        gradient[-1] = by_sentence.sum() + (slope * extra).sum() / (1 + math.exp(-theta[-1]))
        return value, gradient

    @classmethod
    def fit(cls, documents: list[tuple[int, list[list[int]]]], support: np.ndarray, rounds: int = 1500):
        """Gradient steps (Adam) on the log-likelihood of (label, bags).

        ``support`` has the toxic documents behind each feature; weights of features
        that few of them have are held back more.
        """
        n_features = len(support)
        label = np.array([d[0] > 0 for d in documents], float)
        extra = np.array([len(d[1]) - 1 for d in documents], float)
        owner = np.array([k for k, d in enumerate(documents) for _ in d[1]], np.int64)
        bags = [b for d in documents for b in d[1]]
        row = np.repeat(np.arange(len(bags)), [len(b) for b in bags])
        col = np.array([f for b in bags for f in b], np.int64)
        theta = np.zeros(n_features + 1)
        theta[-1] = -7.0
        mean, square = np.zeros_like(theta), np.zeros_like(theta)
        for step in range(1, rounds + 1):
            _, rising = cls._likelihood(theta, label, extra, owner, row, col, len(bags), n_features)
            gradient = -rising
            gradient[:-1] += RESTRAINT / support * theta[:-1]
            mean = 0.9 * mean + 0.1 * gradient
            square = 0.999 * square + 0.001 * gradient**2
            theta -= 0.1 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
            # a feature can only speak for toxicity, and the leak is small
            theta[:-1] = np.maximum(theta[:-1], 0.0)
            theta[-1] = min(theta[-1], -7.0)
        return cls(theta[:-1].copy(), float(theta[-1]))

    def sentence(self, found: set[int]) -> float:
        """Log-odds of a sentence with these features."""
        return self.bias + sum(self.weights[f] for f in found)


class ToxicityModel:
    """Fitted features and weights; their number is at most ``MOST_FEATURES``."""

    def __init__(self, number: dict[str, int], fitted: NoisyOr | None, prior: float):
        self.number, self.fitted, self.prior = number, fitted, prior

    def log_odds(self, text: str | None, cache: dict) -> list[tuple[str, float]]:
        """(sentence, log-odds) of a text's sentences."""
        return [
            (s, self.fitted.sentence(_found(s.lower(), self.number, cache))) for s in sentences(text)
        ]

    def score(self, text: str | None, cache: dict) -> float:
        if self.fitted is None:
            return self.prior
        quiet = math.log1p(math.exp(self.fitted.bias))
        none = quiet
        for sentence in sentences((text or "").lower()):
            found = _found(sentence, self.number, cache)
            if found:
                none += float(_softplus(self.fitted.sentence(found))) - quiet
        return -math.expm1(-none)


def train(
    docs: DataFrame,
    labels: DataFrame,
    sample: int = SAMPLE,
    most_features: int = MOST_FEATURES,
    least_documents: int = LEAST_DOCUMENTS,
) -> ToxicityModel:
    rows = materialise(_labelled(docs, labels, sample), "labelled")
    counts = {r.toxic: r.n for r in rows.groupBy((F.col("toxic") > 0).alias("toxic")).agg(
        F.count("*").alias("n")
    ).collect()}
    n_toxic, n_clean = counts.get(True, 0), counts.get(False, 0)
    if not n_toxic or not n_clean:
        return ToxicityModel({}, None, 1.0 if n_toxic else 0.0)
    number, support = _telling(_feature_counts(rows), n_toxic, n_clean, most_features, least_documents)
    shared = rows.sparkSession.sparkContext.broadcast(number)
    # the kept features of at most ``sample`` rows
    documents = [(r.toxic, r.bags) for r in _bags(rows, shared).toLocalIterator()]
    return ToxicityModel(number, NoisyOr.fit(documents, support), n_toxic / (n_toxic + n_clean))


def score_documents(docs: DataFrame, model: ToxicityModel, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (doc_id) with _score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    keep = keep or ["doc_id"]
    rows = docs.select(F.col("text").alias("_text"), *keep)

    @plain_task
    def run(batches: Iterator):
        import pyarrow as pa

        cache: dict[str, tuple] = {}
        for batch in batches:
            score = []
            for _, texts in text_slices(batch, "_text"):
                score += [shared.value.score(t, cache) for t in texts]
            columns = {n: batch.column(batch.schema.get_field_index(n)) for n in keep}
            yield pa.RecordBatch.from_pydict(columns | {"_score": pa.array(score, pa.float64())})

    schema = T.StructType(list(rows.select(*keep).schema.fields)).add("_score", T.DoubleType())
    return rows.mapInArrow(run, schema)


def offending_sentences(docs: DataFrame, model: ToxicityModel, least: float = 0.5) -> DataFrame:
    """(doc_id, sentence, position, probability) of sentences that are likely toxic."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @plain_task
    def run(batches: Iterator):
        import pyarrow as pa

        cache: dict[str, tuple] = {}
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if shared.value.fitted is None:
                    continue
                for k, (sentence, x) in enumerate(shared.value.log_odds(text.as_py(), cache)):
                    p = 1 / (1 + math.exp(-x))
                    if p >= least:
                        rows.append({"doc_id": doc_id, "sentence": sentence.strip(), "position": k, "probability": p})
            yield pa.RecordBatch.from_pylist(
                rows,
                pa.schema([("doc_id", pa.int64()), ("sentence", pa.string()), ("position", pa.int32()),
                           ("probability", pa.float64())]),
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, sentence string, position int, probability double"
    )


def judge(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    scored = score_documents(docs.select("doc_id", "text"), train(docs, labels))
    return scored.select(
        "doc_id",
        (~in_training_fold(F.col("doc_id"))).alias("held_out"),
        F.col("_score").alias("score"),
        (F.col("_score") >= threshold).cast("int").alias("predicted"),
    )
