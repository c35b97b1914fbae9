"""Toxicity scores by non-negative positive-unlabelled learning over hashed words."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketline.llm import textcodes as X
from basketline.llm.common import document_rows, scratch, stored

BUCKETS = 1 << 20  # hashed words and beginnings
BEGINNINGS = (4, 5, 6)  # bytes
LEAST = 10  # training texts that a feature is in, or it has no weight
CLEAR = 8.0  # standard errors between its two rates, or it has no weight
HELD_OUT = "crc32(cast(doc_id as string)) % 5 = 0"


def presence(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed words and word beginnings of every text, and the n + 1 offsets of its rows.

    Beginnings catch a stem under whatever ending or punctuation follows it.
    """
    words, beginnings, at = X.words(texts, BEGINNINGS)
    features = np.concatenate([words, *beginnings])
    kinds = np.repeat(np.arange(1, len(BEGINNINGS) + 2, dtype=X.U), len(words))
    row = np.tile(np.repeat(np.arange(len(texts)), np.diff(at)).astype(X.U), len(BEGINNINGS) + 1)
    pairs = np.unique((row << X.U(32)) + (X.mix(features + kinds * X.U(X.ODD)) & X.U(BUCKETS - 1)))
    return (pairs & X.U(BUCKETS - 1)).astype(np.int32), np.searchsorted(pairs, np.arange(len(texts) + 1).astype(X.U) << X.U(32))


def hashed_words(rows: DataFrame) -> DataFrame:
    """The columns (doc_id, kind) and the distinct hashed features of the text, at most BUCKETS."""

    def run(batches):
        for big in batches:
            for batch in X.slices(big, "text"):
                words, at = presence(batch.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"),
                        batch.column("kind"),
                        pa.array([words[a:b].tobytes() for a, b in zip(at[:-1], at[1:])], pa.binary()),
                    ],
                    names=["doc_id", "kind", "words"],
                )

    return rows.select("doc_id", "kind", "text").mapInArrow(run, "doc_id long, kind int, words binary")


def pu_slopes(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> list[np.ndarray]:
    """Slopes of the non-negative PU risk by the scores of both samples.

    The risk is prior * mean loss of the positives as positive, plus what the unlabelled have as negatives less
    prior times what the positives have as negatives. Where that second part is below 0 its slope is turned
    round and the first left out.
    """
    s = [1 / (1 + np.exp(-np.clip(z, -30, 30))) for z in (positive, unlabelled)]
    to_p, to_n = (s[0] - 1) / len(s[0]), [y / len(y) for y in s]
    if np.logaddexp(0, unlabelled).mean() >= prior * np.logaddexp(0, positive).mean():
        return [prior * (to_p - to_n[0]), to_n[1]]
    return [prior * to_n[0], -to_n[1]]


class Linear:
    """sigmoid(b + sum of the weights of the distinct features), trained by the non-negative PU risk."""

    def __init__(self, prior: float):
        self.prior = prior
        self.weights = np.zeros(BUCKETS)
        self.bias = float(np.log(prior / (1 - prior)))

    def screen(self, p: np.ndarray, u: np.ndarray, n_p: int, n_u: int) -> np.ndarray:
        """Features whose rates differ clearly: among the positives, and among the negatives.

        ``p`` and ``u`` are the numbers of positive and of unlabelled texts with each feature. The rate among
        negatives is that of the unlabelled with the share of the positives taken out.
        """
        rate = p / n_p
        other = np.clip((u / n_u - self.prior * rate) / (1 - self.prior), 0, 1)
        pooled = np.clip((p + other * n_u) / (n_p + n_u), 1e-9, 1 - 1e-9)
        z = np.abs(rate - other) / np.sqrt(pooled * (1 - pooled) * (1 / n_p + 1 / n_u))
        return (p + u >= LEAST) & (z >= CLEAR)

    def fit(self, use: np.ndarray, positive: list[np.ndarray], unlabelled: list[np.ndarray], rounds: int = 400, rate: float = 0.05,
            decay: float = 2e-3) -> Linear:
        """Adam over the whole sample; ``use`` are the features that have a weight, texts are lists of features.

        The risk of the negatives is that of the unlabelled less prior times that of the positives
        taken as negatives. Where that estimate is negative, the step goes back up its gradient,
        which keeps the classifier from fitting the positives among the unlabelled.
        """
        place = np.full(BUCKETS, -1)
        place[use] = np.arange(len(use))
        parts = []
        for texts in (positive, unlabelled):
            at = np.repeat(np.arange(len(texts)), [len(w) for w in texts])
            words = place[np.concatenate(texts)]
            parts.append((at[words >= 0], words[words >= 0], len(texts)))
        x = np.zeros(len(use) + 1)
        x[-1] = self.bias
        m, v = np.zeros_like(x), np.zeros_like(x)
        for t in range(1, rounds + 1):
            z = [np.bincount(at, x[words], minlength=n) + x[-1] for at, words, n in parts]
            slope = pu_slopes(z[0], z[1], self.prior)
            grad = np.zeros_like(x)
            for (at, words, _), g in zip(parts, slope):
                grad[:-1] += np.bincount(words, g[at], minlength=len(use))
                grad[-1] += g.sum()
            grad[:-1] += decay * x[:-1]
            m = 0.9 * m + 0.1 * grad
            v = 0.999 * v + 0.001 * grad * grad
            x -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        self.weights[use], self.bias = x[:-1], float(x[-1])
        return self


def training_sample(documents: DataFrame, labels: DataFrame, each: int) -> tuple[DataFrame, float]:
    """(doc_id, kind, words) of at most ``each`` confirmed toxic and ``each`` unlabelled texts, kind 1 and 0, and the class prior.

    Only rows outside the held-out fold take part. The sample is a bounded one in the order of a hash of the
    id; the prior is the toxic share of all labelled rows of the fold. A label of 0 or null
    confirms nothing: such texts are unlabelled ones.
    """
    fold = f"doc_id is not null and not ({HELD_OUT})"
    toxic = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where(fold)
    toxic = toxic.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    share = toxic.agg(F.avg((F.col("toxic") == 1).cast("double")).alias("p")).first()["p"]
    known = toxic.where("toxic = 1").select("doc_id", F.lit(1).alias("kind"))
    rows = document_rows(documents).where(fold)
    ids = rows.select("doc_id").join(known, "doc_id", "left").select("doc_id", F.coalesce("kind", F.lit(0)).alias("kind"))
    order = [F.xxhash64(F.lit("sample"), "doc_id"), "doc_id"]
    chosen = ids.where("kind = 1").orderBy(*order).limit(each).union(ids.where("kind = 0").orderBy(*order).limit(each))
    return hashed_words(rows.join(F.broadcast(chosen.distinct()), "doc_id")), float(share or 0.0)


def feature_counts(sample: DataFrame) -> DataFrame:
    """feature, p and u: in how many toxic and in how many unlabelled texts it is; features of LEAST texts or more."""

    def run(batches):
        counts = np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            for kind, words in zip(batch.column("kind").to_pylist(), batch.column("words")):
                counts[kind, np.frombuffer(words.as_buffer(), np.int32)] += 1
        at = np.flatnonzero(counts.any(0))
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(counts[1, at]), pa.array(counts[0, at])], names=["feature", "p", "u"])

    found = sample.mapInArrow(run, "feature int, p long, u long").groupBy("feature").agg(F.sum("p").alias("p"), F.sum("u").alias("u"))
    return found.where(F.col("p") + F.col("u") >= LEAST)


def only_features(sample: DataFrame, use: np.ndarray) -> DataFrame:
    """The sample's texts with the given features alone."""
    wanted = np.zeros(BUCKETS, bool)
    wanted[use] = True
    shared = sample.sparkSession.sparkContext.broadcast(np.packbits(wanted))

    def run(batches):
        wanted = np.unpackbits(shared.value).astype(bool)
        for batch in batches:
            words = [np.frombuffer(w.as_buffer(), np.int32) for w in batch.column("words")]
            kept = pa.array([w[wanted[w]].tobytes() for w in words], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("kind"), kept], names=["doc_id", "kind", "words"])

    return sample.mapInArrow(run, "doc_id long, kind int, words binary")


def toxicity_scores(documents: DataFrame, labels: DataFrame, each: int = 6000) -> DataFrame:
    """One row per document: doc_id, held_out, score and predicted.

    A linear model over the distinct hashed words of the whole text, learned by non-negative
    positive-unlabelled risk from at most ``each`` confirmed toxic texts and ``each`` unlabelled
    ones of the training fold (``training_sample``). The score is the model's probability; labels, source,
    language and id never enter it. Null and empty texts score by the bias alone. Without any
    confirmed toxic text all scores are 0. held_out is null where doc_id is.
    """
    score = scorer(documents, labels, each)
    scored = document_rows(documents).select("doc_id", score("text").alias("score"))
    return scored.select("doc_id", F.expr(HELD_OUT).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def scorer(documents: DataFrame, labels: DataFrame, each: int = 6000) -> Callable[[Column | str], Column]:
    """The trained model of ``toxicity_scores`` as a function of a text column without nulls."""
    weights, bias = np.zeros(BUCKETS), -np.inf
    with scratch(documents.sparkSession):
        sample, prior = training_sample(documents, labels, each)
        sample = stored(sample)
        n = {r["kind"]: r["n"] for r in sample.groupBy("kind").agg(F.count(F.lit(1)).alias("n")).collect()}
        if n.get(1) and n.get(0):
            model = Linear(min(max(prior, 0.001), 0.999))
            counts = feature_counts(sample).toPandas()  # BUCKETS rows at most
            p, u = np.zeros(BUCKETS), np.zeros(BUCKETS)
            p[counts["feature"]], u[counts["feature"]] = counts["p"], counts["u"]
            use = np.flatnonzero(model.screen(p, u, n[1], n[0]))
            found = only_features(sample, use).orderBy("doc_id", "kind").toPandas()
            texts = {k: [np.frombuffer(w, np.int32) for w in found["words"][found["kind"] == k]] for k in (0, 1)}
            model.fit(use, texts[1], texts[0])
            weights, bias = model.weights, model.bias
    shared = documents.sparkSession.sparkContext.broadcast(weights.astype(np.float32))  # BUCKETS floats

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        parts = [np.zeros(0)]
        for batch in X.slices(pa.RecordBatch.from_arrays([texts], names=["text"]), "text"):
            words, at = presence(batch.column("text"))
            sums = np.concatenate([[0.0], np.cumsum(shared.value[words].astype(float))])
            z = np.clip(sums[at[1:]] - sums[at[:-1]] + bias, -700, 700)
            parts.append(1 / (1 + np.exp(-z)) if np.isfinite(bias) else np.zeros(len(z)))
        return pa.array(np.concatenate(parts))

    return score
