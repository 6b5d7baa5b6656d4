"""Quality classifier: hashed word n-grams, logistic regression by follow-the-regularised-leader."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordHashes, cut, hashed_words, id_fold, keep_columns, mix64, plain_id, shingle_hashes, whole_id

#: Features: 1- and 2-word grams hashed to 2**BITS places.
BITS = 18
#: FTRL-proximal: learning rate, its smoothing, L1 and L2 penalties, passes over a shard.
ALPHA, BETA, L1, L2, PASSES = 0.5, 1.0, 0.02, 0.2, 3
#: Labelled documents to learn from at most, and those that one shard learns from in turn; shards' models are averaged.
SAMPLE_DOCS, SHARD_DOCS = 20_000, 4000
FOLDS, HELD_OUT = 5, 0
THRESHOLD = 0.3


def features(text: str | None, known: WordHashes, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct feature places of a text and their weights, of length 1 in all."""
    if not text:
        return np.empty(0, np.int64), np.empty(0)
    words = hashed_words(text, known, lower=False)
    # a word's shape goes beside the word: case, digits and punctuation say much about quality and generalise
    shapes = np.fromiter((_shape(w) for w in text.encode("utf-8", "surrogatepass").split()), np.uint64, len(words))
    grams = np.concatenate((mix64(words), shingle_hashes(words, 2), shapes, shingle_hashes(shapes, 2)))
    places, counts = np.unique(grams >> np.uint64(64 - bits), return_counts=True)
    weights = np.log1p(counts)
    return places.astype(np.int64), weights / np.sqrt(np.dot(weights, weights)) if len(weights) else weights


_UPPER, _LOWER, _DIGIT = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789"
_CLASSES = bytes(
    ord("A") if c in _UPPER else ord("a") if c in _LOWER or c >= 128 else ord("0") if c in _DIGIT else c for c in range(256)
)
_SHAPES = WordHashes()


def _shape(word: bytes) -> int:
    """Hash of a word's shape: classes of its first and last three bytes."""
    return _SHAPES[b"\x00" + word[:1].translate(_CLASSES) + word[-3:].translate(_CLASSES)]


@dataclass
class Ftrl:
    """Per-coordinate FTRL-proximal state of a logistic regression; the last place is the bias."""

    bits: int = BITS

    def __post_init__(self):
        self.z = np.zeros((1 << self.bits) + 1)
        self.n = np.zeros((1 << self.bits) + 1)

    def weights(self, places: np.ndarray) -> np.ndarray:
        z, n = self.z[places], self.n[places]
        w = -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
        return np.where(np.abs(z) <= L1, 0.0, w)

    def learn(self, places: np.ndarray, values: np.ndarray, label: float, importance: float = 1.0) -> None:
        w = self.weights(places)
        g = importance * (sigmoid(np.dot(w, values)) - label) * values
        n = self.n[places]
        self.z[places] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[places] = n + g * g


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


def with_bias(places: np.ndarray, values: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    return np.append(places, 1 << bits), np.append(values, 1.0)


def _train(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows sorted by shard -> non-zero weights of each shard's model; a shard's features are held, not its texts."""
    known = WordHashes()

    def model(shard, held):
        ftrl = Ftrl()
        for _ in range(PASSES):
            for document in held:
                ftrl.learn(*document)
        every = np.flatnonzero(ftrl.n)
        w = ftrl.weights(every)
        # the bias place stands for the shard itself, so it is always sent
        send = (w != 0) | (every == 1 << BITS)
        return pd.DataFrame({"shard": shard, "place": every[send], "weight": w[send]})

    at, held = None, []
    for batch in batches:
        for shard, text, label, importance in zip(batch["shard"], batch["text"], batch["label"], batch["importance"]):
            if shard != at and held:
                yield model(at, held)
                held = []
            at = shard
            places, values = with_bias(*features(text, known))
            held.append((places, values.astype(np.float32), float(label), importance))
    if held:
        yield model(at, held)


def fit(docs: DataFrame, labels: DataFrame, folds: int = FOLDS, held_out: int = HELD_OUT) -> np.ndarray:
    """Weights (2**BITS + bias) learned from labelled documents outside the held-out fold.

    The labelled ids with the ``SAMPLE_DOCS`` smallest hashes are the sample; their
    whole texts are dealt by hash into shards of about ``SHARD_DOCS``, each shard runs
    FTRL in a task of its own, and the models are averaged, a weight that a shard
    never met counting as 0 there.  Both labels weigh the same in all, so that a score
    says how a text reads and not how common good texts are.

    The driver gets one model.  Rows without label, id or text are left out of
    training, a label above 0 counts as 1, an id with several labels takes the
    smallest, and one with several texts the one with the smallest hash; without any
    labelled document all weights are 0.
    """
    one = labels.filter("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("label"))
    one = one.filter(id_fold(F.col("doc_id"), folds) != held_out).withColumn("label", (F.col("label") > 0).cast("int"))
    sample = cut(one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_DOCS))
    seen = sample.agg(F.count("*").alias("n"), F.sum("label").alias("good")).first()
    n, good = seen["n"], seen["good"] or 0
    n_shards = max(1, round(n / SHARD_DOCS))
    importance = F.when(F.col("label") == 1, F.lit(n / (2 * max(good, 1)))).otherwise(F.lit(n / (2 * max(n - good, 1))))
    # the sample is bounded, so it may go to every task, and only its texts are moved
    known = docs.filter("text is not null").select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    known = known.groupBy("doc_id", "label").agg(F.min(F.struct(F.xxhash64(F.lit(3), "doc_id", "text").alias("o"), "text")).alias("t"))
    rows = known.select(F.pmod("t.o", F.lit(n_shards)).alias("shard"), "t.o", "t.text", "label", importance.alias("importance"))
    rows = rows.repartition(n_shards, "shard").sortWithinPartitions("shard", "o").select("shard", "text", "label", "importance")
    models = rows.mapInPandas(_train, "shard long, place long, weight double")
    # whole numbers add up to the same sum in any order
    steps = F.round(F.col("weight") * F.lit(1e9)).cast("long")
    summed = models.groupBy("place").agg(F.sum(steps).alias("w"), F.count("*").alias("n")).toArrow().to_pandas()
    weights = np.zeros((1 << BITS) + 1)
    shards = summed.loc[summed["place"] == 1 << BITS, "n"]
    if len(shards):
        weights[summed["place"]] = summed["w"] / 1e9 / shards.iloc[0]
    return weights


def _score(weights):
    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, w = WordHashes(), weights.value
        for batch in batches:
            out = np.empty(len(batch))
            for i, text in enumerate(batch["text"]):
                places, values = features(text, known)
                out[i] = w[-1] + np.dot(w[places], values)
            yield batch.drop(columns=["text"]).assign(score=sigmoid(out))

    return score


def score_documents(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """doc_id, row_key and ``score`` (0 to 1) of every row; a null or empty text gets the bias alone."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    rows = docs.select(*plain_id(F.col("doc_id")), "text")
    return rows.mapInPandas(_score(shared), "id long, has_id boolean, score double").select(whole_id(), "score")


def good_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose score reaches ``threshold``, with their columns."""
    weights = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))
    names = keep_columns(docs, [])

    def kept(text: pd.Series) -> pd.Series:
        known, w = _SHAPES, weights.value
        out = np.empty(len(text))
        for i, t in enumerate(text):
            places, values = features(t, known)
            out[i] = w[-1] + np.dot(w[places], values)
        return pd.Series(sigmoid(out) >= threshold)

    good = F.pandas_udf(kept, "boolean")
    return docs.filter(good(F.col("text"))).select(*[F.col(f"`{c}`") for c in names])


def quality_digest(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Score and prediction of every document."""
    scored = score_documents(documents, fit(documents, labels))
    return scored.select("doc_id", (id_fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
