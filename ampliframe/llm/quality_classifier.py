"""A quality classifier on averaged subword embeddings.

A text's features are its words and their character n-grams, hashed into a fixed number of
buckets. A word that only repeats the one before it counts as the same marker, whatever the word. Each bucket has a learned vector; a text is the average of the vectors of all its
features, and a softmax layer on that average gives the probability of each label. Vectors and
layer are trained together by stochastic gradient descent in numpy.

Training takes a bounded sample of labelled rows (`max_rows`), whose features are computed by
Spark and whose sparse counts alone reach the driver. Scoring runs over all rows. As the layer is
linear in the average, each bucket then needs a single number, so what is sent to the workers has
a fixed size (4 bytes a bucket).
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, DoubleType, IntegerType, StructField, StructType,
)

from ampliframe.llm.common import WordCache, add_columns, utf8


@dataclass(frozen=True)
class Settings:
    buckets: int = 1 << 17
    width: int = 16
    shortest: int = 3
    longest: int = 5
    epochs: int = 8
    rate: float = 0.5
    seed: int = 7
    #: labelled rows used for training, those with the smallest hashes of their ids
    max_rows: int = 1500


@dataclass(frozen=True)
class Model:
    settings: Settings
    #: what a bucket adds to the log odds of label 1, before averaging
    weights: np.ndarray
    bias: float


def word_buckets(word: bytes, s: Settings) -> np.ndarray:
    """Buckets of a word and of its n-grams of bytes, the word's ends marked."""
    marked = b"<" + word + b">"
    crc, mask = zlib.crc32, s.buckets - 1
    found = [crc(marked) & mask]
    for n in range(s.shortest, s.longest + 1):
        found += [crc(marked[i : i + n], n) & mask for i in range(len(marked) - n + 1)]
    return np.array(found, np.int32)


#: stands for a word equal to the word before it; not a word itself, as it holds a space
AGAIN = b" again"


def marked_words(text: bytes) -> list[bytes]:
    words = text.split()
    return words[:1] + [AGAIN if w == before else w for before, w in zip(words, words[1:])]


def feature_counts(docs: DataFrame, text: str, s: Settings) -> DataFrame:
    """`docs` with the sparse bucket counts of every whole text."""

    def start():
        cache = WordCache(lambda w: word_buckets(w, s).tobytes(), 100_000)

        def step(texts):
            buckets, counts = [], []
            for t in utf8(texts):
                found = np.frombuffer(b"".join([cache[w] for w in marked_words(t)]), np.int32)
                b, c = np.unique(found, return_counts=True)
                buckets.append(b)
                counts.append(c.astype(np.int32))
            kind = pa.list_(pa.int32())
            return [pa.array(buckets, kind), pa.array(counts, kind)]

        return step

    numbers = ArrayType(IntegerType())
    fields = StructType([StructField("__buckets", numbers), StructField("__counts", numbers)])
    return add_columns(docs, [text], fields, start)


def _train(rows: pa.Table, s: Settings) -> Model:
    vectors_of = np.random.default_rng(s.seed)
    vectors = vectors_of.uniform(-1 / s.width, 1 / s.width, (s.buckets, s.width)).astype(np.float32)
    layer = np.zeros((s.width, 2), np.float32)
    bias = np.zeros(2, np.float32)
    examples = []
    by_id = np.argsort(rows["__id"].to_numpy(), kind="stable")
    labels = rows["__label"].to_pylist()
    for i in by_id.tolist():
        # small types: all examples are held by the driver while it trains
        buckets = rows["__buckets"][i].values.to_numpy()
        counts = rows["__counts"][i].values.to_numpy().astype(np.float32)
        examples.append((buckets, counts[:, None] / max(counts.sum(), 1), labels[i]))
    steps = s.epochs * len(examples)
    for n in range(steps):
        if n % len(examples) == 0:
            order = vectors_of.permutation(len(examples))
        buckets, shares, label = examples[order[n % len(examples)]]
        rate = s.rate * (1 - n / steps)
        own = vectors[buckets]
        mean = (own * shares).sum(0)
        logits = mean @ layer + bias
        odds = np.exp(logits - logits.max())
        error = odds / odds.sum()
        error[label] -= 1
        pull = layer @ error
        layer -= rate * np.outer(mean, error)
        bias -= rate * 0.1 * error
        vectors[buckets] = own - rate * s.width * shares * pull
    weights = vectors @ (layer[:, 1] - layer[:, 0])
    return Model(s, weights.astype(np.float32), float(bias[1] - bias[0]))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    settings: Settings = Settings(),
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    allowed: Column | None = None,
) -> Model:
    """Learn from the texts of labelled documents.

    `allowed` restricts the labelled ids used. Null ids or labels are left out; an id labelled
    more than once counts once, as 1 if most of its labels are 1 (also on a tie). Without any
    usable row the model gives every text a score of 0.5.
    """
    chosen = labels.select(F.col(doc_id).alias("__id"), F.col(label).alias("__y"))
    chosen = chosen.filter("__id is not null and __y is not null")
    if allowed is not None:
        chosen = chosen.filter(allowed)
    chosen = chosen.groupBy("__id").agg((F.avg("__y") >= 0.5).cast("int").alias("__label"))
    chosen = chosen.orderBy(F.xxhash64("__id"), "__id").limit(settings.max_rows)
    given = docs.select(F.col(doc_id).alias("__id"), F.col(text).alias("__text"))
    # at most max_rows ids: a size that is known
    rows = feature_counts(given.join(F.broadcast(chosen), "__id"), "__text", settings)
    rows = rows.select("__id", "__label", "__buckets", "__counts").toArrow()
    if not rows.num_rows:
        return Model(settings, np.zeros(settings.buckets, np.float32), 0.0)
    model = _train(rows, settings)
    del rows
    pa.default_memory_pool().release_unused()
    return model


def score(
    docs: DataFrame, model: Model, text: str = "text", name: str = "score"
) -> DataFrame:
    """`docs` with the probability of label 1 of every whole text.

    A null text counts as empty; a text without words has only the bias. A column called like the
    score is replaced; other columns, repeated rows and their order are left alone.
    """
    s, weights, bias = model.settings, model.weights, model.bias

    def start():
        def summed(word: bytes) -> complex:
            own = word_buckets(word, s)
            return complex(float(weights[own].sum(dtype=np.float64)), len(own))

        # the sum of a word's weights and, as the imaginary part, their number
        cache = WordCache(summed, 500_000)

        def step(texts):
            sums = [sum(map(cache.__getitem__, marked_words(t)), 0j) for t in utf8(texts)]
            total = np.array(sums, np.complex128)
            log_odds = total.real / np.maximum(total.imag, 1) + bias
            return [pa.array(1 / (1 + np.exp(-np.clip(log_odds, -30, 30))))]

        return step

    return add_columns(docs, [text], StructType([StructField(name, DoubleType(), False)]), start)


def classify(
    docs: DataFrame, labels: DataFrame, threshold: float = 0.3, settings: Settings = Settings()
) -> DataFrame:
    """`docs` with held_out, score and predicted; labels of held-out ids are not learnt from.

    An id is held out if the CRC-32 of its text is divisible by five; null ids are not.
    """
    model = fit(docs, labels, settings, allowed=~held_out(F.col("__id")))
    scored = score(docs, model)
    return scored.withColumns(
        {
            "held_out": held_out(F.col("doc_id")),
            "predicted": (F.col("score") >= threshold).cast("int"),
        }
    )


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))
