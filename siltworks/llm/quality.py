"""Quality of texts: logistic regression on hashed word n-grams, trained by follow-the-regularised-leader.

Method. A text's words and runs of marks are hashed; single ones and neighbouring pairs, and a sign
for a word that repeats the one before, are counted in 2**18 places. The value of a place is the
square root of its count, and a text's values have a fixed length. Training takes a bounded sample
of labelled rows: for each shard FTRL-Proximal (per-coordinate steps, L1 and L2) runs over its rows
in a fixed order for some epochs, whichever shards share a task, and the models' weights are
averaged. A score is the sigmoid of a sparse dot product.

Bounds. ``max_examples`` labelled rows at most, in expectation, chosen by a hash of the id;
``2**bits`` weights, which the driver holds and sends to tasks whatever the size of the data.

Defined cases: null text counts as empty and scores as the intercept says; rows without id are
scored, and are not held out; labels other than 0 and 1 or null are ignored, and if a document has
both labels it counts as 0; without any usable label every score is 0.5; repeated rows each give a
row; an empty table gives an empty table; further columns are ignored. Texts of any length are read
whole, a block at a time.
"""

from __future__ import annotations

import math
from itertools import groupby
from typing import Iterator, NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import bounded_batches
from .common import Sink, give_back, rows_of, whole_text
from .wordhash import WordHasher, combine, words_and_marks

BITS = 18
MAX_EXAMPLES = 20_000
SHARD_EXAMPLES = 4_000
LENGTH = 3.0
THRESHOLD = 0.7


class Steps(NamedTuple):
    """Settings of the training."""

    alpha: float = 0.3
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.1
    epochs: int = 4


class Features:
    """Places and values of a text's n-grams."""

    def __init__(self, bits: int = BITS):
        self.bits, self.hasher = bits, WordHasher(words_and_marks())
        self.again = np.uint64(0x5851F42D4C957F2D)

    def of(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        parts = [words]
        if len(words) > 1:
            pairs = combine(words[:-1], words[1:])
            same = words[:-1] == words[1:]
            pairs[same] = self.again
            parts.append(pairs)
        places = (np.concatenate(parts) >> np.uint64(64 - self.bits)).astype(np.int64)
        places, counts = np.unique(places, return_counts=True)
        values = np.sqrt(counts)
        return places, values * (LENGTH / max(math.sqrt(counts.sum()), 1e-9))

    def texts(self, rows) -> Iterator[tuple]:
        for keys, begins, words in self.hasher.documents(rows):
            for k, key in enumerate(keys):
                yield key, *self.of(words[begins[k]:begins[k + 1]])


class Ftrl:
    """FTRL-Proximal for logistic loss; the last place is the intercept."""

    def __init__(self, size: int, steps: Steps):
        self.z, self.n, self.steps = np.zeros(size + 1), np.zeros(size + 1), steps

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n, s = self.z[at], self.n[at], self.steps
        return np.where(np.abs(z) <= s.l1, 0.0, -(z - np.sign(z) * s.l1) / ((s.beta + np.sqrt(n)) / s.alpha + s.l2))

    def learn(self, places: np.ndarray, values: np.ndarray, label: int) -> None:
        at, x = np.append(places, len(self.z) - 1), np.append(values, 1.0)
        w, n = self.weights(at), self.n[at]
        gradient = (sigmoid(float(w @ x)) - label) * x
        grown = n + gradient * gradient
        self.z[at] += gradient - (np.sqrt(grown) - np.sqrt(n)) / self.steps.alpha * w
        self.n[at] = grown


def sigmoid(x: float) -> float:
    return 1.0 / (1.0 + math.exp(-min(max(x, -35.0), 35.0)))


def remainder(id_column: str) -> Column:
    """crc32 of the id as text, modulo 4; rows whose remainder is 2 are held out of training."""
    return F.crc32(F.col(id_column).cast("string").cast("binary")) % 4


_EXAMPLE = pa.schema([("shard", pa.int32()), ("turn", pa.int64()), ("label", pa.int32()),
                      ("places", pa.binary()), ("amounts", pa.binary())])
_WEIGHT = pa.schema([("place", pa.int64()), ("weight", pa.float64())])
_MODELS = -1  # the place at which each model adds a one


def fit(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
        label_column: str = "quality", max_examples: int = MAX_EXAMPLES, bits: int = BITS,
        steps: Steps = Steps()) -> np.ndarray:
    """Weights of ``2**bits`` places and the intercept, from rows that are not held out."""
    bounded_batches(docs.sparkSession)
    known = (labels.where(F.col(label_column).isin(0, 1) & (remainder(id_column) != 2))
             .groupBy(F.col(id_column).cast("bigint").alias("row_key")).agg(F.min(label_column).cast("int").alias("label")))
    found = known.count()
    turn = F.xxhash64("row_key")
    share = min(1.0, max_examples / max(found, 1))
    sample = known.where(F.pmod(turn, F.lit(1 << 30)) < int(share * (1 << 30)))
    shards = max(1, min(found, max_examples) // SHARD_EXAMPLES)
    rows = (docs.select(F.col(id_column).cast("bigint").alias("row_key"), whole_text(text_column).alias("body"))
            .join(F.broadcast(sample), "row_key")  # at most max_examples ids and labels
            .select("row_key", "label", "body"))

    def examples(batches):
        features, sink = Features(bits), Sink(_EXAMPLE)
        texts = (((key, label), body.encode("utf-8", "surrogatepass")) for key, label, body in rows_of(batches))
        for (key, label), places, amounts in features.texts(texts):
            row = (key % shards, key * 0x9E3779B97F4A7C15 % (1 << 63), label, places.tobytes(), amounts.tobytes())
            if sink.add(row, 16 * len(places) + 64):
                yield sink.flush()
        yield sink.flush()
        give_back()

    def train(batches):
        for _, shard in groupby(rows_of(batches), key=lambda row: row[0]):  # a task may hold several shards
            model = Ftrl(1 << bits, steps)
            kept = [(np.frombuffer(places, np.int64), np.frombuffer(amounts), label) for _, _, label, places, amounts in shard]
            for _ in range(steps.epochs):
                for places, amounts, label in kept:
                    model.learn(places, amounts, label)
            weights = model.weights()
            at = np.flatnonzero(weights)
            yield pa.RecordBatch.from_arrays([pa.array(np.append(at, _MODELS)), pa.array(np.append(weights[at], 1.0))], schema=_WEIGHT)
            del model, kept
        give_back()

    trained = (rows.mapInArrow(examples, "shard int, turn bigint, label int, places binary, amounts binary")
               .repartition(shards, "shard").sortWithinPartitions("shard", "turn")
               .mapInArrow(train, "place bigint, weight double"))
    weights = np.zeros((1 << bits) + 1)
    sums = dict(trained.groupBy("place").agg(F.sum("weight")).collect())  # at most 2**bits + 2 rows
    models = sums.pop(_MODELS, 1.0)
    for place, total in sums.items():
        weights[place] = total / models
    return weights


class Scorer:
    """Scores of many texts; made in the task."""

    def __init__(self, weights: np.ndarray):
        self.weights, self.features = weights, Features(int(math.log2(len(weights) - 1)))

    def of(self, texts: list[str | None]) -> list[float]:
        rows = ((None, (t or "").encode("utf-8", "surrogatepass")) for t in texts)
        return [sigmoid(float(self.weights[places] @ values + self.weights[-1]))
                for _, places, values in self.features.texts(rows)]


_SCORE = pa.schema([("row_key", pa.int64()), ("score", pa.float64())])


def score(docs: DataFrame, weights: np.ndarray, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``<id>, score`` of every row."""
    def run(batches):
        scorer = Scorer(weights)
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                scores = scorer.of(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(scores, pa.float64())], schema=_SCORE)

    rows = docs.select(F.col(id_column).cast("bigint").alias("row_key"), whole_text(text_column).alias("body"))
    return rows.mapInArrow(run, "row_key bigint, score double").withColumnRenamed("row_key", id_column)


def keep_good(docs: DataFrame, weights: np.ndarray, text_column: str = "text",
              threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score at least ``threshold``, with all their columns."""
    bounded_batches(docs.sparkSession)
    place = docs.columns.index(text_column)

    def run(batches):
        scorer = Scorer(weights)
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                scores = scorer.of(part.column(place).to_pylist())
                yield part.filter(pa.array([s >= threshold for s in scores], pa.bool_()))
        give_back()

    return docs.mapInArrow(run, docs.schema)
