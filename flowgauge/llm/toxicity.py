"""Toxicity by a linear classifier on character n-grams, scaled by naive Bayes.

A text's features are the n-grams of its lower-cased bytes that it has once, twice, or
four times at least, hashed into a table of fixed size.  Each is scaled by the log of the ratio of its shares among toxic
and other texts; a logistic regression is trained on the scaled features.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowgauge.llm.common import col, id_bucket, ship, spread_sample

ship(__name__)

#: Lengths of the n-grams in bytes.
ORDERS = (3, 4, 5, 6)
#: How often a text has an n-gram, at least, for each of its features.
LEVELS = (1, 2, 4)
#: The table has 2 ** TABLE_BITS features.
TABLE_BITS = 20
#: Labelled texts that the classifier is fitted on at most, and the bytes of the longest of them.
TRAIN_TEXTS, TRAIN_BYTES = 6_000, 100_000
#: Log-count ratio that a feature has at least, either way.
LEAST_RATIO = 0.3
#: Bytes of a text that are hashed at a time.
SLICE = 1 << 20
THRESHOLD = 0.3


def _hashed(raw: np.ndarray, starts: int) -> np.ndarray:
    """Table places of the n-grams that begin at the first ``starts`` bytes, all lengths together."""
    codes, places = raw.astype(np.uint32), []
    rolled = codes.copy()
    for n in range(2, max(ORDERS) + 1):
        if len(codes) < n:
            break
        rolled = rolled[:-1] * np.uint32(0x01000193) + codes[n - 1 :] + np.uint32(n)
        if n in ORDERS:
            mixed = (rolled[:starts] ^ (rolled[:starts] >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
            places.append(mixed >> np.uint32(32 - TABLE_BITS))
    return np.concatenate(places) if places else np.zeros(0, np.uint32)


def features(text: bytes | None) -> np.ndarray:
    """The distinct table places of a text, framed by spaces; n-grams that repeat have more than one."""
    raw = np.frombuffer(b" " + (text or b"") + b" ", np.uint8)
    values, counts = [], []
    for at in range(0, len(raw), SLICE):
        # A slice ends where the n-grams that begin in the next one begin.
        places = np.sort(_hashed(raw[at : at + SLICE + max(ORDERS) - 1], min(SLICE, len(raw) - at)))
        first = np.flatnonzero(np.concatenate([[True], places[1:] != places[:-1]])[: len(places)])
        values.append(places[first])
        counts.append(np.diff(np.append(first, len(places))))
    found, often = np.concatenate(values), np.concatenate(counts)
    if len(values) > 1:
        found, back = np.unique(found, return_inverse=True)
        often = np.bincount(back, often)
    out = [found]
    for level in LEVELS[1:]:
        mixed = (found[often >= level] + np.uint32(level << TABLE_BITS)) * np.uint32(0x9E3779B1)
        out.append(mixed >> np.uint32(32 - TABLE_BITS))
    return np.concatenate(out)


@dataclass
class Model:
    """Weight of every table place, scaling included, and the intercept."""

    weights: np.ndarray
    intercept: float


def train(texts: list[bytes | None], labels: list[int], epochs: int = 8, seed: int = 3) -> Model:
    """Log-count ratios with add-one smoothing, then Adagrad on the scaled features with L2."""
    size = 1 << TABLE_BITS
    y = np.array(labels, float)
    if not len(y) or y.min() == y.max():
        return Model(np.zeros(size, np.float32), 4.0 if len(y) and y[0] else -4.0)
    rows = [features(t).astype(np.int32) for t in texts]
    toxic, other, often = np.ones(size), np.ones(size), np.zeros(size, np.int32)
    for row, label in zip(rows, labels):
        (toxic if label else other)[row] += 1
        often[row] += 1
    # Shares of texts that have the feature.
    ratio = np.log(toxic / (y.sum() + 2)) - np.log(other / (len(y) - y.sum() + 2))
    # Rare n-grams and those that tell next to nothing are left out, which is most of a text.
    ratio[(often < 3) | (np.abs(ratio) < LEAST_RATIO)] = 0.0
    ratio = ratio.astype(np.float32)
    rng = np.random.default_rng(seed)
    w, squares = np.zeros(size, np.float32), np.full(size, 1e-6, np.float32)
    bias, bias_squares = float(np.log(y.mean() / (1 - y.mean()))), 1e-6
    rows = [row[ratio[row] != 0] for row in rows]
    scale = [ratio[row] / np.float32(np.sqrt(max(1, len(row)) / 1000)) for row in rows]
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            row, x = rows[i], scale[i]
            p = 1 / (1 + np.exp(-np.clip(bias + float(w[row] @ x), -30, 30)))
            g = np.float32(p - y[i]) * x + np.float32(1e-4) * w[row]
            squares[row] += g * g
            w[row] -= np.float32(0.05) * g / np.sqrt(squares[row] + np.float32(0.01))
            bias_squares += (p - y[i]) ** 2
            bias -= 0.05 * (p - y[i]) / np.sqrt(bias_squares)
    return Model((w * ratio).astype(np.float32), bias)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    held_out: tuple[int, int] = (4, 2),
    sample: int = TRAIN_TEXTS,
) -> Model:
    """Learn from at most ``sample`` labelled texts, those of the smallest id hashes.

    Rows whose id's crc32 leaves remainder ``held_out[1]`` by ``held_out[0]`` are left
    out, and so are texts above ``TRAIN_BYTES`` bytes.
    """
    marked = labels.select(col(id).alias("id"), col(label).cast("int").alias("label")).where(
        (id_bucket(F.col("id"), held_out[0]) != held_out[1]) & F.col("label").isNotNull()
    )
    # Of several labels of one id the largest counts.
    chosen = spread_sample(marked.groupBy("id").agg(F.max("label").alias("label")), F.xxhash64("id"), sample)
    texts = docs.select(col(id).alias("id"), col(text).cast("binary").alias("text")).where(
        F.coalesce(F.octet_length("text"), F.lit(0)) <= TRAIN_BYTES
    )
    lowered = F.lower(F.col("text").cast("string")).cast("binary")
    # Repeated rows are one; several texts of one id count, up to twice the sample in the order of a hash.
    joined = texts.join(F.broadcast(chosen), "id").select("id", "label", lowered.alias("text")).dropDuplicates(["id", "text"])
    rows = joined.orderBy(F.xxhash64("id", "text")).limit(2 * sample).collect()
    rows.sort(key=lambda r: (str(r.id), bytes(r.text or b"")))
    return train([bytes(r.text) if r.text is not None else None for r in rows], [int(r.label != 0) for r in rows])


def predict(docs: DataFrame, model: Model, id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(id, score, predicted) of every row's whole text; a null text counts as empty."""
    rows = docs.select(col(id).alias("id"), F.lower(col(text)).cast("binary").alias("text"))
    schema = T.StructType([rows.schema["id"]]).add("score", "double").add("predicted", "integer")
    # 4 MB, as large as the table, whatever the input.
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = sent.value
        for batch in batches:
            scores = np.empty(batch.num_rows)
            for i, text in enumerate(batch.column(1)):
                places = features(text.as_py())
                weights = model.weights[places]
                used = max(1, int(np.count_nonzero(weights)))
                scores[i] = model.intercept + float(weights.sum(dtype=float)) / np.sqrt(used / 1000)
            scores = 1 / (1 + np.exp(-np.clip(scores, -30, 30)))
            predicted = (scores >= threshold).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores), pa.array(predicted)], ["id", "score", "predicted"])

    return rows.mapInArrow(run, schema).withColumnRenamed("id", id)
