"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads a text's bytes in pieces, forwards and backwards, and labels every
position; a text's languages are the mean of its positions' probabilities.  It is
trained on the driver, in numpy, by backpropagation through time over a bounded sample
of labelled pieces.  Its weights are a few KB; tasks get a copy.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowgauge.llm.common import col, id_bucket, ship, tidy

ship(__name__)

HIDDEN, EMBEDDING = 12, 12
#: Bytes that the network reads in one go; a text is cut into pieces of that length.
PIECE = 64
#: Pieces labelled at a time.
BATCH = 2048
#: Training: texts sampled per language, bytes read of each at random places, rounds.
TRAIN_TEXTS, TRAIN_PIECES, EPOCHS = 400, 6, 4
#: Texts that the network learns from, over all languages.
MOST_TEXTS = 8000
UNKNOWN = "und"


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


@dataclass
class Network:
    """Weights of both directions, stacked: gates are update, reset, candidate."""

    languages: list[str]
    embedding: np.ndarray  # 256 x E
    inputs: np.ndarray  # 2 x E x 3H
    state: np.ndarray  # 2 x H x 3H
    bias: np.ndarray  # 2 x 1 x 3H
    out: np.ndarray  # 2H x L
    out_bias: np.ndarray  # L

    @staticmethod
    def new(languages: list[str], seed: int = 7) -> Network:
        rng = np.random.default_rng(seed)
        draw = lambda *s: (rng.standard_normal(s) / np.sqrt(s[-2])).astype(np.float32)
        h, e, n = HIDDEN, EMBEDDING, len(languages)
        zero = lambda *s: np.zeros(s, np.float32)
        return Network(languages, draw(256, e) * 4, draw(2, e, 3 * h), draw(2, h, 3 * h), zero(2, 1, 3 * h), draw(2 * h, n), zero(n))

    def weights(self) -> list[np.ndarray]:
        return [self.embedding, self.inputs, self.state, self.bias, self.out, self.out_bias]

    def table(self) -> np.ndarray:
        """2 x 256 x 3H: what each byte gives to the gates."""
        return self.embedding @ self.inputs + self.bias

    def run(self, codes: np.ndarray, keep: bool = False):
        """States (T x 2 x B x H) over pieces (B x T), backwards for the second direction."""
        b, t = codes.shape
        h, table, state = HIDDEN, self.table(), self.state
        ways = np.stack([codes.T, codes.T[::-1]], 1)  # T x 2 x B
        hidden = np.zeros((2, b, h), np.float32)
        states = np.empty((t, 2, b, h), np.float32)
        saved = []
        gates_w, cand_w = np.ascontiguousarray(state[:, :, : 2 * h]), np.ascontiguousarray(state[:, :, 2 * h :])
        for i in range(t):
            x = np.stack([table[0].take(ways[i, 0], 0), table[1].take(ways[i, 1], 0)])
            gates = _sigmoid(x[..., : 2 * h] + hidden @ gates_w)
            z, r = gates[..., :h], gates[..., h:]
            c = np.tanh(x[..., 2 * h :] + (r * hidden) @ cand_w)
            if keep:
                saved.append((hidden, z, r, c))
            hidden = hidden + z * (c - hidden)
            states[i] = hidden
        return (states, saved, ways) if keep else states

    def positions(self, codes: np.ndarray) -> np.ndarray:
        """Probabilities of every language at every position: T x B x L."""
        states = self.run(codes)
        scores = states[:, 0] @ self.out[:HIDDEN] + states[::-1, 1] @ self.out[HIDDEN:] + self.out_bias
        scores -= scores.max(-1, keepdims=True)
        np.exp(scores, out=scores)
        scores /= scores.sum(-1, keepdims=True)
        return scores

    def gradients(self, codes: np.ndarray, labels: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean loss over positions, and its gradients by backpropagation through time."""
        b, t = codes.shape
        h = HIDDEN
        states, saved, ways = self.run(codes, keep=True)
        both = np.concatenate([states[:, 0], states[::-1, 1]], -1)  # T x B x 2H
        scores = both @ self.out + self.out_bias
        scores -= scores.max(-1, keepdims=True)
        p = np.exp(scores)
        p /= p.sum(-1, keepdims=True)
        loss = -float(np.log(np.maximum(p[:, np.arange(b), labels], 1e-9)).mean())
        p[:, np.arange(b), labels] -= 1
        p /= b * t
        d_out = np.einsum("tbh,tbl->hl", both, p)
        d_both = p @ self.out.T
        d_states = np.stack([d_both[..., :h], d_both[::-1, :, h:]], 1)  # T x 2 x B x H
        d_table = np.zeros((2, 256, 3 * h), np.float32)
        d_state, d_hidden = np.zeros_like(self.state), np.zeros((2, b, h), np.float32)
        gates_w, cand_w = self.state[:, :, : 2 * h], self.state[:, :, 2 * h :]
        for i in range(t - 1, -1, -1):
            before, z, r, c = saved[i]
            d = d_hidden + d_states[i]
            d_c = d * z * (1 - c * c)
            d_rh = d_c @ cand_w.transpose(0, 2, 1)
            d_gates = np.concatenate([d * (c - before) * z * (1 - z), d_rh * before * r * (1 - r)], -1)
            d_state[:, :, : 2 * h] += before.transpose(0, 2, 1) @ d_gates
            d_state[:, :, 2 * h :] += (r * before).transpose(0, 2, 1) @ d_c
            d_hidden = d * (1 - z) + d_rh * r + d_gates @ gates_w.transpose(0, 2, 1)
            whole = np.concatenate([d_gates, d_c], -1)
            for way in (0, 1):
                np.add.at(d_table[way], ways[i, way], whole[way])
        d_embedding = np.einsum("wvg,weg->ve", d_table, self.inputs)
        d_inputs = np.einsum("ve,wvg->weg", self.embedding, d_table)
        return loss, [d_embedding, d_inputs, d_state, d_table.sum(1, keepdims=True), d_out, p.sum((0, 1))]


def _pieces(text: bytes) -> np.ndarray:
    """A text in pieces, the last one filled up with zeros, which do not count."""
    codes = np.frombuffer(text, np.uint8)
    short = -len(codes) % PIECE
    filled = np.concatenate([codes, np.zeros(short, np.uint8)])
    return filled.reshape(-1, PIECE)


def train(texts: list[bytes], labels: list[str], seed: int = 7, epochs: int = EPOCHS) -> Network:
    """Fit by Adam on pieces of the texts taken at random places."""
    rng = np.random.default_rng(seed)
    net = Network.new(sorted(set(labels)), seed)
    number = {name: i for i, name in enumerate(net.languages)}
    pieces, wanted = [], []
    for text, label in zip(texts, labels):
        if not text:
            continue
        for at in rng.integers(0, max(1, len(text) - PIECE + 1), min(TRAIN_PIECES, -(-len(text) // PIECE))):
            pieces.append(_pieces(text[at : at + PIECE])[0])
            wanted.append(number[label])
    if not pieces:
        return net
    codes, marks = np.array(pieces), np.array(wanted)
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in net.weights()]
    steps = 0
    # Few pieces are gone through more often.
    for _ in range(max(epochs, min(60, -(-12_000 // len(marks)) * epochs))):
        order = rng.permutation(len(marks))
        for i in range(0, len(order), 128):
            some = order[i : i + 128]
            _, grads = net.gradients(codes[some], marks[some])
            steps += 1
            size = np.sqrt(sum(float((g * g).sum()) for g in grads))
            for w, g, (m, v) in zip(net.weights(), grads, moments):
                g = g * min(1.0, 1.0 / max(size, 1e-9))
                m += 0.1 * (g - m)
                v += 0.005 * (g * g - v)
                w -= (0.01 * (m / (1 - 0.9**steps)) / (np.sqrt(v / (1 - 0.995**steps)) + 1e-7)).astype(np.float32)
    return net


def fit(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    held_out: tuple[int, int] = (5, 0),
    per_language: int = TRAIN_TEXTS,
    most_texts: int = MOST_TEXTS,
) -> Network:
    """Learn from at most ``per_language`` texts of each language, those of the smallest hashes of id and text.

    There are at most ``most_texts`` of them over all languages, which share these evenly; of
    more languages than that the most frequent are learned.  Repeated rows count once.

    Rows whose id's crc32 leaves remainder ``held_out[1]`` by ``held_out[0]`` are left
    out, and so are rows without language or letters.  Of each text a bounded stretch is
    read.  Without any labelled text the network knows no language.
    """
    usable = docs.select(col(text).alias("text"), col(lang).cast("string").alias("lang"), col(id).alias("id")).where(
        (id_bucket(F.col("id"), held_out[0]) != held_out[1]) & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")
    )
    place = F.xxhash64(F.col("id").cast("string"), F.substring("text", 1, 64))
    start = F.greatest(F.lit(1), F.pmod(place, F.greatest(F.lit(1), F.length("text") - 2000)) + 1).cast("int")
    marked = usable.select("lang", place.alias("place"), F.substr("text", start, F.lit(2000)).cast("binary").alias("text"))
    # Copies of one row are one text.  Different texts of each language, counted before any text is sent on.
    different = marked.select("lang", "place").distinct().groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    known = different.orderBy(F.desc("n"), "lang").limit(most_texts).collect()
    if not known:
        return train([], [])
    share = min(per_language, max(1, most_texts // len(known)))
    bounds = [(r.lang, min(2.0, (3.0 * share + 50.0) / r.n)) for r in known]
    limits = docs.sparkSession.createDataFrame(bounds, "lang string, bound double")
    # The k smallest of each language; the bound on the hash, one row a language, keeps their texts where they are.
    near = marked.join(F.broadcast(limits), "lang").where(F.col("place") / F.lit(2.0**64) + 0.5 <= F.col("bound"))
    order = F.row_number().over(Window.partitionBy("lang").orderBy("place"))
    rows = near.dropDuplicates(["lang", "place"]).withColumn("at", order).where(F.col("at") <= share).collect()
    best: dict[str, list] = {}
    for row in sorted(rows, key=lambda r: (r.lang, r.place)):
        best.setdefault(row.lang, []).append(bytes(row.text))
    texts = [t for name in sorted(best) for t in best[name]]
    labels = [name for name in sorted(best) for _ in best[name]]
    return train(texts, labels)


def _label(texts: list[bytes | None], net: Network) -> np.ndarray:
    """Mean probabilities per text; rows of a text's pieces are weighed by their bytes."""
    sums = np.zeros((len(texts), len(net.languages)))
    waiting: list[np.ndarray] = []
    owners: list[np.ndarray] = []
    rows = 0

    def run():
        codes, owner = np.concatenate(waiting), np.concatenate(owners)
        for i in range(0, len(codes), BATCH):
            part = codes[i : i + BATCH]
            labelled = net.positions(part)
            labelled *= (part.T != 0)[..., None]
            found = labelled.sum(0)
            np.add.at(sums, owner[i : i + BATCH], found)

    for i, text in enumerate(texts):
        # Very long texts go through in parts.
        for at in range(0, len(text or b""), PIECE * BATCH):
            part = _pieces(text[at : at + PIECE * BATCH])
            waiting.append(part)
            owners.append(np.full(len(part), i))
            rows += len(part)
            if rows >= BATCH:
                run()
                waiting, owners, rows = [], [], 0
    if rows:
        run()
    return sums / np.maximum(sums.sum(1, keepdims=True), 1e-9)


def predict(docs: DataFrame, net: Network, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, lang_pred, score) of every row's whole text.

    ``score`` is the mean probability of the predicted language over all positions.  A
    text that is null or has no letter is ``und`` with score 0, and so is every text if
    the network knows no language.
    """
    letters = F.coalesce(col(text).rlike(r"\p{L}"), F.lit(False))
    rows = docs.select(col(id).alias("id"), F.when(letters, col(text)).cast("binary").alias("text"))
    schema = T.StructType([rows.schema["id"]]).add("lang_pred", "string").add("score", "double")

    def run(batches):
        for batch in batches:
            texts = batch.column(1).to_pylist()
            if net.languages:
                shares = _label(texts, net)
                best = shares.argmax(1)
                names = [UNKNOWN if t is None else net.languages[b] for t, b in zip(texts, best)]
                scores = [0.0 if t is None else min(1.0, float(s)) for t, s in zip(texts, shares.max(1))]
            else:
                names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["id", "lang_pred", "score"]
            )

    return rows.mapInArrow(tidy(run), schema).withColumnRenamed("id", id)
