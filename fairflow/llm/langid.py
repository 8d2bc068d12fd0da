"""Language identification: a byte convolutional network, trained in numpy.

Bytes are embedded, filters of several widths slide over fixed-length windows, each filter's maximum
over the window feeds a softmax.  The network learns from a bounded sample of labelled documents
(``PER_LANGUAGE`` of each language, one passage of ``PASSAGE`` characters each) outside the held-out
fold; id, source and language are never inputs.  Every whole text is cut into windows of ``WINDOW``
bytes (the last one padded with zero bytes); their probabilities are averaged by bytes.

Filters of width two to four over embedded bytes are sums of values that depend on one or two bytes,
so a task looks them up in tables made from the weights once.

Defined results.  ``und`` with score 0 for NULL texts, texts without a letter, and when there is
nothing to learn from.  NULL languages are not learned.  Repeated rows get equal results.  Extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import text_blocks
from .folds import held_out, sample_per_class
from .register import query

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBEDDING = 8
PER_LANGUAGE = 400
PASSAGE = 1500
EPOCHS = 5
BLOCK_BYTES = 1 << 20
PIECE = 256  # windows at a time


def windows_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Padded windows of all texts, the text of each, and its bytes."""
    sizes = np.diff(offsets)
    per_text = -(-sizes // WINDOW)
    of = np.repeat(np.arange(len(sizes)), per_text)
    index = np.arange(len(of)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
    begin = offsets[:-1][of] + index * WINDOW
    used = np.minimum(offsets[1:][of] - begin, WINDOW)
    at = begin[:, None] + np.arange(WINDOW)
    inside = np.arange(WINDOW) < used[:, None]
    out = np.where(inside, data[np.where(inside, at, 0)] if len(data) else 0, 0).astype(np.uint8)
    return out, of, used


class ByteCNN:
    def __init__(self, classes: int, seed: int = 0):
        r = np.random.default_rng(seed)
        self.weights = {"bytes": r.normal(0, 0.5, (256, EMBEDDING))}
        for w in WIDTHS:
            self.weights[f"filters{w}"] = r.normal(0, (w * EMBEDDING) ** -0.5, (w, EMBEDDING, FILTERS))
            self.weights[f"bias{w}"] = np.zeros(FILTERS)
        self.weights["out"] = r.normal(0, 0.1, (FILTERS * len(WIDTHS), classes))
        self.weights["out_bias"] = np.zeros(classes)
        self.weights = {k: v.astype(np.float32) for k, v in self.weights.items()}
        self.tables = None

    def _pooled(self, x: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        e = self.weights["bytes"][x]
        values, places = [], []
        for w in WIDTHS:
            n = WINDOW - w + 1
            conv = sum(e[:, j:j + n] @ self.weights[f"filters{w}"][j] for j in range(w)) + self.weights[f"bias{w}"]
            places.append(conv.argmax(1))
            values.append(conv.max(1))
        return values, places

    def train(self, x: np.ndarray, y: np.ndarray, epochs: int, seed: int = 0, batch: int = 64, rate: float = 0.004) -> None:
        r = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.weights.items()}
        second = {k: np.zeros_like(v) for k, v in self.weights.items()}
        step = 0
        for _ in range(epochs):
            for part in np.array_split(r.permutation(len(x)), max(1, len(x) // batch)):
                step += 1
                for k, g in self._gradients(x[part], y[part]).items():
                    first[k] += 0.1 * (g - first[k])
                    second[k] += 0.01 * (g * g - second[k])
                    self.weights[k] -= rate * (first[k] / (1 - 0.9 ** step)) / (
                        np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-7)
        self.tables = None

    def _gradients(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        w_ = self.weights
        values, places = self._pooled(x)
        pooled = np.concatenate(values, 1)
        active = np.maximum(pooled, 0)
        p = self._softmax(active @ w_["out"] + w_["out_bias"])
        p[np.arange(len(y)), y] -= 1
        p /= len(y)
        out = {"out": active.T @ p, "out_bias": p.sum(0), "bytes": np.zeros_like(w_["bytes"])}
        back = (p @ w_["out"].T) * (pooled > 0)
        rows = np.arange(len(x))[:, None]
        for k, w in enumerate(WIDTHS):
            g = back[:, k * FILTERS:(k + 1) * FILTERS]
            out[f"bias{w}"] = g.sum(0)
            grad = np.zeros_like(w_[f"filters{w}"])
            for j in range(w):
                byte = x[rows, places[k] + j]  # only each filter's maximum has a gradient
                grad[j] = np.einsum("bfe,bf->ef", w_["bytes"][byte], g)
                np.add.at(out["bytes"], byte, g[:, :, None] * w_[f"filters{w}"][j].T[None])
            out[f"filters{w}"] = grad
        return out

    @staticmethod
    def _softmax(z: np.ndarray) -> np.ndarray:
        z = np.exp(z - z.max(1, keepdims=True))
        return z / z.sum(1, keepdims=True)

    def _tables(self) -> dict:
        if self.tables is None:
            one = lambda w, j: self.weights["bytes"] @ self.weights[f"filters{w}"][j]
            pair = lambda w, j: (one(w, j)[:, None] + one(w, j + 1)[None]).reshape(65536, FILTERS)
            self.tables = {(w, j): pair(w, j) if j + 1 < w else one(w, j) for w in WIDTHS for j in range(0, w, 2)}
        return self.tables

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of each window."""
        tables, out = self._tables(), np.empty((len(x), len(self.weights["out_bias"])), np.float32)
        for k in range(0, len(x), PIECE):
            part = x[k:k + PIECE].astype(np.int32)
            pairs = part[:, :-1] * 256 + part[:, 1:]
            pooled = []
            for w in WIDTHS:
                n = WINDOW - w + 1
                conv = None
                for j in range(0, w, 2):
                    add = tables[w, j][pairs[:, j:j + n] if j + 1 < w else part[:, j:j + n]]
                    conv = add if conv is None else np.add(conv, add, out=conv)
                pooled.append(conv.max(1) + self.weights[f"bias{w}"])
            active = np.maximum(np.concatenate(pooled, 1), 0)
            out[k:k + PIECE] = self._softmax(active @ self.weights["out"] + self.weights["out_bias"])
        return out


def train(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          per_language: int = PER_LANGUAGE) -> tuple[list[str], ByteCNN] | None:
    """The learned languages and the network; None without a labelled text."""
    rows = documents.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{lang_col}`").alias("lang"),
                            F.col(f"`{text_col}`").alias("text"), held_out(id_col).alias("out"))
    rows = rows.filter("NOT out AND lang IS NOT NULL").filter(F.col("text").rlike(r"\p{L}"))
    start = F.expr(f"cast(pmod(xxhash64(id, 3), greatest(1, length(text) - {PASSAGE})) + 1 AS int)")
    rows = rows.select("id", "lang", F.substring("text", start, F.lit(PASSAGE)).alias("text"))
    sample = sorted(tuple(r) for r in sample_per_class(rows, "lang", "id", per_language).select("lang", "text", "id").collect())
    languages = sorted({r[0] for r in sample})
    if not languages:
        return None
    data = [r[1].encode() for r in sample]
    x, of, used = windows_of(np.frombuffer(b"".join(data), np.uint8), np.cumsum([0] + [len(d) for d in data]))
    y = np.array([languages.index(r[0]) for r in sample])[of]
    network = ByteCNN(len(languages))
    network.train(x, y, EPOCHS)
    return languages, network


def identify(documents: DataFrame, model: tuple[list[str], ByteCNN] | None, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred, score per row."""
    text = F.col(f"`{text_col}`")
    rows = documents.select(F.col(f"`{id_col}`").alias("doc_id"), held_out(id_col).alias("held_out"), text.alias("text"),
                            F.coalesce(text.rlike(r"\p{L}"), F.lit(False)).alias("letters"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in text_blocks(batch.column("text"), BLOCK_BYTES):
                letters = batch.column("letters").slice(a, b - a).to_numpy(zero_copy_only=False)
                names, scores = np.full(b - a, "und", object), np.zeros(b - a)
                if model is not None and letters.any():
                    x, of, used = windows_of(data, offsets)
                    total = np.zeros((b - a, len(model[0])))
                    np.add.at(total, of, model[1].predict(x) * used[:, None])
                    total /= np.maximum(np.diff(offsets), 1)[:, None]
                    names = np.where(letters, np.array(model[0], object)[total.argmax(1)], "und")
                    scores = np.where(letters, np.minimum(total.max(1), 1.0), 0.0)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a), batch.column("held_out").slice(a, b - a),
                     pa.array(names, pa.string()), pa.array(scores)], ["doc_id", "held_out", "lang_pred", "score"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double")


@query("op5_language_id")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return identify(documents, train(documents))
