"""Quality classifier: a byte-level convolutional network in numpy.

A text's bytes go through ``filters`` convolutions of ``width`` bytes (a filter is a table
with one weight for each byte value at each place, so a convolution is ``width`` look-ups).
Chunks of ``chunk`` window places, overlapping by width - 1 bytes, cover the whole text;
each chunk keeps the largest value of each filter.  The mean and the maximum of the rectified
chunk values go into one logistic unit.  No prefix is taken: every byte of every text counts.

Training (Adam on the cross-entropy, gradients through the largest values) runs on the driver
over a bounded sample: at most ``per_class`` labelled texts of each class, those with the
smallest hash of their key.  Scoring runs in the tasks; only the weights travel.  Both classes
have the same weight in training, so a score of 0.5 says that both are as likely for such a text.

Defined results: NULL or empty text is scored like one zero byte; NULL keys pass through and
are held in training only with a label (never, as NULL joins nothing).  Without labels of both
classes every score is the share of label 1 (0.5 without labels).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from vitrina.llm.pieces import release_encoders

BLOCK = 1 << 17  # window places worked on at once


@dataclass
class ByteCnn:
    tables: np.ndarray  # (width, 256, filters)
    bias: np.ndarray  # (filters,)
    weights: np.ndarray  # (2 * filters,): of the chunk means, then of the maxima
    intercept: float
    chunk: int = 256

    @classmethod
    def start(cls, filters: int = 16, width: int = 4, chunk: int = 256, seed: int = 7) -> ByteCnn:
        rng = np.random.default_rng(seed)
        return cls(rng.normal(0, 0.3, (width, 256, filters)).astype(np.float32), np.zeros(filters, np.float32),
                   rng.normal(0, 0.1, 2 * filters).astype(np.float32), 0.0, chunk)

    def maxima(self, data: bytes, places: bool = False):
        """Largest value of each filter in each chunk of one text; with ``places``, also where."""
        width = len(self.tables)
        raw = np.frombuffer(data or b"\0", np.uint8)
        padded = np.concatenate([raw, np.zeros(width - 1, np.uint8)])
        values, at = [], []
        for a in range(0, len(raw), BLOCK):
            n = min(BLOCK, len(raw) - a)
            out = self.tables[0][padded[a:a + n]]
            for k in range(1, width):
                out += self.tables[k][padded[a + k:a + k + n]]
            starts = np.arange(0, n, self.chunk)
            if places:
                for s in starts.tolist():
                    best = out[s:s + self.chunk].argmax(axis=0)
                    at.append(best + (a + s))
                    values.append(out[s + best, np.arange(out.shape[1])][None])
            else:
                values.append(np.maximum.reduceat(out, starts, axis=0))
        v = np.concatenate(values) + self.bias
        return (v, np.array(at), padded) if places else v

    def score(self, data: bytes) -> float:
        v = np.maximum(self.maxima(data), 0)
        z = float(np.concatenate([v.mean(axis=0), v.max(axis=0)]) @ self.weights + self.intercept)
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))

    def fit(self, texts: list[bytes], labels: np.ndarray, epochs: int = 8, batch: int = 32, rate: float = 0.01,
            steps: int = 500, seed: int = 7) -> ByteCnn:
        rng = np.random.default_rng(seed)
        weight = np.where(labels == 1, 0.5 / max(labels.mean(), 1e-9), 0.5 / max(1 - labels.mean(), 1e-9))
        intercept = np.zeros(1, np.float32)
        params = [self.tables, self.bias, self.weights, intercept]
        moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
        step, n_f = 0, len(self.bias)
        for _ in range(max(epochs, -(-steps * batch // len(texts)))):
            for at in np.array_split(rng.permutation(len(texts)), max(1, len(texts) // batch)):
                grads = [np.zeros_like(p) for p in params]
                for i in at.tolist():
                    v, places, padded = self.maxima(texts[i], places=True)
                    r = np.maximum(v, 0)
                    x = np.concatenate([r.mean(axis=0), r.max(axis=0)])
                    z = float(x @ self.weights + intercept[0])
                    d = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[i]
                    d *= weight[i]
                    grads[2] += d * x
                    grads[3] += d
                    dv = np.repeat(d * self.weights[None, :n_f] / len(v), len(v), axis=0)
                    dv[r.argmax(axis=0), np.arange(n_f)] += d * self.weights[n_f:]
                    dv *= v > 0
                    grads[1] += dv.sum(axis=0)
                    for k in range(len(self.tables)):
                        np.add.at(grads[0][k], (padded[places + k], np.arange(n_f)[None, :]), dv)
                step += 1
                for p, g, (m, s) in zip(params, grads, moments):
                    g /= len(at)
                    m += 0.1 * (g - m)
                    s += 0.001 * (g * g - s)
                    p -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.999 ** step)) + 1e-8)
        self.intercept = float(intercept[0])
        return self


def held_out(id_col: str = "doc_id"):
    """Whether a row is kept from training: crc32 of its key as text is divisible by 5."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id",
          text_col: str = "text", per_class: int = 1000, max_bytes: int = 100_000) -> ByteCnn | float:
    """The fitted network, or a constant score where there are not two classes to learn from.

    It learns from a sample: at most ``per_class`` labelled documents of each class, whole, of at most
    ``max_bytes`` each; a document that is labelled twice alike counts once."""
    rows = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y"))
            .filter("id IS NOT NULL AND y IN (0, 1)").filter(~held_out("id")))
    counts = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}  # two rows
    share = counts.get(1, 0) / sum(counts.values()) if counts else 0.5
    if len(counts) < 2:
        return float(share)
    order = [F.xxhash64("id"), "id"]
    chosen = rows.filter("y = 1").orderBy(*order).limit(per_class).union(rows.filter("y = 0").orderBy(*order).limit(per_class))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    # Bounded in rows and bytes: long texts are left out, and at most 4 * per_class rows that repeat an id count.
    found = texts.join(F.broadcast(chosen.distinct()), "id").filter(F.coalesce(F.octet_length("text"), F.lit(0)) <= max_bytes)
    found = found.orderBy("id", "text").limit(4 * per_class).toPandas()
    y = found["y"].to_numpy(np.float32)
    if len(set(y.tolist())) < 2:
        return float(share)
    return ByteCnn.start().fit([(t or "").encode() for t in found["text"]], y)


def score_quality(df: DataFrame, model: ByteCnn | float, keep: tuple[str, ...] = ("doc_id",),
                  text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``keep`` columns and the score of every whole text."""
    keep = tuple(c for c in keep if c != score_col)
    place = keep.index(text_col) if text_col in keep and df.schema[text_col].dataType.simpleString() == "string" else len(keep)
    text = [F.col(text_col).cast("string").alias("__text")] if place == len(keep) else []  # a kept text is not sent twice
    src = df.select(*(F.col(f"`{c}`") for c in keep), *text)
    schema = ", ".join([*(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep), f"`{score_col}` double"])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_encoders()
        for batch in (b.slice(at, 256) for b in batches for at in range(0, b.num_rows, 256)):
            texts = batch.column(place)
            if isinstance(model, float):
                scores = [model] * len(texts)
            else:
                scores = [model.score((t.as_py() or "").encode()) for t in texts]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(len(keep))), pa.array(scores, pa.float64())],
                                             names=[*keep, score_col])

    return src.mapInArrow(score, schema)
