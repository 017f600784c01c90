"""A quality classifier by compression: one zstandard dictionary of good and one of bad labelled text.

A text is cut into chunks, each is compressed with either dictionary, and the normalised difference of the summed sizes
says which class it resembles; a logistic curve, fitted to labelled texts that are in neither dictionary, makes a score of it.

The model is fitted on the driver from at most `sample` labelled rows of each class (those of least hash of doc_id; of rows that share an id, that of least
hash of the text). Of a text of more than `longest` bytes it gets chunks of that many bytes together, spread evenly from the text's beginning to its end, so what
the driver gets is bounded by the product (2 * 3,000 * 8 KiB by default), and no text is left out for its length. Every other row of a class makes its dictionary,
the rest the curve. Scoring reads every whole text, on the executors, without a shuffle.

Defined cases: a null text is an empty one; an empty text gets the curve's value for no evidence; with labels of
one class only, or too few for a dictionary, every score is the share of label 1 (0.5 without labels); a null doc_id has no label; a label of neither 0 nor 1 is none; an
id with both labels teaches both; repeated rows are scored each for itself; an input column of the score's name is replaced; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import raw, small


@dataclass
class Model:
    dictionaries: tuple[bytes, bytes] | None
    weights: np.ndarray
    chunk: int = 1024
    level: int = 3

    def compressors(self) -> list[zstandard.ZstdCompressor]:
        found = [zstandard.ZstdCompressionDict(x) for x in self.dictionaries]
        for x in found:
            x.precompute_compress(level=self.level)
        return [zstandard.ZstdCompressor(dict_data=x, level=self.level, write_content_size=False, write_dict_id=False) for x in found]

    def features(self, texts: list[bytes]) -> np.ndarray:
        """1 and the normalised difference of the compressed sizes."""
        bad, good = (x.compress for x in self.compressors())
        out = np.ones((len(texts), 2))
        for k, text in enumerate(texts):
            cut = [text[i : i + self.chunk] for i in range(0, len(text), self.chunk)]
            a, b = sum(len(bad(x)) for x in cut), sum(len(good(x)) for x in cut)
            out[k, 1] = 10 * (a - b) / max(1, a + b)
        return out

    def score(self, texts: list[bytes]) -> np.ndarray:
        if self.dictionaries is None:
            return np.full(len(texts), self.weights[0])
        return 1 / (1 + np.exp(-np.clip(self.features(texts) @ self.weights, -30, 30)))


def logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray, ridge: float = 1e-2, rounds: int = 60) -> np.ndarray:
    """Weights by Newton steps on the penalised likelihood; w: a weight per row."""
    at = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -30, 30)))
        slope = x.T @ (w * (y - p)) - ridge * at
        bend = (x * (w * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(at))
        step = np.linalg.solve(bend, slope)
        at += step * min(1.0, 5 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-8:
            break
    return at


def spread(text: bytes, longest: int, chunk: int) -> bytes:
    """A text of up to `longest` bytes as it is; of a longer one, chunks of so many bytes from all over it, the first and last among them."""
    if len(text) <= longest:
        return text
    n = max(2, longest // chunk)
    return b"".join(text[i : i + chunk] for i in ((len(text) - chunk) * k // (n - 1) for k in range(n)))


def fit(docs: DataFrame, labels: DataFrame, learn: Column, sample: int = 3000, longest: int = 1 << 13, size: int = 1 << 16, chunk: int = 1024) -> Model:
    """learn: which rows of `labels` (doc_id, quality) may be learnt from."""
    labels = labels.select(F.col("doc_id").cast("bigint"), F.col("quality").cast("int").alias("label")).where(learn & F.col("label").isin(0, 1)).distinct()
    shares = {r["label"]: r["count"] for r in labels.groupBy("label").count().collect()}
    chosen = None
    for label in (0, 1):  # ids only, and no more than `sample`
        own = labels.where(F.col("label") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
        chosen = own if chosen is None else chosen.unionByName(own)
    texts = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).where(F.octet_length("text") > 0)
    rows = texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "label", F.xxhash64("doc_id", "text").alias("h"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array([spread(x, longest, chunk) for x in raw(b.column(3))], pa.binary())], ["doc_id", "label", "h", "text"])

    rows = rows.mapInArrow(run, "doc_id long, label int, h long, text binary").groupBy("doc_id", "label").agg(F.min(F.struct("h", "text")).alias("r"))
    rows = sorted(map(tuple, rows.select("label", "r.h", "r.text").collect()), key=lambda r: (r[1], r[0], r[2]))  # a row per chosen id at most
    prior = shares.get(1, 0) / max(1, sum(shares.values())) if shares else 0.5
    none = Model(None, np.array([prior]))
    cut = {label: [bytes(r[2]) for r in rows if r[0] == label] for label in (0, 1)}
    found = []
    for label in (0, 1):
        half = [t[i : i + chunk] for t in cut[label][::2] for i in range(0, len(t), chunk)]
        if len(half) < 16 or len(cut[label]) < 8:
            return none
        try:
            found.append(zstandard.train_dictionary(size, half).as_bytes())
        except zstandard.ZstdError:  # too little text: what there is, as it is
            found.append(b"".join(half)[-size:])
    model = Model((found[0], found[1]), np.zeros(2), chunk)
    rest = {label: cut[label][1::2] for label in (0, 1)}
    y = np.repeat([0.0, 1.0], [len(rest[0]), len(rest[1])])
    share = np.array([1 - prior, prior])
    w = np.concatenate([np.full(len(rest[k]), share[k] * len(y) / max(1, len(rest[k]))) for k in (0, 1)])
    model.weights = logistic(model.features(rest[0] + rest[1]), y, w)
    return model


def with_scores(docs: DataFrame, model: Model, keep_from: float | None = None, score: str | None = "score") -> DataFrame:
    """`docs` with a column of scores; with `keep_from`, only rows of that score or more. score: None adds no column."""
    docs = docs.drop(score) if score else docs
    at = docs.columns.index("text")
    names = [*docs.columns, *([score] if score else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            scores = model.score(raw(b.column(at).cast(pa.string())))
            columns = [*b.columns, *([pa.array(scores)] if score else [])]
            b = pa.RecordBatch.from_arrays(columns, names)
            yield b if keep_from is None else b.filter(pa.array(scores >= keep_from))

    return docs.mapInArrow(run, T.StructType([*docs.schema, *([T.StructField(score, T.DoubleType())] if score else [])]))
