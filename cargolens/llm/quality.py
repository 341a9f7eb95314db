"""Quality scores from compressed sizes.

Two zstandard dictionaries are trained, one on texts labelled good and one on
texts labelled bad. A text is compressed with each and with none; the difference
of the two sizes over the text's length says which kind it resembles, and the
size without dictionary says how much it repeats itself. A logistic regression
over piecewise linear functions of these ratios, fitted to labelled texts that
the dictionaries have not seen, turns them into a probability.

Defined results: null counts as empty; an empty text is scored like any other;
without two labelled texts of each kind (one for the dictionary, one for the
regression, neither of them empty) every score is the share of good ones seen (1
if there are none); of an id's texts one counts for fitting, of its labels the
greatest; texts are compressed whole, whatever their length; equal
texts get equal scores; other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import bucket_of, map_arrow, text_or_empty
from .labelled import sample

DICTIONARY_BYTES = 112_640
LEVEL = 1
#: Texts are cut into samples of so many bytes for training; a dictionary takes one
#: part in ``SHARE`` of them, and ``LEAST_DICTIONARY`` bytes at least.
SAMPLE_BYTES, SHARE, LEAST_DICTIONARY, LEAST_SAMPLES = 1024, 4, 1024, 32
#: Segment and stretch lengths of the dictionary trainer.
COVER = (50, 8)
KNOTS = (0.01, 0.03, 0.06, 0.1, 0.15, 0.2, 0.5, 0.8, 0.85, 0.9, 0.95, 0.98)


@dataclass
class Model:
    prior: float
    good: bytes = b""
    bad: bytes = b""
    centre: np.ndarray | None = None
    scale: np.ndarray | None = None
    knots: np.ndarray | None = None
    weights: np.ndarray | None = None

    def compressors(self) -> tuple:
        make = lambda d: zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(d) if d else None, write_content_size=False, write_checksum=False, write_dict_id=False)
        return make(self.good), make(self.bad), make(b"")

    def design(self, x: np.ndarray) -> np.ndarray:
        cols = [np.ones(len(x))]
        for j in range(x.shape[1]):
            cols.append((x[:, j] - self.centre[j]) / self.scale[j])
            cols += [np.maximum(0, x[:, j] - k) / self.scale[j] for k in self.knots[j]]
        return np.stack(cols, 1)

    def score(self, texts: list[str], compressors: tuple) -> np.ndarray:
        if self.weights is None:
            return np.full(len(texts), self.prior)
        if not texts:
            return np.empty(0)
        x = np.array([ratios(t, compressors) for t in texts])
        return 1 / (1 + np.exp(-np.clip(self.design(x) @ self.weights, -30, 30)))


def ratios(text: str, compressors: tuple) -> tuple[float, ...]:
    raw = text.encode()
    a, b, z = (len(c.compress(raw)) for c in compressors)
    n = len(raw) + 16
    return (a - b) / n, (a - b) / (a + b), min(a, b) / n, z / n, float(np.log(n))


def _dictionary(texts: list[bytes]) -> bytes:
    """A trained dictionary, of a fixed share of its samples' size and ``DICTIONARY_BYTES`` at most."""
    samples = [t[i : i + SAMPLE_BYTES] for t in texts for i in range(0, len(t), SAMPLE_BYTES)]
    size = min(DICTIONARY_BYTES, max(LEAST_DICTIONARY, sum(map(len, texts)) // SHARE))
    # the trainer wants some samples and bytes: what is too little is repeated
    samples *= -(-max(LEAST_SAMPLES, 0) // max(1, len(samples)))
    return zstandard.train_dictionary(size, samples, k=COVER[0], d=COVER[1]).as_bytes()


def fit(pairs: list[tuple[str, int]], prior: float | None = None, ridge: float = 0.05) -> Model:
    good, bad = ([t.encode() for t, y in pairs if y == k and t] for k in (1, 0))
    if prior is None:
        prior = sum(y for _, y in pairs) / len(pairs) if pairs else 1.0
    if len(good) < 2 or len(bad) < 2:
        return Model(prior)
    model = Model(prior, _dictionary(good[::2]), _dictionary(bad[::2]))
    compressors = model.compressors()
    fresh = [(t, 1) for t in good[1::2]] + [(t, 0) for t in bad[1::2]]
    x, y = np.array([ratios(t.decode(), compressors) for t, _ in fresh]), np.array([k for _, k in fresh], float)
    model.centre, model.scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    model.knots = np.quantile(x, KNOTS, axis=0).T
    share = y.mean()
    weight = np.where(y == 1, prior / share, (1 - prior) / (1 - share)) if 0 < prior < 1 else np.ones(len(y))
    d = model.design(x)
    w = np.zeros(d.shape[1])
    for _ in range(60):  # Newton's method
        p = 1 / (1 + np.exp(-np.clip(d @ w, -30, 30)))
        step = np.linalg.solve((d * (weight * p * (1 - p))[:, None]).T @ d + ridge * np.eye(len(w)), d.T @ (weight * (p - y)) + ridge * w)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    model.weights = w
    return model


def learn(docs: DataFrame, labels: DataFrame, modulus: int = 5, remainder: int = 0, rows: int = 6000, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Fit on at most ``rows`` labelled rows outside the held-out remainder."""
    allowed = bucket_of(F.col("_id"), modulus) != remainder
    pairs = sample(docs, labels, "quality", allowed, rows, id_col, text_col)
    known = labels.select(F.col(id_col).alias("_id"), F.col("quality").cast("int").alias("y")).filter("y in (0, 1)").filter(allowed)
    return fit(pairs, known.agg(F.avg("y")).first()[0])


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3, modulus: int = 5, remainder: int = 0) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressors = model.compressors()
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(batch.column(1).to_pylist(), compressors), pa.float64())], names=[id_col, "score"])

    rows = map_arrow(docs.select(F.col(id_col).cast("long").alias(id_col), text_or_empty(text_col).alias("text")), run, f"{id_col} long, score double")
    return rows.select(id_col, (bucket_of(F.col(id_col), modulus) == remainder).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
