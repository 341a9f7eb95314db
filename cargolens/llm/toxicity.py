"""Toxicity scores from a counterfactually regularised classifier.

A logistic regression over the words that occur in a text is fitted to a bounded
sample of labelled texts. For each labelled sentence that names a group, copies
are made in which the identity term is swapped for another of the same kind,
and the squared change of the logit between a sentence and its copies is added
to the loss. A weight that only stands for the mention of a group is thereby
driven towards what the other terms have, and since terms of a kind are swapped
for a neutral placeholder too, towards none: neutral mentions don't score high.

The words that the model may use are those whose frequencies differ
significantly between the labels (likelihood-ratio statistic; ``max_words`` of
them at most, a bound on the model), and all identity terms.

In a model of words the penalty acts on the weights of identity terms alone: it
changes the scores of texts that name a group, and of others only through the
common fit. The sample always holds neutral mentions, so that a corpus that names
no group gets a model that is even-handed about them.

Defined results: null and empty texts get the score of the bias alone; without
labelled rows of both kinds every score is the share of toxic ones seen (0 if
there are none); texts of any length are scored whole; word order, case,
repetition and other columns play no part; repeated rows get equal scores.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import bucket_of, map_arrow, text_or_empty
from .labelled import sample

WORD = re.compile(r"[^\W\d_]+")
#: Identity terms by kind. A parameter: give the terms of the corpus's languages.
IDENTITY_TERMS: tuple[tuple[str, ...], ...] = (
    ("women", "men", "girls", "boys", "frauen", "männer", "femmes", "hommes", "mujeres", "hombres"),
    ("woman", "man", "girl", "boy", "frau", "mann", "femme", "homme", "mujer", "hombre"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino", "african", "european"),
    ("gay", "straight", "lesbian", "bisexual", "transgender", "heterosexual"),
    ("immigrant", "native", "refugee", "foreigner"),
    ("immigrants", "natives", "refugees", "foreigners"),
    ("disabled", "blind", "deaf", "old", "young"),
)
#: Neutral mentions that are added to the sample, one for each term, so that a
#: corpus that names no group has counterfactuals too.
MENTIONS = ("The {} came to town", "A story about {} was read at school", "Many {} people live in this street")
SENTENCE = re.compile(r"[.!?\n]+")


@dataclass
class Model:
    bias: float
    weights: dict[str, float] = field(default_factory=dict)

    def score(self, text: str) -> float:
        z = self.bias + sum(self.weights[w] for w in self.weights.keys() & set(WORD.findall(text.lower())))
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, z))))


def counterfactuals(text: str, terms: Sequence[Sequence[str]] = IDENTITY_TERMS) -> list[tuple[set[str], set[str]]]:
    """(words of a sentence, words of its copy) for each swap of an identity term."""
    kind = {t: i for i, group in enumerate(terms) for t in group}
    out = []
    for sentence in SENTENCE.split(text.lower()):
        words = set(WORD.findall(sentence))
        for term in sorted(words & kind.keys()):
            rest = words - {term}
            out += [(words, rest | {other}) for other in terms[kind[term]] if other not in words]
            out.append((words, rest))
    return out


def mentions(terms: Sequence[Sequence[str]] = IDENTITY_TERMS) -> list[tuple[str, int]]:
    return [(m.format(t), 0) for m in MENTIONS for group in terms for t in group]


def _csr(sets: list[set[str]], index: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    rows, cols = [], []
    for i, words in enumerate(sets):
        hit = [index[w] for w in words if w in index]
        rows += [i] * len(hit)
        cols += hit
    return np.array(rows, np.int64), np.array(cols, np.int64)


def fit(pairs: list[tuple[str, int]], terms: Sequence[Sequence[str]] = IDENTITY_TERMS, penalty: float = 1.0, l2: float = 3e-6, max_words: int = 2000, prior: float | None = None, steps: int = 400) -> Model:
    """``penalty``: weight of the counterfactual term. ``prior``: share of label 1
    outside the sample, for which the bias is corrected."""
    y = np.array([t for _, t in pairs], float)
    share = float(y.mean()) if len(y) else 0.0
    if share in (0.0, 1.0):
        p = min(max(share, 1e-6), 1 - 1e-6)
        return Model(math.log(p / (1 - p)))
    sets = [set(WORD.findall(t.lower())) for t, _ in pairs]
    seen = Counter(w for s in sets for w in s)
    toxic = Counter(w for s, t in zip(sets, y, strict=True) if t for w in s)
    n, m = len(y), float(y.sum())

    def ratio(word: str) -> float:
        """Likelihood-ratio statistic of the word's table with the label."""
        a, c = toxic[word], seen[word]
        cells = ((a, c * m / n), (c - a, c * (n - m) / n), (m - a, (n - c) * m / n), (n - m - c + a, (n - c) * (n - m) / n))
        return 2 * sum(x * math.log(x / e) for x, e in cells if x > 0 and e > 0)

    stat = {w: ratio(w) for w in seen}
    # 15: a word is used if its table is this unlikely by chance (about 1 in 10,000)
    vocabulary = sorted((w for w in stat if stat[w] > 15), key=lambda w: (-stat[w], w))[:max_words]
    vocabulary = sorted({*vocabulary, *(t for group in terms for t in group)})
    index = {w: i for i, w in enumerate(vocabulary)}
    rows, cols = _csr(sets, index)
    swaps = [pair for t, _ in pairs for pair in counterfactuals(t, terms)]
    r1, c1 = _csr([a for a, _ in swaps], index)
    r2, c2 = _csr([b for _, b in swaps], index)
    w, b = np.zeros(len(vocabulary)), 0.0
    mean_w, mean_sq, mean_b, sq_b = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for step in range(1, steps + 1):  # Adam on the full batch
        z = b + np.bincount(rows, w[cols], n)
        error = (1 / (1 + np.exp(-np.clip(z, -500, 500))) - y) / n
        gw, gb = np.bincount(cols, error[rows], len(w)) + l2 * w, float(error.sum())
        if swaps:
            change = np.bincount(r1, w[c1], len(swaps)) - np.bincount(r2, w[c2], len(swaps))
            change *= 2 * penalty / len(swaps)
            gw += np.bincount(c1, change[r1], len(w)) - np.bincount(c2, change[r2], len(w))
        mean_w, mean_sq = 0.9 * mean_w + 0.1 * gw, 0.999 * mean_sq + 0.001 * gw * gw
        mean_b, sq_b = 0.9 * mean_b + 0.1 * gb, 0.999 * sq_b + 0.001 * gb * gb
        u, v = 1 - 0.9**step, 1 - 0.999**step
        w -= 0.1 * (mean_w / u) / (np.sqrt(mean_sq / v) + 1e-8)
        b -= 0.1 * (mean_b / u) / (math.sqrt(sq_b / v) + 1e-8)
    if prior is not None and 0 < prior < 1:
        b += math.log(prior / (1 - prior)) - math.log(share / (1 - share))
    return Model(float(b), {t: float(w[i]) for t, i in index.items() if w[i]})


def learn(docs: DataFrame, labels: DataFrame, modulus: int = 4, remainder: int = 2, rows: int = 6000, id_col: str = "doc_id", text_col: str = "text", **settings) -> Model:
    """Fit on at most ``rows`` labelled rows outside the held-out remainder, and the
    neutral mentions if those rows have both labels."""
    allowed = bucket_of(F.col("_id"), modulus) != remainder
    pairs = sample(docs, labels, "toxic", allowed, rows, id_col, text_col)
    known = labels.select(F.col(id_col).alias("_id"), F.col("toxic").cast("int").alias("y")).filter("y in (0, 1)").filter(allowed)
    prior = known.agg(F.avg("y")).first()[0]
    if len({y for _, y in pairs}) == 2:
        pairs = pairs + mentions(settings.get("terms", IDENTITY_TERMS))
    return fit(pairs, prior=prior, **settings)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3, modulus: int = 4, remainder: int = 2) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [model.score(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=[id_col, "score"])

    rows = map_arrow(docs.select(F.col(id_col).cast("long").alias(id_col), text_or_empty(text_col).alias("text")), run, f"{id_col} long, score double")
    return rows.select(id_col, (bucket_of(F.col(id_col), modulus) == remainder).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` whose text scores below the threshold."""
    at, schema = docs.columns.index(text_col), docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [model.score(t or "") < threshold for t in batch.column(at).to_pylist()]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return map_arrow(docs, run, schema)
