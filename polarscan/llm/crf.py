"""Document quality from a linear-chain conditional random field over lines.

Every line with a word is labelled good or bad from its own features and those of the lines beside it. Training takes the
document's label for each of its lines (lines of a bad document that look good are noise that the chain averages out). A
document's quality is the mean forward-backward marginal of "good", weighted by line length, mapped to a score by a fitted
logistic curve.

Training reads a bounded sample: at most ``TRAIN_ROWS`` labelled ids, of which texts with over ``TRAIN_LINES`` lines are left
out; scoring reads every whole text. Defined results: texts without a word (null and empty ones too) score 0; a one-line text
is a chain of one; if the labelled rows know bad texts only, every text with words scores near 0, and if they know no bad one
(or there are none), near 1, so that a filter without evidence keeps.
"""

from __future__ import annotations

from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import PIECE, as_bytes, bounded_training, fold, label_rows, map_batches, table, texts

TRAIN_ROWS = 4000
TRAIN_LINES = 400
STEPS = 120
FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.7

UPPER = bytes(range(65, 91))
LETTERS = UPPER + bytes(range(97, 123)) + bytes(range(0x80, 0x100))
DIGITS = b"0123456789"
SYMBOLS = b"#*$%&|<>"
OWN = 12  # features of a line itself
BESIDE = (1, 2, 3, 5, 6)  # of them, those also taken from the line before and the line after
WIDTH = OWN + 2 * len(BESIDE)


def _line(line: bytes, repeated: bool) -> tuple[float, ...]:
    n = len(line)
    words = line.split()
    k = len(words)
    letters = n - len(line.translate(None, LETTERS))
    upper = n - len(line.translate(None, UPPER))
    symbols = n - len(line.translate(None, SYMBOLS))
    digits = n - len(line.translate(None, DIGITS))
    adjacent = sum(map(eq, words, words[1:]))
    return (
        1.0,
        upper / max(letters, 1),
        min(1.0, 4 * symbols / n),
        min(1.0, 4 * line.count(b"!") / n),
        digits / n,
        1 - len(set(words)) / k,
        adjacent / max(k - 1, 1),
        min(n / k, 40) / 40,
        min(np.log1p(k), 8) / 8,
        float(k < 5),
        float(repeated),
        (n - letters) / n,
    )


def line_features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(lines x WIDTH features, lengths of the lines); lines without a word are left out."""
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    own = np.zeros((len(lines), WIDTH))
    seen: set[bytes] = set()
    for i, line in enumerate(lines):
        own[i, :OWN] = _line(line, line in seen)
        seen.add(line)
    m = len(BESIDE)
    own[1:, OWN : OWN + m] = own[:-1, BESIDE]
    own[:-1, OWN + m :] = own[1:, BESIDE]
    return own, np.array([len(x) for x in lines], dtype=float)


@dataclass
class Chain:
    """Two states: 0 bad, 1 good. ``weights`` give the log-odds of good for a line, ``pairs`` the transition scores."""

    weights: np.ndarray
    pairs: np.ndarray
    slope: float = 6.0
    offset: float = -3.0

    def marginals(self, x: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Forward-backward over concatenated chains: P(good) of every line, and expected pair counts (2 x 2).

        Chains are sorted by length, so that step t works on the leading chains that have a line t.
        """
        order = np.argsort(-lengths, kind="stable")
        size = lengths[order]
        start = (np.cumsum(lengths) - lengths)[order]
        active = np.searchsorted(-size, -np.arange(1, (size[0] if len(size) else 0) + 1), side="right")
        odds = x @ self.weights
        forward, backward = np.zeros((len(x), 2)), np.zeros((len(x), 2))
        for t, k in enumerate(active):
            at = start[:k] + t
            a = np.zeros((k, 2)) if t == 0 else _log_product(forward[at - 1], self.pairs)
            a[:, 1] += odds[at]
            forward[at] = a - a.max(axis=1, keepdims=True)
        for t in range(len(active) - 2, -1, -1):
            k = active[t + 1]
            at = start[:k] + t
            b = backward[at + 1].copy()
            b[:, 1] += odds[at + 1]
            b = _log_product(b, self.pairs.T)
            backward[at] = b - b.max(axis=1, keepdims=True)
        both = forward + backward
        good = 1 / (1 + np.exp(np.clip(both[:, 0] - both[:, 1], -60, 60)))
        first = np.ones(len(x), bool)
        first[start[size > 0]] = False
        at = np.flatnonzero(first)
        counts = np.zeros((2, 2))
        if len(at):
            later = backward[at].copy()
            later[:, 1] += odds[at]
            joint = forward[at - 1][:, :, None] + self.pairs + later[:, None, :]
            joint = np.exp(joint - joint.max(axis=(1, 2), keepdims=True))
            counts = (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        return good, counts

    def quality(self, x: np.ndarray, weights: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Length-weighted mean of the marginals of each chain; 0 for a chain without lines."""
        good, _ = self.marginals(x, lengths)
        owner = np.repeat(np.arange(len(lengths)), lengths)
        total = np.bincount(owner, weights, len(lengths))
        return np.bincount(owner, weights * good, len(lengths)) / np.maximum(total, 1e-9)

    def score(self, quality: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        z = 1 / (1 + np.exp(-np.clip(self.slope * quality + self.offset, -60, 60)))
        return np.where(lengths > 0, z, 0.0)


def _log_product(a: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    s = a[:, :, None] + pairs
    top = s.max(axis=1)
    return top + np.log(np.exp(s - top[:, None, :]).sum(axis=1))


def train(x: np.ndarray, weights: np.ndarray, lengths: np.ndarray, y: np.ndarray, steps: int = STEPS) -> Chain:
    """Maximum likelihood with all lines labelled as their document, by Adam; then the logistic curve on the qualities."""
    chain = Chain(np.zeros(WIDTH), np.zeros((2, 2)))
    if len(x) == 0 or len(set(y.tolist())) < 2:
        chain.slope, chain.offset = 0.0, -5.0 if 0 in y.tolist() else 5.0
        return chain
    line_y = np.repeat(y, lengths).astype(float)
    pairs_seen = np.diag([(lengths - 1)[(y == c) & (lengths > 0)].sum() for c in (0, 1)]).astype(float)
    n = len(x)
    theta, m, v = np.zeros(WIDTH + 4), np.zeros(WIDTH + 4), np.zeros(WIDTH + 4)
    for step in range(1, steps + 1):
        chain = Chain(theta[:WIDTH], theta[WIDTH:].reshape(2, 2))
        good, pairs = chain.marginals(x, lengths)
        gradient = np.concatenate([x.T @ (line_y - good), (pairs_seen - pairs).ravel()]) / n - 1e-4 * theta
        m, v = 0.9 * m + 0.1 * gradient, 0.99 * v + 0.01 * gradient**2
        theta = theta + 0.15 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    chain = Chain(theta[:WIDTH], theta[WIDTH:].reshape(2, 2))
    q = chain.quality(x, weights, lengths)
    design, beta = np.stack([q, np.ones(len(q))], axis=1), np.zeros(2)
    target = np.where(y == 1, 0.995, 0.005)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        curve = design.T @ (design * (p * (1 - p))[:, None]) + 1e-3 * np.eye(2)
        beta = beta + np.linalg.solve(curve, design.T @ (target - p) - 1e-3 * beta)
    chain.slope, chain.offset = float(beta[0]), float(beta[1])
    return chain


def _featurize(text_column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    parts = [line_features(x) for x in as_bytes(text_column)]
    lengths = np.array([len(w) for _, w in parts], dtype=np.int64)
    x = np.concatenate([p for p, _ in parts]) if parts else np.zeros((0, WIDTH))
    return x, np.concatenate([w for _, w in parts]) if parts else np.zeros(0), lengths


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, lines: int = TRAIN_LINES) -> Chain:
    """Trains on the labelled rows outside the held-out fold, at most ``rows`` of them and short enough texts."""

    def features(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = []
        for text, y in zip(as_bytes(batch.column(1)), batch.column(2).to_pylist()):
            if text.count(b"\n") <= lines:
                x, w = line_features(text)
                found.append((x.astype(np.float32).tobytes(), w.astype(np.float32).tobytes(), y))
        arrays = list(zip(*found)) or [(), (), ()]
        return pa.RecordBatch.from_arrays([pa.array(a, k) for a, k in zip(arrays, (pa.binary(), pa.binary(), pa.int32()))], names=["x", "w", "y"])

    sample = bounded_training(docs, label_rows(labels, "quality", FOLDS, HELD_OUT), rows)
    got = map_batches(sample, features, "x binary, w binary, y int").collect()
    x = [np.frombuffer(r["x"], np.float32).reshape(-1, WIDTH).astype(float) for r in got]
    lengths = np.array([len(a) for a in x], dtype=np.int64)
    weights = [np.frombuffer(r["w"], np.float32).astype(float) for r in got]
    y = np.array([r["y"] for r in got], dtype=np.int64)
    if not got:
        return train(np.zeros((0, WIDTH)), np.zeros(0), lengths, y)
    return train(np.concatenate(x), np.concatenate(weights), lengths, y)


def _scores(chain: Chain, text_column: pa.Array) -> np.ndarray:
    x, weights, lengths = _featurize(text_column)
    return chain.score(chain.quality(x, weights, lengths), lengths)


def scored(docs: DataFrame, chain: Chain) -> DataFrame:
    """doc_id, held_out, score and predicted for every document."""

    def score(batch: pa.RecordBatch) -> pa.RecordBatch:
        s = _scores(chain, batch.column(2))
        arrays = [batch.column(0), batch.column(1), pa.array(s, pa.float64()), pa.array((s >= THRESHOLD).astype(np.int32))]
        return pa.RecordBatch.from_arrays(arrays, names=["doc_id", "held_out", "score", "predicted"])

    rows = texts(docs).select("doc_id", (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "text")
    return map_batches(rows, score, "doc_id long, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, chain: Chain) -> DataFrame:
    """The documents with a score of at least ``THRESHOLD``, with all their columns."""

    def keep(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.filter(pa.array(_scores(chain, batch.column(batch.schema.get_field_index("text"))) >= THRESHOLD))

    return map_batches(docs, keep, docs.schema, PIECE)


def op4_quality_crf(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return scored(docs, fit(docs, table(spark, sf_dir, "labels")))
