"""Toxicity by a weighted finite-state pattern grammar.

Words are read as classes: insult, threat, target, negation, reported speech, clause break, other. Three transducers over
these symbols are composed once into one machine: negation (an insult or threat up to three words after a negation becomes a
negated one), reported speech (after a verb of saying, until the clause ends, it becomes a reported one) and target (one
within four words after a person addressed becomes an attack). The machine's output for a clause is a row of pattern labels;
a clause is worth the learned weights of its labels plus the strength of its insults, so isolated words count for little by
themselves where weights say so. A document's score is the logistic of its clauses' sum (on a log scale) and best clause.

Threats, targets, negations and verbs of saying are fixed lists in four languages. Insults are learned: terms (words and
stems of five letters) that occur in toxic training texts far more often than in others, in several contexts. Training reads
at most ``TRAIN_ROWS`` labelled rows; scoring reads every whole text. Texts without an insult or threat have no matched clause
and all get the machine's score of nothing. Defined results: null and empty texts are such texts; equal rows get equal scores;
without labelled rows of both classes nothing is an insult and only threats count.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, bounded_training, fold, label_rows, map_batches, staged, table, texts

TRAIN_ROWS = 12_000
FOLDS, HELD_OUT = 3, 1
THRESHOLD = 0.7
STEM = 5
LEAST_TEXTS, LEAST_CONTEXTS, LEAST_SHARE, LEAST_EVIDENCE = 4, 4, 0.9, 16.0

# Words of the grammar.
THREAT = "kill hurt destroy burn beat stab shoot matar golpear quemar tuer frapper brûler töten schlagen verbrennen".split()
TARGET = "you your yourself he she they them him her people tú usted ustedes ellos vous toi ils elles du dich ihr euch sie".split()
NEGATION = "not never no isn't aren't don't nunca jamás jamais pas nicht nie kein keine".split()
REPORTED = "said says say wrote writes quoted claimed called dijo dicen escribió dit disent écrit sagte sagt schrieb".split()

LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0x80 or c == 39 else 32 for c in range(256))
CLAUSES = bytes(46 if chr(c) in ".,;:!?\n" else LETTERS[c] for c in range(256))
TOKEN = re.compile(rb"[^ .]+|\.")

OTHER, TARGETS, NEGATES, REPORTS, BREAK = "o", "t", "n", "r", "."
FIXED = {
    **{w.encode(): TARGETS for w in TARGET},
    **{w.encode(): NEGATES for w in NEGATION},
    **{w.encode(): REPORTS for w in REPORTED},
    **{w.encode(): "T" for w in THREAT},
}


@dataclass(frozen=True)
class Transducer:
    """Deterministic: (state, symbol) gives (next state, output symbol); symbols not in the table pass through."""

    arcs: dict
    start: int = 0

    def step(self, state: int, symbol: str) -> tuple[int, str]:
        return self.arcs.get((state, symbol), (state, symbol))

    def symbols(self) -> set[str]:
        return {s for _, s in self.arcs} | {o for _, o in self.arcs.values()}


def within(mark: str, marked: str, reach: int, subjects: str, rename: dict[str, str], others: str) -> Transducer:
    """After ``mark``, for ``reach`` words (0: until the clause ends), each of ``subjects`` is renamed."""
    arcs = {}
    last = max(reach, 1)
    for state in range(last + 1):
        after = state if reach == 0 else max(0, state - 1)
        for symbol in others + subjects:
            arcs[state, symbol] = (after, rename[symbol] if state and symbol in subjects else symbol)
        arcs[state, mark] = (last, marked)
        arcs[state, BREAK] = (0, BREAK)
    return Transducer(arcs)


def compose(a: Transducer, b: Transducer, alphabet: str) -> Transducer:
    """The machine that feeds the output of ``a`` to ``b``, over reachable pairs of states."""
    number, arcs, todo = {(a.start, b.start): 0}, {}, [(a.start, b.start)]
    while todo:
        pair = todo.pop()
        for symbol in alphabet:
            x, middle = a.step(pair[0], symbol)
            y, out = b.step(pair[1], middle)
            if (x, y) not in number:
                number[x, y] = len(number)
                todo.append((x, y))
            arcs[number[pair], symbol] = (number[x, y], out)
    return Transducer(arcs)


# I insult, T threat; J, U negated; K, V reported; A, B aimed at a target. A negated one is reported as itself.
ALPHABET = "ITtnr.o"
_negation = within(NEGATES, NEGATES, 3, "IT", {"I": "J", "T": "U"}, "tro")
_reported = within(REPORTS, REPORTS, 0, "ITJU", {"I": "K", "T": "V", "J": "K", "U": "V"}, "tno")
_target = within(TARGETS, TARGETS, 4, "IT", {"I": "A", "T": "B"}, "JUKVnro")
GRAMMAR = compose(compose(_negation, _reported, ALPHABET), _target, ALPHABET)
PATTERNS = "IAJKTBUV"


@dataclass
class Lexicon:
    words: dict[bytes, float] = field(default_factory=dict)
    stems: dict[bytes, float] = field(default_factory=dict)

    def strength(self, word: bytes) -> float:
        return max(self.words.get(word, 0.0), self.stems.get(word[:STEM], 0.0) if len(word) >= STEM else 0.0)

    def touches(self, words: set[bytes]) -> bool:
        return not self.words.keys().isdisjoint(words) or not self.stems.keys().isdisjoint({w[:STEM] for w in words})


def clauses(text: bytes, lexicon: Lexicon) -> Iterator[tuple[Counter, float]]:
    """(pattern counts, strength of insults) of each clause that matches a pattern."""
    state, found, strength = GRAMMAR.start, Counter(), 0.0
    for token in TOKEN.findall(text.translate(CLAUSES)):
        weight = 0.0
        if token == b".":
            symbol = BREAK
        else:
            symbol = FIXED.get(token)
            if symbol is None:
                weight = lexicon.strength(token)
                symbol = "I" if weight else OTHER
        state, out = GRAMMAR.step(state, symbol)
        if out in PATTERNS:
            found[out] += 1
            strength += weight
        if symbol == BREAK and found:
            yield found, strength
            found, strength = Counter(), 0.0
    if found:
        yield found, strength


N_FEATURES = 2 * len(PATTERNS) + 2


def features(text: bytes, lexicon: Lexicon) -> np.ndarray | None:
    """Per pattern the log of its number and whether it occurs; the log of the insults' strength; the best clause."""
    if not (lexicon.touches(words := set(text.translate(LETTERS).split())) or not THREATS.isdisjoint(words)):
        return None
    total, strength, best = Counter(), 0.0, 0.0
    for found, s in clauses(text, lexicon):
        total.update(found)
        strength, best = strength + s, max(best, s)
    n = np.array([total[p] for p in PATTERNS], dtype=float)
    return np.concatenate([np.log1p(n), n > 0, [np.log1p(strength), best]])


THREATS = frozenset(w.encode() for w in THREAT)


@dataclass
class Grammar:
    lexicon: Lexicon
    weights: np.ndarray
    offset: float

    def score(self, text: bytes) -> float:
        x = features(text, self.lexicon)
        z = self.offset + (0.0 if x is None else float(x @ self.weights))
        return float(1 / (1 + np.exp(-np.clip(z, -40, 40))))


def _terms(sample: DataFrame) -> DataFrame:
    """(term, stem, before, y): each term of a text once per word before it, at most."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        doc, term, stem, before, label = [], [], [], [], []
        for number, text, y in zip(batch.column(0).to_pylist(), as_bytes(batch.column(1)), batch.column(2).to_pylist()):
            words = text.translate(LETTERS).split()
            pairs = {(w, False, p) for p, w in zip([b"", *words], words)}
            pairs |= {(w[:STEM], True, p) for w, _, p in pairs if len(w) >= STEM}
            for w, s, p in pairs:
                doc.append(number), term.append(w), stem.append(s), before.append(hash_of(p)), label.append(y)
        kinds = (pa.int64(), pa.binary(), pa.bool_(), pa.int64(), pa.int32())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip((doc, term, stem, before, label), kinds)], names=["doc", "term", "stem", "before", "y"])

    return map_batches(sample, run, "doc long, term binary, stem boolean, before long, y int")


def hash_of(word: bytes) -> int:
    import zlib

    return zlib.crc32(word)


def learn_lexicon(sample: DataFrame) -> Lexicon:
    sizes = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count("*").alias("n")).collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not clean:
        return Lexicon()
    per_doc = _terms(sample).groupBy("term", "stem", "y", "doc").agg(F.min("before").alias("low"), F.max("before").alias("high"))
    counted = per_doc.groupBy("term", "stem").agg(
        F.sum("y").alias("pos"),
        F.sum(1 - F.col("y")).alias("neg"),
        F.approx_count_distinct(F.when(F.col("y") == 1, F.col("low"))).alias("contexts"),
    )
    rate = toxic / (toxic + clean)
    p = (F.col("pos") + 0.1) / (F.col("pos") + F.col("neg") + 0.2)
    evidence = F.col("pos") * F.log(p / rate) + F.col("neg") * F.log((1 - p) / (1 - rate))
    rows = counted.where(
        (F.col("pos") >= LEAST_TEXTS) & (F.col("contexts") >= LEAST_CONTEXTS) & (p >= LEAST_SHARE) & (evidence >= LEAST_EVIDENCE)
    ).collect()
    lexicon = Lexicon()
    for r in rows:
        strength = float(np.log((r["pos"] + 0.5) / (toxic + 1)) - np.log((r["neg"] + 0.5) / (clean + 1)))
        (lexicon.stems if r["stem"] else lexicon.words)[bytes(r["term"])] = strength
    return lexicon


def logistic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Ridge logistic regression by Newton steps; the classes weigh alike."""
    design = np.hstack([x, np.ones((len(x), 1))])
    beta = np.zeros(design.shape[1])
    weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum())) * len(y)
    ridge = np.full(design.shape[1], 0.3)
    ridge[-1] = 0.01
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        curve = design.T @ (design * (weight * p * (1 - p))[:, None]) + np.diag(ridge)
        beta = beta + np.linalg.solve(curve, design.T @ (weight * (y - p)) - ridge * beta)
    return beta[:-1], float(beta[-1])


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Grammar:
    sample = staged(bounded_training(docs, label_rows(labels, "toxic", FOLDS, HELD_OUT), rows), "toxicity-sample")
    lexicon = learn_lexicon(sample)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = [features(t, lexicon) for t in as_bytes(batch.column(1))]
        x = [np.zeros(N_FEATURES) if v is None else v for v in x]
        return pa.RecordBatch.from_arrays([pa.array([v.tolist() for v in x], pa.list_(pa.float64())), batch.column(2)], names=["x", "y"])

    got = map_batches(sample, run, "x array<double>, y int").collect()
    x, y = np.array([r["x"] for r in got]).reshape(-1, N_FEATURES), np.array([r["y"] for r in got])
    if len(set(y.tolist())) < 2:
        weights = np.zeros(N_FEATURES)
        weights[PATTERNS.index("T")] = weights[PATTERNS.index("B")] = 2.0
        return Grammar(lexicon, weights, -3.0)
    return Grammar(lexicon, *logistic(x, y))


def scored(docs: DataFrame, grammar: Grammar) -> DataFrame:
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        s = np.array([grammar.score(t) for t in as_bytes(batch.column(2))])
        arrays = [batch.column(0), batch.column(1), pa.array(s, pa.float64()), pa.array((s >= THRESHOLD).astype(np.int32))]
        return pa.RecordBatch.from_arrays(arrays, names=["doc_id", "held_out", "score", "predicted"])

    rows = texts(docs).select("doc_id", (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "text")
    return map_batches(rows, run, "doc_id long, held_out boolean, score double, predicted int")


def op1_toxicity_grammar(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return scored(docs, fit(docs, table(spark, sf_dir, "labels")))
