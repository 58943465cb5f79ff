"""Language-model scores: a log-bilinear model trained by noise-contrastive estimation.

Words are seen as units: the ``HEAD`` most frequent words of the training texts, the end mark, and classes of all other words
(by length and last character). The representation of the next unit is a sum of linear maps of the two units before it; its
product with a unit's vector, plus a bias, is the unit's score. Scores are normalised exactly: the log-sum-exp of all units' scores is
subtracted, which one matrix product gives for all contexts. A word of a class is worth the
class's probability times its share in the class, (count + 1) / (tokens + words + 1), so that one unknown word per class has
its share, too.

Corpus counts are Spark aggregations over all training texts. Training is distributed and reads all of them: every block is
trained on in its task from the same start, and the parameters are averaged by tokens; ``ROUNDS`` such rounds follow each
other. Documents come as blocks of word codes, so that counts reach positions without a row per token.

Defined results: null and empty texts are the end mark alone; rows of the held-out fold are scored but never counted; with no
training text all counts are 0 and the model knows the end mark and the classes only.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import blocks_of, unpack_codes, with_words, word_rows
from .common import staged, table

FOLDS, HELD_OUT = 7, 2
HEAD = 512  # words with a unit of their own
WIDTH = 24  # dimensions of a unit
ROUNDS = 2
BATCH = 4096
TINY = 1e-250
NOISE = 64  # noise units per batch, shared by its tokens
RATE = 0.08
END = "\n"  # no word holds a line break
MARKS = b".,;:!?"
LENGTHS = 12
CLASSES = 2 * LENGTHS


def split(text: bytes) -> list[bytes]:
    return [*text.lower().split(), END.encode()]


def class_of(word: bytes) -> int:
    return 2 * (min(max(len(word), 1), LENGTHS) - 1) + (word[-1:] in MARKS if word else 0)


def class_column(word):
    """``class_of`` as a column."""
    return 2 * (F.least(F.greatest(F.octet_length(word), F.lit(1)), F.lit(LENGTHS)) - 1) + F.substring(word, -1, 1).isin(*map(chr, MARKS)).cast("int")


class Units:
    """Numbers of units: head words first, then classes; one more number stands for what precedes a text."""

    def __init__(self, head: list[str]):
        self.head = {w: i for i, w in enumerate(head)}
        self.n = len(head) + CLASSES
        self.start = self.n

    def of(self, words: pa.StringArray) -> np.ndarray:
        found = pc.index_in(words, value_set=pa.array(list(self.head), pa.string()))
        sizes = pc.binary_length(words).to_numpy().astype(np.int64)
        _, offsets, data = words.buffers()
        ends = np.frombuffer(offsets, np.int32)[words.offset + 1 : words.offset + 1 + len(words)]
        last = np.frombuffer(data or b"", np.uint8)[ends[sizes > 0] - 1]
        marked = np.zeros(len(words), bool)
        marked[sizes > 0] = np.isin(last, np.frombuffer(MARKS, np.uint8))
        classes = 2 * (np.clip(sizes, 1, LENGTHS) - 1) + marked
        return np.where(found.is_null().to_numpy(zero_copy_only=False), len(self.head) + classes, pc.fill_null(found, 0).to_numpy()).astype(np.int64)


def contexts(units: np.ndarray, sizes: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray]:
    """The unit before and the one before that, of every position; texts do not see each other."""
    first = np.cumsum(sizes) - sizes
    one, two = np.roll(units, 1), np.roll(units, 2)
    one[first], two[first] = start, start
    second = first[sizes > 1] + 1
    two[second] = start
    return one, two


class Model:
    """Context vectors (units + 1), maps of the two context places, output vectors and biases."""

    SHAPES = ("context", "near", "far", "output", "bias")

    def __init__(self, **parts: np.ndarray):
        self.__dict__.update(parts)

    @classmethod
    def initial(cls, counts: np.ndarray) -> Model:
        n, random = len(counts), np.random.default_rng(7)
        share = (counts + 1) / (counts + 1).sum()
        vectors = lambda k: random.normal(0, 0.1, (k, WIDTH)).astype(np.float32)
        eye = np.eye(WIDTH, dtype=np.float32)
        return cls(context=vectors(n + 1), near=eye.copy(), far=0.5 * eye, output=vectors(n), bias=np.log(share).astype(np.float32))

    def flat(self) -> np.ndarray:
        return np.concatenate([getattr(self, k).ravel() for k in self.SHAPES]).astype(np.float64)

    def like(self, flat: np.ndarray) -> Model:
        parts, at = {}, 0
        for k in self.SHAPES:
            old = getattr(self, k)
            parts[k] = flat[at : at + old.size].reshape(old.shape).astype(np.float32)
            at += old.size
        return Model(**parts)

    def log_probabilities(self, one: np.ndarray, two: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Natural log of the normalised probability of each target, looked up by each pair of its three units."""
        near, far, total = self.tables
        n = len(self.bias)
        return near.take(one * n + target) + far.take(two * n + target) - total.take(one * (n + 1) + two)

    @functools.cached_property
    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """What the near and the far unit add to each unit's score, and the log-sum-exp of each context's scores. A score is a sum
        over the two places, so the sum of its exponential over units is a product of two matrices."""
        parts = {k: getattr(self, k).astype(np.float64) for k in self.SHAPES}
        near = parts["context"] @ parts["near"] @ parts["output"].T + parts["bias"]
        far = parts["context"] @ parts["far"] @ parts["output"].T
        top_near, top_far = near.max(axis=1, keepdims=True), far.max(axis=1, keepdims=True)
        sums = np.exp(near - top_near) @ np.exp(far - top_far).T
        total = np.log(np.maximum(sums, TINY)) + top_near + top_far.T
        for i, j in np.argwhere(sums < TINY):  # the places' best units are so far apart that products vanish
            total[i, j] = np.logaddexp.reduce(near[i] + far[j])
        return near, far, total

    def train(self, one: np.ndarray, two: np.ndarray, target: np.ndarray, counts: np.ndarray, seed: int) -> Model:
        """One pass of noise-contrastive estimation in shuffled batches, with AdaGrad steps."""
        random = np.random.default_rng(seed)
        noise_share = (counts + 1) / (counts + 1).sum()
        log_noise = np.log(NOISE * noise_share).astype(np.float32)
        now = {k: getattr(self, k).copy() for k in self.SHAPES}
        seen = {k: np.full_like(v, 1e-2) for k, v in now.items()}

        def step(name: str, gradient: np.ndarray) -> None:
            seen[name] += gradient * gradient
            now[name] += RATE * gradient / np.sqrt(seen[name])

        def scattered(index: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
            flat = (index[:, None] * WIDTH + places).ravel()
            return np.bincount(flat, rows.ravel(), k * WIDTH).reshape(k, WIDTH).astype(np.float32)

        n, places = len(counts), np.arange(WIDTH)
        order = random.permutation(len(target))
        for low in range(0, len(order), BATCH):
            at = order[low : low + BATCH]
            a, b, t = one[at], two[at], target[at]
            noise = random.choice(n, NOISE, p=noise_share)
            context, output = now["context"], now["output"]
            r = (context @ now["near"]).take(a, axis=0)
            r += (context @ now["far"]).take(b, axis=0)
            own, other, excess = output.take(t, axis=0), output[noise], now["bias"] - log_noise
            true = np.einsum("ij,ij->i", r, own) + excess[t]
            up = (1 / (1 + np.exp(np.clip(true, -30, 30)))) / len(at)
            down = r @ other.T
            down += excess[noise]
            down *= 0.5  # the logistic function by tanh, in place
            np.tanh(down, out=down)
            down += 1
            down *= np.float32(-0.5 / len(at))
            dr = down @ other
            own *= up[:, None]
            dr += own
            by_noise = np.zeros((n, WIDTH), np.float32)
            np.add.at(by_noise, noise, down.T @ r)
            r *= up[:, None]
            d_output = scattered(t, r, n) + by_noise
            d_bias = (np.bincount(t, up, n) + np.bincount(noise, np.ones(len(at), np.float32) @ down, n)).astype(np.float32)
            to_near, to_far = scattered(a, dr, n + 1), scattered(b, dr, n + 1)  # summed by unit, then mapped: both are linear
            d_near, d_far, d_context = context.T @ to_near, context.T @ to_far, to_near @ now["near"].T + to_far @ now["far"].T
            step("near", d_near)
            step("far", d_far)
            step("output", d_output)
            step("bias", d_bias)
            step("context", d_context)
        return Model(**now)


class Corpus:
    """Blocks, word counts of the training texts, and what the model needs of them."""

    def __init__(self, docs: DataFrame):
        self.blocks = blocks_of(docs, split, FOLDS, HELD_OUT)
        self.words = word_rows(self.blocks)
        self.counts = staged(self.words.groupBy("word").agg(F.sum("uses").alias("c")).where("c > 0"), "word-counts")
        spark = docs.sparkSession
        head = self.counts.orderBy(F.desc("c"), "word").limit(HEAD).collect()
        names = [r["word"] for r in head]
        self.units = Units(names if END in names else [*names[: HEAD - 1], END])
        chosen = spark.createDataFrame([(w,) for w in self.units.head], "word string")
        by_class = self.counts.join(F.broadcast(chosen), "word", "left_anti").groupBy(class_column(F.col("word")).alias("k"))
        self.class_tokens, self.class_words = np.zeros(CLASSES), np.zeros(CLASSES)
        for r in by_class.agg(F.sum("c").alias("c"), F.count("*").alias("v")).collect():
            self.class_tokens[r["k"]], self.class_words[r["k"]] = r["c"], r["v"]
        total = self.counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
        self.tokens, self.distinct = int(total["n"]), int(total["v"])
        known = {r["word"]: r["c"] for r in head}
        self.unit_counts = np.concatenate([[known.get(w, 0) for w in self.units.head], self.class_tokens])


def fit(corpus: Corpus, rounds: int = ROUNDS) -> Model:
    """Rounds of training every block from the common start and averaging by tokens."""
    model, units, counts = Model.initial(corpus.unit_counts), corpus.units, corpus.unit_counts
    size = len(model.flat())

    for number in range(rounds):

        def run(batches: Iterator[pa.RecordBatch], start: Model = model, number: int = number) -> Iterator[pa.RecordBatch]:
            total, weight = np.zeros(size), 0
            for batch in batches:
                for k, block in enumerate(batch.drop_columns("words").to_pylist()):
                    unit = units.of(batch.column("words")[k].values)[unpack_codes(block["codes"])]
                    sizes = np.array(block["sizes"], dtype=np.int64)
                    one, two = contexts(unit, sizes, units.start)
                    use = np.repeat(~np.array(block["held_out"]), sizes)
                    n = int(use.sum())
                    if n:
                        trained = start.train(one[use], two[use], unit[use], counts, number * 1_000_003 + block["block"])
                        total, weight = total + n * trained.flat(), weight + n
            if weight:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(size)), pa.array(total), pa.array(np.full(size, float(weight)))], names=["at", "total", "weight"]
                )

        parts = corpus.blocks.select("block", "held_out", "sizes", "codes", "words").mapInArrow(run, "at long, total double, weight double")
        mean = parts.groupBy("at").agg((F.sum("total") / F.sum("weight")).alias("value")).toPandas()
        if len(mean) == size:
            flat = np.zeros(size)
            flat[mean["at"].to_numpy()] = mean["value"].to_numpy()
            model = model.like(flat)
    return model


SCORED = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
)


def scored(corpus: Corpus, model: Model) -> DataFrame:
    units, tokens, distinct = corpus.units, corpus.tokens, corpus.distinct
    class_tokens, class_words = corpus.class_tokens, corpus.class_words
    base_total = np.log10(tokens + distinct + 1)

    def run(block: dict, facts: pa.Table) -> pa.Table:
        codes, facts = unpack_codes(block["codes"]), facts.sort_by("code")
        words = pa.concat_arrays(facts.column("word").chunks)
        c = facts.column("c").to_numpy().astype(np.float64)
        unit = units.of(words)
        k = np.maximum(unit - len(units.head), 0)
        share = np.where(unit < len(units.head), 0.0, np.log10((c + 1) / (class_tokens[k] + class_words[k] + 1)))
        sizes = np.array(block["sizes"], dtype=np.int64)
        at = unit[codes]
        model_log = model.log_probabilities(*contexts(at, sizes, units.start), at) / np.log(10) + share[codes]
        first = np.cumsum(sizes) - sizes
        base = np.add.reduceat((np.log10(c + 1) - base_total)[codes], first)
        known = np.add.reduceat((c > 0)[codes].astype(np.int64), first)
        return pa.table(
            {
                "doc_id": pa.array(block["doc_ids"], pa.int64()),
                "held_out": pa.array(block["held_out"], pa.bool_()),
                "n_tokens": sizes,
                "n_known": known,
                "train_tokens": np.full(len(sizes), tokens),
                "base_score": base,
                "score": np.add.reduceat(model_log, first),
            }
        )

    counted = corpus.words.join(corpus.counts, "word", "left").select("home", "code", "word", F.coalesce("c", F.lit(0)).alias("c"))
    return with_words(corpus.blocks, counted, run, SCORED)


def op9_log_bilinear(spark, sf_dir: str) -> DataFrame:
    corpus = Corpus(table(spark, sf_dir, "documents"))
    return scored(corpus, fit(corpus))
