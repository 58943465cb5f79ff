"""Quality rules as a short-circuit cascade.

Each rule needs some measures of a text. On a bounded sample every rule's cost (seconds to compute the measures that it
needs) and its selectivity (share of rejected texts) are estimated; rules then run in the order of rejections per second,
and a text that one rule rejects is not measured further. The order changes the time only, never the verdict.

Defined results: null and empty texts have no words, fail the base rule and are rejected; equal rows get equal verdicts;
an empty table gives an empty result; further columns of the documents pass through the filter untouched.
"""

from __future__ import annotations

import time
from collections import Counter
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import PIECE, SPACE, as_bytes, map_batches, texts

UPPER = bytes(range(65, 91))
LOWER = bytes(range(97, 123))
SYMBOLS = b"#*$%&|<>"

SAMPLE_ROWS = 256  # rows on which cost and selectivity are estimated
SAMPLE_TEXT_BYTES = 1 << 16  # longer texts are left out of that estimate, so that the sample stays below 16 MiB


class Measures:
    """Measures of one text, each computed when first asked for."""

    def __init__(self, data: bytes):
        self.data = data

    def __getattr__(self, name: str):
        value = getattr(self, "_" + name)()
        setattr(self, name, value)
        return value

    def _words(self) -> list[bytes]:
        return self.data.split()

    def _n_words(self) -> int:
        return len(self.words)

    def _word_chars(self) -> int:
        # code points are the bytes that do not continue one
        return len(self.data.translate(None, SPACE + bytes(range(0x80, 0xC0))))

    def _n_symbols(self) -> int:
        return sum(self.data.count(c) for c in SYMBOLS)

    def _n_exclaims(self) -> int:
        return self.data.count(b"!")

    def _n_upper(self) -> int:
        return len(self.data) - len(self.data.translate(None, UPPER))

    def _n_lower(self) -> int:
        return len(self.data) - len(self.data.translate(None, LOWER))

    def _lines(self) -> list[bytes]:
        return [line for line in self.data.split(b"\n") if not line.isspace() and line]

    def _n_lines(self) -> int:
        return len(self.lines)

    def _n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    def _n_repeat_words(self) -> int:
        words = self.words
        windows = list(zip(words, words[1:], words[2:]))
        if len(set(windows)) == len(windows):
            return 0
        seen = Counter(windows)
        covered = bytearray(len(words))
        for i, window in enumerate(windows):
            if seen[window] > 1:
                covered[i : i + 3] = b"\1\1\1"
        return sum(covered)

    def _n_adjacent(self) -> int:
        return sum(map(bytes.__eq__, self.words, self.words[1:]))


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Measures], bool]


# The rules, all in whole numbers so that SQL gives the same verdicts.
BASE = Rule("base", lambda m: m.n_words < 50 or 100 * m.n_repeat_words > 50 * m.n_words)
RULES = (
    BASE,
    Rule("symbols", lambda m: 100 * m.n_symbols > 5 * m.word_chars),
    Rule("shouting", lambda m: m.n_upper > m.n_lower and m.n_exclaims * 4 > m.n_words),
    Rule("duplicate_lines", lambda m: 2 * m.n_dup_lines > m.n_lines),
    Rule("adjacent_repeats", lambda m: 4 * m.n_adjacent > m.n_words),
    Rule("word_length", lambda m: m.word_chars > 20 * m.n_words or m.word_chars < 2 * m.n_words),
)


@dataclass(frozen=True)
class Estimate:
    rule: Rule
    seconds: float
    rejected: float

    @property
    def rank(self) -> float:
        return self.rejected / max(self.seconds, 1e-9)


def estimate(docs: DataFrame, rules: Sequence[Rule] = RULES, rows: int = SAMPLE_ROWS) -> list[Estimate]:
    """Cost and selectivity of each rule, measured alone on at most ``rows`` short texts."""
    sample = texts(docs).where(F.octet_length("text") <= SAMPLE_TEXT_BYTES).select("text").limit(rows).toArrow()
    data = as_bytes(sample.column("text").combine_chunks())
    found = []
    for rule in rules:
        start = time.perf_counter()
        rejected = sum(rule.rejects(Measures(x)) for x in data)
        n = max(1, len(data))
        found.append(Estimate(rule, (time.perf_counter() - start) / n, rejected / n))
    return found


def cascade_order(docs: DataFrame, rules: Sequence[Rule] = RULES, rows: int = SAMPLE_ROWS) -> list[Rule]:
    """Rules by rejections per second, best first."""
    return [e.rule for e in sorted(estimate(docs, rules, rows), key=lambda e: -e.rank)]


def rejected_by(order: Sequence[Rule], measures: Measures) -> str | None:
    """Name of the first rule that rejects; later rules are not computed."""
    return next((rule.name for rule in order if rule.rejects(measures)), None)


def keep_good(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """The documents that no rule rejects, with all their columns."""
    order = cascade_order(docs, rules)

    def keep(batch: pa.RecordBatch) -> pa.RecordBatch:
        data = as_bytes(batch.column(batch.schema.get_field_index("text")))
        return batch.filter(pa.array([rejected_by(order, Measures(x)) is None for x in data], pa.bool_()))

    return map_batches(docs, keep, docs.schema, PIECE)


MEASURED = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean"
)


def measured(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Measures and verdict of every document. The base rule is shown by itself; the others follow in cascade order."""
    later = [rule for rule in cascade_order(docs, rules) if rule is not BASE]

    def measure(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for data in as_bytes(batch.column(1)):
            m = Measures(data)
            failed = BASE.rejects(m)
            kept = not failed and rejected_by(later, m) is None
            rows.append((m.n_words, m.word_chars, m.n_symbols, m.n_dup_lines, m.n_repeat_words, failed, kept))
        names = [part.split()[0] for part in MEASURED.split(", ")[1:]]
        columns = list(zip(*rows)) or [()] * len(names)
        kinds = [pa.int64()] * 5 + [pa.bool_()] * 2
        arrays = [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))]
        return pa.RecordBatch.from_arrays(arrays, names=["doc_id", *names])

    return map_batches(texts(docs), measure, MEASURED)


def op10_quality_rules(spark, sf_dir: str) -> DataFrame:
    from .common import table

    return measured(table(spark, sf_dir, "documents"))


WORDS = r"regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+')"
SQL = rf"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
listed AS (SELECT rid, list_filter({WORDS}, lambda x: x <> '') AS w, string_split(text, chr(10)) AS l FROM docs),
words AS (SELECT rid, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM listed),
windows AS (
  SELECT rid, pos, word, lead(word) OVER o AS w2, lead(word, 2) OVER o AS w3 FROM words
  WINDOW o AS (PARTITION BY rid ORDER BY pos)
),
repeats AS (SELECT *, w3 IS NOT NULL AND count(*) OVER (PARTITION BY rid, word, w2, w3) > 1 AS again FROM windows),
covered AS (
  SELECT rid, word, w2, again OR coalesce(lag(again) OVER o, false) OR coalesce(lag(again, 2) OVER o, false) AS hit
  FROM repeats WINDOW o AS (PARTITION BY rid ORDER BY pos)
),
by_word AS (
  SELECT rid, count(*) FILTER (hit) AS n_repeat_words, count(*) FILTER (word = w2) AS n_adjacent FROM covered GROUP BY rid
),
lines AS (SELECT rid, unnest(l) AS line FROM listed),
by_line AS (
  SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines FROM lines
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid
),
m AS (
  SELECT d.doc_id, len(listed.w) AS n_words,
    length(regexp_replace(d.text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
    length(d.text) - length(regexp_replace(d.text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    length(d.text) - length(replace(d.text, '!', '')) AS n_exclaims,
    length(d.text) - length(regexp_replace(d.text, '[A-Z]', '', 'g')) AS n_upper,
    length(d.text) - length(regexp_replace(d.text, '[a-z]', '', 'g')) AS n_lower,
    coalesce(b.n_repeat_words, 0) AS n_repeat_words, coalesce(b.n_adjacent, 0) AS n_adjacent,
    coalesce(k.n_lines, 0) AS n_lines, coalesce(k.n_dup_lines, 0) AS n_dup_lines
  FROM docs d JOIN listed USING (rid) LEFT JOIN by_word b USING (rid) LEFT JOIN by_line k USING (rid)
),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
  NOT (base_failed OR 100 * n_symbols > 5 * word_chars OR (n_upper > n_lower AND n_exclaims * 4 > n_words)
    OR 2 * n_dup_lines > n_lines OR 4 * n_adjacent > n_words OR word_chars > 20 * n_words OR word_chars < 2 * n_words) AS kept
FROM judged
"""
