"""Secret scans with multipart credential linking.

Three base kinds are found by pattern in every whole text. Beside them, parts of a credential are collected that say little
alone: identifiers (client_id = ..., account: ..., access keys), endpoints (URLs of any scheme, host:port) and weak secrets (long
mixed tokens without a keyword, also as the user or password of a URL). A host is a dotted name, an IPv4 or bracketed IPv6
address, or a bare name that is no keyword of a credential; a port is 1 to 65535. An interval join in Spark links, inside a scope, a secret with identifiers and endpoints: parts of
the same text whose gap is at most ``SCOPE`` characters and between which no blank line lies. A weak secret is reported only
if such a complement exists; identifiers and endpoints only if they stand by a secret, base ones included.

The join is keyed by document and stretch of ``SCOPE`` characters. A secret is entered in all stretches that it touches, its
complements in all that they touch when widened by ``SCOPE``, and a pair counts in the first stretch that both have. So a text
of any length is spread over stretches, and a stretch holds a bounded number of parts. Offsets are code points, ends
exclusive. Defined results: null and empty texts have no spans; equal rows get equal spans; null ids are scanned like others.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import PIECE, as_texts, map_batches, staged, table, texts

# The patterns of the base kinds, and those of the parts.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
IDENTIFIER = re.compile(r"""(?:client|account|tenant|user|key|app)_?(?:id|name)["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.@-]{3,}""", re.IGNORECASE | re.ASCII)
URL = re.compile(r"[A-Za-z][A-Za-z0-9+.-]{0,30}://[^\s\"'<>]+")
PORT = re.compile(r":([0-9]{1,5})(?![0-9A-Za-z_:]|\.[0-9])", re.ASCII)
HOST = re.compile(r"(?:(?<![A-Za-z0-9._-])[A-Za-z0-9](?:[A-Za-z0-9.-]*[A-Za-z0-9])?|\[[0-9A-Fa-f:.]+\])$")
NO_HOST = re.compile(r"[0-9.-]*|.*(?:password|passwd|secret|token|key|id|name)", re.IGNORECASE)
IPV4 = re.compile(r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}")
WEAK = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{20,}={0,2}")
KINDS = ("assign", "access", "hex", "weak", "identifier", "endpoint")

ASSIGN_MIN, ACCESS_MIN = 8, 16
SCOPE = 400
WEAK_BITS = 3.5  # least entropy per character of a weak secret

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    found = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_MIN]
    found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_MIN]
    found += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return in_order(found)


def in_order(spans) -> list[Span]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def listed(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def _entropy(token: str) -> float:
    n = len(token)
    return -sum(c / n * math.log2(c / n) for c in Counter(token).values())


def _is_weak(token: str) -> bool:
    kinds = (any(c.isdigit() for c in token), any(c.islower() for c in token) + any(c.isupper() for c in token) > 0)
    return all(kinds) and _entropy(token) >= WEAK_BITS


def endpoints(text: str) -> list[Span]:
    """URLs, and host:port outside them."""
    ends = [("endpoint", m.start(), m.end()) for m in URL.finditer(text)] if "://" in text else []
    at, urls = 0, len(ends)
    for m in PORT.finditer(text):
        while at < urls and ends[at][2] <= m.start():
            at += 1
        host = HOST.search(text, max(0, m.start() - 255), m.start())
        if not host or not 0 < int(m[1]) <= 65535 or at < urls and ends[at][1] <= m.start():
            continue
        if IPV4.fullmatch(host[0]) or not NO_HOST.fullmatch(host[0]):
            ends.append(("endpoint", host.start(), m.end()))
    return ends


def _user_part(text: str, a: int, b: int) -> int:
    """Where the user and password of the URL end, or its start if it has none."""
    low = text.find("://", a, b) + 3
    high = re.compile(r"[/?#]").search(text, low, b)
    at = text.rfind("@", low, high.start() if high else b) if low > 2 else -1
    return a if at < 0 else at


def parts(text: str, base: list[Span]) -> list[Span]:
    """Candidate parts outside the base spans; only texts with a secret of either kind give any."""
    covered = [(a, b) for _, a, b in base]
    clear = lambda m: all(m.end() <= a or b <= m.start() for a, b in covered)
    tokens = [m for m in WEAK.finditer(text) if _is_weak(m[0]) and clear(m)]
    if not tokens and not base:
        return []
    ends = [e for e in endpoints(text) if text.find("://", e[1], e[2]) >= 0 or all(e[2] <= a or b <= e[1] for a, b in covered)]
    shown = [(_user_part(text, a, b), b) for _, a, b in ends]
    inside = lambda m: any(a <= m.start() < b for a, b in shown)
    weak = [("weak", m.start(), m.end()) for m in tokens if not inside(m)]
    if not weak and not base:
        return []
    return weak + ends + [("identifier", m.start(), m.end()) for m in IDENTIFIER.finditer(text) if clear(m)]


SPANS = "array<struct<kind:string,start:long,stop:long>>"
FOUND = f"doc_id long, digest long, base {SPANS}, parts array<struct<kind:string,start:long,stop:long,scope:long>>"
SPAN_TYPE = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64())])
PART_TYPE = pa.struct([*SPAN_TYPE, ("scope", pa.int64())])


def _scopes(text: str, spans: list[Span]) -> list[dict]:
    """Spans with the number of blank lines before them: parts on both sides of a blank line are never linked."""
    breaks = [m.start() for m in re.finditer(r"\n[\x20\t\r]*\n", text)] if spans else []
    return [{"kind": k, "start": a, "stop": b, "scope": sum(x < a for x in breaks)} for k, a, b in spans]


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: its base spans and its candidate parts (base spans among them, as they can be complements)."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        base, candidates = [], []
        for text in as_texts(batch.column(2)):
            b = base_spans(text)
            p = parts(text, b)
            base.append([{"kind": k, "start": x, "stop": y} for k, x, y in b])
            candidates.append(_scopes(text, b + p) if p else [])
        arrays = [batch.column(0), batch.column(1), pa.array(base, pa.list_(SPAN_TYPE)), pa.array(candidates, pa.list_(PART_TYPE))]
        return pa.RecordBatch.from_arrays(arrays, names=["doc_id", "digest", "base", "parts"])

    return map_batches(texts(docs).select("doc_id", F.xxhash64("text").alias("digest"), "text"), run, FOUND)


def linked(found: DataFrame) -> DataFrame:
    """(doc_id, digest, added): per document the weak secrets, identifiers and endpoints that complement each other."""
    part = found.select("doc_id", "digest", F.explode("parts").alias("p")).select("doc_id", "digest", "p.*").distinct()
    stretches = lambda low, high: F.sequence(F.floor(low / SCOPE), F.floor(high / SCOPE))
    is_secret = F.col("kind").isin("assign", "hex", "weak")
    is_other = F.col("kind").isin("access", "identifier", "endpoint")
    secret = part.where(is_secret).withColumn("met", stretches(F.col("start"), F.col("stop")))
    secret = secret.select(*(F.col(c).alias(f"s_{c}") for c in part.columns), F.col("met")[0].alias("s_first"), F.explode("met").alias("s_stretch"))
    other = part.where(is_other).withColumn("met", stretches(F.col("start") - SCOPE, F.col("stop") + SCOPE))
    other = other.select(*part.columns, F.col("met")[0].alias("first"), F.explode("met").alias("stretch"))
    pairs = secret.join(
        other,
        F.col("s_doc_id").eqNullSafe(F.col("doc_id"))
        & (F.col("s_digest") == F.col("digest"))
        & (F.col("s_scope") == F.col("scope"))
        & (F.col("s_stretch") == F.col("stretch"))
        & (F.col("stretch") == F.greatest("first", "s_first"))
        & (F.col("start") - F.col("s_stop") <= SCOPE)
        & (F.col("s_start") - F.col("stop") <= SCOPE),
    )
    sides = pairs.select("doc_id", "digest", F.explode(F.array(F.struct(F.col("s_kind").alias("kind"), F.col("s_start").alias("start"), F.col("s_stop").alias("stop")), F.struct("kind", "start", "stop"))).alias("span"))
    added = sides.where(F.col("span.kind").isin("weak", "identifier", "endpoint")).distinct()
    return added.groupBy("doc_id", "digest").agg(F.collect_list("span").alias("added"))


def _joined(left: DataFrame, added: DataFrame) -> DataFrame:
    named = added.select(F.col("doc_id").alias("a_doc_id"), F.col("digest").alias("a_digest"), "added")
    same = F.col("doc_id").eqNullSafe(F.col("a_doc_id")) & (F.col("digest") == F.col("a_digest"))
    return left.join(named, same, "left").drop("a_doc_id", "a_digest")


def spans(docs: DataFrame) -> DataFrame:
    """doc_id, base and all spans of every document."""
    found = staged(scan(docs), "secret-parts")
    added = staged(linked(found), "secret-links")
    return _joined(found.select("doc_id", "digest", "base"), added).select("doc_id", "base", F.coalesce("added", F.array().cast(SPANS)).alias("added"))


def report(docs: DataFrame) -> DataFrame:
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for base, added in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            b = in_order((s["kind"], s["start"], s["stop"]) for s in base)
            n = Counter(k for k, _, _ in b)
            whole = in_order(b + [(s["kind"], s["start"], s["stop"]) for s in added])
            rows.append((n["assign"], n["access"], n["hex"], hashlib.sha256(listed(b).encode()).hexdigest(), listed(whole)))
        columns = list(zip(*rows)) or [()] * 5
        kinds = [pa.int64()] * 3 + [pa.string()] * 2
        names = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
        return pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))], names=names)

    return map_batches(spans(docs), run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """The documents with secrets blotted out (of an assignment its value) and n_chars, where it is a column, counted anew
    for changed texts. All rows and columns stay; endpoints and identifiers stay readable. The links are a written table, so
    that Spark broadcasts it only below the broadcast threshold."""
    added = staged(linked(staged(scan(docs).where("size(parts) > 0"), "secret-parts")), "secret-links")
    # the documents' own columns travel in one, so that their names meet no others
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("own")
    keyed = docs.select(own, F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("digest"))
    names, at_text = docs.columns, docs.columns.index("text")
    at_count = names.index("n_chars") if "n_chars" in names else None

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        arrays = batch.column(0).flatten()
        old = arrays[at_text].to_pylist()
        new = [None if t is None else blot(t, more or [], mark) for t, more in zip(old, batch.column(1).to_pylist())]
        arrays[at_text] = pa.array(new, pa.string())
        if at_count is not None:
            counts = arrays[at_count]
            arrays[at_count] = pa.array([k if a == b else len(b) for a, b, k in zip(old, new, counts.to_pylist())], counts.type)
        return pa.RecordBatch.from_arrays(arrays, names=names)

    return map_batches(_joined(keyed, added).select("own", "added"), run, docs.schema, PIECE)


def blot(text: str, added: list[dict], mark: str) -> str:
    cuts = [(m.start(2), m.end(2)) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_MIN]
    cuts += [(a, b) for k, a, b in base_spans(text) if k != "assign"]
    cuts += [(s["start"], s["stop"]) for s in added if s["kind"] == "weak"]
    out, done = [], 0
    for a, b in sorted(cuts):
        if a >= done:
            out += [text[done:a], mark]
        done = max(done, b)
    return "".join([*out, text[done:]])


def op7_secret_scan(spark, sf_dir: str) -> DataFrame:
    return report(table(spark, sf_dir, "documents"))
