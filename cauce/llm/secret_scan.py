"""Secret scans: known patterns, and a battery of randomness tests.

Base spans come from three patterns. Candidates of the battery are runs of key
characters; each gets the encoding it fits (hex, HEX, base32, base62, base64,
base64url) and three statistics against that alphabet:

- chi-squared uniformity, as its equivalent, the number of coinciding symbols;
- runs: switches between lower case, upper case, digits and signs;
- serial correlation of neighbouring symbols' codes.

The battery is held against both sides. First, randomness itself: a candidate that
uniform random symbols would give with a chance under ``REJECT`` in any test is
no key. Then each statistic is tested one-sidedly against ordinary text, whose symbol, switch and
neighbour frequencies are counted over the whole corpus: the p-value is the
chance that ordinary text of that length looks so random. A secret has to pass
them all, so the candidate's p-value is the largest (an intersection-union
test, valid whatever their dependence); the serial test counts only at lengths
at which it can tell ordinary text from random symbols. Over all candidates of the corpus, false discoveries are held to ``level`` separately in
each class of lengths (Benjamini-Hochberg on a histogram of p-values of fixed
size), so that many short candidates do not pay for few long ones or the other
way round. Spans within a base span are not reported again.

The text is scanned once; what a later pass needs (spans and statistics) is a
narrow table. Null text is empty; an empty table gives no rows; null and
repeated ids are rows of their own.
"""

from __future__ import annotations

import hashlib
import math
import re
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cauce.llm.common import ship, stage

KINDS = ["assign", "access", "hex", "random"]
ASSIGN = re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
#: Every assign match holds one of these (lower-cased).
KEYS = ("password", "passwd", "secret", "token", "apikey", "api_key")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")

_LOW, _UP, _DIG = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
ENCODINGS = [("hex", _DIG + "abcdef"), ("HEX", _DIG + "ABCDEF"), ("base32", _UP + "234567"),
             ("base62", _DIG + _UP + _LOW), ("base64", _UP + _LOW + _DIG + "+/"), ("base64url", _UP + _LOW + _DIG + "-_")]
SYMBOLS = _DIG + _UP + _LOW + "+/-_"
_CODE = np.full(256, len(SYMBOLS), np.int64)  # the last code: no key character
for _i, _c in enumerate(SYMBOLS):
    _CODE[ord(_c)] = _i
_CLASS = np.array([0] * 10 + [1] * 26 + [2] * 26 + [3] * 4)
_ORDER = [np.array([SYMBOLS.index(c) for c in letters]) for _, letters in ENCODINGS]
N = len(SYMBOLS)

#: The serial test joins in from this many standard errors on.
POWER = 2.0
#: A candidate is no key if random symbols would fail a test so rarely.
REJECT = 0.001
#: Lower ends of the classes of lengths.
LENGTHS = np.array([16, 20, 24, 32, 48, 64])
#: Bins of -log10 p, each this wide.
BIN, BINS = 0.05, 1200


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the patterns' matches, sorted."""
    out = []
    low = text.lower()
    if any(k in low for k in KEYS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def encoding_of(token: str) -> int:
    """Index of the narrowest encoding that the token fits, -1 if it has only
    letters of one case, only digits or mixed sign sets."""
    body = token.rstrip("=")
    kinds = [any(c in s for c in body) for s in (_LOW, _UP, _DIG)]
    if sum(kinds) < 2:
        return -1
    own = set(body)
    for i, (_, letters) in enumerate(ENCODINGS):
        if own <= set(letters):
            return i
    return -1


def statistics(token: str, encoding: int) -> tuple[int, int, int, float]:
    """(length, coinciding pairs, class switches, serial correlation)."""
    raw = np.frombuffer(token.rstrip("=").encode(), np.uint8)
    code = _CODE[raw]
    counts = np.bincount(code)
    switches = int((_CLASS[code][1:] != _CLASS[code][:-1]).sum())
    place = np.zeros(N, np.float64)
    place[_ORDER[encoding]] = np.arange(len(_ORDER[encoding]))
    x = place[code] - place[code].mean()
    r = float((x[1:] * x[:-1]).sum() / max((x * x).sum(), 1e-12))
    return len(raw), int((counts * (counts - 1)).sum() // 2), switches, r


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple]:
    """(start, end, encoding, length, coincidences, switches, correlation)."""
    out = []
    for m in CANDIDATE.finditer(text):
        a, b = m.span()
        if any(s <= a and b <= e for s, _, e in base):
            continue
        e = encoding_of(m.group())
        if e >= 0:
            out.append((a, b, e, *statistics(m.group(), e)))
    return out


def pair_counts(texts: list[str]) -> np.ndarray:
    """Counts of neighbouring key characters, (N + 1) x (N + 1) flattened."""
    total = np.zeros((N + 1) ** 2, np.int64)
    for i in range(0, len(texts), 256):
        code = _CODE[np.frombuffer("\n".join(texts[i:i + 256]).encode("utf-8", "replace"), np.uint8)]
        total += np.bincount(code[:-1] * (N + 1) + code[1:], minlength=(N + 1) ** 2)
    return total


def _phi(z: float) -> float:
    return 0.5 * math.erfc(-z / math.sqrt(2))


def _binomial_tail(s: int, n: int, p: float) -> float:
    """P(Binomial(n, p) >= s)."""
    p = min(max(p, 1e-9), 1 - 1e-9)
    terms = [math.exp(math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)
                      + k * math.log(p) + (n - k) * math.log1p(-p)) for k in range(s, n + 1)]
    return min(1.0, math.fsum(terms))


def looks_random(encoding: int, n: int, coincide: int, switches: int, r: float) -> bool:
    """The battery with uniform random symbols as the hypothesis."""
    order = _ORDER[encoding]
    k, two = len(order), n * (n - 1) / 2
    sd = math.sqrt(two / k * (1 - 1 / k))
    same = (np.bincount(_CLASS[order]) / k) ** 2
    return (_phi((two / k - coincide + 0.5) / sd) >= REJECT
            and 1 - _binomial_tail(switches + 1, n - 1, 1 - float(same.sum())) >= REJECT
            and 2 * _phi(-abs(r + 1 / n) * math.sqrt(n)) >= REJECT)


@dataclass
class Ordinary:
    """What ordinary text looks like in each encoding: sum of squared and cubed
    symbol frequencies, rate of class switches, neighbour correlation."""
    s2: list[float] = field(default_factory=list)
    s3: list[float] = field(default_factory=list)
    switch: list[float] = field(default_factory=list)
    rho: list[float] = field(default_factory=list)

    @staticmethod
    def fit(pairs: np.ndarray) -> "Ordinary":
        full = pairs.reshape(N + 1, N + 1)[:N, :N].astype(np.float64)
        out = Ordinary()
        differ = _CLASS[:, None] != _CLASS[None, :]
        for order in _ORDER:
            own = full[np.ix_(order, order)] + 0.01  # a trace, so that an unseen symbol is possible
            q = own.sum(1) / own.sum()
            out.s2.append(float((q ** 2).sum()))
            out.s3.append(float((q ** 3).sum()))
            out.switch.append(float((own * differ[np.ix_(order, order)]).sum() / own.sum()))
            x = np.arange(len(order), dtype=np.float64)
            a, b = (own.sum(1) * x).sum() / own.sum(), (own.sum(0) * x).sum() / own.sum()
            cov = (own * np.outer(x - a, x - b)).sum() / own.sum()
            var = math.sqrt((own.sum(1) * (x - a) ** 2).sum() * (own.sum(0) * (x - b) ** 2).sum()) / own.sum()
            out.rho.append(float(cov / max(var, 1e-12)))
        return out

    def p_value(self, encoding: int, n: int, coincide: int, switches: int, r: float) -> float:
        if not looks_random(encoding, n, coincide, switches, r):
            return 1.0
        s2, s3 = self.s2[encoding], self.s3[encoding]
        two, three = n * (n - 1) / 2, n * (n - 1) * (n - 2) / 6
        sd = math.sqrt(max(two * s2 * (1 - s2) + 6 * three * (s3 - s2 * s2), 1e-9))
        uniform = _phi((coincide + 0.5 - two * s2) / sd)
        runs = _binomial_tail(switches, n - 1, self.switch[encoding])
        rho = self.rho[encoding]
        serial = _phi(math.copysign(1, rho) * (r - rho) * math.sqrt(n))  # small if moved from rho towards none
        tests = [uniform, runs]
        if abs(rho) * math.sqrt(n) >= POWER:
            tests.append(serial)
        return max(*tests, 1e-300)


def length_class(n: int) -> int:
    return int(np.searchsorted(LENGTHS, n, "right")) - 1


def bin_of(p: float) -> int:
    return min(int(-math.log10(max(p, 1e-300)) / BIN), BINS - 1)


def cutoffs(histogram: list[tuple[int, int, int]], level: float) -> list[int]:
    """Per class of lengths, the lowest bin that is a discovery (Benjamini-
    Hochberg with each bin's largest p-value), or BINS if none is."""
    out = []
    for c in range(len(LENGTHS)):
        counts = np.zeros(BINS)
        for cls, b, n in histogram:
            if cls == c:
                counts[b] += n
        at_least = counts[::-1].cumsum()[::-1]
        p = 10.0 ** (-BIN * np.arange(BINS))
        good = np.nonzero((at_least > 0) & (p * at_least[0] <= level * at_least))[0]
        out.append(int(good[0]) if len(good) else BINS)
    return out


@dataclass
class Scanner:
    """A fitted scan: ordinary text and the cut of each class of lengths."""
    ordinary: Ordinary
    cuts: list[int]

    def random_spans(self, found: list[tuple]) -> list[tuple[int, int, int]]:
        return [(a, 3, b) for a, b, e, n, c, s, r in found
                if bin_of(self.ordinary.p_value(e, n, c, s, r)) >= self.cuts[length_class(n)]]

    def spans(self, text: str | None) -> list[tuple[int, int, int]]:
        base = base_spans(text or "")
        return sorted(base + self.random_spans(candidates(text or "", base)))


_SPAN = pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())])
_CAND = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("encoding", pa.int32()), ("n", pa.int32()),
                   ("coincide", pa.int64()), ("switches", pa.int32()), ("r", pa.float64())])
_STAGED = ("doc_id long, base array<struct<start:int,kind:int,end:int>>, "
           "found array<struct<start:int,end:int,encoding:int,n:int,coincide:long,switches:int,r:double>>, "
           "pairs array<long>")


def scan(docs: DataFrame) -> DataFrame:
    """The one pass over the texts: a row per document with its base spans and
    candidates, and a row per batch (``pairs`` set) with its neighbour counts."""
    ship(docs.sparkSession)

    def task(batches):
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
            base = [base_spans(t) for t in texts]
            found = [candidates(t, b) for t, b in zip(texts, base)]
            pairs = [None] * len(ids) + [pair_counts(texts).tolist()]
            yield pa.RecordBatch.from_arrays([
                pa.array(ids + [None], pa.int64()),
                pa.array([[dict(zip(("start", "kind", "end"), s)) for s in b] for b in base] + [None], pa.list_(_SPAN)),
                pa.array([[dict(zip(_CAND.names, c)) for c in f] for f in found] + [None], pa.list_(_CAND)),
                pa.array(pairs, pa.list_(pa.int64()))], ["doc_id", "base", "found", "pairs"])

    return docs.select("doc_id", "text").mapInArrow(task, _STAGED)


def fit(scanned: DataFrame, level: float = 0.01) -> Scanner:
    """Ordinary text and cuts from a staged scan. The driver gets one array of
    fixed size and at most BINS x classes counts."""
    ship(scanned.sparkSession)
    summed = (scanned.where("pairs is not null").select(F.posexplode("pairs").alias("i", "n"))
              .groupBy("i").agg(F.sum("n").alias("n")).collect())  # (N + 1) ** 2 rows
    pairs = np.zeros((N + 1) ** 2, np.int64)
    for i, n in summed:
        pairs[i] = n
    ordinary = Ordinary.fit(pairs)

    def bins(batches):
        for batch in batches:
            rows = [c for found in batch.column(0).to_pylist() for c in found]
            cls = [length_class(c["n"]) for c in rows]
            at = [bin_of(ordinary.p_value(c["encoding"], c["n"], c["coincide"], c["switches"], c["r"])) for c in rows]
            yield pa.RecordBatch.from_arrays([pa.array(cls, pa.int32()), pa.array(at, pa.int32())], ["cls", "bin"])

    histogram = (scanned.where("size(found) > 0").select("found").mapInArrow(bins, "cls int, bin int")
                 .groupBy("cls", "bin").count().collect())  # at most BINS x classes rows
    return Scanner(ordinary, cutoffs([tuple(r) for r in histogram], level))


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def find_secrets(docs: DataFrame, level: float = 0.01) -> DataFrame:
    """Counts of base spans, their digest, and all spans per document."""
    scanned = stage(scan(docs))
    scanner = fit(scanned, level)

    def task(batches):
        for batch in batches:
            cols: list[list] = [[] for _ in range(6)]
            for doc_id, base, found in zip(*(c.to_pylist() for c in batch.columns)):
                base = [(s["start"], s["kind"], s["end"]) for s in base]
                more = scanner.random_spans([tuple(c.values()) for c in found])
                row = (doc_id, *(sum(k == i for _, k, _ in base) for i in range(3)),
                       hashlib.sha256(joined(base).encode()).hexdigest(), joined(sorted(base + more)))
                for col, v in zip(cols, row):
                    col.append(v)
            kinds = [pa.int64()] * 4 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                             ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return scanned.where("pairs is null").select("doc_id", "base", "found").mapInArrow(
        task, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def redact(docs: DataFrame, level: float = 0.01, mark: str = "[SECRET]") -> DataFrame:
    """The documents with every span replaced by ``mark``; n_chars follows."""
    scanner = fit(stage(scan(docs)), level)

    def clean(text: str | None) -> str | None:
        spans, at, out = scanner.spans(text), 0, []
        if not spans:
            return text
        for a, _, b in spans:
            if b > at:
                if a >= at:
                    out += [text[at:a], mark]
                at = b
        return "".join(out) + text[at:]

    @F.pandas_udf("string")
    def cleaned(texts: pd.Series) -> pd.Series:
        return texts.map(clean, na_action="ignore").astype(object)

    out = docs.withColumn("text", cleaned("text"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.length("text"))
                             .cast(docs.schema["n_chars"].dataType))
    return out
