"""Language identification by string kernels.

The blended-spectrum presence kernel of two texts counts the n-grams of letters
(n = 1 .. ``LONGEST``, words apart by one blank) that both contain, whatever
their positions and numbers, over the geometric mean of the texts' own counts.
Presence is a row of 0 and 1 over hashed n-grams, so the kernel of a batch of
texts with all landmarks is one matrix product.

Nystroem: some texts of the training sample are landmarks; kernel ridge
regression is solved in the span of their kernel functions, one-versus-rest for
every language (least squares of +1 and -1 with the kernel norm as penalty).
Scoring a batch is two matrix products, presence with landmarks and kernel with
weights. The language of the largest value is predicted; the score is its share
in a softmax of all values.

The sample is bounded: ``FIT_ROWS`` texts in all, as many of each language, by a
hash of the id (one count a language, then a filter on the hash); a text
travels to the driver as the bits of its presence row, 1 KB, never as text. All
texts, of any length, are read whole, in pieces.

Defined results: null texts and texts without a letter are ``und`` with score 0;
rows of null lang and of null id aren't learned from, a null id is not held out;
repeated rows count each; ties go to the smaller language name; without any
training text all texts are ``und``; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cauce.llm.common import ship

LONGEST = 3
#: Hashed n-grams of a presence row.
WIDTH = 1 << 13
#: Bounds of the fit: texts of the sample, and landmarks among them.
FIT_ROWS = 4096
LANDMARKS = 128
RIDGE = 1e-4
#: Weight of the values in the softmax that gives the score.
SHARPNESS = 4.0
#: Texts that are scored at once; characters of a text that are worked off at once.
BATCH = 256
PIECE = 1 << 18
NO_LANGUAGE = "und"

_LETTER = re.compile(r"[^\W\d_]")
_MIX = np.uint32(0x9E3779B1)  # the golden ratio's odd 32-bit multiplier


@lru_cache(maxsize=1)
def _folded() -> np.ndarray:
    """For each character of the basic plane: its lower-case letter, or a blank."""
    out = np.full(1 << 16, 32, np.uint32)
    for c in range(1 << 16):
        x = chr(c)
        if x.isalpha():
            low = x.lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


def _letters(text: str) -> np.ndarray:
    """Lower-case letters as code points, everything else one blank between words."""
    codes = np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")
    low = _folded()[np.minimum(codes, 0xFFFF)]
    for at in np.nonzero(codes > 0xFFFF)[0]:
        x = chr(codes[at])
        low[at] = codes[at] if x.isalpha() else 32
    return low[~((low == 32) & np.r_[False, low[:-1] == 32])]


def presence(text: str | None, out: np.ndarray) -> bool:
    """Set out[h] for every hashed n-gram of the whole text; False if it has no letter."""
    if not text or not _LETTER.search(text):
        return False
    bits = np.uint32(32 - int(WIDTH).bit_length() + 1)
    tail = np.array([32], np.uint32)
    for a in range(0, len(text), PIECE):
        part = _letters(text[a:a + PIECE])
        if len(part) and part[0] == 32 and tail[-1] == 32:
            part = part[1:]
        codes = np.concatenate([tail, part] if a + PIECE < len(text) else [tail, part, tail[:0] if not len(part) or part[-1] == 32
                                                                           else np.array([32], np.uint32)])
        h = np.zeros(len(codes), np.uint32)
        for n in range(1, LONGEST + 1):
            if len(codes) < n:
                break
            h = (h[:len(codes) - n + 1] * _MIX) ^ codes[n - 1:]
            mixed = (h + np.uint32(n)) * _MIX
            mixed ^= mixed >> np.uint32(15)
            out[(mixed * _MIX) >> bits] = 1
        tail = codes[max(0, len(codes) - LONGEST + 1):]
    return True


def presence_rows(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """(presence rows scaled to length 1, which texts have a letter)."""
    x = np.zeros((len(texts), WIDTH), np.float32)
    some = np.array([presence(t, row) for t, row in zip(texts, x)], bool)
    x /= np.sqrt(np.maximum(x.sum(1, keepdims=True), 1))
    return x, some


class Model:
    """Landmarks' presence rows, one-versus-rest weights, and language names."""

    def __init__(self, landmarks: np.ndarray, weights: np.ndarray, names: list[str]):
        self.landmarks, self.weights, self.names = landmarks, weights, names

    def predict(self, texts: list) -> tuple[list[str], np.ndarray]:
        x, some = presence_rows(texts)
        if not self.names:
            return [NO_LANGUAGE] * len(texts), np.zeros(len(texts))
        value = (x @ self.landmarks.T) @ self.weights
        best = value.argmax(1)
        share = np.exp(SHARPNESS * (value - value.max(1, keepdims=True)).astype(float))
        score = np.where(some, 1 / share.sum(1), 0.0)
        return [self.names[i] if ok else NO_LANGUAGE for i, ok in zip(best, some)], score


def held_out(doc_id: Column, folds: int = 4, fold: int = 2) -> Column:
    """The rows that are never learned from: crc32 of the id's text mod folds is the fold."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def sample(docs: DataFrame, fit_rows: int, folds: int, fold: int) -> tuple[np.ndarray, list[str]]:
    """Presence rows (as bytes of bits, in a fixed order) and languages of the
    training sample, at most ``fit_rows`` in all and as many of each language."""
    ship(docs.sparkSession)
    free = ~held_out(F.col("doc_id"), folds, fold) & F.col("lang").isNotNull() & F.col("doc_id").isNotNull()
    rows = docs.where(free).select("doc_id", "text", "lang")
    sizes = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(fit_rows).collect()
    if not sizes:
        return np.zeros((0, WIDTH), np.uint8), []
    each = max(1, fit_rows // len(sizes))
    # a quarter more than needed, as the hash only gives about its share
    share = docs.sparkSession.createDataFrame(
        [(r["lang"], min(1.0, (1.25 * each + 20) / r["count"])) for r in sizes], "lang string, share double")
    place = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 52)) / F.lit(float(1 << 52))
    picked = (rows.withColumn("place", place).join(F.broadcast(share), "lang").where(F.col("place") < F.col("share"))
              .select("lang", "place", "doc_id", "text"))

    def task(batches):
        for b in batches:
            x = np.zeros((b.num_rows, WIDTH), np.uint8)
            some = [presence(t, row) for t, row in zip(b.column(3).to_pylist(), x)]
            keep = np.nonzero(some)[0]
            yield pa.RecordBatch.from_arrays(
                [b.column(i).take(pa.array(keep)) for i in range(3)]
                + [pa.array([np.packbits(x[i]).tobytes() for i in keep], pa.binary())], ["lang", "place", "doc_id", "bits"])

    found = picked.mapInArrow(task, "lang string, place double, doc_id long, bits binary").collect()
    found.sort(key=lambda r: (r["place"], r["doc_id"], r["lang"], r["bits"]))
    kept, n = [], dict.fromkeys((r["lang"] for r in sizes), 0)
    for r in found:
        if n[r["lang"]] < each:
            n[r["lang"]] += 1
            kept.append(r)
    bits = np.frombuffer(b"".join(bytes(r["bits"]) for r in kept), np.uint8).reshape(len(kept), WIDTH // 8)
    return np.unpackbits(bits, axis=1), [r["lang"] for r in kept]


def fit(x: np.ndarray, langs: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """Kernel ridge regression in the span of the landmarks' kernel functions."""
    names = sorted(set(langs))
    if not names:
        return Model(np.zeros((0, WIDTH), np.float32), np.zeros((0, 0), np.float32), [])
    x = x.astype(np.float32)
    x /= np.sqrt(np.maximum(x.sum(1, keepdims=True), 1))
    of = np.array([names.index(g) for g in langs])
    turn = np.zeros(len(of), int)  # landmarks by turns of the languages, in the sample's order
    for g in range(len(names)):
        turn[of == g] = np.arange((of == g).sum())
    chosen = np.lexsort((of, turn))[:max(landmarks, len(names))]
    z = x[chosen]
    k = (x @ z.T).astype(float)
    inner = (z @ z.T).astype(float)
    y = np.where(of[:, None] == np.arange(len(names)), 1.0, -1.0)
    left = k.T @ k + ridge * len(x) * inner
    left += np.eye(len(left)) * (1e-8 * np.trace(left) / len(left))
    return Model(z, np.linalg.solve(left, k.T @ y).astype(np.float32), names)


def predict(docs: DataFrame, fit_rows: int = FIT_ROWS, folds: int = 4, fold: int = 2) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every document."""
    model = fit(*sample(docs, fit_rows, folds, fold))

    def task(batches):
        for b in batches:
            names, scores = [], []
            for a in range(0, b.num_rows, BATCH):
                part = model.predict(b.column(2).slice(a, BATCH).to_pylist())
                names += part[0]
                scores.append(part[1])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(names, pa.string()), pa.array(np.concatenate(scores or [np.zeros(0)]))],
                ["doc_id", "held_out", "lang_pred", "score"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id"), folds, fold).alias("held_out"),
                        "text").mapInArrow(task, "doc_id long, held_out boolean, lang_pred string, score double"))
