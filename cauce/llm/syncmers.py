"""Document fingerprints from closed syncmers.

A k-mer of characters is a closed syncmer if the smallest of its s-mers (by
hash) is its first or its last. Whether it is one depends on its own characters
only, so the same passage gives the same anchors in any context, and an edit
spoils no anchor that it does not touch. The fingerprint is all of a text's
anchors, each with every position at which it appears, by hash and position.

Likeness of two fingerprints: the share of their distinct anchors that both
have at a common shift of positions (the one with most anchors, within ``slack``
characters; an anchor that appears several times may fit by any of its
positions). It is exact: shifts of an anchor are counted one by one, or by a
convolution where it appears too often in both texts. Two empty fingerprints
are alike.

The operator pairs each document with the next by descending id, in one shuffle
of the texts (each compressed): ids are cut into ranges from the id column alone, each range is a
sorted stream, and the first document of a range is also sent to the end of
the range before it. A task holds two documents at a time.

A fingerprint names some 64 bits of hash for every sixth character, so results are
several times the texts. ``written`` is the plain form, ``dense`` a shorter one with
the same content, for large tables.

Defined results: null text is empty; a text shorter than k is its own single
anchor, an empty text has none; equal ids follow each other by the hash of
their texts, null ids come last; a lone document is its own next.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cauce.llm.common import bucket_of, id_cuts, ship, shuffle_partitions

K, S = 16, 5
SLACK = 64
_MIX = np.uint64(0x9E3779B97F4A7C15)  # the golden ratio's odd 64-bit multiplier
#: Texts are worked off in pieces of this many characters.
PIECE = 1 << 18
#: Pairs of positions that are compared at once; an anchor with more is convolved.
PAIRS = 1 << 20
#: Characters of fingerprints and texts in a batch of results.
BATCH = 1 << 23


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * _MIX
    return x ^ (x >> np.uint64(29))


def _window_hash(codes: np.ndarray, width: int) -> np.ndarray:
    """A hash of every ``width`` consecutive characters."""
    h = np.zeros(len(codes) - width + 1, np.uint64)
    for j in range(width):
        h = h * _MIX + codes[j:j + len(h)]
    return _mixed(h)


def _window_min(h: np.ndarray, width: int) -> np.ndarray:
    """Smallest value of every ``width`` consecutive ones."""
    out, have = h, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


def anchors(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, positions) of the text's closed syncmers."""
    codes = np.frombuffer(text.encode("utf-32-le", "replace"), "<u4").astype(np.uint64)
    n = len(codes)
    if n < K:
        if not n:
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        return _window_hash(codes, n) + np.uint64(n), np.zeros(1, np.int64)
    found, at = [], []
    for a in range(0, n - K + 1, PIECE):
        part = codes[a:a + PIECE + K - 1]
        inner = _window_hash(part, S)
        least = _window_min(inner, K - S + 1)
        m = len(least)
        hit = np.nonzero((inner[:m] == least) | (inner[K - S:K - S + m] == least))[0]
        whole = np.zeros(len(hit), np.uint64)
        for j in range(K):
            whole = whole * _MIX + part[hit + j]
        found.append(_mixed(whole))
        at.append(hit + a)
    return np.concatenate(found), np.concatenate(at).astype(np.int64)


def sketch(text: str) -> tuple[np.ndarray, np.ndarray]:
    """All anchors' hashes, ascending, and positions, ascending for each hash."""
    h, at = anchors(text)
    order = np.argsort(h, kind="stable")
    return h[order], at[order]


_HEX = np.frombuffer(b"0123456789abcdef", np.uint8)


def written(mark: tuple[np.ndarray, np.ndarray]) -> str:
    """The fingerprint as text: hash:position in hex digits, dot-separated."""
    h, at = mark
    if not len(h):
        return ""
    wide = (int(at.max()).bit_length() + 3) // 4 or 1
    out = np.empty((len(h), 18 + wide), np.uint8)
    for a, v, n in ((0, h, 16), (17, at.astype(np.uint64), wide)):
        for j in range(n):
            out[:, a + j] = _HEX[(v >> np.uint64(4 * (n - 1 - j))) & np.uint64(15)]
    out[:, 16], out[:, 17 + wide] = ord(":"), ord(".")
    return out.tobytes()[:-1].decode("ascii")


#: Digits of base 85: printable, without quotes, backslash, comma, dot, colon and blank.
_DIGITS = np.frombuffer(b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz!#$%&()*+-;<=>?@^_`{|}~", np.uint8)
_VALUES = np.zeros(256, np.uint64)
_VALUES[_DIGITS] = np.arange(85)


def dense(mark: tuple[np.ndarray, np.ndarray]) -> str:
    """The fingerprint in 11 characters an anchor, by position: characters since the anchor
    before (at most K - S, as any K - S successive k-mers hold an anchor; from the
    start for the first), and five digits of each half of the hash."""
    h, at = mark
    order = np.argsort(at)
    h, gap = h[order], np.diff(at[order], prepend=0)
    out = np.empty((len(h), 11), np.uint8)
    out[:, 0] = _DIGITS[gap]
    for a, half in ((1, (h >> np.uint64(32)).astype(np.uint32)), (6, h.astype(np.uint32))):
        for j in range(4, -1, -1):
            rest = half // np.uint32(85)
            out[:, a + j] = _DIGITS[half - rest * np.uint32(85)]
            half = rest
    return out.tobytes().decode("ascii")


def undense(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The sketch that ``dense`` wrote."""
    digits = _VALUES[np.frombuffer(text.encode("ascii"), np.uint8).reshape(-1, 11)]
    high, low = (sum(digits[:, a + j] * np.uint64(85 ** (4 - j)) for j in range(5)) for a in (1, 6))
    h = (high << np.uint64(32)) + low
    at = np.cumsum(digits[:, 0].astype(np.int64))
    order = np.argsort(h, kind="stable")
    return h[order], at[order]


def _spread(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """All distinct shifts x - y of many positions, by convolution."""
    x0, y0 = x.min(), y.min()
    a, b = np.zeros(x.max() - x0 + 1), np.zeros(y.max() - y0 + 1)
    a[x - x0], b[len(b) - 1 - (y - y0)] = 1, 1
    n = len(a) + len(b) - 1
    size = 1 << (n - 1).bit_length()
    met = np.fft.irfft(np.fft.rfft(a, size) * np.fft.rfft(b, size), size)[:n]
    return np.nonzero(met > 0.5)[0] - (len(b) - 1) + x0 - y0


def _reach(of: np.ndarray, shift: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last shifts of each anchor's runs whose steps are at most SLACK."""
    order = np.lexsort((shift, of))
    of, shift = of[order], shift[order]
    new = (of[1:] != of[:-1]) | (shift[1:] - shift[:-1] > SLACK)
    return shift[np.concatenate([[True], new])], shift[np.concatenate([new, [True]])]


def likeness(x: tuple[np.ndarray, np.ndarray], y: tuple[np.ndarray, np.ndarray]) -> float:
    """Share of both texts' distinct anchors that both have at a common shift."""
    if not len(x[0]) or not len(y[0]):
        return float(len(x[0]) == len(y[0]))
    hx, ax, nx = np.unique(x[0], return_index=True, return_counts=True)
    hy, ay, ny = np.unique(y[0], return_index=True, return_counts=True)
    both, i, j = np.intersect1d(hx, hy, assume_unique=True, return_indices=True)
    if not len(both):
        return 0.0
    ax, nx, ay, ny = ax[i], nx[i], ay[j], ny[j]
    pairs = nx * ny
    runs = []
    for k in np.nonzero(pairs > PAIRS)[0].tolist():
        shift = _spread(x[1][ax[k]:ax[k] + nx[k]], y[1][ay[k]:ay[k] + ny[k]])
        runs.append(_reach(np.zeros(len(shift), np.int64), shift))
    few = np.nonzero(pairs <= PAIRS)[0]
    piece = np.cumsum(pairs[few]) // PAIRS
    for part in np.split(few, np.nonzero(np.diff(piece))[0] + 1):
        n = pairs[part]
        of = np.repeat(part, n)
        step = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
        if len(of):
            runs.append(_reach(of, x[1][ax[of] + step // ny[of]] - y[1][ay[of] + step % ny[of]]))
    # an anchor fits all common shifts s with s <= one of its shifts <= s + SLACK
    first = np.sort(np.concatenate([r[0] for r in runs])) - SLACK
    last = np.sort(np.concatenate([r[1] for r in runs]))
    most = (np.arange(1, len(first) + 1) - np.searchsorted(last, first, "left")).max()
    return float(most / (len(hx) + len(hy) - len(both)))


def edited(text: str, following: str) -> str:
    """The last third of the text replaced by the start of the following one."""
    cut = len(text) // 3
    return text[:len(text) - cut] + following[:cut]


def spliced(text: str, mark: tuple[np.ndarray, np.ndarray], following: str,
            other: tuple[np.ndarray, np.ndarray], changed: str) -> tuple[np.ndarray, np.ndarray]:
    """The sketch of ``changed = edited(text, following)`` from the two texts'
    own: an anchor hangs on its k characters only, so those before the seam are
    the text's, those behind it the following one's, moved, and only the windows
    across the seam are hashed."""
    cut = len(text) // 3
    kept, taken = len(text) - cut, min(cut, len(following))
    if len(changed) < K:
        return sketch(changed)
    start = max(0, kept - K + 1)
    seam = text[start:kept] + following[:min(taken, K - 1)]
    across = anchors(seam) if len(seam) >= K else (mark[0][:0], mark[1][:0])
    own = mark[1] <= kept - K
    moved = other[1] <= taken - K
    # positions rise from part to part, and a stable sort keeps that for equal hashes
    h = np.concatenate([mark[0][own], across[0], other[0][moved]])
    at = np.concatenate([mark[1][own], across[1] + start, other[1][moved] + kept])
    order = np.argsort(h, kind="stable")
    return h[order], at[order]


SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
          "edited_fingerprint string, near_edited double, near_next double")


def fingerprints(docs: DataFrame, form=written) -> DataFrame:
    """One row per document: its fingerprint, its edited text's, likenesses. ``form``
    writes a fingerprint as text (``written`` or ``dense``)."""
    spark = docs.sparkSession
    ship(spark)
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    cuts = id_cuts(docs, "doc_id", 4 * shuffle_partitions(spark))
    top = len(cuts)
    ranged = docs.withColumn("range", F.lit(top) - bucket_of(F.col("doc_id"), cuts))
    heads = ranged.groupBy("range").agg(F.max("doc_id").alias("head")).collect()  # one row per range
    heads = sorted((r["range"], r["head"]) for r in heads)
    # the first document of each range is also the next of the last one of the range before
    linked = [(r, h, heads[i - 1][0]) for i, (r, h) in enumerate(heads)]
    linked = F.broadcast(spark.createDataFrame(linked, "range int, head long, before int"))
    as_guest = F.struct(F.col("before").alias("r"), F.lit(True).alias("guest"))
    at_home = F.struct(F.col("range").alias("r"), F.lit(False).alias("guest"))
    rows = ranged.join(linked, "range").withColumn("to", F.explode(F.when(
        F.col("doc_id").eqNullSafe(F.col("head")), F.array(at_home, as_guest)).otherwise(F.array(at_home))))
    rows = rows.select(F.col("to.r").alias("range"), F.col("to.guest").alias("guest"), "doc_id", "text")
    rows = rows.withColumn("tie", F.xxhash64("text"))
    parts = max(1, min(len(heads), 4 * shuffle_partitions(spark)))
    # row by row: a batch of whole texts in Arrow would take much more memory
    compressed = F.udf(lambda b: pa.compress(bytes(b), codec="zstd", asbytes=True), "binary", useArrow=False)
    rows = rows.select("range", "guest", "doc_id", "tie", F.octet_length("text").alias("size"),
                       compressed(F.col("text").cast("binary")).alias("packed"))
    rows = (rows.repartition(parts, "range")
            .sortWithinPartitions("range", "guest", F.col("doc_id").desc_nulls_last(), "tie")
            .select("range", "guest", "doc_id", "size", "packed"))

    def task(batches):
        codec = pa.Codec("zstd")
        held = None  # (range, doc_id, text, sketch) waiting for its next

        def row(own, text, mark):
            changed = edited(own[2], text)
            other = own[3] if changed == own[2] else spliced(own[2], own[3], text, mark, changed)
            return (own[1], len(own[2]), hashlib.sha256(changed.encode("utf-8", "replace")).hexdigest(),
                    form(own[3]), form(other), likeness(own[3], other), likeness(own[3], mark))

        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

        def result(made):
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(made, kinds)],
                                              [f.split()[0] for f in SCHEMA.split(", ")])

        for batch in batches:
            made: list[list] = [[] for _ in range(7)]
            size = 0
            for part, is_guest, doc_id, n_bytes, packed in zip(*(c.to_pylist() for c in batch.columns)):
                if held and held[0] != part:
                    held = None
                if is_guest and not held:
                    continue  # of several rows with the head's id only the first counts
                text = codec.decompress(packed, n_bytes, asbytes=True).decode("utf-8")
                mark = sketch(text)
                if held:
                    done = row(held, text, mark)
                    for col, v in zip(made, done):
                        col.append(v)
                    size += len(done[3]) + len(done[4])
                    if size > BATCH:
                        yield result(made)
                        made, size = [[] for _ in range(7)], 0
                held = None if is_guest else (part, doc_id, text, mark)
            yield result(made)

    return rows.mapInArrow(task, SCHEMA)
