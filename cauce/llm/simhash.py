"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints at distance r share a point that is at most r / 2 flips away
from either. Every distinct fingerprint emits all variants within half the
radius (1 + 64 + 2016 for radius 4); variants are shuffled, and fingerprints
that share a variant are a verified pair.

What is shuffled. A variant is its fingerprint with one, two or no bits
flipped, and its bucket is a GF(2)-linear function of its bits, so bucket(fp ^
flips) = bucket(fp) ^ bucket(flips). A fingerprint therefore goes once to each
bucket that owns some of its variants, and the bucket's task spells out exactly
the variants that fall there: the 2,081 variants cost 8 bytes for each bucket
reached and not 16 bytes each. Each bit of the bucket is the parity of a few
bits of its own, so that two flips change at most two of them: a fingerprint
reaches 1 + 14 + 91 = 106 of the 16,384 buckets that there are at least, and a
bucket gets 0.65 % of the fingerprints. Buckets double until one holds ``HELD``
fingerprints and ``BUCKET`` variants at most on average; tasks are so many that
one takes buckets of ``TASK`` fingerprints on average, and it works them off one
by one in slices of ``SLICE`` variants.

Fingerprints that share a variant lie within the radius of each other
(triangle inequality), so a run of k equal variants needs k - 1 links for its
connectivity, not all pairs; links are deduplicated, verified by bit count and
closed to components by distributed star rounds. Copies are collapsed to their
fingerprint before anything is emitted.

Defined results: null or wordless text has fingerprint zero, linked like any
other; null doc_ids sort last, a component of null ids only is named null;
repeated rows get the same fingerprint and component; an empty table no rows.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cauce.llm.common import ship, stage
from cauce.llm.components import components

_PLAIN = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ\t\n\x0b\x0c\r", "abcdefghijklmnopqrstuvwxyz     ")
#: Variants held at once by a task.
SLICE = 2_000_000
#: Fingerprints and variants per bucket at which the number of buckets doubles.
HELD, BUCKET = 1_000_000, 32_000_000
MIN_BITS, MAX_BITS = 14, 30
#: (fingerprint, bucket) pairs per task, and the least number of tasks.
TASK, MIN_TASKS = 4_000_000, 64
#: (fingerprint, bucket) pairs that are sorted at once when dealing.
DEALT = 1 << 20


def row_key():
    """Tells rows apart whose ids repeat or are null."""
    return F.xxhash64("doc_id", "text")


def fingerprint(text: str | None, shingle: int) -> int:
    """64-bit SimHash: bit is 1 if set in over half the shingles' XXH64."""
    import xxhash
    words = list(filter(None, (text or "").translate(_PLAIN).split(" ")))
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    n = len(words) - shingle + 1
    if n <= 1:
        return digest(" ".join(words), 42)
    parts = [words[i:len(words) - shingle + 1 + i] for i in range(shingle)]
    total = np.zeros(64, np.int64)
    grams = list(map(" ".join, zip(*parts)))
    for a in range(0, n, 1 << 16):
        h = np.array([digest(g, 42) for g in grams[a:a + (1 << 16)]], "<u8")
        total += _bit_counts(h)
    bits = (total * 2 > n).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def _bit_counts(h: np.ndarray) -> np.ndarray:
    """How many of the values have each bit set."""
    return np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """doc_id, row_key and fingerprint ``fp`` (a signed long with the same bits)."""
    ship(docs.sparkSession)

    def task(batches):
        for b in batches:
            fps = np.array([fingerprint(t, shingle) for t in b.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), b.column(2), pa.array(fps.view(np.int64))],
                                             ["doc_id", "row_key", "fp"])

    return docs.select("doc_id", "text", row_key().alias("row_key")).mapInArrow(task, "doc_id long, row_key long, fp long")


def flip_masks(half: int) -> np.ndarray:
    """All flips of at most ``half`` of 64 bits."""
    one = np.uint64(1) << np.arange(64, dtype=np.uint64)
    level, out = np.zeros(1, np.uint64), [np.zeros(1, np.uint64)]
    top = np.full(1, -1)
    for _ in range(half):
        nxt, tops = [], []
        for v, t in zip(level, top):
            nxt.append(v ^ one[t + 1:])
            tops.append(np.arange(t + 1, 64))
        level, top = np.concatenate(nxt), np.concatenate(tops)
        out.append(level)
    return np.concatenate(out)


@lru_cache
def _images(bits: int, more: int) -> list[np.ndarray]:
    """The buckets of the 256 values of each byte of a fingerprint."""
    columns = np.uint64(1) << (np.arange(64, dtype=np.uint64) % np.uint64(max(bits, 1))) if bits else np.zeros(64, np.uint64)
    extra = np.random.default_rng(20240601).integers(0, 1 << 62, 64, dtype=np.uint64) >> np.uint64(62 - more)
    columns = columns << np.uint64(more) | extra
    tables = []
    for i in range(0, 64, 8):
        table = np.zeros(1, np.uint64)
        for c in columns[i:i + 8]:
            table = np.concatenate([table, table ^ c])
        tables.append(table)
    return tables


def linear_bucket(v: np.ndarray, bits: int, more: int = 0) -> np.ndarray:
    """GF(2)-linear image of 64-bit values: ``bits`` parities of every
    ``bits``-th bit, then ``more`` parities of random bits."""
    out = np.zeros(v.shape, np.uint64)
    for i, table in enumerate(_images(bits, more)):
        out ^= table[(v >> np.uint64(8 * i)) & np.uint64(255)]
    return out.astype(np.int64)


@lru_cache
def reached(half: int, bits: int) -> np.ndarray:
    """Of the bucket of any fingerprint, those that its variants reach."""
    return np.unique(linear_bucket(flip_masks(half), bits))


def bucket_bits(count: int, half: int) -> int:
    """Bits of the bucket for ``count`` fingerprints."""
    per, bits = len(flip_masks(half)), MIN_BITS
    while bits < MAX_BITS and (count * len(reached(half, bits)) > HELD << bits or count * per > BUCKET << bits):
        bits += 1
    return bits


class Masks:
    """The flips, grouped by their linear bucket."""

    def __init__(self, half: int, bits: int, more: int):
        masks = flip_masks(half)
        at = linear_bucket(masks, bits, more)
        order = np.argsort(at, kind="stable")
        self.masks = masks[order]
        self.kinds, self.start, self.count = np.unique(at[order], return_index=True, return_counts=True)

    def owned(self, own: np.ndarray, bucket: int) -> tuple[np.ndarray, np.ndarray]:
        """(first mask, number of masks) of each fingerprint in the bucket; ``own``: their buckets."""
        need = own ^ bucket
        i = np.minimum(np.searchsorted(self.kinds, need), len(self.kinds) - 1)
        return self.start[i], np.where(self.kinds[i] == need, self.count[i], 0)

    def variants(self, fps: np.ndarray, own: np.ndarray, bucket: int) -> tuple[np.ndarray, np.ndarray]:
        """(variants of fps in the bucket, their fps); ``own``: the fps' buckets."""
        start, n = self.owned(own, bucket)
        of = np.repeat(np.arange(len(fps)), n)
        step = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
        return fps[of] ^ self.masks[start[of] + step], of


_masks = lru_cache(Masks)


def _links(fps: np.ndarray, half: int, bits: int, bucket: int) -> np.ndarray:
    """Links among ``fps`` by the variants in one of 2**bits buckets, sliced by
    as many further bits as its variants need."""
    n, k = int(_masks(half, bits, 0).owned(linear_bucket(fps, bits), bucket)[1].sum()), 0
    while n > SLICE << k:
        k += 1
    masks = _masks(half, bits, k)
    own = linear_bucket(fps, bits, k)
    found = []
    for s in range(1 << k):
        v, of = masks.variants(fps, own, (bucket << k) | s)
        w = np.sort(v)
        twice = w[1:][w[1:] == w[:-1]]
        if not len(twice):
            continue
        # runs of equal variants: everything in a run links to its first
        twice = np.unique(twice)
        at = np.minimum(np.searchsorted(twice, v), len(twice) - 1)
        hit = np.nonzero(twice[at] == v)[0]
        order = hit[np.lexsort((of[hit], v[hit]))]
        run = np.concatenate([[True], v[order][1:] != v[order][:-1]])
        head = of[order][np.maximum.accumulate(np.where(run, np.arange(len(order)), 0))]
        pairs = np.stack([head, of[order]], 1)[~run]
        found.append(np.unique(pairs, axis=0))
    if not found:
        return np.empty((0, 2), np.uint64)
    return fps[np.unique(np.concatenate(found), axis=0)]


def near_links(fps: DataFrame, distance: int = 4) -> DataFrame:
    """Links (a, b) whose closure is that of all pairs of distinct fingerprints
    (column ``fp``) at up to ``distance`` differing bits."""
    spark = fps.sparkSession
    ship(spark)
    half, count = (distance + 1) // 2, fps.count()
    bits = bucket_bits(count, half)
    pairs = count * len(reached(half, bits))
    tasks = min(1 << bits, max(MIN_TASKS, -(-pairs // TASK)))

    def deal(batches):
        near = reached(half, bits)
        step = max(1, DEALT // len(near))
        kind = np.min_scalar_type((1 << bits) - 1)  # short ones sort faster

        def dealt(part):
            to = (linear_bucket(part, bits)[:, None] ^ near[None, :]).ravel().astype(kind)
            order = np.argsort(to, kind="stable")
            sent, to = part[order // len(near)], to[order]
            first = np.nonzero(np.concatenate([[True], to[1:] != to[:-1]]))[0]
            ends = np.append(first[1:], len(to))
            return pa.RecordBatch.from_arrays(
                [pa.array(to[first].astype(np.int32)),
                 pa.array([sent[x:y].tobytes() for x, y in zip(first.tolist(), ends.tolist())], pa.binary())],
                ["bucket", "blob"])

        held = np.empty(0, np.uint64)
        for b in batches:
            held = np.concatenate([held, np.asarray(b.column(0)).view(np.uint64)])
            while len(held) >= step:
                yield dealt(held[:step])
                held = held[step:]
        if len(held):
            yield dealt(held)

    def meet(batches):
        held, to = [], []
        for b in batches:
            blob = b.column(1)
            at = np.frombuffer(blob.buffers()[1], np.int32)[blob.offset:blob.offset + len(blob) + 1]
            held.append(np.frombuffer(blob.buffers()[2], np.uint64, (at[-1] - at[0]) // 8, at[0]).copy() if len(blob) else
                        np.empty(0, np.uint64))
            to.append(np.repeat(np.asarray(b.column(0)), np.diff(at) // 8) if len(blob) else np.empty(0, np.int32))
        if not held:
            return
        held, to = np.concatenate(held), np.concatenate(to)
        order = np.argsort(to, kind="stable")
        held, to = held[order], to[order]
        del order
        ends = np.append(np.nonzero(to[1:] != to[:-1])[0] + 1, len(to))
        made, size, x = [], 0, 0
        for y in ends.tolist():
            if y > x:
                made.append(_links(np.sort(held[x:y]), half, bits, int(to[x])).view(np.int64))
                size += len(made[-1])
            if made and (size > DEALT or y == len(to)):
                pairs = np.concatenate(made)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])
                made, size = [], 0
            x = y

    dealt = fps.select("fp").mapInArrow(deal, "bucket int, blob binary")
    links = dealt.repartition(tasks, "bucket").mapInArrow(meet, "a long, b long")
    return links.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance).distinct()


def near_duplicates(docs: DataFrame, shingle: int = 4, distance: int = 4) -> DataFrame:
    """doc_id, row_key, fp, root (the component's key) and component_id per document."""
    by_doc = stage(fingerprints(docs, shingle))
    by_fp = stage(by_doc.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    star = components(near_links(by_fp.select("fp"), distance)).withColumnRenamed("node", "fp")
    rooted = by_fp.join(star, "fp", "left").withColumn("root", F.coalesce("component", "fp")).drop("component")
    named = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    by_root = stage(rooted.select("fp", "root").join(named, "root"))
    return by_doc.join(by_root, "fp").select("doc_id", "row_key", "fp", "root", "component_id")


def keep_one(docs: DataFrame, shingle: int = 4, distance: int = 4) -> DataFrame:
    """The documents without near-duplicates: of each component the row with
    the smallest doc_id stays (nulls last; then the smallest hash of id and
    text; of rows that agree in both, one)."""
    found = near_duplicates(docs, shingle, distance).where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    first = (found.groupBy("root", "row_key").agg(F.count(F.lit(1)).alias("n"))
             .groupBy("root").agg(F.min(F.struct("row_key", "n")).alias("first")))
    first = stage(first.select(F.col("first.row_key").alias("key"), F.col("first.n").alias("n")))
    keyed = docs.select(F.struct("*").alias("row"), row_key().alias("key"))  # the row's own names stay apart
    # one way to join at every size: texts are dealt by key once, the keys hashed
    once = keyed.join(first.where("n = 1").select("key").hint("shuffle_hash"), "key")
    many = keyed.join(first.where("n > 1").select("key").hint("shuffle_hash"), "key").dropDuplicates(["key"])
    return once.unionByName(many).select("row.*")
