"""Token ids as files: an adaptive context-mixing range coder.

A block holds whole documents in ascending id order. Its ids are laid out in
``lanes`` of consecutive ids that are coded side by side, one id of every lane
per step, by a model that they share and that learns after each step (so both
directions run in numpy). Per id:

1. The order-2 context (two ids before it in its lane) names a candidate, the
   id it was last followed by; without one, the order-1 context does. Whether
   the candidate is right is one binary event, whose probability is a logistic
   mix of adaptive estimates under the order-2 confidence, the order-1
   confidence and agreement, and the candidate's order-0 frequency.
2. If not, and the order-1 context names another id, the same for that one.
3. Else the id itself is coded by adaptive order-0 frequencies.

All model arithmetic is in integers, so blocks decode alike on any machine.
The events drive a carry-less 64-bit range coder that writes 16-bit words.

A block starts with a fresh model and ends with its own checksum, so any block
is read alone and a damaged one is found. Blocks are rows of a Parquet table
(range, block, first and last id, counts, document index, payload), which Spark
writes and reads on any store.

Defined results: null text is empty (the end id alone); rows with equal ids
keep the order of their texts' hashes, null ids come first; a document longer
than a block gets a block of its own; an empty table gives no blocks and rows.
"""

from __future__ import annotations

import math
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cauce.llm import tokens
from cauce.llm.common import id_cuts, ship, shuffle_partitions, stage

#: Ids in a block, at least; lanes at most, and ids per lane at least.
BLOCK, LANES, LANE = 4_000_000, 12288, 128
_MAGIC = b"CMR2"
_TOP, _LOW = np.uint64(1 << 48), np.uint64(1 << 32)
_ZERO, _BELOW = np.uint64(0), np.uint64((1 << 16) - 1)
_16, _48, _32 = np.uint64(16), np.uint64(48), np.uint64(32)
_P = 1 << 16  # scale of probabilities
_CONF_BITS = 4
_CONF = (1 << _CONF_BITS) - 1
_HASH_BITS = 20

#: ln(p / (1 - p)) in 1/256 for p in 1/4096, and back to 1/65536.
_STRETCH = np.array([round(256 * math.log((i + 0.5) / (4095.5 - i))) for i in range(4096)], np.int64)
_REACH = 2047
_SQUASH = np.array([min(_P - 32, max(32, round(_P / (1 + math.exp(-x / 256))))) for x in range(-_REACH, _REACH + 1)],
                   np.int64)


#: Bits of a share of 2**17, at most 17.
_MAGNITUDE = np.array([min(17, i.bit_length()) for i in range((1 << 17) + 1)], np.int64)


class Mixer:
    """A binary event's probability from several small contexts."""

    def __init__(self, sizes: list[int]):
        self.ones = [np.ones(s, np.int64) for s in sizes]
        self.seen = [np.full(s, 2, np.int64) for s in sizes]
        self.weight = [_P * 3 // (2 * len(sizes))] * len(sizes)
        self.bias = 0

    def predict(self, contexts):
        st = [np.take(_STRETCH[(o << 12) // (s + 1)], c) for o, s, c in zip(self.ones, self.seen, contexts)]
        dot = sum(w * s for w, s in zip(self.weight, st)) >> 16
        return np.take(_SQUASH, dot + _REACH, mode="clip"), st

    def learn(self, contexts, st, p, hit):
        n = len(hit)
        if not n:
            return
        error = (hit.astype(np.int64) << 16) - p
        for i, c in enumerate(contexts):
            misses, hits = np.bincount(c + c + hit, minlength=2 * len(self.ones[i])).reshape(-1, 2).T
            self.ones[i] += hits
            self.seen[i] += misses + hits
            full = self.seen[i] > 1 << 18
            self.ones[i][full] >>= 1
            self.seen[i][full] >>= 1
            step = int(np.dot(st[i], error)) // n >> 9
            self.weight[i] = min(4 * _P, max(0, self.weight[i] + step))


class Model:
    """Order-0 to order-2 predictions, shared by the lanes of a block. An entry of a
    context's table is the id that followed last and, in the low bits, its confidence
    (0: none yet)."""

    def __init__(self, vocab: int):
        self.count, self.below = np.ones(vocab, np.int64), np.zeros(vocab + 1, np.int64)
        self.sum()
        kind = np.int32 if vocab <= 1 << (31 - _CONF_BITS) else np.int64
        self.after1, self.after2 = np.zeros(vocab, kind), np.zeros(1 << _HASH_BITS, kind)
        self.first = Mixer([(_CONF + 1) * 3, (_CONF + 1) * 3, 18 * 2])
        self.second = Mixer([_CONF + 1, 18])

    def sum(self):
        np.cumsum(self.count, out=self.below[1:])

    def slot(self, a, b):
        return ((a * 49633 + b) * 0x9E3779B1 >> 12) & ((1 << _HASH_BITS) - 1)

    def contexts(self, a, b):
        """The first event: (entries and places in both tables, order-1 candidate and
        confidence, candidate, whether there is one, contexts)."""
        slot = self.slot(a, b)
        e2, e1 = np.take(self.after2, slot), np.take(self.after1, b)
        c2, f2, c1, f1 = e2 >> _CONF_BITS, e2 & _CONF, e1 >> _CONF_BITS, e1 & _CONF
        has2, has1 = f2 > 0, f1 > 0
        cand = np.where(has2, c2, c1)
        agree = (has2 & has1) * (1 + (c1 == c2).astype(np.int8))
        seen = ((self.after2, slot, c2, f2), (self.after1, b, c1, f1))
        return seen, c1, f1, cand, has2 | has1, [f2 * 3 + agree, f1 * 3 + agree, self.rank(cand) * 2 + has2]

    def rank(self, ids):
        """Order of magnitude of the order-0 frequency, 0..17."""
        return np.take(_MAGNITUDE, (np.take(self.count, ids) << 17) // self.below[-1])

    def learn(self, seen, ids):
        for table, at, known, conf in seen:
            right = known == ids
            new = np.maximum(np.where(right, np.minimum(conf + 1, _CONF), conf >> 1), 1)
            # a candidate in little confidence gives way; of lanes in one context the last one's entry stays
            table[at] = np.where(right | (conf > 1), known, ids) << _CONF_BITS | new
        new = np.bincount(ids, minlength=len(self.count))
        new *= 24  # in place: new arrays of this size cost more than the sums
        self.count += new
        if self.below[-1] > 1 << 26:
            self.count += 1
            self.count >>= 1
        self.sum()

    def find(self, points):
        """The ids whose share of the order-0 frequencies holds the points, looked up in ascending order."""
        bits = len(points).bit_length()
        keys = np.sort((points << bits) + np.arange(len(points)))
        out = np.empty_like(points)
        out[keys & ((1 << bits) - 1)] = np.searchsorted(self.below, keys >> bits, "right") - 1
        return out


class Encoder:
    def __init__(self, lanes: int, words: int):
        self.low = np.zeros(lanes, np.uint64)
        self.range = np.full(lanes, (1 << 64) - 1, np.uint64)
        self.out = np.zeros((lanes, words), np.uint16)
        self.at = np.zeros(lanes, np.int64)

    def bit(self, who, p, hit):
        """One binary event of lanes ``who``, ``p`` of ``_P`` for it."""
        whole = self.range[who]
        split = (whole >> _16) * p
        self._settle(who, self.low[who] + np.where(hit, _ZERO, split), np.where(hit, split, (whole & ~_BELOW) - split))
        return hit

    def put(self, who, start, width, total):
        r = self.range[who] // total
        self._settle(who, self.low[who] + r * start, r * width)

    def _settle(self, who, low, rng):
        """Write the words that are certain."""
        live, l, g = None, low, rng  # all of who, then those that go on
        while True:
            same = (l ^ (l + g)) < _TOP
            small = g < _LOW
            go = np.flatnonzero(same | small)
            if not len(go):
                break
            live = go if live is None else live[go]
            tight = (small & ~same)[go]
            l, g = l[go], g[go]
            g = np.where(tight, (np.uint64(0) - l) & (_LOW - np.uint64(1)), g)
            lane = live if isinstance(who, slice) else who[live]
            at = self.at[lane]
            self.out[lane, at] = l >> _48
            self.at[lane] = at + 1
            l, g = l << _16, g << _16
            low[live], rng[live] = l, g
        self.low[who], self.range[who] = low, rng

    def finish(self):
        last = (self.low + np.uint64(0xFFFFFFFF)) >> _32
        lane = np.arange(len(self.low))
        for shift in (_16, np.uint64(0)):
            self.out[lane, self.at] = (last >> shift).astype(np.uint16)
            self.at += 1


class Decoder:
    def __init__(self, words: np.ndarray, counts: np.ndarray):
        self.words = np.concatenate([words, np.zeros(4, np.uint16)]).astype(np.uint64)
        self.end = np.cumsum(counts)
        self.at = self.end - counts
        n = len(counts)
        self.low, self.range = np.zeros(n, np.uint64), np.full(n, (1 << 64) - 1, np.uint64)
        self.code = np.zeros(n, np.uint64)
        for _ in range(4):
            self.code = (self.code << _16) | self._next(np.arange(n))

    def _next(self, lane):
        at = self.at[lane]
        got = np.where(at < self.end[lane], self.words[np.minimum(at, len(self.words) - 1)], np.uint64(0))
        self.at[lane] += 1
        return got

    def bit(self, who, p, hit):
        """One binary event of lanes ``who``, read back; ``hit`` is not known here."""
        whole, low = self.range[who], self.low[who]
        split = (whole >> _16) * p
        hit = self.code[who] - low < split
        self._settle(who, low + np.where(hit, _ZERO, split), np.where(hit, split, (whole & ~_BELOW) - split))
        return hit

    def point(self, who, total):
        self.step = self.range[who] // total
        return np.minimum((self.code[who] - self.low[who]) // self.step, total - np.uint64(1))

    def take(self, who, start, width):
        self._settle(who, self.low[who] + self.step * start, self.step * width)

    def _settle(self, who, low, rng):
        """Read the words that are certain."""
        code = self.code[who]  # a copy, or a view that is written in place
        live, l, g = None, low, rng  # all of who, then those that go on
        while True:
            same = (l ^ (l + g)) < _TOP
            small = g < _LOW
            go = np.flatnonzero(same | small)
            if not len(go):
                break
            live = go if live is None else live[go]
            tight = (small & ~same)[go]
            l, g = l[go], g[go]
            g = np.where(tight, (np.uint64(0) - l) & (_LOW - np.uint64(1)), g)
            code[live] = (code[live] << _16) | self._next(live if isinstance(who, slice) else who[live])
            l, g = l << _16, g << _16
            low[live], rng[live] = l, g
        self.low[who], self.range[who], self.code[who] = low, rng, code


def _u(x) -> np.ndarray:
    return np.asarray(x).astype(np.uint64)


def _lanes(n: int) -> tuple[int, int]:
    lanes = max(1, min(LANES, n // LANE))
    return lanes, -(-n // lanes)


def _run(n: int, vocab: int, coder, given: np.ndarray | None) -> np.ndarray:
    """Code (``given`` set) or decode the n ids of a block, step by step."""
    lanes, steps = _lanes(n)
    length = np.clip(n - np.arange(lanes) * steps, 0, steps)
    flat = np.zeros(lanes * steps, np.int32)  # lanes hold consecutive ids
    if given is not None:
        flat[:n] = given
    grid = flat.reshape(lanes, steps).T.copy()  # by step
    model = Model(vocab)
    a, b = np.zeros(lanes, np.int64), np.zeros(lanes, np.int64)

    def event(mixer, who, contexts, actual):
        """One binary event of lanes ``who``; returns whether it holds."""
        p, st = mixer.predict(contexts)
        hit = coder.bit(who, _u(p), actual)
        mixer.learn(contexts, st, p, hit)
        return hit

    for t in range(steps):
        live = int(np.searchsorted(-length, -t, "left"))  # lanes longer than t come first
        if not live:
            break
        a, b = a[:live], b[:live]
        ids = grid[t, :live].astype(np.int64)
        seen, c1, f1, cand, has, contexts = model.contexts(a, b)
        done = np.zeros(live, bool)
        if has.all():  # no lane to pick out
            done = event(model.first, slice(live), contexts, ids == cand)
        elif has.any():
            who = np.flatnonzero(has)
            done[who] = event(model.first, who, [c[who] for c in contexts], ids[who] == cand[who])
        if given is None:
            ids[done] = cand[done]
        who = np.flatnonzero(~done & (f1 > 0) & (c1 != cand))
        if len(who):
            c = c1[who]
            hit = event(model.second, who, [f1[who], model.rank(c)], ids[who] == c)
            done[who] = hit
            if given is None:
                ids[who[hit]] = c[hit]
        who = np.flatnonzero(~done)
        if len(who):
            total = np.uint64(model.below[-1])
            if given is None:
                ids[who] = model.find(coder.point(who, total).astype(np.int64))
            x = ids[who]
            start, width = _u(np.take(model.below, x)), _u(np.take(model.count, x))
            if given is None:
                coder.take(who, start, width)
            else:
                coder.put(who, start, width, total)
        model.learn(seen, ids)
        grid[t, :live] = ids
        a, b = b, ids
    return grid.T.reshape(-1)[:n]


def encode_block(ids: np.ndarray, vocab: int) -> bytes:
    """A block: header, words per lane, words; checksum over the ids."""
    n = len(ids)
    check = zlib.crc32(ids.astype("<u4").tobytes())
    lanes, steps = _lanes(n)
    coder = Encoder(lanes, 4 * steps + 8)
    if n:
        _run(n, vocab, coder, ids)
    coder.finish()
    words = coder.out[np.arange(coder.out.shape[1])[None, :] < coder.at[:, None]]
    return (_MAGIC + struct.pack("<QIII", n, vocab, lanes, check) + coder.at.astype("<u4").tobytes()
            + words.astype("<u2").tobytes())


def decode_block(raw: bytes) -> np.ndarray:
    """The block's ids; raises if the checksum doesn't hold."""
    if raw[:4] != _MAGIC:
        raise ValueError("not a block")
    n, vocab, lanes, check = struct.unpack_from("<QIII", raw, 4)
    counts = np.frombuffer(raw, "<u4", lanes, 24).astype(np.int64)
    words = np.frombuffer(raw, "<u2", -1, 24 + 4 * lanes)
    ids = _run(n, vocab, Decoder(words, counts), None).astype("<u4") if n else np.empty(0, "<u4")
    if zlib.crc32(ids.tobytes()) != check:
        raise ValueError("checksum differs: the block is damaged")
    return ids


_BLOCKS = "range int, block int, n_docs int, n_ids long, doc_ids binary, missing binary, lengths binary, payload binary"


def blocks(docs: DataFrame, tokenizer: str | None = None, end_id: int = 2, block: int = BLOCK) -> DataFrame:
    """The documents' ids as coded blocks, in ranges of ascending doc_id."""
    spark, path = docs.sparkSession, tokenizer or tokens.default_path()
    ship(spark)
    parts = shuffle_partitions(spark)
    lib = tokens.Encoder(path)
    vocab, dtype = max(lib.lib.get_vocab_size(), end_id + 1), lib.dtype
    del lib
    cuts = np.array(id_cuts(docs, "doc_id", parts), np.int64)

    def ids(batches):
        enc = tokens.encoder(path)
        for b in batches:
            for i in range(0, b.num_rows, tokens.PART):
                s = b.slice(i, tokens.PART)
                keys = s.column(0).cast(pa.int64())
                at = np.searchsorted(cuts, keys.fill_null(-(1 << 63)).to_numpy(), "right").astype(np.int32)
                got = [x.tobytes() for x in enc.encode(s.column(1).to_pylist())]
                yield pa.RecordBatch.from_arrays([pa.array(at), keys, s.column(2), pa.array(got, pa.binary())],
                                                 ["range", "doc_id", "tie", "ids"])

    coded = (docs.select("doc_id", "text", F.xxhash64("text").alias("tie"))
             .mapInArrow(ids, "range int, doc_id long, tie long, ids binary")
             .repartition(parts, "range").sortWithinPartitions("range", F.col("doc_id").asc_nulls_first(), "tie")
             .select("range", "doc_id", "ids"))

    def write(batches):
        tokens.encoder.cache_clear()  # a reused worker needs its remembered chunks no more
        end = np.array([end_id], dtype).tobytes()
        at, number, keys, held, size = None, 0, [], [], 0

        def flush():
            nonlocal number, keys, held, size
            lengths = np.array([len(h) // dtype.itemsize for h in held], "<u4")
            missing = np.array([k is None for k in keys], np.uint8)
            row = [at, number, len(keys), int(lengths.sum()),
                   np.array([k or 0 for k in keys], "<i8").tobytes(), missing.tobytes(), lengths.tobytes(),
                   encode_block(np.frombuffer(b"".join(held), dtype), vocab)]
            number, keys, held, size = number + 1, [], [], 0
            kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int64()] + [pa.binary()] * 4
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)],
                                              [f.split()[0] for f in _BLOCKS.split(", ")])

        for b in batches:
            ranges, ids_, raws = b.columns
            for r, doc_id, i in zip(ranges.to_pylist(), ids_.to_pylist(), range(b.num_rows)):
                raw = raws[i].as_py()
                if keys and (r != at or size >= block):
                    yield flush()
                if r != at:
                    at, number = r, 0
                keys.append(doc_id)
                held.append(raw + end)
                size += len(raw) // dtype.itemsize + 1
        if keys:
            yield flush()

    return coded.mapInArrow(write, _BLOCKS)


def read_blocks(written: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document in the blocks."""
    ship(written.sparkSession)
    per_range = written.groupBy("range").agg(F.sum("n_ids").alias("n"))
    # one row per range, then one per block of a range
    before = per_range.withColumn("r_start", F.coalesce(F.sum("n").over(
        Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("range", "r_start")
    inside = Window.partitionBy("range").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = (written.select("range", "block", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)).alias("b_start"))
              .join(before, "range")
              .select("range", "block", (F.col("r_start") + F.col("b_start")).alias("base")))

    def read(batches):
        tokens.encoder.cache_clear()
        for b in batches:
            for i in range(b.num_rows):  # one block at a time
                r, block, keys, missing, lengths, raw = (c[i].as_py() for c in b.columns)
                ids = decode_block(raw)
                n = np.frombuffer(lengths, "<u4").astype(np.int64)
                ends = np.cumsum(n)
                view = memoryview(ids.tobytes())
                crc = [zlib.crc32(view[4 * (e - k):4 * e]) for e, k in zip(ends.tolist(), n.tolist())]
                docs = pa.array(np.frombuffer(keys, "<i8"), mask=np.frombuffer(missing, np.uint8).astype(bool))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(n), r, np.int32)), pa.array(np.full(len(n), block, np.int32)), docs,
                     pa.array(ends - n), pa.array(n), pa.array(crc, pa.int64())],
                    ["range", "block", "doc_id", "at", "n_tokens", "ids_crc32"])

    found = written.select("range", "block", "doc_ids", "missing", "lengths", "payload").mapInArrow(
        read, "range int, block int, doc_id long, at long, n_tokens long, ids_crc32 long")
    return found.join(starts, ["range", "block"]).select(
        "doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def round_trip(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Write all documents' ids as blocks, read the files back, digest them."""
    return read_blocks(stage(blocks(docs, tokenizer)))
