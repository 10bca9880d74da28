"""Removal of long repeated strings by suffix arrays.

A byte goes if it is covered by a string of ``width`` bytes (a window) that
also starts anywhere else. The work is dealt so that equal windows meet:

1. Every window has an anchor, the smallest-hashed ``K``-byte string in it, so
   equal windows have equal anchors. The consecutive windows of one anchor are a
   block; a block's context is all its bytes. Per block only hashes of its
   anchor and of its context are kept.
2. A window that repeats lies in blocks whose anchor repeats. Blocks whose whole
   context repeats are settled: all their windows repeat. What is left are blocks
   that share an anchor but not the context, the rims of repeats; of each
   distinct context among them one copy of its bytes goes to a shard, chosen by
   anchor.
3. A shard builds the suffix array of its contexts (Larsson-Sadakane refinement
   of unsorted groups) and the common prefixes (Kasai's recurrence): windows in a
   run of common prefixes of ``width`` or more repeat.
4. An anchor with more distinct contexts than a shard takes is split over several
   shards. Their windows that are still single (and one of each that is not) are
   dealt by a 128-bit digest and merged by binary search across shards.

So exact copies cost hashes only, the suffix arrays hold the rims only, and no
group, however many documents share it, is gathered in one task.

Defined results: null text is no bytes; texts shorter than the window keep
everything; repeated rows are documents of their own and repeat each other;
null ids are kept; an empty table gives no rows. Hashes are 64 bits for the
anchor and 64 for the context, used jointly.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cauce.llm.common import ship, shuffle_partitions, stage

K = 128
#: Buffer of at most 2**BITS bytes are hashed at once; longer texts in pieces.
BITS = 20
#: Bytes of context per shard on average, and distinct contexts of one anchor
#: that one shard takes.
SHARD_BYTES, SHARD_CONTEXTS = 2_000_000, 2000
_BASE = 0x9E3779B97F4A7C15


class Hasher:
    """Hashes of all K-byte strings of a buffer, by prefix sums modulo 2**64."""

    def __init__(self, size: int):
        self.power = np.full(size, _BASE, np.uint64)
        self.power[0] = 1
        self.power = np.multiply.accumulate(self.power)
        self.inverse = np.full(size, pow(_BASE, -1, 1 << 64), np.uint64)
        self.inverse[0] = 1
        self.inverse = np.multiply.accumulate(self.inverse)

    def __call__(self, data: np.ndarray) -> np.ndarray:
        sums = np.concatenate([np.zeros(1, np.uint64),
                               np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.power[:len(data)])])
        h = (sums[K:] - sums[:-K]) * self.inverse[:len(data) - K + 1]
        h = (h ^ (h >> np.uint64(32))) * np.uint64(_BASE)
        return h ^ (h >> np.uint64(29))


def _window_min(v: np.ndarray, width: int) -> np.ndarray:
    out, have = v, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


def blocks(hasher: Hasher, data: np.ndarray, ends: np.ndarray, width: int):
    """Blocks of a buffer of concatenated texts: (first window, windows, anchor
    hash), windows within one text only. ``ends``: the texts' ends."""
    none = np.empty(0, np.int64)
    if len(data) < width:
        return none, none, none.astype(np.uint64)
    h = hasher(data)
    low = np.uint64((1 << BITS) - 1)
    at = (_window_min((h & ~low) | np.arange(len(h), dtype=np.uint64), width - K + 1) & low).astype(np.int64)
    start = np.arange(len(at))
    text = np.searchsorted(ends, start, "right")
    valid = start + width <= ends[text]
    first = valid.copy()
    first[1:] &= ~valid[:-1] | (at[1:] != at[:-1]) | (text[1:] != text[:-1])
    begin = np.nonzero(first)[0]
    if not len(begin):
        return none, none, none.astype(np.uint64)
    group = np.cumsum(first) - 1
    count = np.bincount(group[valid], minlength=len(begin))
    return begin, count, h[at[begin]]


def anchor_table(rows: DataFrame, width: int) -> DataFrame:
    """key, h (anchor), ctx (context), lo (first window), n (windows)."""
    from xxhash import xxh3_64_intdigest as digest

    def task(batches):
        hasher = Hasher(1 << BITS)

        def emit(keys, texts, shift=0):
            raw = b"".join(texts)
            ends = np.cumsum([len(t) for t in texts])
            begin, count, h = blocks(hasher, np.frombuffer(raw, np.uint8), ends, width)
            view = memoryview(raw)
            ctx = np.array([digest(view[a:a + n + width - 1]) for a, n in zip(begin.tolist(), count.tolist())], np.uint64)
            of = np.searchsorted(ends, begin, "right")
            base = np.concatenate([[0], ends[:-1]])[of] if len(of) else begin
            return pa.RecordBatch.from_arrays(
                [pa.array(np.array(keys, np.int64)[of]), pa.array(h.view(np.int64)), pa.array(ctx.view(np.int64)),
                 pa.array(begin - base + shift), pa.array(count.astype(np.int32))], ["key", "h", "ctx", "lo", "n"])

        for b in batches:
            keys, texts, size = [], [], 0
            for key, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                raw = (text or "").encode("utf-8")
                if len(raw) < width:
                    continue
                if len(raw) > 1 << BITS:
                    step = (1 << BITS) - width + 1
                    for a in range(0, len(raw) - width + 1, step):
                        yield emit([key], [raw[a:a + (1 << BITS)]], a)
                    continue
                if size + len(raw) > 1 << BITS:
                    yield emit(keys, texts)
                    keys, texts, size = [], [], 0
                keys.append(key)
                texts.append(raw)
                size += len(raw)
            if texts:
                yield emit(keys, texts)

    return rows.select("key", "text").mapInArrow(task, "key long, h long, ctx long, lo long, n int")


def suffix_array(t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(suffix array, rank) of symbols 0..510 by Larsson-Sadakane: groups that
    agree in h symbols are refined by the ranks h further on; sorted ones rest."""
    n = len(t)
    key = np.zeros(n, np.int64)
    for j in range(7):
        key <<= 9
        key[:max(0, n - j)] |= t[j:] + 1  # 0 is past the end
    sa = np.argsort(key, kind="stable")
    new = np.concatenate([[True], key[sa][1:] != key[sa][:-1]]) if n else np.empty(0, bool)
    head = np.maximum.accumulate(np.where(new, np.arange(n), 0)) if n else np.empty(0, np.int64)
    rank = np.empty(n, np.int64)
    rank[sa] = head
    h, open_ = 7, np.arange(n)
    while True:
        # slots whose group has more than one suffix
        single = new & np.concatenate([new[1:], [True]]) if len(new) else new
        open_ = open_[~single]
        if not len(open_):
            return sa, rank
        pos = sa[open_]
        ahead = pos + h
        after = np.where(ahead < n, rank[np.minimum(ahead, n - 1)], -1)
        group = rank[pos]
        order = np.lexsort((after, group))
        pos, group, after = pos[order], group[order], after[order]
        sa[open_] = pos
        new = np.concatenate([[True], (group[1:] != group[:-1]) | (after[1:] != after[:-1])])
        rank[pos] = open_[np.maximum.accumulate(np.where(new, np.arange(len(open_)), 0))]
        h *= 2


def common_prefixes(t: np.ndarray, sa: np.ndarray) -> np.ndarray:
    """lcp[i]: symbols that suffixes sa[i - 1] and sa[i] share (lcp[0] is 0).
    Kasai: in text order a value is at least its predecessor's less one, and
    exactly that where the symbols before the two suffixes agree; only the
    other positions are compared, all at once, seven symbols a step."""
    n = len(t)
    if not n:
        return np.empty(0, np.int64)
    phi = np.full(n, -1, np.int64)
    phi[sa[1:]] = sa[:-1]
    i = np.arange(n)
    before = t[np.maximum(i - 1, 0)] == t[np.maximum(phi - 1, 0)]
    fresh = (i == 0) | (phi < 1) | ~before
    fresh[1:] |= phi[:-1] < 0
    key = np.zeros(n + 7, np.int64)
    for j in range(7):
        key <<= 9
        key[:max(0, n - j)] |= t[j:].astype(np.int64) + 1
    at = np.nonzero(fresh & (phi >= 0))[0]
    length = np.zeros(n, np.int64)
    a, b, out = at, phi[at], np.zeros(len(at), np.int64)
    live = np.arange(len(at))
    while len(live):
        x = key[np.minimum(a[live] + out[live], n)] ^ key[np.minimum(b[live] + out[live], n)]
        full = (x == 0) & (np.maximum(a[live], b[live]) + out[live] + 7 <= n)
        rest = live[~full]
        if len(rest):
            y = x[~full]
            same = np.zeros(len(rest), np.int64)
            for j in range(7):  # leading symbols that agree, not past the end
                ok = (y >> (9 * (6 - j)) == 0) & (np.maximum(a[rest], b[rest]) + out[rest] + j < n)
                same += ok & (same == j)
            out[rest] += same
        live = live[full]
        out[live] += 7
    length[at] = out
    last = np.maximum.accumulate(np.where(fresh, i, 0))
    length = np.maximum(length[last] - (i - last), 0)
    return length[sa]


def repeated_windows(contexts: list[bytes], counts: np.ndarray, weights: np.ndarray, width: int):
    """For contexts of ``counts`` windows each: (context, offset, run, repeated)
    of every window, ``run`` naming equal windows. A weight over 1 says that the
    whole context repeats elsewhere."""
    sizes = np.array([len(c) + 1 for c in contexts])
    starts = np.cumsum(sizes) - sizes
    t = np.frombuffer(b"\0".join(contexts) + b"\0", np.uint8).astype(np.int64) + 1
    t[starts + sizes - 1] = 0
    sa, _ = suffix_array(t)
    run = np.cumsum(common_prefixes(t, sa) < width) - 1
    of = np.searchsorted(starts, sa, "right") - 1
    offset = sa - starts[of]
    own = offset < counts[of]
    of, offset, run = of[own], offset[own], run[own]
    total = np.bincount(run, np.minimum(weights[of], 2), minlength=run.max(initial=-1) + 1)
    return of, offset, run, total[run] >= 2


def _spans(key: np.ndarray, start: np.ndarray):
    """Consecutive windows of a key joined to (key, lo, n)."""
    order = np.lexsort((start, key))
    key, start = key[order], start[order]
    new = np.concatenate([[True], (key[1:] != key[:-1]) | (start[1:] != start[:-1] + 1)]) if len(key) else np.empty(0, bool)
    at = np.nonzero(new)[0]
    return key[at], start[at], np.diff(np.append(at, len(key)))


#: A window that is merged across shards: digest, place, and its weight.
_WINDOW = np.dtype([("hi", "<i8"), ("low", "<i8"), ("key", "<i8"), ("lo", "<i8"), ("weight", "<i8")])
_FOUND = "key long, lo long, n int, part int, run binary"


def shard_repeats(contexts: DataFrame, n_shards: int, n_parts: int, width: int) -> DataFrame:
    """Rows (key, lo, n) for repeats found within a shard (part null). What
    split anchors have to merge across shards follows as one sorted run of
    windows for each of ``n_parts`` ranges of digests."""
    from xxhash import xxh3_128_digest as digest

    def one(rows: pa.Table) -> pa.Table:
        keys, los = rows["key"].to_numpy(), rows["lo"].to_numpy()
        texts = rows["bytes"].to_pylist()
        weights, split = rows["weight"].to_numpy(), np.asarray(rows["split"].to_pylist(), bool)
        of, offset, run, twice = repeated_windows(texts, rows["n"].to_numpy(), weights, width)
        hit = twice & (weights[of] == 1)
        key, lo, n = _spans(keys[of[hit]], los[of[hit]] + offset[hit])
        # of split anchors: windows still single, and the first of each repeated run
        head = np.concatenate([[True], run[1:] != run[:-1]]) if len(run) else np.empty(0, bool)
        cross = np.nonzero(split[of] & (~twice | head))[0]
        w = np.empty(len(cross), _WINDOW)
        d = np.frombuffer(b"".join(digest(texts[of[i]][offset[i]:offset[i] + width]) for i in cross), "<i8").reshape(-1, 2)
        w["hi"], w["low"], w["key"], w["lo"] = d[:, 0], d[:, 1], keys[of[cross]], los[of[cross]] + offset[cross]
        w["weight"] = 1 + twice[cross]
        w = w[np.lexsort((w["low"], w["hi"]))]
        part = w["hi"] % n_parts
        own = np.unique(part).tolist()
        none = len(own)
        return pa.table([pa.array(key.tolist() + [None] * none, pa.int64()), pa.array(lo.tolist() + [None] * none, pa.int64()),
                         pa.array(n.tolist() + [None] * none, pa.int32()), pa.array([None] * len(key) + own, pa.int32()),
                         pa.array([None] * len(key) + [w[part == p].tobytes() for p in own], pa.binary())],
                        [f.split()[0] for f in _FOUND.split(", ")])

    return contexts.repartition(n_shards, "shard").groupBy("shard").applyInArrow(one, _FOUND)


def merge_across(runs: DataFrame, n_parts: int) -> DataFrame:
    """Windows that more than one shard holds: the sorted runs of a part of the
    digests are merged, each window's equals found by binary search. A task
    holds one part at a time."""
    def merged(raws):
        w = np.frombuffer(b"".join(raws), _WINDOW)
        w = w[np.lexsort((w["low"], w["hi"]))]
        new = np.concatenate([[True], (w["hi"][1:] != w["hi"][:-1]) | (w["low"][1:] != w["low"][:-1])])
        equal = np.searchsorted(np.nonzero(new)[0], np.arange(len(w)), "right") - 1
        total = np.bincount(equal, w["weight"])
        hit = (total[equal] >= 2) & (w["weight"] == 1)
        key, lo, n = _spans(w["key"][hit], w["lo"][hit])
        return pa.RecordBatch.from_arrays([pa.array(key), pa.array(lo), pa.array(n.astype(np.int32))], ["key", "lo", "n"])

    def task(batches):
        at, held = None, []
        for b in batches:
            for part, raw in zip(b.column(0).to_pylist(), b.column(1)):
                if part != at:
                    if held:
                        yield merged(held)
                    at, held = part, []
                held.append(raw.as_py())
        if held:
            yield merged(held)

    dealt = runs.select("part", "run").repartition(n_parts, "part").sortWithinPartitions("part")
    return dealt.mapInArrow(task, "key long, lo long, n int")


def repeats(rows: DataFrame, width: int) -> DataFrame:
    """(key, lo, n): n windows from byte lo on of the text(s) ``key`` repeat."""
    table = stage(anchor_table(rows, width))
    shared = (table.groupBy("h").agg(F.count(F.lit(1)).alias("t"), (F.min("ctx") != F.max("ctx")).alias("mixed"))
              .where("t > 1").select("h", "mixed"))
    # joined as written tables, whose hot anchors Spark can split; dealt by
    # text again, so that the rows of a hot anchor lie in many files
    parts = shuffle_partitions(rows.sparkSession)
    suspect = stage(table.join(stage(shared), "h").repartition(parts, "key"))
    context = stage(suspect.groupBy("h", "ctx", "mixed").agg(
        F.count(F.lit(1)).alias("copies"), F.first("key").alias("key"), F.first("lo").alias("lo"),
        F.first("n").alias("n")))
    settled = suspect.join(context.where("copies > 1").select("h", "ctx"), ["h", "ctx"]).select("key", "lo", "n")

    rim = context.where("mixed")
    per_anchor = stage(rim.groupBy("h").agg(F.count(F.lit(1)).alias("d")))
    rim = rim.join(per_anchor, "h").withColumn("parts", F.ceil(F.col("d") / SHARD_CONTEXTS).cast("long"))
    size = rim.agg(F.sum(F.col("n") + width)).first()[0] or 0
    n_shards = max(1, -(-int(size) // SHARD_BYTES))
    sub = F.pmod(F.xxhash64("ctx"), F.col("parts"))
    rim = rim.withColumn("shard", F.pmod(F.xxhash64("h", sub), F.lit(n_shards)).cast("int"))
    wanted = rim.groupBy("key").agg(F.collect_list(F.struct(
        "lo", "n", F.least("copies", F.lit(2)).cast("int").alias("weight"), (F.col("parts") > 1).alias("split"),
        "shard")).alias("cuts"))

    def cut(batches):
        for b in batches:
            out: list[list] = [[] for _ in range(7)]
            for key, text, cuts in zip(*(c.to_pylist() for c in b.columns)):
                raw = text.encode("utf-8")
                for c in cuts:
                    row = (key, c["lo"], c["n"], c["weight"], c["split"], c["shard"],
                           raw[c["lo"]:c["lo"] + c["n"] + width - 1])
                    for col, v in zip(out, row):
                        col.append(v)
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.int32(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)],
                                             ["key", "lo", "n", "weight", "split", "shard", "bytes"])

    # rows that repeat as a whole have the same key and text: one of them is enough
    texts = rows.where(F.octet_length("text") >= width).select("key", "text")
    texts = texts.join(rim.select("key").distinct(), "key", "left_semi").dropDuplicates(["key"])
    held = texts.join(wanted, "key").select("key", "text", "cuts").mapInArrow(
        cut, "key long, lo long, n int, weight int, split boolean, shard int, bytes binary")
    n_parts = max(n_shards, shuffle_partitions(rows.sparkSession))
    found = stage(shard_repeats(held, n_shards, n_parts, width))
    crossed = merge_across(found.where("part is not null"), n_parts)
    return settled.unionByName(found.where("part is null").select("key", "lo", "n")).unionByName(crossed)


def dedup(docs: DataFrame, width: int = 400, with_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 per document;
    ``with_text`` adds the bytes that stay (``kept``)."""
    ship(docs.sparkSession)
    rows = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("key"))
    spans = repeats(rows, width).groupBy("key").agg(F.collect_set(F.struct("lo", "n")).alias("spans"))
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    schema += ", kept binary" if with_text else ""

    def task(batches):
        for b in batches:
            out: list[list] = [[] for _ in range(6)]
            for doc_id, text, spans in zip(*(c.to_pylist() for c in b.columns)):
                raw = (text or "").encode("utf-8")
                kept, at, runs, end = [], 0, 0, -1
                for lo, n in sorted((s["lo"], s["n"]) for s in spans or ()):
                    if lo > end:  # a new removed run begins
                        runs += 1
                        kept.append(raw[max(end, 0):lo])
                    end = max(end, lo + n + width - 1)
                kept = b"".join(kept) + raw[max(end, 0):]
                row = (doc_id, len(raw), len(raw) - len(kept), runs, hashlib.sha256(kept).hexdigest(), kept)
                for col, v in zip(out, row):
                    col.append(v)
            kinds = [pa.int64()] * 4 + [pa.string(), pa.binary()]
            names = [f.split()[0] for f in schema.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)][:len(names)], names)

    return rows.join(spans, "key", "left").select("doc_id", "text", "spans").mapInArrow(task, schema)
