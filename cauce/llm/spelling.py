"""Spelling variant grouping by dense prefix-suffix tiling.

Words are counted from the texts and grouped under their frequent form. Two
words are near if they differ by exactly one inserted, deleted or replaced
character: then their common prefix and common suffix together reach the longer
length minus one. That is what is tested, on padded matrices of code points,
block against block.

Which blocks meet: let m be the shorter length of a near pair and p the length
of the common prefix, one of 0..m. These places are cut into ``segments``
ranges, and both words agree in all that lies outside the range that holds p.
A word therefore enters one tile for each range, as the shorter (m its length)
and as the longer one (m its length less one), under the hash of its characters
outside the range. A pair is counted in the one tile whose range holds p, so no
pair is lost or met twice. Tiles of up to ``BLOCK`` words are one group; larger
ones are cut into blocks by the words' hashes and every pair of blocks is a
group of its own, so that no task gathers more than two blocks. Counts and the
best partner are reduced in the task: pairs are never rows.

Forms rise at least tenfold in count at each step, so chains have at most
log10(largest count) links and are followed by doubling. A word of L characters
has some 180 L possible near words, so no form is shared by a hot group.

Defined results: null text has no words; a null id counts as the empty text in
the deletion's hash, so does no harm; repeated rows count as often as they
appear; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cauce.llm.common import ship, shuffle_partitions, stage

LETTERS = "A-Za-z\\u00C0-\\u00FF"
#: Ranges that the places of a difference are cut into.
SEGMENTS = 4
#: Words of a tile that one group holds; larger tiles are cut into blocks.
BLOCK = 4096
#: Rows of the matrices that are compared at once, and cells of a comparison.
SIDE = 256
CELLS = 1 << 22
#: Words that a task compares together.
BATCH = 1 << 15


def _without(run: Column, at: Column) -> Column:
    """The run without its character ``at`` (from 0)."""
    return F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))


def word_counts(docs: DataFrame, min_length: int = 7, min_count: int = 2, every: int = 31) -> DataFrame:
    """(word, n): distinct runs of letters, only A-Z lower-cased, one character
    deleted where ``every`` divides the crc32 of ``<doc_id>:<run>``."""
    found = F.explode(F.regexp_extract_all("text", F.lit(f"[{LETTERS}]{{{min_length},}}"), F.lit(0)))
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), found.alias("run"))
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    runs = runs.select("id", F.when(F.col("run").rlike("[A-Z]"), F.translate("run", capitals, capitals.lower()))
                       .otherwise(F.col("run")).alias("run"))
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    size = F.length("run")
    word = F.when(h % every == 0, _without(F.col("run"), (h % size).cast("int"))).otherwise(F.col("run"))
    return (runs.select(word.alias("word")).where(F.length("word") >= min_length)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count))


def tile_entries(words: DataFrame, segments: int = SEGMENTS, min_length: int = 7) -> DataFrame:
    """(m, segment, key, word, n): every word in each tile that it may share."""
    size = F.length("word")
    rows = words.withColumn("m", F.explode(F.array(size - 1, size))).where(F.col("m") >= min_length)
    rows = rows.withColumn("segment", F.explode(F.sequence(F.lit(0), F.lit(segments - 1))))
    start = F.floor(F.col("segment") * (F.col("m") + 1) / segments).cast("int")
    stop = F.floor((F.col("segment") + 1) * (F.col("m") + 1) / segments).cast("int")
    tail = F.greatest(F.col("m") - stop, F.lit(0))
    key = F.xxhash64(F.substring("word", F.lit(1), start), F.substring("word", size - tail + 1, tail))
    return rows.select("m", "segment", key.alias("key"), "word", "n")


def _dealt(entries: DataFrame, block: int) -> DataFrame:
    """Entries with the pair of blocks they are compared in: (0, 0) unless the
    tile holds more than ``block`` words."""
    tile = ["m", "segment", "key"]
    large = (entries.groupBy(*tile).agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > block)
             .withColumn("blocks", F.ceil(F.col("size") * 2 / block).cast("int")).drop("size"))
    rows = entries.join(large, tile, "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    own = F.pmod(F.xxhash64("word", F.lit(7)), F.col("blocks")).cast("int")
    rows = rows.withColumn("own", own)
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    rows = rows.select(*tile, "word", "n", "own", other.alias("other"))
    return rows.select(*tile, F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"),
                       (F.col("own") > F.col("other")).alias("second"), "word", "n")


class _Codes:
    """Padded code-point matrices of words: from the left and from the right."""

    def __init__(self, words: list[str]):
        self.size = np.array([len(w) for w in words] + [-9], np.int64)  # the last row stands for no word
        flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4")
        if not len(flat) or flat.max() < 256:
            flat = flat.astype(np.uint8)
        self.flat = flat
        self.start = np.cumsum(self.size) - self.size

    def padded(self, rows: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """(from the left, from the right), each rows.shape + (width,)."""
        size = np.maximum(self.size[rows], 0)[..., None]
        at = np.arange(width)
        inside = at < size
        left = self.start[rows][..., None] + np.where(inside, at, 0)
        right = self.start[rows][..., None] + np.where(inside, size - 1 - at, 0)
        top = max(len(self.flat) - 1, 0)
        return tuple(np.where(inside, self.flat[np.minimum(i, top)], 0) for i in (left, right))


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common start of every row of a with every row of b, for
    stacks of padded matrices (t, rows, width)."""
    run = np.ones((a.shape[0], a.shape[1], b.shape[1]), bool)
    out = np.zeros(run.shape, np.int32)
    for k in range(a.shape[2]):
        run &= a[:, :, None, k] == b[:, None, :, k]
        if not run.any():
            break
        out += run
    return out


def near(codes: _Codes, a: np.ndarray, b: np.ndarray, m: int, span: tuple[int, int]) -> np.ndarray:
    """Which rows a[t, i] and b[t, j] are one edit apart, the shorter of length
    m and the common prefix in ``span``."""
    al, ar = codes.padded(a, m + 1)
    bl, br = (al, ar) if b is a else codes.padded(b, m + 1)
    x, y = codes.size[a][:, :, None], codes.size[b][:, None, :]
    short, long = np.minimum(x, y), np.maximum(x, y)
    prefix = np.minimum(_common(al, bl), short)
    suffix = np.minimum(_common(ar, br), short)
    one = (short == m) & (long - short <= 1) & (prefix + suffix >= long - 1) & ((prefix < m) | (long > m))
    return one & (prefix >= span[0]) & (prefix < span[1])


def _stacks(groups: list[tuple[np.ndarray, np.ndarray]], width: int):
    """Pairs of row blocks as stacks of equal shape: small groups are padded to
    a power of two and stacked, large ones (and those of very long words) are
    cut into blocks of at most SIDE rows."""
    side = max(1, min(SIDE, CELLS // (2 * width)))
    waiting: dict[tuple[int, int, bool], list] = {}
    for one, two in groups:
        same = one is two
        for i in range(0, len(one), side):
            for j in range(i if same else 0, len(two), side):
                a, b = one[i:i + side], two[j:j + side]
                own = same and i == j
                if own and len(a) < 2:
                    continue
                shape = (1 << (len(a) - 1).bit_length(), 1 << (len(b) - 1).bit_length(), own)
                held = waiting.setdefault(shape, [])
                held.append((a, b))
                cells = shape[0] * shape[1] * 8 + (shape[0] + shape[1]) * width
                if (len(held) + 1) * cells > CELLS:
                    yield shape, waiting.pop(shape)
    yield from waiting.items()


def _compare(words: list[str], n: np.ndarray, groups: list[tuple[int, int, list]], segments: int):
    """(near words, best partner's row or -1) of every row; ``groups`` lists
    (m, segment, pairs of row blocks)."""
    codes = _Codes(words)
    order = sorted(range(len(words)), key=lambda i: (-n[i], words[i]))
    rank = np.empty(len(words) + 1, np.int64)
    rank[order] = np.arange(len(words))
    rank[-1] = none = len(words)
    count, best = np.zeros(len(words) + 1, np.int64), np.full(len(words) + 1, none)
    for m, segment, pairs in groups:
        span = (segment * (m + 1) // segments, (segment + 1) * (m + 1) // segments)
        for (rows, cols, own), held in _stacks(pairs, m + 1):
            a = np.full((len(held), rows), -1)
            b = a if own else np.full((len(held), cols), -1)
            for t, (x, y) in enumerate(held):
                a[t, :len(x)] = x
                if not own:
                    b[t, :len(y)] = y
            hit = near(codes, a, b, m, span)
            if not hit.any():
                continue
            np.add.at(count, a, hit.sum(2))
            np.minimum.at(best, a, np.where(hit, rank[b][:, None, :], none).min(2))
            if not own:  # a block against itself has both directions already
                np.add.at(count, b, hit.sum(1))
                np.minimum.at(best, b, np.where(hit, rank[a][:, :, None], none).min(1))
    found = np.array(order + [-1])
    return count[:-1], found[best[:-1]]


_FOUND = "word string, n_near long, best string, best_n long"


def _tiles(segments: int):
    def task(batches):
        held: list = []  # rows of whole tables, the last group may go on
        kept = 0

        def result(table):
            words, n = table["word"].to_pylist(), table["n"].to_numpy()
            marks = [table[c].to_numpy() for c in ("m", "segment", "key", "lo", "hi")]
            second = table["second"].to_numpy(zero_copy_only=False)
            cut = np.zeros(max(len(words) - 1, 0), bool)
            for v in marks:
                cut |= v[1:] != v[:-1]
            edges = [0, *(np.nonzero(cut)[0] + 1).tolist(), len(words)]
            by_kind: dict[tuple[int, int], list] = {}
            for a, b in zip(edges, edges[1:]):
                if b - a < 2:
                    continue
                rows = np.arange(a, b)
                if marks[3][a] == marks[4][a]:
                    pair = (rows, rows)
                else:
                    pair = (rows[~second[a:b]], rows[second[a:b]])
                by_kind.setdefault((int(marks[0][a]), int(marks[1][a])), []).append(pair)
            count, best = _compare(words, n, [(m, s, p) for (m, s), p in by_kind.items()], segments)
            hit = np.nonzero(count)[0]
            return pa.RecordBatch.from_arrays(
                [pa.array([words[i] for i in hit], pa.string()), pa.array(count[hit], pa.int64()),
                 pa.array([words[i] for i in best[hit]], pa.string()), pa.array(n[best[hit]], pa.int64())],
                ["word", "n_near", "best", "best_n"])

        def last_start(table):
            """Row at which the last group of the table begins."""
            at = 0
            for c in ("m", "segment", "key", "lo", "hi"):
                v = table[c].to_numpy()
                other = np.nonzero(v != v[-1])[0]
                at = max(at, int(other[-1]) + 1 if len(other) else 0)
            return at

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            kept += batch.num_rows
            if kept >= BATCH:
                table = pa.Table.from_batches(held).combine_chunks()
                at = last_start(table)
                if at:
                    yield result(table.slice(0, at))
                rest = table.slice(at)
                held, kept = rest.to_batches(), rest.num_rows
        if held:
            yield result(pa.Table.from_batches(held).combine_chunks())

    return task


def near_words(words: DataFrame, segments: int = SEGMENTS, block: int = BLOCK, min_length: int = 7) -> DataFrame:
    """(word, n_near, best, best_n) of every word of ``words`` (word, n) that
    has a near one; best is the near word of largest n, ties the smallest word."""
    spark = words.sparkSession
    ship(spark)
    rows = _dealt(tile_entries(words, segments, min_length), block)
    tile = ["m", "segment", "key", "lo", "hi"]
    rows = rows.repartition(4 * shuffle_partitions(spark), *tile).sortWithinPartitions(*tile)
    found = rows.mapInArrow(_tiles(segments), _FOUND)
    first = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("word")))
    return (found.groupBy("word").agg(F.sum("n_near").alias("n_near"), first.alias("first"))
            .select("word", "n_near", F.col("first.word").alias("best"), (-F.col("first.less")).alias("best_n")))


def follow(links: DataFrame, largest: int, least: int, ratio: int) -> DataFrame:
    """(word, root): the last form reached from every word of ``links`` (word,
    form), where n rises from ``least`` to at most ``largest`` by ``ratio`` a step."""
    hops = max(1, int(math.log(max(largest, 1) / least, ratio)) + 1)
    roots = stage(links.select("word", F.col("form").alias("root")))
    for _ in range(math.ceil(math.log2(hops))):
        onward = roots.select(F.col("word").alias("via"), F.col("root").alias("onto"))
        roots = stage(roots.join(onward, F.col("root") == F.col("via"), "left")
                      .select("word", F.coalesce("onto", "root").alias("root")))
    return roots


def group_variants(docs: DataFrame, min_length: int = 7, min_count: int = 2, every: int = 31, ratio: int = 10,
                   segments: int = SEGMENTS, block: int = BLOCK) -> DataFrame:
    """(word, form, root, n, n_near, form_n): all words of ``docs`` with their
    near words counted, the frequent form each stands for, and the last form
    that following forms leads to (the word itself if it has none)."""
    words = stage(word_counts(docs, min_length, min_count, every))
    found = near_words(words, segments, block, min_length)
    formed = F.col("best_n") >= ratio * F.col("n")
    rows = stage(words.join(found, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(formed, F.col("best")).alias("form"), F.when(formed, F.col("best_n")).alias("form_n")))
    largest = words.agg(F.max("n")).first()[0] or 1
    roots = follow(rows.where("form IS NOT NULL"), largest, max(min_count, 1), ratio)
    return (rows.join(roots, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
