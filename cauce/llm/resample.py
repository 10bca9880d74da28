"""Importance resampling towards a target distribution.

Documents are drawn so that their hashed word n-grams come to resemble those of
target texts. Texts are read as UTF-8 bytes: one 256-byte table lower-cases A-Z
and blanks every separator, ``bytes.split`` gives the words, and crc32 values
chained from word to word (the value of one run seeds that of the run a word
longer) give the hashes of all runs of 1 to ``longest`` words without joining
them. Counters of these hashes reduce in each task, and Spark adds up one count
per bucket and task.

The gain of a bucket is the logarithm of its smoothed frequency in the target
texts over that in the documents; a document's weight is the mean gain of its
features; Gumbel noise from a hash of the id makes the highest scores a draw
without replacement in proportion to the importance weights. The texts are read
twice, once for the counts and once for the weights; all else works on one
narrow row a document.

Ranks need no global sort: scores are integers of a range that only grows with
the logarithm of the table (some 10^5 values), so one count a score gives the
cut and the offset of each score, and positions are counted among the rows of
one score. The noise spreads ids over thousands of scores whatever the texts
are; rows of equal score, id and size are counted, then numbered, so repeated
rows are no hot group.

Defined results: null and wordless texts have no features and weight 0; a null
id is hashed as the empty text and comes last among ties; repeated rows are
documents of their own with ranks of their own; without target texts the gains
are those of T = 0; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cauce.llm.common import ship, stage

_LETTERS = b"0123456789abcdefghijklmnopqrstuvwxyz" + bytes(range(128, 256))
#: What each byte becomes: A-Z lower case, separators a blank, words' bytes themselves.
TABLE = bytes(c + 32 if 65 <= c <= 90 else c if c in _LETTERS else 32 for c in range(256))
#: Bytes of a text whose words are held at once, and distinct hashes of a Counter.
PIECE = 1 << 22
HELD = 1 << 20
#: Ranks that one row is exploded into at a time.
STEP = 100_000


def word_lists(text: bytes):
    """The words of a text, in lists of about PIECE bytes."""
    clean, at = text.translate(TABLE), 0
    while at < len(clean):
        end = clean.find(b" ", at + PIECE)
        end = len(clean) if end < 0 else end
        yield clean[at:end].split()
        at = end


def run_hashes(text: bytes, longest: int):
    """(k, crc32 of every run of k words joined by blanks), for k = 1..longest,
    list by list."""
    last: list[bytes] = []  # words before this list that its runs may begin with
    for words in word_lists(text):
        seeds = list(map(zlib.crc32, words))
        yield 1, seeds
        if longest > 1:
            words = last + words
            seeds = list(map(zlib.crc32, words))
            for k in range(2, longest + 1):
                seeds = [zlib.crc32(b" " + w, s) for s, w in zip(seeds, words[k - 1:])]
                # a run that ends before this list was counted with the one before it
                yield k, seeds[max(0, len(last) - k + 1):]
            last = words[1 - longest:]


def bucket_counts(texts: DataFrame, longest: int, buckets: int) -> np.ndarray:
    """Occurrences of each bucket's features in all texts (``buckets`` numbers
    come to the driver)."""
    ship(texts.sparkSession)

    def task(batches):
        total = np.zeros(buckets, np.int64)
        held: Counter = Counter()

        def fold():
            h = np.fromiter(held.keys(), np.int64, len(held))
            np.add.at(total, h % buckets, np.fromiter(held.values(), np.int64, len(held)))
            held.clear()

        for b in batches:
            for text in b.column(0).to_pylist():
                for _, seeds in run_hashes(text, longest) if text else ():
                    held.update(seeds)
                    if len(held) > HELD:
                        fold()
        fold()
        at = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    rows = texts.select(F.col("text").cast("binary").alias("text")).mapInArrow(task, "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for bucket, n in rows.groupBy("bucket").agg(F.sum("n")).collect():
        out[bucket] = n
    return out


def gains(source: np.ndarray, target: np.ndarray, scale: int = 1000) -> np.ndarray:
    """Each bucket's scaled log ratio of smoothed frequencies, floored."""
    k = len(source)
    up = (target + 1).astype(float) * float(source.sum() + k)
    down = (source + 1).astype(float) * float(target.sum() + k)
    return np.array([math.floor(scale * math.log(x)) for x in (up / down).tolist()], np.int64)


def noise(doc_id, seed: int, scale: int = 1000) -> int:
    """The id's scaled Gumbel noise, floored."""
    name = f"{seed}:{'' if doc_id is None else doc_id}"
    h = int(hashlib.sha256(name.encode()).hexdigest()[:8], 16)
    return math.floor(-scale * math.log(-math.log((h + 0.5) / 4294967296)))


def scores(docs: DataFrame, gain: np.ndarray, longest: int, seed: int) -> DataFrame:
    """doc_id, n_words, n_features, weight, score of every document."""
    ship(docs.sparkSession)
    buckets = len(gain)

    def weigh(text: bytes) -> tuple[int, int, int]:
        n_words = n = total = 0
        for k, seeds in run_hashes(text, longest):
            at = np.fromiter(seeds, np.int64, len(seeds)) % buckets
            total += int(gain[at].sum())
            n += len(seeds)
            n_words += len(seeds) if k == 1 else 0
        return n_words, n, total // n if n else 0

    def task(batches):
        for b in batches:
            ids = b.column(0).to_pylist()
            made = [weigh(t or b"") for t in b.column(1).to_pylist()]
            score = [w + noise(i, seed) for i, (_, _, w) in zip(ids, made)]
            columns = [ids, *(zip(*made) if made else ([], [], [])), score]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns],
                                             ["doc_id", "n_words", "n_features", "weight", "score"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
            .mapInArrow(task, "doc_id long, n_words long, n_features long, weight long, score long"))


def ranked(scored: DataFrame, share: int, min_words: int) -> DataFrame:
    """``rank`` 1, 2, 3 ... of the ``share`` percent highest scores among rows of
    at least ``min_words`` words (ties: smaller doc_id), null elsewhere.
    ``scored`` is read several times, so it should be staged."""
    fit = F.col("n_words") >= min_words
    histogram = sorted(((s, n) for s, n in scored.where(fit).groupBy("score").count().collect()), reverse=True)
    size = share * sum(n for _, n in histogram) // 100
    offsets, before = [], 0
    for score, n in histogram:  # at most one row a score
        if before >= size:
            break
        offsets.append((score, before))
        before += n
    columns = ["doc_id", "n_features", "weight", "score"]
    if not offsets:
        return scored.select(*columns, F.lit(None).cast("long").alias("rank"))
    cut = offsets[-1][0]
    top = fit & (F.col("score") >= cut)
    offsets = F.broadcast(scored.sparkSession.createDataFrame(offsets, "score long, before long"))
    order = Window.partitionBy("score").orderBy(F.col("doc_id").asc_nulls_last(), "n_features")
    counted = (scored.where(top).groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).join(offsets, "score")
               .withColumn("first", F.col("before") + F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, 0))
                           - F.col("n") + 1))
    last = F.col("first") + F.col("n") - 1
    steps = counted.withColumn("start", F.explode(F.sequence("first", last, F.lit(STEP).cast("long"))))
    drawn = steps.withColumn("rank", F.explode(F.sequence("start", F.least(F.col("start") + STEP - 1, last))))
    rank = F.when(F.col("rank") <= size, F.col("rank")).alias("rank")
    rest = scored.where(~top).select(*columns, F.lit(None).cast("long").alias("rank"))
    return drawn.select(*columns, rank).unionByName(rest)


def resample(docs: DataFrame, target: DataFrame, longest: int = 1, buckets: int = 10_000, share: int = 10,
             min_words: int = 20, seed: int = 2024) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every document: the share of
    documents with a rank is drawn towards the distribution of ``target`` texts."""
    gain = gains(bucket_counts(docs, longest, buckets), bucket_counts(target, longest, buckets))
    return ranked(stage(scores(docs, gain, longest, seed)), share, min_words)
