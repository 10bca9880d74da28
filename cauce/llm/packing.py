"""Harmonic packing of token pieces into sequences of a fixed capacity.

Lengths fall into reciprocal-capacity classes: class j (1..classes) holds
pieces of exactly capacity // j tokens and its bins always take j of them, so a
worker fills each class's bins with a fixed document count and needs to know
nothing of other workers. A document is cut greedily into the largest class
sizes that fit; what is shorter than the last class goes to the class of small
pieces, whose bins are filled in order and cut at the capacity. When a worker
ends, the bins that are not full are emptied into the small class, and the very
last rest is cut into powers of two (sequences of such a length need no padding).

Each worker is one partition of the input, whatever its sizes: no shuffle, no
state beyond ``classes`` open bins, and a lost task rebuilds the same sequences
from the same partition. Sequence ids are (partition, counter) pairs in one long.

Defined results: null text is empty (the end id alone); null or repeated ids
are packed as separate documents; documents of any length are cut; an empty
table gives no rows.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from cauce.llm import tokens
from cauce.llm.common import ship

SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")
FULL_SCHEMA = SCHEMA + ", sequence_length long, padded_length long, ids binary"


def padded(length: int, capacity: int) -> int:
    """A sequence's stored length: the capacity, or itself at a power of two."""
    return length if length & (length - 1) == 0 else capacity


class Packer:
    """Cuts documents and fills bins; ``out`` gets (sequence, pieces) lists.
    A piece is (document index, start, length)."""

    def __init__(self, capacity: int, classes: int):
        self.capacity = capacity
        self.sizes = [capacity // j for j in range(1, classes + 1)]
        self.open: list[list] = [[] for _ in self.sizes]
        self.small: list = []
        self.room = capacity
        self.out: list[list] = []

    def _small(self, doc, start: int, length: int) -> None:
        while length:
            take = min(length, self.room)
            self.small.append((doc, start, take))
            start, length, self.room = start + take, length - take, self.room - take
            if not self.room:
                self.out.append(self.small)
                self.small, self.room = [], self.capacity

    def add(self, doc, length: int) -> None:
        start = 0
        for j, size in enumerate(self.sizes):
            while length - start >= size:
                bin_ = self.open[j]
                bin_.append((doc, start, size))
                start += size
                if len(bin_) == j + 1:
                    self.out.append(bin_)
                    self.open[j] = []
        self._small(doc, start, length - start)

    def finish(self) -> None:
        for j, bin_ in enumerate(self.open):
            for piece in bin_:
                self._small(*piece)
            self.open[j] = []
        rest, left = self.small, self.capacity - self.room
        self.small, self.room = [], self.capacity
        while left:
            room = 1 << (left.bit_length() - 1)
            left -= room
            seq = []
            while room:
                doc, start, length = rest.pop(0)
                take = min(room, length)
                seq.append((doc, start, take))
                room -= take
                if take < length:
                    rest.insert(0, (doc, start + take, length - take))
            self.out.append(seq)


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = 4096, classes: int = 16,
         end_id: int = 2, with_ids: bool = False) -> DataFrame:
    """One row per piece. ``with_ids`` adds the sequence's lengths and the
    piece's ids (little-endian unsigned 32-bit integers)."""
    path = tokenizer or tokens.default_path()
    ship(docs.sparkSession)

    def task(batches):
        enc, packer = tokens.encoder(path), Packer(capacity, classes)
        base = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 32
        held: dict[int, list] = {}  # document number -> [doc_id, ids, tokens not yet out]
        made, number = 0, 0

        def rows():
            nonlocal made
            cols: list[list] = [[] for _ in range(10)]
            for seq in packer.out:
                offset, total = 0, sum(p[2] for p in seq)
                for doc, start, length in seq:
                    entry = held[doc]
                    raw = entry[1][start:start + length].astype("<u4").tobytes()
                    for col, v in zip(cols, (entry[0], start, length, zlib.crc32(raw), len(entry[1]),
                                             base | made, offset, total, padded(total, capacity), raw)):
                        col.append(v)
                    offset += length
                    entry[2] -= length
                    if not entry[2]:
                        del held[doc]
                made += 1
            packer.out = []
            kinds = [pa.int64()] * 9 + [pa.binary()]
            n = 10 if with_ids else 7
            names = [f.split()[0] for f in FULL_SCHEMA.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols[:n], kinds)], names[:n])

        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for i in range(0, len(ids), tokens.PART):
                for doc_id, got in zip(ids[i:i + tokens.PART], enc.encode(texts[i:i + tokens.PART])):
                    held[number] = [doc_id, np.append(got, got.dtype.type(end_id)), len(got) + 1]
                    packer.add(number, len(got) + 1)
                    number += 1
                yield rows()
        packer.finish()
        yield rows()

    return docs.select("doc_id", "text").mapInArrow(task, FULL_SCHEMA if with_ids else SCHEMA)
