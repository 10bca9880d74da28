import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cauce.llm import suffix_dedup as D
from llm.helpers import awkward_rows, frame, plain


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=200))
def test_suffix_array_and_common_prefixes(symbols):
    t = np.array(symbols, np.int64)
    n = len(t)
    sa, rank = D.suffix_array(t)
    assert sa.tolist() == sorted(range(n), key=lambda i: symbols[i:])
    assert all(rank[s] == i for i, s in enumerate(sa))
    lcp = D.common_prefixes(t, sa)
    for i in range(1, n):
        a, b, k = sa[i - 1], sa[i], 0
        while max(a, b) + k < n and t[a + k] == t[b + k]:
            k += 1
        assert lcp[i] == k


def brute(texts, width=400):
    seen, out = {}, []
    for t in texts:
        for i in range(len(t) - width + 1):
            seen[t[i:i + width]] = seen.get(t[i:i + width], 0) + 1
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - width + 1):
            if seen[t[i:i + width]] > 1:
                gone[i:i + width] = True
        runs = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        out.append((len(t), int(gone.sum()), runs, hashlib.sha256(np.frombuffer(t, np.uint8)[~gone].tobytes()).hexdigest()))
    return out


def held(df, rows):
    got = D.dedup(df).collect()
    expected = [(r[0], *b) for r, b in zip(rows, brute([(r[1] or "").encode() for r in rows]))]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, expected))
    return got


def text(r, n):
    return "".join(r.choice("abcde ") for _ in range(n))


def test_planted_repeats(spark):
    r = random.Random(1)
    a, b, c = text(r, 700), text(r, 450), text(r, 399)
    texts = [a, a, "x" + a[100:] + "y", b + c, c + text(r, 100) + b, c, None, "", text(r, 300), "ab" * 900, "ab" * 700 + "q",
             a[:390] + a[-395:], text(r, 60) + a[150:600] + text(r, 50) + b[10:440] + a[:500], "é" * 600, b[:400], b[:399]]
    rows = list(enumerate(texts))
    got = held(plain(spark, texts), rows)
    assert sum(x.n_removed for x in got) > 5000
    assert {x.n_removed for x in got if x.doc_id in (5, 6, 7, 8)} == {0}


@pytest.mark.parametrize("limit", [2, 5])
def test_an_anchor_split_over_shards(spark, monkeypatch, limit):
    monkeypatch.setattr(D, "SHARD_CONTEXTS", limit)
    monkeypatch.setattr(D, "SHARD_BYTES", 3000)
    r = random.Random(2)
    a = text(r, 700)
    texts = ([text(r, r.randint(0, 300)) + a + text(r, r.randint(0, 500)) for _ in range(25)]
             + [text(r, 30) + a[r.randint(0, 300):] + text(r, 30) for _ in range(25)]
             + ["zz" + a[10:420] + "q", "r" + a[-410:]])
    held(plain(spark, texts), list(enumerate(texts)))


def test_long_texts_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(D, "BITS", 11)
    r = random.Random(3)
    a = text(r, 3000)
    texts = [text(r, 1700) + a + text(r, 900), a, text(r, 500) + a[100:2900], text(r, 5000)]
    held(plain(spark, texts), list(enumerate(texts)))


def test_awkward_documents(spark):
    rows = [r for r in awkward_rows() if r[1] is None or len(r[1]) < 6000]
    held(frame(spark, rows), rows)
    assert D.dedup(frame(spark, [])).count() == 0


def test_kept_bytes(spark):
    r = random.Random(4)
    a, x, y = text(r, 500), text(r, 40), text(r, 60)
    got = {g.doc_id: bytes(g.kept) for g in D.dedup(plain(spark, [x + a, a + y]), with_text=True).collect()}
    assert got == {0: x.encode(), 1: y.encode()}


def test_repeated_rows_are_cut_once(spark, monkeypatch):
    r = random.Random(5)
    a = text(r, 900)
    rows = [(None, text(r, 50) + a + text(r, 50))] * 300 + [(1, text(r, 70) + a[100:800] + text(r, 90))]
    seen, real = [], D.shard_repeats

    def counted(contexts, *more):
        seen.append((contexts.count(), contexts.select("key", "lo").distinct().count()))
        return real(contexts, *more)
    monkeypatch.setattr(D, "shard_repeats", counted)
    held(frame(spark, [x + ("en", "s", 1, 0, "k", "f", "r", 0.0, "s", 1) for x in rows]), rows)
    assert seen[0][0] == seen[0][1] > 0


@pytest.mark.parametrize("size", [399, 400, 401, 650])
def test_planted_repeats_around_the_width(spark, size):
    """A passage of ``size`` bytes in many documents goes whole from 400 bytes on,
    and stays whole below; documents without it keep every byte."""
    r = random.Random(size)

    def letters(n, of="abcdefghijklmnopqrstuvwxyz "):
        return "".join(r.choice(of) for _ in range(n))
    passage = letters(size)
    planted = {i: letters(300 + 7 * i) + "<" + passage + ">" + letters(200) for i in range(12)}
    # the neighbours of the passage differ, so that no repeat is longer than planted
    planted = {i: t.replace("<", chr(65 + i)).replace(">", chr(65 + (5 * i + 1) % 12)) for i, t in planted.items()}
    clean = {100 + i: letters(900) for i in range(12)}
    rows = [(i, t) for i, t in {**planted, **clean}.items()]
    got = {x.doc_id: x for x in D.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    gone = size if size >= 400 else 0
    for i, t in planted.items():
        kept = t.replace(passage, "") if gone else t
        assert (got[i].n_bytes, got[i].n_removed, got[i].n_spans) == (len(t), gone, int(gone > 0))
        assert got[i].kept_sha256 == hashlib.sha256(kept.encode()).hexdigest()
    assert all((got[i].n_removed, got[i].n_bytes) == (0, 900) for i in clean)
