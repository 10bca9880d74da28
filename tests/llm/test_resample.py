import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from cauce.llm import resample as M
from llm.helpers import awkward, awkward_rows, frame, plain, words


def brute_features(text, longest):
    t = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t)
    runs = [" ".join(w[i:i + k]) for k in range(1, longest + 1) for i in range(len(w) - k + 1)]
    return len(w), [zlib.crc32(r.encode()) for r in runs]


def brute(rows, target, longest=1, buckets=10_000, share=10, min_words=20, seed=2024):
    made = [brute_features(r[1], longest) for r in rows]
    s, t = Counter(), Counter()
    for _, f in made:
        s.update(h % buckets for h in f)
    for x in target:
        t.update(h % buckets for h in brute_features(x, longest)[1])
    big_s, big_t = sum(s.values()), sum(t.values())

    def gain(b):
        return math.floor(1000 * math.log((t[b] + 1) * (big_s + buckets) / ((s[b] + 1) * (big_t + buckets))))
    out = []
    for r, (n_words, f) in zip(rows, made):
        weight = sum(gain(h % buckets) for h in f) // len(f) if f else 0
        name = f"{seed}:{'' if r[0] is None else r[0]}"
        h = int(hashlib.sha256(name.encode()).hexdigest()[:8], 16)
        out.append([r[0], len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n_words])
    fit = sorted((x for x in out if x[5] >= min_words), key=lambda x: (-x[3], x[0] is None, x[0] or 0, x[1]))
    for k, x in enumerate(fit[:share * len(fit) // 100]):
        x[4] = k + 1
    return sorted((tuple(x[:5]) for x in out), key=str)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_words_are_the_pattern(monkeypatch):
    every = "".join(map(chr, range(1, 300))) + "A1b É😀_x\x7fy Ω-ω"
    pattern = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), every))
    assert [w.decode() for part in M.word_lists(every.encode()) for w in part] == pattern
    monkeypatch.setattr(M, "PIECE", 7)
    assert [w.decode() for part in M.word_lists(every.encode()) for w in part] == pattern


@pytest.mark.parametrize("longest", [1, 2, 4])
def test_chained_hashes_are_those_of_joined_runs(monkeypatch, longest):
    for t in ("", "one", "a b", words(300, 1) + " É 😀 end"):
        whole = brute_features(t, longest)[1]
        for piece in (1 << 22, 40, 1):
            monkeypatch.setattr(M, "PIECE", piece)
            got = [h for _, seeds in M.run_hashes(t.encode(), longest) for h in seeds]
            assert sorted(got) == sorted(whole)


@pytest.mark.parametrize("longest", [1, 3])
def test_draw_is_brute_force(spark, monkeypatch, longest):
    monkeypatch.setattr(M, "HELD", 50)
    texts = [words(5 + i % 60, i, kinds=40 + i) for i in range(400)]
    target = [words(50, 1000 + i, kinds=30) for i in range(20)] + [None, ""]
    got = M.resample(plain(spark, texts), plain(spark, target), longest)
    rows = list(enumerate(texts))
    assert result(got) == brute(rows, target, longest)
    assert [k for k, _ in got.dtypes] == ["doc_id", "n_features", "weight", "score", "rank"]
    assert {t for _, t in got.dtypes} == {"bigint"}


def test_awkward_tables(spark):
    rows = awkward_rows()
    target = [words(200, 3), None]
    assert result(M.resample(awkward(spark), plain(spark, target), share=40)) == brute(rows, target, share=40)
    assert result(M.resample(frame(spark, []), plain(spark, target))) == []
    assert result(M.resample(frame(spark, rows[:3]), plain(spark, target))) == brute(rows[:3], target)
    assert result(M.resample(awkward(spark), frame(spark, []), share=100)) == brute(rows, [], share=100)


def test_equal_rows_have_ranks_of_their_own(spark, monkeypatch):
    monkeypatch.setattr(M, "STEP", 7)
    same = words(40, 5)
    rows = [(None, same)] * 120 + [(7, same)] * 100 + [(i, words(30, i)) for i in range(100, 220)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = M.resample(df, plain(spark, [same]), share=50)
    assert result(got) == brute(rows, [same], share=50)
    ranks = sorted(r.rank for r in got.collect() if r.rank)
    assert ranks == list(range(1, 171))


def test_drawn_documents_are_nearer_to_the_target(spark):
    """Of two kinds of text, the draw mostly takes the target's kind."""
    pool = sorted(set(words(3000, 1, kinds=400).split()))
    r = np.random.default_rng(2)

    def text(own, n):
        return " ".join(str(w) for w in r.choice([w for i, w in enumerate(pool) if (i % 4 == 0) == own], n))
    kinds = [text(i % 4 == 0, 40) for i in range(800)]
    target = [text(True, 60) for _ in range(100)]
    drawn = [r.doc_id for r in M.resample(plain(spark, kinds), plain(spark, target)).collect() if r.rank]
    assert len(drawn) == 80 and np.mean([i % 4 == 0 for i in drawn]) > 0.6
