import re
import zlib
from collections import Counter

import numpy as np
import pytest

from cauce.llm import spelling as M
from llm.helpers import awkward, awkward_rows, frame, plain, words


def brute_words(rows, least=2):
    n = Counter()
    for i, t, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 7:
                n[run] += 1
    return {w: k for w, k in n.items() if k >= least}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def brute(n, ratio=10):
    form, near = {}, {}
    for w in n:
        found = [x for x in n if one_edit(w, x)]
        near[w] = len(found)
        top = min(found, key=lambda x: (-n[x], x), default=None)
        form[w] = top if top is not None and n[top] >= ratio * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n[w], near[w], n.get(form[w])))
    return out


def result(df):
    rows = [(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def vocabulary(seed, kinds=40):
    """Words with variants of variants, and runs of one letter, where the place
    of an inserted letter is open."""
    r = np.random.default_rng(seed)
    letters = "abcé"
    out = []
    for _ in range(kinds):
        w = "".join(r.choice(list(letters), int(r.integers(6, 13))))
        for k in range(6):
            out.append(w)
            p = int(r.integers(0, len(w) + 1))
            kind = int(r.integers(0, 3))
            w = w[:p] + ("" if kind == 2 else str(r.choice(list(letters)))) + w[p + (kind > 0):]
    return out + ["a" * k for k in range(6, 12)] + ["aaaaaab", "baaaaaa", "aaabaaa"]


@pytest.mark.parametrize("segments,block,side", [(4, 4096, 256), (4, 4, 3), (2, 16, 256), (1, 32, 4)])
def test_near_words_are_brute_force(spark, monkeypatch, segments, block, side):
    monkeypatch.setattr(M, "SIDE", side)
    n = {w: 1 + i % 50 for i, w in enumerate(sorted(set(vocabulary(1)))) if len(w) >= 7}
    df = spark.createDataFrame(list(n.items()), "word string, n long")
    got = {r.word: (r.n_near, r.best, r.best_n) for r in M.near_words(df, segments, block).collect()}
    want = {}
    for w in n:
        found = [x for x in n if one_edit(w, x)]
        if found:
            top = min(found, key=lambda x: (-n[x], x))
            want[w] = (len(found), top, n[top])
    assert got == want


def test_variants_are_brute_force(spark):
    r = np.random.default_rng(2)
    kinds = vocabulary(3, 60)
    texts = [" ".join(str(r.choice(kinds)).capitalize() if r.random() < 0.2 else kinds[min(int(r.exponential(20)), len(kinds) - 1)]
                      for _ in range(80)) for _ in range(60)]
    texts += [None, "", "É ÀÉÎÕÜÿ× ÀÉÎÕÜÿ× àéîõüÿ× x2y", "straßenbahn STRASSENBAHN Straßenbahn straßenbahn"]
    rows = [(i, t) for i, t in enumerate(texts)]
    got = result(M.group_variants(plain(spark, texts)))
    assert got == brute(brute_words(rows))
    assert any(f is not None and root != f for _, f, root, *_ in got) or len(got) > 50


def test_chain_of_forms_is_followed(spark):
    n = {"abcdefg": 2, "abcdefgh": 20, "abcdefghi": 200, "abcdefghij": 2000, "abcdefghijk": 20000}
    rows = [(w, f) for w, f in zip(list(n), list(n)[1:])]
    got = M.follow(spark.createDataFrame(rows, "word string, form string"), 20000, 2, 10)
    assert {r.word: r.root for r in got.collect()} == {w: "abcdefghijk" for w, _ in rows}


def test_awkward_tables(spark):
    rows = awkward_rows()
    got = result(M.group_variants(awkward(spark)))
    assert got == brute(brute_words(rows))
    assert "x" * 5000 not in {r[0] for r in got}  # once only
    twice = frame(spark, rows + rows)
    assert result(M.group_variants(twice)) == brute(brute_words(rows + rows))
    assert result(M.group_variants(frame(spark, []))) == set()
    assert result(M.group_variants(frame(spark, rows[:3]))) == set()


def test_very_long_words(spark):
    long = "ab" * 6000
    texts = [long, long, long + "c", long + "c", long[:5000] + "z" + long[5001:], "q" * 30 + " " + "q" * 30] * 2
    got = {r[0]: r[4] for r in result(M.group_variants(plain(spark, texts), every=10 ** 9))}
    assert got[long] == 2 and got[long + "c"] == 1 and got["q" * 30] == 0


def test_a_third_of_all_words_in_one_tile(spark):
    """Words that agree in all but a few letters crowd one tile: every pair of
    its blocks is a group, and nothing is lost."""
    r = np.random.default_rng(4)
    letters = list("abcdefghijklmnopqrstuvwxyz")
    crowd = {"prefix" + "".join(r.choice(letters, 3)) for _ in range(900)}
    others = {w for w in words(6000, 9, kinds=3000).split() if len(w) >= 7}
    n = {w: 2 for w in crowd | others}
    df = spark.createDataFrame(list(n.items()), "word string, n long")
    got = {x.word: x.n_near for x in M.near_words(df, block=64).collect()}
    near = Counter()
    crowd = sorted(crowd)
    for i, a in enumerate(crowd):
        for b in crowd[:i]:
            if one_edit(a, b):
                near[a] += 1
                near[b] += 1
    assert {w: k for w, k in got.items() if w in near} == dict(near)
    sizes = M._dealt(M.tile_entries(df), 64).groupBy("m", "segment", "key", "lo", "hi").count()
    assert sizes.agg({"count": "max"}).first()[0] <= 2 * 64
