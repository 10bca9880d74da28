import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cauce.llm import syncmers as M
from llm.helpers import awkward_rows, frame, plain, words


def brute_anchors(text):
    def mix(x):
        m = (1 << 64) - 1
        x ^= x >> 31
        x = x * int(M._MIX) & m
        return x ^ x >> 29

    def h(part):
        v = 0
        for c in part:
            v = (v * int(M._MIX) + ord(c)) & ((1 << 64) - 1)
        return mix(v)
    out = []
    for i in range(len(text) - M.K + 1):
        inner = [h(text[i + j:i + j + M.S]) for j in range(M.K - M.S + 1)]
        if min(inner) in (inner[0], inner[-1]):
            out.append((h(text[i:i + M.K]), i))
    return out


def test_anchors_are_brute_force(monkeypatch):
    for t in (words(60, 1), "ab" * 60, "é😀漢" * 20, words(3, 2)[:M.K]):
        h, at = M.anchors(t)
        assert list(zip(h.tolist(), at.tolist())) == brute_anchors(t)
    t = words(200, 3)
    whole = M.anchors(t)
    monkeypatch.setattr(M, "PIECE", 100)  # pieces give what the whole text gives
    assert all((a == b).all() for a, b in zip(whole, M.anchors(t)))


def test_anchors_do_not_depend_on_context():
    passage = words(80, 4)
    h, at = M.anchors("x" * 50 + words(30, 5) + passage + words(20, 6))
    own = set(M.anchors(passage)[0].tolist())
    assert own <= set(h.tolist())


def test_likeness():
    a, b = words(900, 7), words(900, 8, kinds=300)
    x, y = M.sketch(a), M.sketch(b)
    assert M.likeness(x, x) == 1 and M.likeness(x, y) < 0.1
    assert M.likeness(M.sketch("pre " + a), x) > 0.9
    swapped = a[len(a) // 2:] + " " + a[:len(a) // 2]  # same anchors, but at two shifts
    assert 0.3 < M.likeness(M.sketch(swapped), x) < 0.75
    assert M.likeness(M.sketch(""), M.sketch("")) == 1 and M.likeness(M.sketch(""), x) == 0


def follow(rows):
    """Documents with their next: descending ids, nulls last."""
    def tie(r):
        return (r[0] is None, -(r[0] or 0))
    order = sorted(rows, key=tie)
    return [(r, order[(i + 1) % len(order)]) for i, r in enumerate(order)]


def test_edited_texts(spark):
    rows = [r for r in awkward_rows()[:-3]]  # distinct ids
    got = {r.doc_id: r for r in M.fingerprints(frame(spark, rows)).collect()}
    assert len(got) == len(rows)
    for own, nxt in follow(rows):
        t, n = own[1] or "", nxt[1] or ""
        e = t[:len(t) - len(t) // 3] + n[:len(t) // 3]
        r = got[own[0]]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(e.encode()).hexdigest())
        assert r.fingerprint == M.written(M.sketch(t)) and r.edited_fingerprint == M.written(M.sketch(e))
        assert np.isclose(r.near_next, M.likeness(M.sketch(t), M.sketch(n)))
        assert np.isclose(r.near_edited, M.likeness(M.sketch(t), M.sketch(e)))
    assert len({got[i].fingerprint for i in (5, 6)}) == 1


def test_repeated_and_null_ids_and_small_tables(spark):
    rows = awkward_rows()
    assert M.fingerprints(frame(spark, rows)).count() == len(rows)
    assert M.fingerprints(frame(spark, [])).count() == 0
    one = M.fingerprints(plain(spark, [words(100, 9)])).collect()
    assert len(one) == 1 and one[0].near_next == 1
    nulls = frame(spark, rows[-2:])
    assert M.fingerprints(nulls).count() == 2


def test_many_ranges(spark):
    n = 500
    d = plain(spark, [words(12, i) for i in range(n)])
    got = {r.doc_id: r.edited_sha256 for r in M.fingerprints(d).collect()}
    texts = [words(12, i) for i in range(n)]
    for i in range(n):
        t, nxt = texts[i], texts[i - 1]
        assert got[i] == hashlib.sha256((t[:len(t) - len(t) // 3] + nxt[:len(t) // 3]).encode()).hexdigest()


def brute_likeness(a, b):
    x, y = ([(int(h), int(p)) for h, p in zip(*M.anchors(t))] for t in (a, b))
    where = {}
    for h, p in y:
        where.setdefault(h, []).append(p)
    fits = {}
    for h, p in x:
        for q in where.get(h, ()):
            fits.setdefault(p - q, set()).add(h)
    most = max((len(set().union(*(fits[d] for d in fits if s <= d <= s + M.SLACK))) for s in fits), default=0)
    return most / len({h for h, _ in x} | {h for h, _ in y})


@pytest.mark.parametrize("pairs", [1 << 20, 3])
def test_long_texts_with_a_shared_passage(monkeypatch, pairs):
    passage = words(60, 50, kinds=5000)
    a = words(2500, 51, kinds=5000) + " " + passage + " " + words(1500, 52, kinds=5000)
    b = words(700, 53, kinds=5000) + " " + passage + " " + words(3000, 54, kinds=5000)
    own = len(M.anchors(passage)[0])
    monkeypatch.setattr(M, "PAIRS", pairs)
    x, y = M.sketch(a), M.sketch(b)
    assert len(x[0]) == len(M.anchors(a)[0]) > 1000
    assert M.likeness(x, y) == brute_likeness(a, b) >= 0.9 * own / (len(x[0]) + len(y[0]))
    for c, d in (("ab" * 300 + passage, "q" + "ab" * 200 + passage), (passage * 3, "zz" + passage * 2), (passage, a)):
        assert M.likeness(M.sketch(c), M.sketch(d)) == brute_likeness(c, d)
    changed = a[:9000] + words(20, 55) + a[9000:]  # only a few anchors are others
    assert 0 < M.likeness(x, M.sketch(changed)) < 1 and M.written(x) != M.written(M.sketch(changed))


def test_fingerprint_names_every_anchor():
    t = words(3000, 56)
    got = [p.split(":") for p in M.written(M.sketch(t)).split(".")]
    assert sorted((int(h, 16), int(p, 16)) for h, p in got) == sorted(zip(*(v.tolist() for v in M.anchors(t))))


@given(st.text("ab é😀", max_size=80), st.text("ab é😀", max_size=80))
@settings(max_examples=300, deadline=None)
def test_spliced_sketch_is_that_of_the_edited_text(text, following):
    changed = M.edited(text, following)
    got = M.spliced(text, M.sketch(text), following, M.sketch(following), changed)
    assert all(a.tolist() == b.tolist() for a, b in zip(got, M.sketch(changed)))


def test_spliced_sketches_of_long_and_short_texts():
    texts = ["", "a", words(3, 1)[:15], words(4, 2)[:16], words(9, 3), words(400, 4), "ab" * 900, words(5000, 5)]
    for a in texts:
        for b in texts:
            got = M.spliced(a, M.sketch(a), b, M.sketch(b), M.edited(a, b))
            assert all(x.tolist() == y.tolist() for x, y in zip(got, M.sketch(M.edited(a, b))))


def test_dense_form_is_whole_and_short(spark):
    texts = ["", "a", words(3, 1)[:15], words(4, 2)[:16], words(400, 4), "ab" * 900, "x" * 5000, "é😀漢" * 50, words(5000, 5)]
    for t in texts:
        mark = M.sketch(t)
        got = M.undense(M.dense(mark))
        assert all(a.dtype == b.dtype and a.tolist() == b.tolist() for a, b in zip(got, mark))
        assert len(M.dense(mark)) <= 0.65 * len(M.written(mark))
    edge = np.array([0, 1, (1 << 32) - 1, 1 << 32, (1 << 64) - 1], np.uint64), np.array([40, 0, 11, 22, 33])
    assert all(a.tolist() == b.tolist() for a, b in zip(M.undense(M.dense(edge)), edge))
    rows = awkward_rows()[:-3]
    plain_form = {r.doc_id: r for r in M.fingerprints(frame(spark, rows)).collect()}
    for r in M.fingerprints(frame(spark, rows), form=M.dense).collect():
        p = plain_form[r.doc_id]
        assert M.written(M.undense(r.fingerprint)) == p.fingerprint
        assert M.written(M.undense(r.edited_fingerprint)) == p.edited_fingerprint
        assert r[:3] == p[:3] and r[5:] == p[5:]


def test_the_query_writes_the_dense_form(spark, tmp_path):
    from cauce.llm.queries import QUERIES
    texts = {i: words(40, i) for i in range(20)}
    plain(spark, list(texts.values())).select("doc_id", "text").write.parquet(f"{tmp_path}/documents.parquet")
    for r in QUERIES["op6_syncmers"](spark, str(tmp_path)).collect():
        assert r.fingerprint == M.dense(M.sketch(texts[r.doc_id]))
        assert r.edited_fingerprint == M.dense(M.sketch(M.edited(texts[r.doc_id], texts[(r.doc_id - 1) % 20])))
