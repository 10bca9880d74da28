import random
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from cauce.llm import mixing
from cauce.llm.mixing import fit, mix, mixed_rows, reachable
from llm.helpers import awkward, awkward_rows, frame, plain, words


@settings(max_examples=80, deadline=None)
@given(st.dictionaries(st.integers(1, 12), st.integers(1, 4), min_size=1, max_size=5), st.integers(0, 60))
def test_knapsack_is_brute_force(items, budget):
    sizes, counts = np.array(list(items)), np.array(list(items.values()))
    sums = {0}
    for s, c in items.items():
        sums = {x + s * k for x in sums for k in range(c + 1)}
    best, used = reachable(sizes, counts, budget)
    assert best == max(x for x in sums if x <= budget) == sum(s * k for s, k in used.items())
    assert all(k <= items[s] for s, k in used.items())


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(0, 300), st.integers(1, 50), min_size=1, max_size=40), st.floats(0, 1))
def test_fit_is_near_and_within_counts(items, share):
    sizes = np.array(sorted(items))
    counts = np.array([items[s] for s in sizes])
    budget = share * (sizes * counts).sum()
    take = fit(sizes, counts, budget)
    assert (take >= 0).all() and (take <= counts).all()
    assert abs((take * sizes).sum() - budget) <= sizes.max() + 1


def expected_targets(totals, weights=(3, 1, 2), share=1.5):
    names = sorted((s for s in totals if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in totals)
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    budget, target, free = share * sum(totals.values()), {}, set(names)
    while free:
        level = (budget - sum(target.values())) / sum(w[s] for s in free)
        over = [s for s in free if level * w[s] > 2 * totals[s]]
        if not over:
            target.update({s: level * w[s] for s in free})
            break
        for s in over:
            target[s] = 2.0 * totals[s]
            free.discard(s)
    return target


def held_against_rules(df, rows):
    got = mix(df).collect()
    totals = defaultdict(int)
    for r in rows:
        totals[r[3]] += len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or ""))
    target, taken = expected_targets(totals), defaultdict(int)
    assert len(got) == len(rows)
    for r in got:
        assert r.source_size == totals[r.source] and abs(r.target - target[r.source]) < 1e-6 * max(1, r.target)
        assert r.taken == r.copies * r["size"] and 0 <= r.copies <= 2
        taken[r.source] += r.taken
    return {s: taken[s] - target[s] for s in totals}


def test_awkward_documents(spark):
    held_against_rules(awkward(spark), awkward_rows())


def test_near_targets_and_reruns(spark):
    r = random.Random(3)
    n = 900
    texts = [words(r.randint(0, 60), i) if i % 3 else words(20, 7) for i in range(n)]  # a third of one size
    sources = ["hot" if i % 3 == 0 else r.choice(["a", "é", "Z", "b"]) for i in range(n)]
    d = plain(spark, texts, sources)
    off = held_against_rules(d, [(i, t, "en", s) for i, (t, s) in enumerate(zip(texts, sources))])
    assert all(abs(x) <= 20 for x in off.values())  # of one size only, a source can't come nearer
    a = sorted((x.doc_id, x.taken) for x in mix(d).collect())
    assert a == sorted((x.doc_id, x.taken) for x in mix(d.repartition(5)).collect())
    assert a != sorted((x.doc_id, x.taken) for x in mix(d, seed=99).collect())


def test_cut_part_is_ranked(spark, monkeypatch):
    monkeypatch.setattr(mixing, "PART", 8)
    texts, sources = [words(10, i) for i in range(400)], ["a", "b"] * 200
    off = held_against_rules(plain(spark, texts, sources), [(i, t, "en", s) for i, (t, s) in enumerate(zip(texts, sources))])
    assert all(abs(x) <= 10 for x in off.values())


def test_rows_of_the_mix(spark):
    d = awkward(spark)
    out = mixed_rows(d)
    assert out.columns == d.columns
    assert out.count() == sum(x.copies for x in mix(d).collect())
    assert mix(frame(spark, [])).count() == 0 and mixed_rows(frame(spark, [])).count() == 0


def test_knapsack_of_a_very_long_text_is_bounded():
    """A text of 10 million words among 3,600 sizes: the programme's sets of sums
    stay far below a worker's memory, and the sum is the one wanted."""
    sizes = np.append(10_000_000, np.arange(3600, 0, -1) * 3)
    counts = np.append(1, np.full(3600, 9))
    tracemalloc.start()
    best, used = reachable(sizes, counts, 40_000_000)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert best == sum(s * k for s, k in used.items()) and best > 39_999_990
    assert all(k <= 9 for s, k in used.items() if s < 10_000_000)
    assert peak < 500 << 20


def same_keys(spark):
    """A third of the rows share a null id, one source and one size: some agree in
    every column, others in the key only."""
    base = [(i, words(i % 30 + 1, i), "en", "ab"[i % 2]) for i in range(300)]
    hot = [(None, words(12, i % 40), "en", "a") for i in range(150)]
    return base + hot, frame(spark, [r + (1, 0, "k", "f", "r", 0.0, "s", 1) for r in base + hot])


def test_hot_key_is_counted_not_ranked(spark, monkeypatch):
    rows, d = same_keys(spark)
    for part, copies in ((200, 10_000), (5, 4)):
        monkeypatch.setattr(mixing, "PART", part)
        monkeypatch.setattr(mixing, "COPIES", copies)
        off = held_against_rules(d, rows)
        assert all(abs(x) <= 30 for x in off.values())
        want, got = Counter(), Counter()
        for x in mix(d).collect():
            want[x.doc_id, x.source, x["size"]] += x.copies
        before = Counter((r[0], r[1], r[3]) for r in rows)
        out = mixed_rows(d).collect()
        for x in out:
            got[x.doc_id, x.source, len(x.text.split())] += 1
        assert got == +want
        for k, n in Counter((x.doc_id, x.text, x.source) for x in out).items():
            assert n <= 2 * before[k]


def test_no_window_holds_a_hot_key(spark, monkeypatch):
    """Rows of one key that differ in their text are ranked in parts."""
    monkeypatch.setattr(mixing, "PART", 10)
    d = frame(spark, [(None, words(12, i), "en", "a", 1, 0, "k", "f", "r", 0.0, "s", 1) for i in range(400)]
              + [(i, words(9, i), "en", "b", 1, 0, "k", "f", "r", 0.0, "s", 1) for i in range(200)])
    out = mixed_rows(d).collect()
    taken = Counter(x.text for x in out if x.doc_id is None)
    assert len(out) == sum(x.copies for x in mix(d).collect()) and max(taken.values()) - min(taken.values()) <= 1
