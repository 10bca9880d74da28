import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cauce.llm import rangecoder as R
from cauce.llm import tokens
from llm.helpers import awkward_rows, frame, plain, words


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 999), max_size=700), st.integers(1, 3))
def test_round_trip(ids, times):
    x = np.array(ids * times, np.int64)
    assert R.decode_block(R.encode_block(x, 1000)).tolist() == x.tolist()


@pytest.mark.parametrize("n", [0, 1, 2, 127, 128, 257, 40_000])
def test_round_trip_sizes_and_extremes(n):
    r = np.random.default_rng(n)
    for x in (r.integers(0, 49408, n), np.full(n, 49407), np.minimum(r.geometric(0.01, n), 49407)):
        assert (R.decode_block(R.encode_block(x, 49408)) == x).all()


def test_prediction_pays():
    r = np.random.default_rng(1)
    x = np.minimum(r.geometric(0.02, 60_000), 999)
    p = np.bincount(x) / len(x)
    order0 = -(p[p > 0] * np.log2(p[p > 0])).sum() * len(x) / 8
    assert len(R.encode_block(x, 1000)) < 1.12 * order0
    loop = np.tile(r.integers(0, 1000, 500), 120)  # order 2 knows what follows
    assert len(R.encode_block(loop, 1000)) < 0.25 * 1.25 * len(loop)


def test_damage_is_found():
    x = np.random.default_rng(2).integers(0, 1000, 5000)
    raw, found = R.encode_block(x, 1000), 0
    for at in range(300, len(raw), 251):
        bad = bytearray(raw)
        bad[at] ^= 1
        try:  # bits that no id depends on may change unseen
            assert (R.decode_block(bytes(bad)) == x).all()
        except ValueError:
            found += 1
    assert found > 20
    with pytest.raises(ValueError):
        R.decode_block(b"nothing of it")


def test_points_are_found_in_any_order():
    r = np.random.default_rng(3)
    m = R.Model(1000)
    m.count[:] = r.integers(1, 5000, 1000)
    m.sum()
    points = np.concatenate([m.below[:-1], m.below[1:] - 1, r.integers(0, m.below[-1], 3000)])
    assert (m.find(points) == np.searchsorted(m.below, points, "right") - 1).all()
    assert m.find(points[:0]).tolist() == []


def test_an_entry_keeps_the_candidate_it_trusts():
    m = R.Model(1000)
    nothing = np.zeros(1, np.int64)
    for ids, known, conf in ((7, 7, 1), (7, 7, 2), (7, 7, 3), (9, 7, 1), (9, 9, 1), (9, 9, 2)):
        m.learn(m.contexts(nothing, nothing)[0], np.array([ids]))
        for table, at, _, _ in m.contexts(nothing, nothing)[0]:  # both orders
            assert (table[at][0] >> 4, table[at][0] & 15) == (known, conf)


def test_blocks_of_the_former_model_are_refused():
    raw = R.encode_block(np.arange(500) % 7, 1000)
    with pytest.raises(ValueError):
        R.decode_block(b"CMR1" + raw[4:])


def expected(rows):
    lib = tokens.Encoder(tokens.default_path()).lib
    out, start = [], 0
    for r in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array(lib.encode(r[1] or "", add_special_tokens=False).ids + [2], "<u4")
        out.append((r[0], start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_documents(spark):
    rows = [r for r in awkward_rows()[:-2]]
    got = [tuple(x) for x in R.round_trip(frame(spark, rows)).collect()]
    assert sorted(got, key=lambda x: x[1]) == expected(rows)
    assert R.round_trip(frame(spark, [])).count() == 0


def test_null_ids_come_first(spark):
    got = R.round_trip(frame(spark, awkward_rows())).collect()
    assert {x.start < 20 for x in got if x.doc_id is None} == {True} and len(got) == len(awkward_rows())


def test_many_blocks(spark):
    texts = [words(30, i) for i in range(300)]
    d = plain(spark, texts)
    written = R.blocks(d, block=200).cache()
    assert written.count() > 30
    got = sorted(map(tuple, R.read_blocks(written).collect()))
    assert got == expected(list(enumerate(texts)))
