import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cauce.llm import tokens
from cauce.llm.packing import Packer, pack, padded
from llm.helpers import awkward, awkward_rows, frame


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 9000), max_size=60), st.sampled_from([64, 1000, 4096]), st.integers(1, 16))
def test_every_token_lies_in_one_piece(lengths, capacity, classes):
    p = Packer(capacity, classes)
    for i, n in enumerate(lengths):
        p.add(i, n)
    p.finish()
    pieces = {}
    for seq in p.out:
        assert 0 < sum(n for _, _, n in seq) <= capacity
        for d, a, n in seq:
            pieces.setdefault(d, []).append((a, n))
    for d, n in enumerate(lengths):
        at = 0
        for a, k in sorted(pieces.get(d, [])):
            assert a == at
            at += k
        assert at == n


def test_little_padding_and_fixed_counts():
    r = np.random.default_rng(1)
    p = Packer(4096, 16)
    total = 0
    for i, n in enumerate(r.integers(1, 6000, 500)):
        p.add(i, int(n))
        total += int(n)
    p.finish()
    assert sum(padded(sum(x[2] for x in s), 4096) for s in p.out) < 1.002 * total
    for s in p.out:  # a bin of a class holds exactly its fixed count
        sizes = {x[2] for x in s}
        if len(sizes) == 1 and (size := sizes.pop()) in p.sizes and sum(x[2] for x in s) > 4096 - 16:
            assert len(s) == p.sizes.index(size) + 1


def test_pieces_match_the_library(spark):
    rows = awkward_rows()
    got = pack(frame(spark, rows), with_ids=True).toPandas()
    lib = tokens.Encoder(tokens.default_path()).lib
    expected = sorted([(r[0] if r[0] is not None else -1), *[x for x in lib.encode(r[1] or "", add_special_tokens=False).ids], 2]
                      for r in rows)
    assert (got.groupby("sequence_id").length.sum() <= 4096).all()
    for _, seq in got.sort_values("offset").groupby("sequence_id"):
        assert list(seq.offset) == list(np.cumsum([0, *seq.length[:-1]]))
    assert sum(len(e) - 1 for e in expected) == got.length.sum()
    for raw, crc, n in zip(got.ids, got.ids_crc32, got.length):
        assert zlib.crc32(raw) == crc and len(raw) == 4 * n
    unique = got[got.doc_id == 8].sort_values("start")
    ids = np.frombuffer(b"".join(unique.ids), "<u4").tolist()
    assert [8, *ids] == next(e for e in expected if e[0] == 8) and (unique.doc_tokens == len(ids)).all()


def test_encoder_is_the_library_on_odd_texts():
    enc = tokens.Encoder(tokens.default_path())
    texts = ["It's we'RE <|endoftext|> x", "Ⅷ ½ ² ª\x00\x1f", "ΑΣ Σ", "İI", "á é", "tab\tnew\nline",
             "don't!!'s", "_x__y-", "数字 123", "", None, "a" * 300]
    for t, ids in zip(texts, enc.encode(texts)):
        assert ids.tolist() == enc.lib.encode(t or "", add_special_tokens=False).ids


def test_empty_table_and_reruns(spark):
    assert pack(frame(spark, [])).count() == 0
    d = awkward(spark).repartition(3, "doc_id")
    assert sorted(map(tuple, pack(d).collect()), key=str) == sorted(map(tuple, pack(d).collect()), key=str)


@pytest.mark.parametrize("length,stored", [(4096, 4096), (2048, 2048), (1, 1), (3000, 4096)])
def test_padding_rule(length, stored):
    assert padded(length, 4096) == stored
