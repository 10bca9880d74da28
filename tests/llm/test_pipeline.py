import pytest

import corpus_pipeline as P
from cauce.llm import mixing, packing, quality, secret_scan, simhash
from cauce.llm.common import stage
from conftest import SF001

NAMES = ["quality", "near_duplicates", "secrets", "mixing", "packing"]


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    out = [docs]
    for _, step in P.STAGES:
        docs = stage(step(spark, docs, SF001))
        out.append(docs)
    return out


def test_stages_and_columns(stages):
    assert [n for n, _ in P.STAGES] == NAMES
    for s in stages[:-1]:
        assert s.columns == stages[0].columns


def test_each_decision_takes_effect(spark, stages):
    docs, good, single, clean, mixed, packed = [s.toPandas() for s in stages]
    labels = spark.read.parquet(f"{SF001}/labels.parquet")
    q = quality.score(stages[0], labels).toPandas()
    assert sorted(good.doc_id) == sorted(q.doc_id[q.predicted == 1])
    near = simhash.near_duplicates(stages[1]).toPandas()
    assert sorted(single.doc_id) == sorted(near.groupby("root").component_id.first())
    found = secret_scan.find_secrets(stages[2]).toPandas().set_index("doc_id")
    before, after = single.set_index("doc_id").text, clean.set_index("doc_id").text
    for i in before.index:
        assert (before[i] == after[i]) == (not found.spans[i])
        if found.spans[i]:
            assert "[SECRET]" in after[i]
    taken = mixing.mix(stages[3]).toPandas().set_index("doc_id")
    copies = mixed.groupby("doc_id").size()
    assert all(copies.get(i, 0) == taken.copies[i] for i in taken.index)
    own = packing.pack(stages[4]).toPandas()
    assert own.length.sum() == packed.length.sum()


def test_run(spark, stages):
    got = P.run(spark, SF001).toPandas()
    last = stages[-1].toPandas()
    key = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    assert sorted(map(tuple, got[key].values)) == sorted(map(tuple, last[key].values))
    assert P.ORACLE_SQL is None


def test_registered():
    import __spark_entry__ as E
    names = set(E.queries())
    assert "pipeline" in names and {f"op{i}" for i in range(1, 11)} <= {n.split("_")[0] for n in names}
