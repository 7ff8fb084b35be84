"""The pipeline against its stages on plain Python, and the registered queries."""
import re
from collections import defaultdict

import corpus_pipeline
import numpy as np
import pytest
from edge import documents, empty
from test_simhash import brute_components, brute_fingerprint

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    out = [docs]
    from shelflife.llm.common import stored
    for name, stage in corpus_pipeline.STAGES:
        out.append(stored(stage(spark, out[-1], SF001), f"test-{name}"))
    return out


def test_order_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language_id", "exact_dedup", "near_dedup", "mixing", "packing"]
    for df in stages[1:-1]:
        assert df.columns == stages[0].columns


def test_stages_against_brute_force(stages):
    docs = [r.asDict() for r in stages[0].collect()]
    ids = [sorted(r.doc_id for r in df.select("doc_id").collect()) for df in stages[:5]]
    assert ids[1] == sorted(d["doc_id"] for d in docs if re.search(r"[^\W\d_]", d["text"] or ""))
    by = {d["doc_id"]: d for d in docs}
    groups = defaultdict(list)
    for i in ids[1]:
        groups[re.sub(r"[\x20\x09-\x0D]", "", by[i]["text"])].append((-len(by[i]["text"]), i))
    assert ids[2] == sorted(min(g)[1] for g in groups.values())
    prints = {i: brute_fingerprint(by[i]["text"]) for i in ids[2]}
    roots = brute_components(np.unique(np.array(list(prints.values()), np.uint64)))
    first = {}
    for i in ids[2]:
        first.setdefault(roots[prints[i]], i)
    assert ids[3] == sorted(first.values())
    assert set(ids[4]) <= set(ids[3]) and max(ids[4].count(i) for i in ids[4]) <= 2
    packed = stages[5].collect()
    assert len({(r.sequence_id, r.offset) for r in packed}) == len(packed)
    assert sorted(r.doc_id for r in packed if r.piece == 0) == ids[4]


def test_run_equals_the_stages(spark, stages):
    got = corpus_pipeline.run(spark, SF001)
    assert sorted(map(tuple, got.select("doc_id", "piece", "length", "ids_crc32").collect())) == sorted(
        map(tuple, stages[5].select("doc_id", "piece", "length", "ids_crc32").collect()))


@pytest.mark.parametrize("make", [documents, empty])
def test_every_stage_takes_awkward_rows(spark, make):
    from shelflife.llm.common import stored
    docs = make(spark)
    for name, stage in corpus_pipeline.STAGES:
        out = stored(stage(spark, docs, SF001), f"edge-{name}")
        if name != "packing":
            assert out.columns == docs.columns
            assert name == "mixing" or out.count() <= docs.count()
        docs = out
    assert (docs.count() == 0) == (make is empty)


def test_registered():
    import __spark_entry__ as entry
    names = list(entry.queries())
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)] == [1] * 10
    assert "pipeline" in names
