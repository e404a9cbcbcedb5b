import collections

import corpus_pipeline as C
import pytest
from duotier.llm import packing, pii, quality, simhash
from duotier.llm.common import documents, saved

import edge

D = "/root/testdata/sf0.001"


def stages(spark, docs, sf_dir):
    """Each stage's input and output, written and read as the driver does."""
    out = []
    for name, stage in C.STAGES:
        got = saved(stage(spark, docs, sf_dir), name)
        out.append((name, docs, got))
        docs = got
    return out


def rows(df, *cols):
    return collections.Counter(map(tuple, df.select(*cols).collect()))


def test_stages_keep_columns_and_take_effect(spark):
    docs = documents(spark, D)
    ran = {name: (i, o) for name, i, o in stages(spark, docs, D)}
    for name in list(ran)[:-1]:
        assert ran[name][1].columns == docs.columns
    i, o = ran["quality_rules"]
    kept = quality.quality(i, spark.read.parquet(f"{D}/labels.parquet")).filter("kept")
    assert rows(o, "doc_id") == rows(kept, "doc_id") and 0 < o.count() < i.count()
    i, o = ran["near_duplicates"]
    groups = simhash.near_duplicates(i)
    assert rows(o, "doc_id") == rows(groups.select("component_id").distinct(), "component_id")
    i, o = ran["personal_data"]
    assert rows(i, "doc_id", "lang", "source") == rows(o, "doc_id", "lang", "source")
    model = pii.fit(i)
    for r in o.collect():
        assert not any(pii.base_spans(r.text)) and r.n_chars == len(r.text)
    assert sum(bool(x.spans) for x in pii.personal_data(i, model).collect()) == sum(
        a != b for a, b in zip(*([r.text for r in sorted(x.collect(), key=lambda r: r.doc_id)] for x in (i, o)))
    )
    i, o = ran["mixing"]
    assert rows(i, *docs.columns) == rows(o, *docs.columns)
    i, o = ran["packing"]
    assert {r.doc_id for r in o.collect()} == {r.doc_id for r in i.collect()}
    assert rows(C.run(spark, D), "doc_id", "piece", "length", "ids_crc32") == rows(o, "doc_id", "piece", "length", "ids_crc32")


@pytest.mark.parametrize("empty", [True, False])
def test_stages_stand_edge_rows(spark, empty):
    for name, stage in C.STAGES:
        docs = edge.docs(spark, empty)
        got = stage(spark, docs, D)
        n = got.count()
        assert n == 0 if empty else n > 0 or name == "quality_rules"
    assert packing.SIZE == 2048
