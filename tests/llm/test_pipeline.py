"""Each stage of the pipeline against brute force on its own input."""
import os
import sys

import pytest
from conftest import SF

import corpus_pipeline
from tastebud.llm import queries

sys.path.insert(0, os.path.dirname(__file__))
import test_decontaminate as t4  # noqa: E402
import test_line_dedup as t5  # noqa: E402
import test_near_dup as t10  # noqa: E402
import test_packing as t3  # noqa: E402
import test_quality as t9  # noqa: E402


@pytest.fixture(scope="module")
def inputs(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = [docs]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{folder}/{i}")
        docs = spark.read.parquet(f"{folder}/{i}")
        found.append(docs)
    return found


def rows(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_columns(inputs):
    assert [d.columns for d in inputs[:-1]] == [inputs[0].columns] * 5


def test_quality_stage(inputs):
    kept = {r.doc_id for r in inputs[1].collect()}
    before = rows(inputs[0])
    assert kept and not [d for d, t in before if t9.base(t)[-1] and d in kept]


def test_line_dedup_stage(inputs):
    assert sorted(rows(inputs[2])) == sorted((d, k) for d, _, _, k in t5.brute(rows(inputs[1])))


def test_near_duplicate_stage(inputs):
    want = {c for _, c, _ in t10.brute(rows(inputs[2]))}
    # texts without words are classes of their own
    assert sorted(d for d, _ in rows(inputs[3])) == sorted(want)


def test_decontamination_stage(spark, inputs):
    before = rows(inputs[3])
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaking = {d for d, *_ in t4.brute(before, items)}
    assert sorted(rows(inputs[4])) == sorted(r for r in before if r[0] not in leaking)


def test_packing_stage(inputs):
    want = sorted(p for d, t in rows(inputs[4]) for p in t3.brute_pieces(queries.tokenizer_path(), d, t))
    got = inputs[5].collect()
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    t3.check_layout(got)


def test_run_is_the_stages(spark, inputs):
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).select("doc_id", "piece", "ids_crc32").collect())) == sorted(map(tuple, inputs[5].select("doc_id", "piece", "ids_crc32").collect()))
