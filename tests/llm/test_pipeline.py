import corpus_pipeline
import pytest
from frames import awkward

from alambique.llm import langid
from alambique.storage import materialize


@pytest.fixture(scope="module")
def stages(spark, small_dir):
    """Input and output of every stage."""
    docs, out = spark.read.parquet(f"{small_dir}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        found = materialize(stage(spark, docs, small_dir), name)
        out[name] = (docs, found)
        docs = found
    return out


def test_stages(stages):
    assert list(stages) == [
        "language_id", "quality_rules", "near_dedup", "source_mix", "window_packing"
    ]
    for name, (before, after) in stages.items():
        if name != "window_packing":
            assert after.columns == before.columns
            assert after.select("doc_id").exceptAll(before.select("doc_id")).isEmpty() or name == "source_mix"


def test_decisions_take_effect(spark, stages):
    before, after = stages["language_id"]
    kept = {r.doc_id for r in after.collect()}
    odd = {r.doc_id for r in langid.predict(before, langid.fit(before)).collect() if r.lang_pred == "und"}
    assert not kept & odd and len(kept) >= 0.95 * before.count()
    _, unique = stages["near_dedup"]
    assert unique.count() == unique.select("doc_id").distinct().count()
    mixed = stages["source_mix"][1]
    packed = {r.doc_id for r in stages["window_packing"][1].select("doc_id").collect()}
    assert packed == {r.doc_id for r in mixed.collect()}


def test_run_gives_the_last_stage(spark, small_dir, stages):
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    found = corpus_pipeline.run(spark, small_dir).select("doc_id", "doc_tokens").distinct()
    expected = stages["window_packing"][1].select("doc_id", "doc_tokens").distinct()
    assert found.exceptAll(expected).isEmpty() and expected.exceptAll(found).isEmpty()
    assert set(columns) < set(corpus_pipeline.run(spark, small_dir).columns)


def test_awkward_documents(spark, tmp_path):
    docs = awkward(spark)
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, str(tmp_path)), name)
    assert docs.columns[0] == "doc_id"
