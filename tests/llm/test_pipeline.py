"""The registered queries and the pipeline against the operators they apply."""

import __spark_entry__
import corpus_pipeline
from tessera.llm import jaccard_join, queries
from tessera.llm.common import materialise
from .test_search import brute_jaccard

SF = "/root/testdata/sf0.001"


def test_every_operator_is_registered():
    names = __spark_entry__.queries()
    assert {n.split("_")[0] for n in queries.QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(queries.QUERIES) | {"pipeline"} <= set(names)


def test_stages_keep_the_columns_and_what_they_should(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language ID", "quality classifier", "n-gram Jaccard join",
                                                      "benchmark decontamination", "best-fit packing"]
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = materialise(stage(spark, docs, SF), "stage")
        if number < 4:
            assert out.columns == docs.columns
            assert out.exceptAll(docs).count() == 0
        if name == "n-gram Jaccard join":
            rows = [(r.doc_id, r.text) for r in docs.collect()]
            assert {r.doc_id for r in out.collect()} == set(brute_jaccard(rows)[0].values())
            assert out.count() == jaccard_join.jaccard_components(out).count()
        if name == "benchmark decontamination":
            assert stage(spark, out, SF).count() == out.count()
        if number == 4:
            assert {r.doc_id for r in out.collect()} == {r.doc_id for r in docs.collect()}
        docs = out


def test_run_gives_the_last_stage(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert out.count() > 0
