"""The pipeline's stages one after the other, each against its own input."""

import sys

import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from tessera.llm import packing, quality_rules, simhash

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark, sample, tmp_path_factory):
    folder, found = tmp_path_factory.mktemp("stages"), [sample]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, found[-1], SF).write.parquet(f"{folder}/{i}")
        found.append(spark.read.parquet(f"{folder}/{i}"))
    return found


def test_stages_hand_on_documents(tables):
    for table in tables[1:-1]:
        assert table.columns == tables[0].columns
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality rules", "SimHash near-dedup", "suffix-array dedup", "mixing", "packing"
    ]


def test_decisions_take_effect(tables):
    docs, good, single, cut, mixed, packed = tables
    measured = quality_rules.measure(docs)
    assert good.count() == measured.where("kept").count()
    groups = simhash.near_duplicates(good)
    want = {r[0] for r in groups.select("component_id").distinct().collect()}
    assert {r[0] for r in single.select("doc_id").collect()} == want
    assert {r[0] for r in cut.select("doc_id").collect()} == want
    assert cut.where(F.col("n_chars") != F.length("text")).count() == 0
    assert mixed.select("doc_id").distinct().join(cut, "doc_id", "left_anti").count() == 0
    tokens = sum(len(packing.token_ids(r[0])) for r in mixed.select("text").collect())
    assert packed.agg(F.sum("length")).first()[0] == tokens


def test_no_passage_of_fifty_words_stands_twice(tables):
    def shared(table):
        seen, twice = {}, 0
        for doc, text in table.select("doc_id", "text").collect():
            words = (text or "").split(" ")
            for i in range(len(words) - 50):
                passage = " ".join(words[i : i + 51])
                if len(passage.encode()) >= corpus_pipeline.PASSAGE:
                    twice += seen.setdefault(passage, doc) != doc
        return twice

    assert shared(tables[2]) > 0 and shared(tables[3]) == 0


def test_run_gives_the_last_stage(spark, tables):
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    run = corpus_pipeline.run(spark, SF).select(*columns)
    # Pieces depend on the order of rows; the tokens of each document do not.
    total = lambda t: sorted(map(tuple, t.where("start = 0").groupBy("doc_id", "doc_tokens").count().collect()))
    assert total(run) == total(tables[-1])


def test_empty_documents(spark, empty):
    docs = empty
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0


def test_entry_works_without_this_subpackage():
    import subprocess

    code = (
        "import sys; sys.modules['corpus_pipeline'] = None; sys.modules['tessera.llm'] = None\n"
        "import __spark_entry__ as e; print(len(e.queries()), 'pipeline' in e.queries())"
    )
    said = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=__spark_entry__.__file__.rpartition("/")[0])
    assert said.stdout.split() == [str(len([q for q in __spark_entry__.queries() if q != "pipeline" and not q.startswith("op")])), "False"]
