"""The pipeline's stages one on the other, in threads, and over its stage of quality."""

import random
import threading

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from frameloom.llm import common

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark):
    """Good and bad documents with labels for half of them, near copies, repeated lines and an e-mail address."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghilmnoprstu") for _ in range(rng.randint(2, 9)))
    words = [word() for _ in range(500)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n)).capitalize() + "."
    line = prose(30)
    rows, labels = [], []
    for i in range(60):
        rows.append((i, f"{prose(40)}\n{prose(20)}", "en", "a", 1))
        labels.append((i, 1, 0))
    for i in range(60, 100):
        rows.append((i, "### $$$ BUY NOW !!! ### $$$ " * rng.randint(3, 9), "en", "b", 1))
        labels.append((i, 0, 0))
    rows.append((200, f"{prose(30)}\n{line}\nwrite to some.one@example.org today", "en", "a", 1))
    rows.append((201, f"{prose(30)}\n{line}", "en", "a", 1))
    rows.append((202, rows[0][1] + " End", "en", "a", 1))
    path = common.fresh_path(spark, "pipeline-docs")
    spark.createDataFrame(rows, DOCS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([x for x in labels if x[0] % 2], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def checked(rows):
    ids = {r["doc_id"] for r in rows}
    # the near copy has lost its lines to the first one, and is an empty document
    assert ids == {*range(60), 200, 201, 202} and [r["length"] for r in rows if r["doc_id"] == 202] == [1]
    at = {}
    for r in rows:
        at.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spans in at.values():
        end = 0
        for offset, length in sorted(spans):
            assert offset == end
            end += length
        assert end <= 1024
    return sorted((r["doc_id"], r["piece"], r["length"], r["ids_crc32"]) for r in rows)


def test_stages_one_on_the_other_equal_written_ones(spark, folder):
    written = checked(corpus_pipeline.run(spark, folder).collect())
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, work in corpus_pipeline.STAGES:
        docs = work(spark, docs, folder)  # nothing is written between
    assert checked(docs.collect()) == written


def test_stage_of_quality(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").withColumn("posterior", F.lit("clash"))
    stage = dict(corpus_pipeline.STAGES)["quality"]
    got = stage(spark, docs, folder)
    assert got.columns[:5] == docs.columns[:5]
    kept = {r["doc_id"] for r in got.collect()}
    assert kept >= {*range(60), 200, 201} and not kept & set(range(60, 100))
    assert stage(spark, docs.limit(0), folder).count() == 0
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "", None, None, 0), (1, "", None, None, 0)], DOCS)
    assert stage(spark, odd, folder).count() <= 3


def test_runs_in_two_threads_leave_each_other_alone(spark, folder):
    got, failed = {}, []

    def one(k):
        try:
            docs = spark.read.parquet(f"{folder}/documents.parquet")
            for name, work in corpus_pipeline.STAGES[1:4]:
                docs = spark.createDataFrame(work(spark, docs, folder).collect(), docs.schema)
            got[k] = sorted(r["doc_id"] for r in docs.collect())
        except Exception as e:  # noqa: BLE001
            failed.append(e)

    both = [threading.Thread(target=one, args=(k,)) for k in range(2)]
    for x in both:
        x.start()
    for x in both:
        x.join()
    assert not failed and got[0] == got[1] and len(got[0]) > 90
