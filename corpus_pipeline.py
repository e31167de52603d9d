"""A corpus pipeline of five stages: quality, repeated lines, near duplicates, personal data, packing.

Each stage takes (spark, docs, sf_dir), works on all rows that the stage before it kept, and returns the columns of
documents (the last one: pieces). Defined cases are those of the operators; besides: a group of near duplicates keeps its
smallest id (null ids come last), of rows that agree in id and text one stays, and different texts of one id are different
documents. Stages may be called on their own or one on the other: a stage deletes the intermediate tables of the stage that its thread called
before it, unless its documents are still to be computed from them. An empty table goes through all stages; null texts and other columns stay.
"""

from __future__ import annotations

import threading
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from frameloom.llm.classifier import classify, sites_of
from frameloom.llm.common import clear, fresh_path, keep, kept, sized
from frameloom.llm.line_dedup import line_dedup
from frameloom.llm.ngram_join import ngram_groups
from frameloom.llm.packing import pack
from frameloom.llm.pii import redact


class _Last(threading.local):
    """The tables of the stage that this thread called last."""

    def __init__(self) -> None:
        self.paths: list[str] = []


_last = _Last()


def _reads(docs: DataFrame, paths: list[str]) -> bool:
    """Whether docs are still to be computed from one of these tables."""
    names = {p.rstrip("/").rsplit("/", 1)[-1] for p in paths}
    return bool(names) and any(part in names for f in docs.inputFiles() for part in f.split("/"))


def stage(work: Callable) -> Callable:
    """A stage begins when the one before it is written, so that one's intermediate tables are deleted then, unless the documents it is given
    read them still (stages called one on the other); those stay until a later stage no longer needs them."""

    @wraps(work)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if not _reads(docs, _last.paths):
            clear(spark, _last.paths)
            _last.paths = []
        before = set(kept())
        out = work(spark, docs, sf_dir)
        _last.paths = [*_last.paths, *(x for x in kept() if x not in before)]
        return out

    return run_stage


def _measured(docs: DataFrame, columns: list[str]) -> DataFrame:
    """n_chars follows the text."""
    if "n_chars" in columns:
        docs = docs.withColumn("n_chars", F.length("text").cast("long"))
    return docs.select(*columns)


@stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts. Without labels of both kinds all are; null and empty texts are judged by their counts."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return classify(docs, labels, *sites_of(docs)).where("accepted").select(*docs.columns)


@stage
def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that repeat an earlier one, exactly or nearly; a text that loses all its lines stays as an empty one."""
    return _measured(line_dedup(docs), docs.columns)


@stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: 80 % of the shingles of five words, linked through any number of others. Texts without words are no duplicates, unless
    their rows agree in id and text."""
    # rows are told apart by id and text, as ids may repeat or be null; equal rows are one
    key = F.xxhash64(F.col("doc_id"), F.col("text"))
    groups = keep(ngram_groups(docs.select(key.alias("key"), "text"), id_col="key", width=5, num=80), "groups")
    ids = docs.select(key.alias("key"), F.col("doc_id").cast("long").alias("id"), F.length("text").alias("size"))
    linked = groups.where("n_shingles > 0").select("key", "component_id").distinct()
    large = keep(linked.groupBy("component_id").count().where("count > 1").select("component_id"), "large")
    members = keep(linked.join(sized(large), "component_id").join(ids.distinct(), "key"), "members")
    first = members.groupBy("component_id").agg(F.min(F.struct(F.col("id").isNull().alias("last"), "id", "key")).alias("m"))
    gone = members.join(first, "component_id").where("key <> m.key").select(F.col("key").alias("_gone")).distinct()
    gone = sized(keep(gone, "gone"))
    left = docs.withColumn("_key", key).join(gone, F.col("_key") == F.col("_gone"), "left_anti")
    again = keep(left.groupBy("_key").count().where("count > 1").select(F.col("_key").alias("_again")), "again")
    if not again.isEmpty():
        twice = sized(again)
        one = left.join(twice, F.col("_key") == F.col("_again"), "left_semi").dropDuplicates(["_key"])
        left = left.join(twice, F.col("_key") == F.col("_again"), "left_anti").unionByName(one)
    return left.select(*docs.columns)


@stage
def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by their kind; null stays null."""
    return _measured(redact(docs), docs.columns)


@stage
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1,024 tokens, placed in sequences; a null or empty text is the end token alone."""
    return pack(docs)


STAGES = [("quality", quality), ("lines", lines), ("near_duplicates", near_duplicates), ("private", private), ("packed", packed)]
ORACLE_SQL = None  # fuzzy lines, minimum encodings and packing plans are beyond SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for n, (name, work) in enumerate(STAGES):
        docs = work(spark, docs, sf_dir)
        if n + 1 < len(STAGES):
            path, schema = fresh_path(spark, name), docs.schema
            docs.write.parquet(path)
            docs = spark.read.schema(schema).parquet(path)
    return docs
