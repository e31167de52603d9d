"""Token counts through a digest cache that lasts from run to run.

The cache is a folder of Parquet tables, one for each tokenizer version: a digest of the tokenizer file, the library's name and
version, and the options. Its rows are (digest, n_tokens), the digest being SHA-256 of the normalised content. A run

1. takes every row's digest and size, and groups them, so that a text with very many copies is one row;
2. joins the distinct digests to the stored counts; those without one are misses;
3. brings the misses to one occurrence of their texts (the smallest id's), encodes those, and appends the counts to the cache in one
   committed write, so that a run that breaks leaves no part behind;
4. joins every row's digest to the counts.

Texts are shuffled once, and only where they meet the misses; each partition's misses are a hash table, so texts aren't sorted.

`normalise` may change a text only in ways that leave the count as it is (the default takes null as empty); texts that it makes equal
share a count. Two runs that append the same digest at a time are harmless: equal digests have equal counts.

Defined cases: a null or empty text has no bytes and no tokens; null or repeated ids and repeated rows are counted row by row; equal
texts under one id are encoded once in each task at most; an empty table gives an empty result; other columns are ignored. The longest
text sets the memory of a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from importlib.metadata import version

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh_path, keep, text_chunks
from .packing import token_runs

STORED = "digest binary, n_tokens long"
#: Spark's setting that names a cache for the query; a fresh one where it is unset.
SETTING = "spark.frameloom.tokenCache"
#: How many digests a task remembers to leave out rows that agree in id and text.
REMEMBERED = 200_000


def as_it_is(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit(""))


def library(path: str) -> str:
    return "sentencepiece" if path.endswith(".model") else "tokenizers"


def tokenizer_digest(path: str) -> str:
    """What names a version: file, library and options."""
    with open(path, "rb") as f:
        file = hashlib.sha256(f.read()).hexdigest()
    name = library(path)
    return hashlib.sha256(f"{file} {name} {version(name)} plain".encode()).hexdigest()


_models: dict[str, object] = {}


def counts(column: pa.Array, path: str) -> Iterator[tuple[int, int, np.ndarray]]:
    """Runs of texts: first row, last row + 1, and how many tokens each text has."""
    if library(path) == "tokenizers":
        for i, j, _, n in token_runs(column, path):
            yield i, j, n
        return
    if path not in _models:
        import sentencepiece

        _models[path] = sentencepiece.SentencePieceProcessor(model_file=path)
    for i, j, raw, off in text_chunks(column):
        body = raw.tobytes()
        texts = [body[a:b].decode() for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]
        yield i, j, np.fromiter(map(len, _models[path].encode(texts, num_threads=1)), np.int64, j - i)


def encoded(texts: DataFrame, path: str) -> DataFrame:
    """digest, n_tokens of the texts: digest, text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            digests, new = batch.column("digest").to_pylist(), []
            for i, d in enumerate(digests):
                if d not in seen:
                    if len(seen) >= REMEMBERED:
                        seen.clear()
                    seen.add(d)
                    new.append(i)
            if len(new) < len(digests):
                batch = batch.take(pa.array(new, pa.int64()))
            for i, j, n in counts(batch.column("text"), path):
                yield pa.RecordBatch.from_arrays([batch.column("digest").slice(i, j - i), pa.array(n)], names=["digest", "n_tokens"])

    return texts.select("digest", "text").mapInArrow(run, STORED)


def stored(spark: SparkSession, folder: str) -> DataFrame:
    """The counts of one version; an empty table before its first run."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], STORED)
    return spark.read.schema(STORED).parquet(folder)


def token_counts(docs: DataFrame, cache: str, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, limit: int = 512, normalise: Callable[[Column], Column] = as_it_is) -> DataFrame:
    """id, n_bytes, n_tokens, over_limit of every row; the cache gets what it lacked."""
    spark = docs.sparkSession
    path = tokenizer or public_tokenizers.path("byte_bpe_50k.json")
    folder = f"{cache}/{tokenizer_digest(path)}"
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.octet_length(as_it_is(F.col(text_col))).cast("long").alias("n_bytes"), normalise(F.col(text_col)).alias("text"))
    texts = texts.withColumn("digest", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))
    rows = keep(texts.select("id", "n_bytes", "digest"), "digests")
    wanted = keep(rows.groupBy("digest").agg(F.min("id").alias("id")), "distinct")
    misses = keep(wanted.join(stored(spark, folder).select("digest"), "digest", "left_anti"), "misses")
    if not misses.isEmpty():
        of = misses.select(F.col("digest").alias("of"), F.col("id").alias("first")).hint("shuffle_hash")
        some = texts.join(of, (F.col("digest") == F.col("of")) & F.col("id").eqNullSafe(F.col("first")), "left_semi")
        encoded(some, path).write.mode("append").parquet(folder)
    known = stored(spark, folder).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
    out = rows.join(known.join(wanted.select("digest"), "digest", "left_semi"), "digest")
    return out.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def query(spark, sf_dir: str) -> DataFrame:
    cache = spark.conf.get(SETTING, None) or fresh_path(spark, "token-cache")
    return token_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"), cache)
