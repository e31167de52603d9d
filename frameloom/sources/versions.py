"""Products that are brought up to date by key: a run adds a version, and readers take the newest version of each key.

A table is a folder with data/version=N (Parquet, partitioned further), keys/version=N (the distinct keys of the version), and manifest/N,
which is created last and holds the schema. A version without a manifest is never read, so a run that breaks changes nothing; a
number is claimed by creating claims/N, which only one of several writers can. Nothing that has been written is changed.

Defined cases: null keys are keys; of a key's rows all those of its newest version are read, and no others, so a run that brings a key
replaces all its rows and leaves those of other keys; a version without rows is a version; columns that a later version adds are null
in the rows of earlier ones; a folder without a version can't be read.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _folder(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def _numbers(spark: SparkSession, path: str) -> list[int]:
    fs, folder = _folder(spark, path)
    return sorted(int(f.getPath().getName()) for f in fs.listStatus(folder)) if fs.exists(folder) else []


def _claim(spark: SparkSession, path: str) -> int:
    number = max([0, *_numbers(spark, f"{path}/claims")])
    while True:
        number += 1
        fs, file = _folder(spark, f"{path}/claims/{number:08d}")
        fs.mkdirs(file.getParent())
        if fs.createNewFile(file):
            return number


def committed(spark: SparkSession, path: str) -> list[int]:
    """The versions that can be read."""
    return _numbers(spark, f"{path}/manifest")


def upsert(df: DataFrame, path: str, keys: list[str], by: list[str] | None = None) -> int:
    """Add df as the newest version of its keys; its number. by: columns that split its files into folders."""
    spark = df.sparkSession
    number = _claim(spark, path)
    writer = df.write
    (writer.partitionBy(*by) if by else writer).parquet(f"{path}/data/version={number:08d}")
    schema = df.schema
    back = spark.read.schema(schema).parquet(f"{path}/data/version={number:08d}")
    back.select(*keys).distinct().write.parquet(f"{path}/keys/version={number:08d}")
    # the manifest's text is complete before it has its name
    fs, file = _folder(spark, f"{path}/manifest/{number:08d}")
    _, draft = _folder(spark, f"{path}/claims/{number:08d}")
    out = fs.create(draft, True)
    out.write(bytearray(schema.json().encode()))
    out.close()
    fs.mkdirs(file.getParent())
    if not fs.rename(draft, file):
        raise OSError(f"version {number} of {path} could not be committed")
    fs.createNewFile(draft)  # the number stays claimed
    return number


def _schema(spark: SparkSession, path: str, numbers: list[int]) -> T.StructType:
    """The fields of all versions, a later version's type first."""
    fields: dict[str, T.StructField] = {}
    for number in reversed(numbers):
        fs, file = _folder(spark, f"{path}/manifest/{number:08d}")
        stream = fs.open(file)
        try:
            text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        for field in T.StructType.fromJson(json.loads(text)).fields:
            fields.setdefault(field.name, T.StructField(field.name, field.dataType, True))
    return T.StructType(list(fields.values()))


def newest(spark: SparkSession, path: str, keys: list[str], upto: int | None = None) -> DataFrame:
    """The rows of every key's newest version, of those up to `upto`."""
    numbers = [n for n in committed(spark, path) if upto is None or n <= upto]
    if not numbers:
        raise FileNotFoundError(f"no version in {path}")
    schema = _schema(spark, path, numbers)
    version = T.StructField("version", T.IntegerType())
    part = lambda name, fields: spark.read.schema(T.StructType([*fields, version])).parquet(f"{path}/{name}").where(F.col("version").isin(numbers))
    rows = part("data", schema.fields)
    if len(numbers) == 1:
        return rows.drop("version")
    last = part("keys", [schema[k] for k in keys]).groupBy(*keys).agg(F.max("version").alias("_last"))
    last = last.select(*(F.col(k).alias(f"_{k}") for k in keys), "_last")
    same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys))
    return rows.join(last, same & (F.col("version") == F.col("_last")), "left_semi").drop("version")
