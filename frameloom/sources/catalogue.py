"""Star catalogues on disk, clustered by bands of declination and by right ascension in them, so that a box reads the files that it touches.

A catalogue is Parquet with a folder for each band (dec_band = floor((dec + 90) / band)), whose files hold ranges of right ascension; a small table
beside it records each band's bounds and rows, and the height of the bands. Stars without a place have none in a catalogue.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_catalog(stars: DataFrame, path: str, band: float = 5.0, rows: int = 1_000_000) -> None:
    """stars (ra, dec, ...) as a new catalogue, about `rows` stars a file. A crowded band is many files."""
    placed = stars.where("ra IS NOT NULL AND dec IS NOT NULL AND NOT isnan(ra) AND NOT isnan(dec)").withColumn("dec_band", F.least(F.floor((F.col("dec") + 90) / band), F.floor(F.lit(180 / band)) - 1).cast("int"))
    files = max(1, -(-placed.count() // rows))
    placed.repartitionByRange(files, "dec_band", "ra").sortWithinPartitions("dec_band", "ra").write.partitionBy("dec_band").parquet(f"{path}/stars")
    back = _stars(stars.sparkSession, path, placed.schema)
    back.groupBy("dec_band").agg(F.min("dec").alias("dec1"), F.max("dec").alias("dec2"), F.min("ra").alias("ra1"), F.max("ra").alias("ra2"), F.count("*").alias("n")).withColumn("band", F.lit(band)).coalesce(1).write.parquet(f"{path}/bands")


def _stars(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{path}/stars")


def bands(spark: SparkSession, path: str) -> DataFrame:
    """dec_band, dec1, dec2, ra1, ra2, n, band: what each band really holds (180 / band rows at most)."""
    return spark.read.parquet(f"{path}/bands")


def read_catalog(spark: SparkSession, path: str, dec1: float = -90.0, dec2: float = 90.0, ra1: float = 0.0, ra2: float = 360.0) -> DataFrame:
    """The stars of a box; with ra1 above ra2 it runs across right ascension 0. Bands whose recorded bounds lie outside aren't opened, and of the
    others Parquet skips row groups by their ranges of right ascension."""
    known = bands(spark, path)
    hit = [r["dec_band"] for r in known.where((F.col("dec2") >= dec1) & (F.col("dec1") <= dec2)).select("dec_band").collect()]
    inside = F.col("ra").between(ra1, ra2) if ra1 <= ra2 else (F.col("ra") >= ra1) | (F.col("ra") <= ra2)
    stars = spark.read.parquet(f"{path}/stars")
    return stars.where(F.col("dec_band").isin(hit) & F.col("dec").between(dec1, dec2) & inside) if hit else stars.where("false")
