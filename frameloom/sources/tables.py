"""The survey's tables, derived from the given ones: frames, pixels, sources, star catalogue, fields, photometry, ephemeris."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import formulas as fx

MICROS = "timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)"
PER_FRAME = 4000
TYPES = {"click": "LIGHT", "error": "BIAS", "view": "DARK", "signup": "FLAT", "purchase": "MASK"}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A frame per event; the event's type stands for the image type, its user for the detector."""
    kind = F.create_map(*(F.lit(x) for pair in TYPES.items() for x in pair))[F.col("event_type")]
    return read(spark, sf_dir, "events").select(
        F.col("event_id").alias("frame_id"),
        F.format_string("img_%06d.fits", "event_id").alias("file"),
        kind.alias("imagetyp"),
        F.col("user_id").alias("detector"),
        F.col("ts").alias("obs_ts"),
        F.expr(MICROS).alias("us"),
        (10.0 * (F.col("event_id") % 4 + 1)).alias("exptime"),
        F.col("value"),
        F.col("props"),
    )


def pixels(spark: SparkSession, sf_dir: str, frames: DataFrame | None = None) -> DataFrame:
    """8 by 8 pixels per frame; grp is the exposure or filter group. With `frames`, those of its frames, and its columns, which meet the vectors
    before they are pixels."""
    rows = read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("frame_id"), F.col("label").alias("grp"), "embedding")
    rows = rows if frames is None else rows.join(frames, "frame_id")
    more = [c for c in rows.columns if c not in ("frame_id", "grp", "embedding")]
    rows = rows.select("frame_id", "grp", *more, F.posexplode("embedding").alias("i", "v"))
    return rows.select("frame_id", "grp", F.expr("i div 8").cast("int").alias("y"), (F.col("i") % 8).alias("x"), F.col("v").cast("double").alias("v"), *more)


def sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PER_FRAME sources on each frame."""
    k, m = F.col("p_partkey"), F.col("p_partkey") % PER_FRAME
    return read(spark, sf_dir, "part").select(k.alias("src_id"), F.floor(k / PER_FRAME).alias("frame_id"), ((m * m * 31 + m * 7919) % 40961 / 10.0).alias("x"), ((m * m * 17 + m * 10473) % 40949 / 10.0).alias("y"), F.col("p_retailprice").alias("flux"), F.col("p_size").alias("npix"))


def stars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalogue in pixels, PER_FRAME stars on each frame, and on the sky."""
    k, m = F.col("c_custkey"), F.col("c_custkey") % PER_FRAME
    return read(spark, sf_dir, "customer").select(
        k.alias("star_id"),
        F.floor(k / PER_FRAME).alias("frame_id"),
        ((m * m * 13 + m * 6271) % 40961 / 10.0).alias("x"),
        ((m * m * 29 + m * 9283) % 40949 / 10.0).alias("y"),
        (12 + k % 700 / 100.0).alias("mag"),
        (k * 6271 % 36000 / 100.0).alias("ra"),
        (k * 92821 % 17000 / 100.0 - 85).alias("dec"),
    )


def fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("s_suppkey")
    return read(spark, sf_dir, "supplier").select(s.alias("field_id"), ((s * s * 37 + s * 1237) % 3600 / 10.0).alias("ra"), ((s * s * 11 + s * 769) % 1600 / 10.0 - 80).alias("dec"))


def measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aperture sums per source and frame."""
    return read(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("frame_id"),
        F.col("l_orderkey").alias("src_id"),
        F.col("l_linenumber").alias("line"),
        F.col("l_extendedprice").alias("aperture_sum"),
        F.col("l_quantity").alias("exptime"),
        (1 + F.col("l_discount")).alias("area"),
        F.col("l_tax").alias("sky"),
        (15 + F.col("l_partkey") % 300 / 100.0).alias("cat_mag"),
    )


def ephemeris(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    return read(spark, sf_dir, "orders").select(k.alias("eph_id"), (F.col("o_custkey") % 100).alias("obsid"), (k * 6271 % 36000 / 100.0).alias("ra"), (k * 92821 % 17000 / 100.0 - 85).alias("dec"), (14 + k % 600 / 100.0).alias("vmag"))


def positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sources on each frame of pixels, between pixel 2 and pixel 6."""
    k, n = F.col("frame_id"), F.col("n")
    rows = read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("frame_id"), F.explode(F.array(F.lit(0), F.lit(1))).alias("n"))
    return rows.select("frame_id", (k * 2 + n).alias("src_id"), (2 + (k * 7 + n * 3) % 17 * 0.25).alias("x"), (2 + (k * 5 + n * 11) % 17 * 0.25).alias("y"))


def _blocks(spark: SparkSession, sf_dir: str, frames: DataFrame | None = None) -> DataFrame:
    """Each vector is a block of 8 by 8 pixels, 8 by 8 blocks are a frame. With `frames`, those of its frames."""
    k = F.col("vec_id")
    rows = read(spark, sf_dir, "embeddings").select("vec_id", F.expr("vec_id div 64").alias("frame_id"), F.expr("vec_id % 64 div 8").alias("ky"), (k % 8).alias("kx"), "embedding")
    return rows if frames is None else rows.join(frames, "frame_id", "left_semi")


def mosaic_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the headers of the mosaics say: frame_id, object, filename, exptime, obsdate, ra0, dec0 (the centre of the field of its number), altcen,
    azcen (its place above the horizon), psffile, zpfile. A mosaic without a field has no row."""
    have = read(spark, sf_dir, "embeddings").select(F.expr("vec_id div 64").alias("frame_id")).distinct()
    rows = fields(spark, sf_dir).select(F.col("field_id").alias("frame_id"), F.col("ra").alias("ra0"), F.col("dec").alias("dec0")).join(have, "frame_id", "left_semi")
    alt, az = fx.alt_az("ra0", "dec0", "37.4", "127.0", "(2460310.5e0 + frame_id * 0.37e0)")
    name = lambda f: F.format_string(f, "frame_id")
    day = F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), F.floor(F.col("frame_id") * 0.37).cast("int")), "yyyyMMdd")
    return rows.select("frame_id", name("field %d").alias("object"), name("img_%d.fits").alias("filename"), F.lit(30.0).alias("exptime"), day.alias("obsdate"), "ra0", "dec0", F.expr(alt).alias("altcen"), F.expr(az).alias("azcen"), name("psf.img_%d.csv").alias("psffile"), name("zp.img_%d.parquet").alias("zpfile"))


def planted(spark: SparkSession, sf_dir: str, frames: DataFrame | None = None) -> DataFrame:
    """The stars of the mosaics, about five a frame, with their true flux; the brightest saturate."""
    k = F.col("star_id")
    rows = _blocks(spark, sf_dir, frames).where("(kx + 5 * ky) % 13 = 2 AND ky < 7").withColumnRenamed("vec_id", "star_id")
    return rows.select("frame_id", "star_id", (F.col("kx") * 8 + 3 + k * 7 % 17 / 16.0).alias("x"), (F.col("ky") * 8 + 3 + k * 5 % 13 / 12.0).alias("y"), (800.0 * (1 + k % 7) * (1 + k % 7)).alias("flux"))


def mosaic(spark: SparkSession, sf_dir: str, frames: DataFrame | None = None) -> DataFrame:
    """frame_id, y, x, v: frames of 64 by 64 pixels, the vectors as noise on a sloping sky, with the planted stars (a Gaussian of 1.3 pixels,
    cut at 6) and, on even frames, a streak. With `frames`, those of its frames."""
    rows = _blocks(spark, sf_dir, frames).select("frame_id", "ky", "kx", F.posexplode("embedding").alias("i", "v"))
    sky = rows.select("frame_id", F.expr("ky * 8 + i div 8").alias("y"), F.expr("kx * 8 + i % 8").alias("x"), (F.col("v").cast("double") * 10).alias("v"))
    streak = F.when(F.expr("frame_id % 2 = 0 AND y IN (61, 62) AND x BETWEEN 10 AND 50"), 200.0).otherwise(0.0)
    sky = sky.withColumn("v", 100 + F.col("x") * 0.05 + F.col("v") + streak)
    around = lambda c: F.explode(F.sequence(F.floor(c).cast("long") - 6, F.floor(c).cast("long") + 6))
    spots = planted(spark, sf_dir, frames).withColumn("py", around("y")).withColumn("px", around("x"))
    light = F.expr(f"flux / {TWO_PI_VAR} * exp(-((px - x) * (px - x) + (py - y) * (py - y)) / {2 * SIGMA * SIGMA}e0)")
    spill = spots.groupBy("frame_id", F.col("py").alias("y"), F.col("px").alias("x")).agg(F.sum(light).alias("light"))
    return sky.join(spill, ["frame_id", "y", "x"], "left").select("frame_id", "y", "x", (F.col("v") + F.coalesce("light", F.lit(0.0))).alias("v"))


SIGMA = 1.3
TWO_PI_VAR = f"{2 * math.pi * SIGMA * SIGMA}e0"

#: The same tables for DuckDB.
SQL = {
    "frames": "frames AS (SELECT event_id AS frame_id, printf('img_%06d.fits', event_id) AS file, CASE event_type "
    + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in TYPES.items())
    + " END AS imagetyp, user_id AS detector, ts AS obs_ts, epoch_us(ts) AS us, CAST(10.0 * (event_id % 4 + 1) AS DOUBLE) AS exptime, value, props FROM events)",
    "pixels": "pixels AS (SELECT frame_id, grp, CAST(i // 8 AS INTEGER) AS y, CAST(i % 8 AS INTEGER) AS x, v FROM (SELECT vec_id AS frame_id, label AS grp, unnest(range(len(embedding))) AS i, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings))",
    "sources": "sources AS (SELECT k AS src_id, k // 4000 AS frame_id, ((m * m * 31 + m * 7919) % 40961) / 10.0::DOUBLE AS x, ((m * m * 17 + m * 10473) % 40949) / 10.0::DOUBLE AS y, flux, npix FROM (SELECT p_partkey AS k, p_partkey % 4000 AS m, p_retailprice AS flux, p_size AS npix FROM part))",
    "stars": "stars AS (SELECT k AS star_id, k // 4000 AS frame_id, ((m * m * 13 + m * 6271) % 40961) / 10.0::DOUBLE AS x, ((m * m * 29 + m * 9283) % 40949) / 10.0::DOUBLE AS y, 12 + (k % 700) / 100.0::DOUBLE AS mag, (k * 6271 % 36000) / 100.0::DOUBLE AS ra, (k * 92821 % 17000) / 100.0::DOUBLE - 85 AS dec FROM (SELECT c_custkey AS k, c_custkey % 4000 AS m FROM customer))",
    "fields": "fields AS (SELECT s_suppkey AS field_id, ((s_suppkey * s_suppkey * 37 + s_suppkey * 1237) % 3600) / 10.0::DOUBLE AS ra, ((s_suppkey * s_suppkey * 11 + s_suppkey * 769) % 1600) / 10.0::DOUBLE - 80 AS dec FROM supplier)",
    "measurements": "measurements AS (SELECT l_suppkey AS frame_id, l_orderkey AS src_id, l_linenumber AS line, l_extendedprice AS aperture_sum, l_quantity AS exptime, 1 + l_discount AS area, l_tax AS sky, 15 + (l_partkey % 300) / 100.0::DOUBLE AS cat_mag FROM lineitem)",
    "positions": "positions AS (SELECT vec_id AS frame_id, vec_id * 2 + n AS src_id, 2 + ((vec_id * 7 + n * 3) % 17) * 0.25::DOUBLE AS x, 2 + ((vec_id * 5 + n * 11) % 17) * 0.25::DOUBLE AS y FROM embeddings, (SELECT unnest([0, 1]) AS n))",
    "planted": "blocks AS (SELECT vec_id, vec_id // 64 AS frame_id, vec_id % 64 // 8 AS ky, vec_id % 8 AS kx, embedding FROM embeddings), planted AS (SELECT frame_id, vec_id AS star_id, kx * 8 + 3 + (vec_id * 7 % 17) / 16.0::DOUBLE AS x, ky * 8 + 3 + (vec_id * 5 % 13) / 12.0::DOUBLE AS y, 800.0::DOUBLE * (1 + vec_id % 7) * (1 + vec_id % 7) AS flux FROM blocks WHERE (kx + 5 * ky) % 13 = 2 AND ky < 7)",
    "mosaic": "sky AS (SELECT frame_id, ky * 8 + i // 8 AS y, kx * 8 + i % 8 AS x, v FROM (SELECT frame_id, ky, kx, unnest(range(len(embedding))) AS i, CAST(unnest(embedding) AS DOUBLE) AS v FROM blocks)), "
    "spots AS (SELECT * FROM (SELECT *, CAST(floor(x) AS BIGINT) + a AS px FROM planted, (SELECT unnest(range(-6, 7)) AS a)), (SELECT unnest(range(-6, 7)) AS b)), "
    f"spill AS (SELECT frame_id, CAST(floor(y) AS BIGINT) + b AS y, px AS x, sum(flux / {TWO_PI_VAR} * exp(-(power(px - x, 2) + power(CAST(floor(y) AS BIGINT) + b - y, 2)) / {2 * SIGMA * SIGMA}e0)) AS light FROM spots GROUP BY 1, 2, 3), "
    "mosaic AS (SELECT s.frame_id, s.y, s.x, 100 + s.x * 0.05::DOUBLE + s.v * 10 + CASE WHEN s.frame_id % 2 = 0 AND s.y IN (61, 62) AND s.x BETWEEN 10 AND 50 THEN 200 ELSE 0 END + coalesce(light, 0) AS v FROM sky s LEFT JOIN spill USING (frame_id, y, x))",
    "ephemeris": "ephemeris AS (SELECT o_orderkey AS eph_id, o_custkey % 100 AS obsid, (o_orderkey * 6271 % 36000) / 100.0::DOUBLE AS ra, (o_orderkey * 92821 % 17000) / 100.0::DOUBLE - 85 AS dec, 14 + (o_orderkey % 600) / 100.0::DOUBLE AS vmag FROM orders)",
}


def with_(*names: str) -> str:
    return "WITH " + ", ".join(SQL[n] for n in names) + " "
