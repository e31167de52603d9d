"""Places through a WCS: round trips with third-order distortion, poles, wraps and nulls."""

from pyspark.sql import functions as F

from frameloom.functions import wcs

SIP = [(2, 0, 2e-7, 1e-7), (1, 1, -1e-7, 3e-7), (0, 2, 1e-7, -2e-7), (3, 0, 1e-10, 0.0), (2, 1, 0.0, 2e-10), (0, 3, -1e-10, 1e-10)]


def table(spark, rows):
    return spark.createDataFrame(rows, f"frame_id int, x double, y double, naxis1 int, naxis2 int, wcs {wcs.SCHEMA}")


def test_round_trip(spark):
    rows = [(k, x, y, 4096, 4096, (ra, dec, 2048.0, 2048.0, -5e-4, 1e-4, 1e-4, 5e-4, SIP if k % 2 else None)) for k, (ra, dec) in enumerate([(10.0, 20.0), (0.2, -45.0), (359.9, 0.0), (180.0, 89.9), (77.0, -89.0)]) for x in (1.0, 1000.5, 4096.0) for y in (1.0, 3333.3)]
    df = table(spark, rows).withColumn("s", wcs.pixel_to_sky("x", "y", "wcs")).withColumn("p", wcs.sky_to_pixel("s.ra", "s.dec", "wcs"))
    got = df.collect()
    assert all(abs(r["p"]["x"] - r["x"]) < 1e-6 and abs(r["p"]["y"] - r["y"]) < 1e-6 and 0 <= r["s"]["ra"] < 360 for r in got) and len(got) == 30
    # the distortion is there: without it places differ by more than a tenth of a pixel
    flat = df.withColumn("p0", wcs.sky_to_pixel("s.ra", "s.dec", F.col("wcs").withField("sip", F.lit(None).cast("array<struct<p: int, q: int, a: double, b: double>>"))))
    assert max(abs(r["p0"]["x"] - r["x"]) for r in flat.collect() if r["wcs"]["sip"]) > 0.1
    centre = table(spark, [(1, 2048.0, 2048.0, 1, 1, (33.0, 44.0, 2048.0, 2048.0, -5e-4, 0.0, 0.0, 5e-4, SIP))]).select(wcs.pixel_to_sky("x", "y", "wcs").alias("s")).first()["s"]
    assert abs(centre["ra"] - 33) < 1e-12 and abs(centre["dec"] - 44) < 1e-12
    north = table(spark, [(1, 2048.0, 3048.0, 1, 1, (33.0, 44.0, 2048.0, 2048.0, -5e-4, 0.0, 0.0, 5e-4, None))]).select(wcs.pixel_to_sky("x", "y", "wcs").alias("s")).first()["s"]
    assert abs(north["ra"] - 33) < 1e-9 and abs(north["dec"] - 44.4999873) < 1e-5


def test_nulls_and_the_far_side(spark):
    w = (10.0, 20.0, 5.0, 5.0, -0.1, 0.0, 0.0, 0.1, None)
    df = table(spark, [(1, None, 1.0, 8, 8, w), (2, 1.0, 1.0, 8, 8, None), (3, 190.0, -20.0, 8, 8, w)])
    got = {r["frame_id"]: r for r in df.select("frame_id", wcs.pixel_to_sky("x", "y", "wcs").alias("s"), wcs.sky_to_pixel("x", "y", "wcs").alias("p")).collect()}
    assert got[1]["s"]["ra"] is None and got[2]["s"]["ra"] is None and got[3]["p"]["x"] is None


def test_boxes_of_corners(spark):
    w = lambda ra, dec: (ra, dec, 50.5, 50.5, -0.01, 0.0, 0.0, 0.01, None)
    df = table(spark, [(1, None, None, 100, 100, w(100.0, 0.0)), (2, None, None, 100, 100, w(0.1, 0.0)), (3, None, None, None, 100, w(1.0, 1.0)), (4, None, None, 100, 100, None)])
    got = sorted(tuple(round(v, 3) for v in r) for r in wcs.corner_boxes(df, 0.1).collect())
    assert got == [(1, 99.4, 100.6, -0.6, 0.6), (2, 0.0, 0.7, -0.6, 0.6), (2, 359.5, 360.0, -0.6, 0.6)]
