"""Masters by night and frames corrected by their own masters, against planted levels."""

import random

from pyspark.sql import functions as F

from frameloom.operators import calibration as ca

FRAMES = "frame_id long, imagetyp string, detector long, us long, exptime double, filter string, night long"
DAY = 86_400_000_000


def nights():
    """Two nights of one detector, whose bias and dark levels differ, and a light on each; a second detector without masters."""
    rows, level, n = [], {}, 0
    slope = {(y, x): 1 + 0.02 * (x - 3.5) for y in range(8) for x in range(8)}
    for night, (bias, dark) in enumerate([(100.0, 5.0), (200.0, 9.0)]):
        for k in range(5):
            for kind, exptime, value in (("BIAS", 0.0, lambda p, b=bias: b), ("dark", 30.0, lambda p, b=bias, k=dark: b + k), ("FLAT", 30.0, lambda p, b=bias, k=dark: b + k + 1000 * slope[p]), ("DARK", 60.0, lambda p, b=bias, k=dark: b + 2 * k)):
                rows.append((n, kind, 1, night * DAY + n, exptime, "g", night))
                level[n] = value
                n += 1
        rows.append((n, "LIGHT", 1, night * DAY + 50 + n, 31.0, "g", night))
        level[n] = lambda p, b=bias, k=dark: b + k + 50 * slope[p]
        n += 1
    rows.append((n, "LIGHT", 2, DAY, 30.0, "g", 1))
    level[n] = lambda p: 70.0
    rng = random.Random(4)
    px = [(f, y, x, value((y, x)) + (0.0 if f % 5 else rng.gauss(0, 1e-6))) for f, value in level.items() for y, x in slope]
    return rows, px, n


def test_nights_have_masters_of_their_own(spark):
    rows, px, alone = nights()
    frames = spark.createDataFrame(rows, FRAMES)
    pixels = spark.createDataFrame(px, "frame_id long, y long, x long, v double").withColumn("v", F.when((F.col("frame_id") == 0) & (F.col("x") == 3), 1e6).otherwise(F.col("v")))
    lib = ca.build_library(frames, pixels, outliers=8.0, box=4)
    bias = {r["night"]: r["v"] for r in lib.bias.pixels.join(lib.bias.meta, "master_id").groupBy("night").agg(F.avg("v").alias("v")).collect()}
    assert {n: round(v, 3) for n, v in bias.items()} == {0: 100.0, 1: 200.0}  # the hot column of one frame is clipped
    dark = {(r["night"], r["exptime"]): round(r["v"], 3) for r in lib.dark.pixels.join(lib.dark.meta, "master_id").groupBy("night", "exptime").agg(F.avg("v").alias("v")).collect()}
    assert dark == {(0, 30.0): 5.0, (0, 60.0): 10.0, (1, 30.0): 9.0, (1, 60.0): 18.0}
    lights = frames.where("imagetyp = 'LIGHT'")
    got = ca.correct_level1(lights, pixels, lib, (8, 8), high=290.0, margin=1).collect()
    by = {}
    for r in got:
        by.setdefault(r["frame_id"], []).append(r)
    night = {r[0]: r[6] for r in rows}
    assert len(by) == 3 and all(len(v) == 64 for v in by.values())
    for f, values in by.items():
        if f == alone:  # no masters: as it was, no row lost
            assert {(r["v"], r["bias_id"], r["dark_id"], r["flat_id"]) for r in values} == {(70.0, None, None, None)}
            continue
        assert all(abs(r["v"] - 50) < 1e-3 for r in values)
        assert {night[r[c]] for r in values for c in ("bias_id", "dark_id", "flat_id")} == {night[f]}
        assert all(r["bits"] & 2 == (2 if 0 in (r["y"], r["x"]) or 7 in (r["y"], r["x"]) else 0) and r["bits"] & 12 == 0 for r in values)
    assert ca.correct_level1(lights.limit(0), pixels, lib, (8, 8)).count() == 0


def test_bits_of_bad_results(spark):
    rows = [(100.0, 1.0, 2.0, 1.0), (100.0, -1.0, -1.0, 1.0), (100.0, 1.0, None, None), (100.0, 1.0, float("inf"), 0.0), (100.0, 1.0, 2.0, 1.6), (100.0, 1.0, 2.0, 0.4), (5000.0, 1.0, 2.0, 1.5)]
    df = spark.createDataFrame(rows, "raw double, dark double, v double, flat double")
    bits = ca.level1_bits(F.col("raw"), F.col("dark"), F.col("v"), F.col("flat"), F.lit(500), F.lit(500), 1000, 1000, 3800.0, 100)
    assert [r[0] for r in df.select(bits).collect()] == [0, 12, 8, 8, 8, 8, 1]


def test_outliers_are_measured_against_the_mesh(spark):
    rng = random.Random(3)
    px = [(1, y, x, 100 + 2.0 * x + rng.gauss(0, 1) + (80 if (y, x) == (20, 9) else 0)) for y in range(32) for x in range(32)]
    df = spark.createDataFrame([*px, (2, 0, 0, None)], "frame_id long, y long, x long, v double")
    masked, facts = ca.mask_outliers(df, 6.0, 8)
    gone = [(r["y"], r["x"]) for r in masked.where("v IS NULL").collect()]
    # a slope of 62 over the frame would hide 80 from one median for all of it
    assert gone == [(20, 9)] and facts.count() == 1 and 125 < facts.first()["bkg"] < 137


def test_vectors_meet_frames_before_they_are_pixels(spark):
    """Pixels that know their type are cut without a join, and outliers are masked without masters of flats."""
    from frameloom.plans import calibration_queries as cq

    plan = cq.cal_pixels(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert 0 <= plan.index("Generate posexplode") < plan.index("Join")
    rows, px, _ = nights()
    frames = spark.createDataFrame(rows, FRAMES)
    pixels = spark.createDataFrame(px, "frame_id long, y long, x long, v double")
    flats = ca.of_kind(frames, "FLAT")
    typed = ca.pixels_of(flats, pixels.join(frames.select("frame_id", "imagetyp"), "frame_id"), "FLAT")
    assert sorted(typed.collect()) == sorted(ca.pixels_of(flats, pixels, "FLAT").collect()) and typed.count() == 640
    assert "Join" not in ca.pixels_of(flats, frames.select("frame_id", "imagetyp", *(F.lit(0).alias(c) for c in "yxv")), "FLAT")._jdf.queryExecution().optimizedPlan().toString()
