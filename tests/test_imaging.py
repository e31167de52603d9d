"""Imaging operators against planted values and brute force."""

import math
import random

from pyspark.sql import functions as F

from frameloom.functions import formulas as fx
from frameloom.operators import imaging as im


def test_whole_disc_has_its_area(spark):
    r = spark.range(-6, 7).select(F.col("id").alias("x")).crossJoin(spark.range(-6, 7).select(F.col("id").alias("y")))
    share = fx.disc_share("(x - 0.3e0)", "(y + 0.4e0)", 2.5)
    assert abs(r.agg(F.sum(F.expr(share))).first()[0] - math.pi * 6.25) < 1e-9


def test_detect_joins_corners_and_u_shapes(spark):
    bright = {(1, 1), (1, 5), (2, 1), (2, 5), (3, 1), (3, 2), (3, 3), (3, 4), (3, 5), (6, 6), (7, 7), (8, 8), (9, 0)}
    data = [(1, y, x, 100.0 if (y, x) in bright else 0.0) for y in range(12) for x in range(12)]
    got = im.detect(spark.createDataFrame(data, "frame_id long, y long, x long, v double"), 2.0, 3)
    groups = {(r["label_y"], r["label_x"]): r["n"] for r in got.groupBy("label_y", "label_x").agg(F.count("*").alias("n")).collect()}
    assert groups == {(1, 1): 9, (6, 6): 3}


def test_centroid_finds_a_star(spark):
    data = [(1, y, x, math.exp(-((x - 7.3) ** 2 + (y - 6.8) ** 2) / 2)) for y in range(15) for x in range(15)]
    px = spark.createDataFrame(data, "frame_id long, y long, x long, v double")
    at = spark.createDataFrame([(1, 9, 7.0, 7.0)], "frame_id long, src_id long, x double, y double")
    r = im.windowed_centroids(px, at, 2.355, 6).first()
    assert abs(r["x"] - 7.3) < 0.01 and abs(r["y"] - 6.8) < 0.01


def test_merged_boxes_equal_brute_force(spark):
    rng = random.Random(3)
    boxes = []
    for _ in range(60):
        a, d = rng.uniform(0, 340), rng.uniform(-80, 70)
        boxes.append((a, a + rng.uniform(1, 20), d, d + rng.uniform(1, 10)))
    want = [(*b, 1) for b in boxes]
    merged = True
    while merged:
        merged = False
        for i in range(len(want)):
            for j in range(i):
                p, q = want[i], want[j]
                if p[0] <= q[1] and q[0] <= p[1] and p[2] <= q[3] and q[2] <= p[3]:
                    want[j] = (min(p[0], q[0]), max(p[1], q[1]), min(p[2], q[2]), max(p[3], q[3]), p[4] + q[4])
                    del want[i]
                    merged = True
                    break
            if merged:
                break
    df = spark.createDataFrame(boxes, "ra1 double, ra2 double, dec1 double, dec2 double")
    got = [tuple(r) for r in im.merge_boxes(df).select("ra1", "ra2", "dec1", "dec2", "n").collect()]
    assert sorted(got) == sorted(want)


def test_flat_background_and_empty_tables(spark):
    px = spark.createDataFrame([(1, y, x, 5.0) for y in range(8) for x in range(8)], "frame_id long, y long, x long, v double")
    mesh = im.background(px, 4)
    assert {r["bg"] for r in im.background_level(px, mesh, 4).collect()} == {5.0}
    none = px.limit(0)
    assert im.detect(none, 1.0, 1).count() == 0 and im.background(none, 4).count() == 0
    at = spark.createDataFrame([], "frame_id long, src_id long, x double, y double")
    assert im.aperture_sum(none, at, 1.5).count() == 0 and im.stamps(none, at).count() == 0


def test_bad_pixels_of_a_wide_box(spark):
    random.seed(4)
    data = [(1, y, x, 1 + random.gauss(0, 0.01)) for y in range(30) for x in range(30)]
    data = [(g, y, x, 2.0 if (y, x) in {(4, 4), (4, 5), (29, 29)} else v) for g, y, x, v in data]
    got = im.bad_pixels(spark.createDataFrame(data, "grp long, y long, x long, v double"), ["grp"])
    assert {(r["y"], r["x"]) for r in got.where("bad").collect()} == {(4, 4), (4, 5), (29, 29)} and got.count() == 900


def test_psf_map_of_planted_stars(spark):
    stars = [(1, 10.0, 10.0, 1.2), (2, 20.0, 11.0, 1.2), (3, 50.0, 50.0, 1.2), (4, 56.0, 40.0, 0.2)]
    data = [(7, y, x, sum(100 * math.exp(-((x - a) ** 2 + (y - b) ** 2) / (2 * s * s)) for _, a, b, s in stars)) for y in range(64) for x in range(64)]
    at = spark.createDataFrame([(7, i, a, b) for i, a, b, _ in stars], "frame_id long, src_id long, x double, y double")
    got = im.psf_map(spark.createDataFrame(data, "frame_id long, y long, x long, v double"), at, 32, half=5).orderBy("j", "i").collect()
    assert [(r["j"], r["i"], r["n_star"], r["x_center"]) for r in got] == [(0, 0, 2, 16.0), (1, 1, 1, 48.0)]
    assert all(abs(r["fwhm_median"] - 2.3548 * 1.2) < 0.02 and len(r["psf"]) == 121 for r in got)


def test_merging_boxes_takes_few_rounds(spark, monkeypatch):
    """A chain of boxes, each overlapping its neighbours only, and many copies about one place."""
    boxes = [(4.0 * i, 4.0 * i + 5, 0.0, 5.0) for i in range(60)] + [(300 + i / 1e4, 301 + i / 1e4, -50.0, -49.0) for i in range(3000)] + [(350.0, 350.0, 7.0, 7.0)] * 2
    rounds = []
    write = im.Steps.write
    monkeypatch.setattr(im.Steps, "write", lambda self, name, df: (rounds.append(name), write(self, name, df))[1])
    got = im.merge_boxes(spark.createDataFrame(boxes, "ra1 double, ra2 double, dec1 double, dec2 double"))
    assert sorted(tuple(r) for r in got.select("ra1", "ra2", "dec1", "dec2", "n").collect()) == [(0.0, 241.0, 0.0, 5.0, 60), (300.0, 301.2999, -50.0, -49.0, 3000), (350.0, 350.0, 7.0, 7.0, 2)]
    assert rounds.count("now") <= 8
