"""Jobs that SQL doesn't check: predictions measured on their frames."""

import math

from frameloom import catalogue


def test_moving_objects_are_measured_on_their_frames(spark):
    rows = catalogue.QUERIES["moving_object_photometry"](spark, "/root/testdata/sf0.001").collect()
    assert len({(r["frame_id"], r["src_id"]) for r in rows}) == len(rows) > 0
    for r in rows:
        assert r["bad"] == (r["net"] <= 0) and (r["mag_inst"] is None) == r["bad"]
        if not r["bad"]:
            assert abs(r["mag_inst"] + 2.5 * math.log10(r["net"] / 30)) < 1e-9 and abs(r["snr"] - r["net"] / r["err"]) < 1e-9


def test_moving_objects_at_one_place_are_measured_once(spark, tmp_path, monkeypatch):
    """Predictions at places that others have too, on frames of which most have no pixels: each has its row, of one measurement."""
    from frameloom.operators import imaging as im

    data = "/root/testdata/sf0.001"
    for name in ("embeddings", "supplier"):
        spark.read.parquet(f"{data}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    orders = spark.read.parquet(f"{data}/orders.parquet")
    orders.unionByName(orders.withColumn("o_orderkey", orders["o_orderkey"] + 612_000)).write.parquet(f"{tmp_path}/orders.parquet")
    want = {(r["frame_id"], r["src_id"]): r["net"] for r in catalogue.QUERIES["moving_object_photometry"](spark, data).collect()}
    seen = []
    centred = im.windowed_centroids
    monkeypatch.setattr(im, "windowed_centroids", lambda px, at, *rest: (seen.append(at.count()), centred(px, at, *rest))[1])
    got = {(r["frame_id"], r["src_id"]): r["net"] for r in catalogue.QUERIES["moving_object_photometry"](spark, str(tmp_path)).collect()}
    assert got.keys() == want.keys() | {(f, s + 612_000) for f, s in want} and all(abs(v - want[f, s % 612_000]) < 1e-9 for (f, s), v in got.items())
    assert len(want) <= seen[0] < len(got)


def test_moving_objects_go_through_every_step(spark):
    """Each frame's own predictions, seven widths from the border; centred above the background, in circles as wide as their tile's stars, against sums by
    hand; frames' own words and zero points come along."""
    import numpy as np
    from pyspark.sql import functions as F

    from frameloom.functions import formulas as fx
    from frameloom.operators import detection as de
    from frameloom.operators import zeropoints as zp
    from frameloom.plans import photometry_queries as ph
    from frameloom.sources import tables as t

    data = "/root/testdata/sf0.001"
    rows = catalogue.QUERIES["moving_object_photometry"](spark, data).collect()
    x, y = fx.sky_to_pixel("ra", "dec", "ra0", "dec0", "2e0", "32", "32")
    e = t.ephemeris(spark, data).join(t.mosaic_frames(spark, data), F.col("obsid") == F.col("frame_id")).where(F.expr(fx.angular_separation("ra", "dec", "ra0", "dec0")) < 89)
    want = {(r["frame_id"], r["eph_id"]): (r["x"], r["y"]) for r in e.select("frame_id", "eph_id", F.expr(x).alias("x"), F.expr(y).alias("y")).collect()}
    want = {k: p for k, p in want.items() if min(*p, 64 - p[0], 64 - p[1]) > 17.5}
    got = {(r["frame_id"], r["src_id"]): r for r in rows}
    assert got.keys() <= want.keys() and len(got) >= len(want) - 1 > 3
    px = ph.image(spark, data)
    tiles = zp.tile_widths(de.round_stars(zp.tiles_of(de.source_table(ph.members(px)), 32, size=(64, 64)), *ph.PEAKS)).collect()
    image = {}
    for r in px.collect():
        image.setdefault(r["frame_id"], np.zeros((64, 64)))[r["y"], r["x"]] = r["v"]
    yy, xx = np.mgrid[:64, :64]
    for k, r in got.items():
        assert (r["x_init"], r["y_init"]) == want[k] and 0 < math.hypot(r["x_winpos"] - r["x_init"], r["y_winpos"] - r["y_init"]) < 20
        own = {(w["i"], w["j"]): w["fwhm_avg"] for w in tiles if w["frame_id"] == k[0]}
        width = own.get((int(r["x_winpos"] // 32), int(r["y_winpos"] // 32)), np.median(list(own.values())))
        assert abs(r["fwhm"] - min(max(width, 1.5), 10)) < 1e-9 and abs(r["area"] - math.pi * (1.5 * r["fwhm"]) ** 2) < 1e-9
        v, far = image[k[0]], np.hypot(xx - r["x_winpos"], yy - r["y_winpos"])
        sky = v[(far > 3 * r["fwhm"]) & (far <= 4 * r["fwhm"]) & (v < ph.FULL)]
        for _ in range(5):
            sky = sky[np.abs(sky - np.median(sky)) <= 3 * sky.std()]
        assert abs(r["sky"] - np.median(sky)) < 1e-6 and abs(r["sky_std"] - sky.std()) < 1e-6
        fine = (np.arange(20) - 9.5) / 20
        share = np.mean([np.hypot(xx + a - r["x_winpos"], yy + b - r["y_winpos"]) <= 1.5 * r["fwhm"] for a in fine for b in fine], axis=0)
        assert abs((share * v).sum() - r["aperture_sum"]) < 0.005 * r["aperture_sum"] and abs(r["net"] - (r["aperture_sum"] - r["area"] * r["sky"])) < 1e-6
        assert r["filename"] == f"img_{k[0]}.fits" and r["exptime"] == 30 and len(r["obsdate"]) == 8 and -90 <= r["altcen"] <= 90 and r["fwhm_global"] == 2.5
    assert any(r["zp_global"] and abs(r["zp_global"] - 20 + 2.5 * math.log10(30)) < 0.1 for r in rows)


def test_dense_positions_are_measured_alike(spark):
    """Pixels that go to the positions' cells give what positions that go to the pixels' cells give, and their pairs are not shuffled again."""
    import random

    from frameloom.operators import apertures as ap
    from frameloom.operators import imaging as im

    rng = random.Random(4)
    px = spark.createDataFrame([(f, y, x, 100 + rng.random() * 50) for f in (1, 2) for y in range(40) for x in range(40)], "frame_id long, y long, x long, v double")
    at = [(1 + k % 2, k, rng.uniform(-3, 43), rng.uniform(-3, 43), rng.choice((1.5, 2.25, 3.0)), 30.0) for k in range(150)] + [(1, 900, None, 2.0, 2.0, 30.0)]
    at = spark.createDataFrame(at, "frame_id long, src_id long, x double, y double, fwhm double, exptime double")
    near = lambda df: {(r["frame_id"], r["src_id"]): [round(v, 6) if isinstance(v, float) else v for v in r] for r in df.collect()}
    assert near(ap.measure(px, at, (1.5, 3.0, 4.0), dense=40)) == near(ap.measure(px, at, (1.5, 3.0, 4.0)))
    assert near(im.windowed_centroids(px, at, 2.5, 3, 40)) == near(im.windowed_centroids(px, at, 2.5))
    plan = ap.near_pixels(px, at.withColumn("r", at["fwhm"]), "r", dense=40).groupBy(*ap.key(40)).count()._jdf.queryExecution().executedPlan().toString()
    assert plan.split("SortMergeJoin")[0].count("Exchange") == 0
