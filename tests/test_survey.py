"""Survey operators against independent answers: brute force, planted values and SQL."""

import math
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from frameloom import catalogue
from frameloom.functions import formulas as fx
from frameloom.operators import survey as ops

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def rows(df):
    return sorted(tuple(repr(round(float(v), 6)) if isinstance(v, float) else repr(v) for v in r) for r in df.select(*sorted(df.columns)).collect())


@pytest.mark.parametrize("name", ["nearest_bias", "nearest_dark", "match_catalogs", "isolate_bright", "fov_subset", "zeropoint", "stack_bias", "correct_level1", "nearest_on_sky"])
def test_equals_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    want = con.execute(catalogue.SQL[name]).df()
    want = sorted(tuple(repr(round(float(v), 6)) if isinstance(v, float) and v == v else repr(None if v != v else v) for v in r) for r in want[sorted(want.columns)].itertuples(index=False))
    got = rows(catalogue.QUERIES[name](spark, DATA))
    assert len(got) == len(want)
    clean = lambda x: [tuple(v.replace("np.int64(", "").replace("np.int32(", "").replace("np.float64(", "").rstrip(")") for v in r) for r in x]
    numbers = lambda x: sorted(tuple(f"{float(v):.5f}" if v not in ("None", "True", "False") and v.replace(".", "").replace("-", "").replace("e", "").isdigit() else v for v in r) for r in clean(x))
    assert numbers(got) == numbers(want)


def test_nearest_in_time_across_blocks(spark):
    rng = random.Random(5)
    masters = [(i, d, rng.randrange(0, 10**9)) for i, d in ((i, i % 2) for i in range(30))]
    frames = [(1000 + i, i % 3, rng.randrange(0, 10**9)) for i in range(200)]
    m = spark.createDataFrame(masters, "frame_id long, detector long, us long")
    f = spark.createDataFrame(frames, "frame_id long, detector long, us long")
    got = {r["frame_id"]: r["master_id"] for r in ops.nearest_in_time(f, m, block=10**7).collect()}
    for i, d, us in frames:
        own = [(abs(us - t), t, k) for k, e, t in masters if e == d]
        assert got[i] == (min(own)[2] if own else None)


def test_galactic_centre(spark):
    lon, lat = fx.galactic("266.40499", "-28.93617")
    r = spark.range(1).select(F.expr(lon).alias("l"), F.expr(lat).alias("b")).first()
    assert min(r["l"], 360 - r["l"]) < 1e-3 and abs(r["b"]) < 1e-3


def test_tangent_plane_round_trip(spark):
    df = spark.createDataFrame([(0.2, 40.3), (359.8, 39.9)], "ra double, dec double")
    x, y = fx.sky_to_pixel("ra", "dec", "0.0", "40.0", "0.001", "500", "500")
    df = df.withColumns({"x": F.expr(x), "y": F.expr(y)})
    ra, dec = fx.pixel_to_sky("x", "y", "0.0", "40.0", "0.001", "500", "500")
    for r in df.withColumns({"ra2": F.expr(ra), "dec2": F.expr(dec)}).collect():
        assert math.isclose(r["ra"], r["ra2"], abs_tol=1e-6) and math.isclose(r["dec"], r["dec2"], abs_tol=1e-6)


def test_sun_at_equinox(spark):
    ra, dec = fx.sun("2460389.629e0")  # 2024-03-20 03:06 UT
    r = spark.range(1).select(F.expr(ra).alias("ra"), F.expr(dec).alias("dec")).first()
    assert min(r["ra"], 360 - r["ra"]) < 0.05 and abs(r["dec"]) < 0.02


def test_hot_pixel_leaves_stack(spark):
    data = [(f, 0, 0, 10.0 + 0.01 * f) for f in range(9)] + [(9, 0, 0, 5000.0)]
    r = ops.stack(spark.createDataFrame(data, "frame_id int, y int, x int, v double"), ["y", "x"], 5).first()
    assert r["n"] == 10 and r["n_kept"] == 9 and abs(r["v"] - 10.04) < 1e-9


def test_nearest_on_sky_goes_on_to_the_whole_sky(spark):
    targets = spark.createDataFrame([(1, 10.0, 5.0), (2, 190.0, -5.0), (3, 359.9, 89.9), (4, None, 1.0)], "eph_id long, ra double, dec double")
    stars = spark.createDataFrame([(8, 10.2, 5.0), (9, 30.0, 60.0)], "star_id long, ra double, dec double")
    got = {r["eph_id"]: (r["star_id"], round(r["dist"] / 3600)) for r in ops.nearest_on_sky(targets, stars, 1.0).collect()}
    assert got == {1: (8, 0), 2: (9, 123), 3: (9, 30)} and ops.nearest_on_sky(targets, stars.limit(0), 1.0).count() == 0


def test_copies_of_targets_and_stars_meet_once(spark, monkeypatch):
    """Targets and stars at few places: each place is compared once, in cells for the places' density, and every target has its star."""
    rng = random.Random(8)
    spots = [(rng.uniform(0, 360), math.degrees(math.asin(rng.uniform(-1, 1)))) for _ in range(2000)]
    stars = spark.createDataFrame([(k, *spots[k % 2000]) for k in range(6000)], "star_id long, ra double, dec double")
    targets = spark.createDataFrame([(k, *spots[k % 40]) for k in range(800)], "eph_id long, ra double, dec double")
    seen = []
    within = ops.nearest_within
    monkeypatch.setattr(ops, "nearest_within", lambda t, s, r: (seen.append((t.count(), s.count(), r)), within(t, s, r))[1])
    got = {r["eph_id"]: r["star_id"] for r in ops.nearest_on_sky(targets, stars, 30.0).collect()}
    assert got == {k: k % 40 for k in range(800)}
    assert seen[0][:2] == (40, 2000) and 4 < seen[0][2] < 5


def test_copies_of_fields_and_stars_are_projected_once(spark, monkeypatch):
    rng = random.Random(9)
    sky = [(rng.uniform(9, 12), rng.uniform(-2, 2), i % 5 == 0) for i in range(150)]
    stars = [(i, a, d, 13.0) for i, (a, d, _) in enumerate(sky)] + [(1000 + i, a, d, 14.0) for i, (a, d, twice) in enumerate(sky) if twice]
    s = spark.createDataFrame(stars, "star_id long, ra double, dec double, mag double")
    f = spark.createDataFrame([(k, 10.0 + k % 2, 0.0) for k in range(30)], "field_id long, ra double, dec double")
    seen = []
    pairs = ops.pairs_within
    monkeypatch.setattr(ops, "pairs_within", lambda a, b, *rest, **named: (seen.append(b.count()), pairs(a, b, *rest, **named))[1])
    got = {(r["field_id"], r["star_id"]) for r in ops.isolated_in_fields(s, f, 0.002, 1024, 40.0).collect()}
    inside = {}
    for r in ops.in_fields(s, f, 0.002, 1024).collect():
        inside.setdefault(r["field_id"], []).append(r)
    want = {(k, a["star_id"]) for k, here in inside.items() for a in here if all(a["star_id"] == b["star_id"] or math.hypot(a["x"] - b["x"], a["y"] - b["y"]) >= 40 for b in here)}
    assert got == want and len(want) > 30 and seen[0] < sum(map(len, inside.values())) / 15


def test_isolated_meets_few_cells_in_tasks_by_rows(spark, monkeypatch):
    """Places on the borders of cells and on either side of 0 against brute force; a place goes to the cells it can reach, and rows that are
    alike are spread over tasks by their number."""
    rng = random.Random(17)
    rows = [(i % 3, i, rng.choice((-120.0, -60.0, 0.0, 45.0, 60.0)) + rng.choice((-15.0, -0.5, 0.0, 14.9, 15.0, 30.0)), rng.uniform(-200, 200)) for i in range(400)] + [(0, 900, None, 1.0), (0, 901, 1.0, None)]
    df = spark.createDataFrame(rows, "frame_id long, star_id long, x double, y double")
    here = [r for r in rows if r[2] is not None and r[3] is not None]
    near = {(a[0], a[1]) for a in here for b in here if a[0] == b[0] and a[1] != b[1] and math.hypot(a[2] - b[2], a[3] - b[3]) < 15}
    assert {(r["frame_id"], r["star_id"]) for r in ops.isolated(df, 15.0).collect()} == {(r[0], r[1]) for r in rows} - near and near
    many = spark.range(250_000).select(F.lit(1).cast("long").alias("frame_id"), F.col("id").alias("star_id"), (F.col("id") * 100.0).alias("x"), F.lit(0.0).alias("y"))
    plan = ops.isolated(many, 15.0)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RepartitionByExpression") == 2 and ", 3" in plan
    assert ops.cells(many, 60.0, reach=15.0).count() < 4 * 250_000


def test_fields_leave_out_what_lies_near_bright_stars(spark):
    """Bright stars of a field hide fainter ones about them, also from the pixels about the image, which count as its own."""
    rng = random.Random(3)
    sky = [(i, rng.uniform(8.9, 11.1), rng.uniform(-1.1, 1.1), 12.0 if i % 12 == 0 else 14.0) for i in range(160)]
    sky += [(500, 10.0, 1.03, 14.0), (501, 10.3, 1.03, 14.0), (502, 10.3, 1.03, 12.0)]  # 3 pixels beyond the border
    df = spark.createDataFrame(sky, "star_id long, ra double, dec double, mag double")
    f = spark.createDataFrame([(0, 10.0, 0.0), (1, 10.9, 0.3), (2, 10.0, 0.0)], "field_id long, ra double, dec double")
    faint, bright = df.where("mag > 13"), df.where("mag <= 13")
    got = {(r["field_id"], r["star_id"]) for r in ops.isolated_in_fields(faint, f, 0.002, 1024, 20.0, bright, 60.0, 10).collect()}
    want, bare = set(), set()
    for k, ra, dec in ((r["field_id"], r["ra"], r["dec"]) for r in f.collect()):
        x, y = fx.sky_to_pixel("ra", "dec", f"{ra}e0", f"{dec}e0", "0.002e0", "512", "512")
        at = [r for r in df.select("star_id", "mag", F.expr(x).alias("x"), F.expr(y).alias("y")).collect() if -10 <= r["x"] <= 1034 and -10 <= r["y"] <= 1034]
        near = lambda a, mags, d: any(a["star_id"] != b["star_id"] and b["mag"] in mags and math.hypot(a["x"] - b["x"], a["y"] - b["y"]) < d for b in at)  # noqa: B023, E731
        alone = [a for a in at if a["mag"] > 13 and not near(a, (14.0,), 20)]
        bare |= {(k, a["star_id"]) for a in alone}
        want |= {(k, a["star_id"]) for a in alone if not near(a, (12.0,), 60)}
    assert got == want and want < bare and {s for _, s in bare} >= {500, 501} and 501 not in {s for _, s in got}


def test_rows_and_fields_meet_last(spark):
    """Copies of places and centres: each pair of a row and its field is there, rounded as its place's pixel is, and pairs are not shuffled."""
    sky = [(k, 10.0 + 0.01 * (k % 50), 0.005 * (k % 50) - 0.1) for k in range(300)]
    s = spark.createDataFrame(sky, "eph_id long, ra double, dec double")
    f = spark.createDataFrame([(k, 10.0 + k % 2, 0.0) for k in range(30)], "field_id long, ra double, dec double")
    df = ops.in_fields(s, f, 0.002, 512, digits=4)
    got = {(r["eph_id"], r["field_id"]): (r["x"], r["y"]) for r in df.collect()}
    want = {}
    for c in (10, 11):
        x, y = fx.sky_to_pixel("ra", "dec", f"{c}e0", "0e0", "0.002e0", "256", "256")
        for r in s.select("eph_id", F.expr(x).alias("x"), F.expr(y).alias("y")).where("x BETWEEN 0 AND 512 AND y BETWEEN 0 AND 512").collect():
            want |= {(r["eph_id"], k): (round(r["x"], 4) + 0.0, round(r["y"], 4) + 0.0) for k in range(30) if 10 + k % 2 == c}
    assert got == want and len(want) > 3000
    # the last join sends the fields to the pairs of a row and a centre
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan.split("Join")[1]
