"""Queries over pixels: apertures, sky, centroids, detection, stamps, backgrounds, fields."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import formulas as fx
from ..operators import imaging as im
from ..operators import survey as ops
from ..sources import tables as t
from .survey_queries import _duck_clip, query, rounded

NEAR = "SELECT p.frame_id, s.src_id, p.x AS px, p.y AS py, p.v, s.x AS sx, s.y AS sy FROM pixels p JOIN positions s ON p.frame_id = s.frame_id"
SHARE = fx.disc_share("(px - sx)", "(py - sy)", 1.75)
APER = f"near AS ({NEAR}), aper AS (SELECT *, {SHARE} AS share FROM near WHERE power(px - sx, 2) + power(py - sy, 2) < 6.25), cut AS (SELECT * FROM aper WHERE share > 1e-9)"
ERROR = fx.pixel_error("1000 * v")


@query("aperture_join", t.with_("pixels", "positions") + f", {APER} SELECT frame_id, src_id, py AS y, px AS x, round(share, 6) + 0 AS share FROM cut WHERE share > 0.001")
def _(spark, d):
    rows = im.apertures(t.pixels(spark, d), t.positions(spark, d), 1.75).where("share > 0.001")
    return rounded(rows, "share").select("frame_id", "src_id", F.col("py").alias("y"), F.col("px").alias("x"), "share")


@query("aperture_sum", t.with_("pixels", "positions") + f", {APER} SELECT frame_id, src_id, round(sum(share * v), 6) + 0 AS aperture_sum, round(sum(share), 6) + 0 AS area, round(sqrt(sum(share * power({ERROR}, 2))), 6) + 0 AS aperture_sum_err FROM cut GROUP BY ALL")
def _(spark, d):
    out = im.aperture_sum(t.pixels(spark, d), t.positions(spark, d), 1.75, error=ERROR)
    return rounded(out, "aperture_sum", "area", "aperture_sum_err").select("frame_id", "src_id", "aperture_sum", "area", "aperture_sum_err")


@query("aperture_badpix", t.with_("pixels", "positions") + f", {APER} SELECT frame_id, src_id, round(coalesce(sum(share) FILTER (WHERE v < -0.15), 0), 6) + 0 AS n_bad, coalesce(sum(share) FILTER (WHERE v < -0.15), 0) > 0 AS flagged FROM cut GROUP BY ALL")
def _(spark, d):
    return rounded(im.aperture_sum(t.pixels(spark, d), t.positions(spark, d), 1.75, bad="v < -0.15"), "n_bad").select("frame_id", "src_id", "n_bad", "flagged")


@query("annulus_sky", t.with_("pixels", "positions") + f", near AS ({NEAR}), ring AS (SELECT frame_id, src_id, v FROM near WHERE sqrt(power(px - sx, 2) + power(py - sy, 2)) <= 3.1 AND sqrt(power(px - sx, 2) + power(py - sy, 2)) > 1.8), " + _duck_clip("ring", "src_id", "v", 2.0, 3) + " SELECT frame_id, src_id, round(median(v), 6) + 0 AS sky, round(stddev_pop(v), 6) + 0 AS sky_std, count(*) AS n_sky FROM c2 GROUP BY ALL")
def _(spark, d):
    return rounded(im.annulus_sky(t.pixels(spark, d), t.positions(spark, d), 1.8, 3.1, 2.0, 3), "sky", "sky_std")


def _duck_centroids(fwhm: float, rounds: int) -> str:
    two = 2 * (fwhm / 2.355) ** 2
    out = [f"near AS ({NEAR} WHERE v > 0 AND sqrt(power(p.x - s.x, 2) + power(p.y - s.y, 2)) <= {2 * fwhm}), m0 AS (SELECT DISTINCT frame_id, src_id, sx AS x, sy AS y FROM near)"]
    for n in range(rounds):
        w = f"v * exp(-(power(px - x, 2) + power(py - y, 2)) / {two}e0)"
        out.append(f"m{n + 1} AS (SELECT frame_id, src_id, x + 2 * sum({w} * (px - x)) / sum({w}) AS x, y + 2 * sum({w} * (py - y)) / sum({w}) AS y FROM near JOIN m{n} USING (frame_id, src_id) GROUP BY frame_id, src_id, x, y)")
    return ", ".join(out)


@query("centroid_windowed", t.with_("pixels", "positions") + f", {_duck_centroids(1.5, 3)} SELECT frame_id, src_id, round(x, 5) + 0 AS x, round(y, 5) + 0 AS y FROM m3")
def _(spark, d):
    return rounded(im.windowed_centroids(t.pixels(spark, d), t.positions(spark, d), 1.5), "x", "y", digits=5)


STAMP = """spot AS (SELECT frame_id, src_id, CAST(floor(x + 0.5) AS INT) AS cx, CAST(floor(y + 0.5) AS INT) AS cy FROM positions), raw AS (SELECT a.frame_id, src_id, CAST(p.y - cy AS INT) AS dy, CAST(p.x - cx AS INT) AS dx, v FROM spot a JOIN pixels p ON a.frame_id = p.frame_id AND abs(p.x - cx) <= 1 AND abs(p.y - cy) <= 1),
  facts AS (SELECT frame_id, src_id, min(v) AS low, sum(v) AS total, count(*) AS n FROM raw GROUP BY ALL HAVING count(*) = 9), stamp AS (SELECT frame_id, src_id, dy, dx, (v - low) / (total - n * low) AS v FROM raw JOIN facts USING (frame_id, src_id))"""


@query("psf_stamp", t.with_("pixels", "positions") + f", {STAMP} SELECT frame_id, CAST(floor(y / 4) AS INT) AS j, CAST(floor(x / 4) AS INT) AS i, dy, dx, round(median(v), 6) + 0 AS v FROM stamp JOIN positions USING (frame_id, src_id) GROUP BY ALL")
def _(spark, d):
    at = t.positions(spark, d)
    tiles = at.select("frame_id", "src_id", F.floor(F.col("y") / 4).cast("int").alias("j"), F.floor(F.col("x") / 4).cast("int").alias("i"))
    return rounded(im.stamps(t.pixels(spark, d), at).join(tiles, ["frame_id", "src_id"]).groupBy("frame_id", "j", "i", "dy", "dx").agg(F.median("v").alias("v")), "v")


@query("star_width", t.with_("pixels", "positions") + f", {STAMP}, m AS (SELECT frame_id, src_id, sum(v * dx * dx) - power(sum(v * dx), 2) AS vx, sum(v * dy * dy) - power(sum(v * dy), 2) AS vy FROM stamp GROUP BY ALL) SELECT frame_id, src_id, round(2.3548 * sqrt(sqrt(greatest(vx, 0)) * sqrt(greatest(vy, 0))), 6) + 0 AS fwhm FROM m")
def _(spark, d):
    return rounded(im.star_width(im.stamps(t.pixels(spark, d), t.positions(spark, d))), "fwhm").select("frame_id", "src_id", "fwhm")


@query("psf_map", t.with_("pixels", "positions") + f""", {STAMP}, m AS (SELECT frame_id, src_id, sum(v * dx * dx) - power(sum(v * dx), 2) AS vx, sum(v * dy * dy) - power(sum(v * dy), 2) AS vy, sum(v * dx * dy) - sum(v * dx) * sum(v * dy) AS vxy FROM stamp GROUP BY ALL),
  top AS (SELECT frame_id, src_id, max(v) AS peak FROM raw GROUP BY ALL), w AS (SELECT m.frame_id, m.src_id, CAST(floor(y / 4) AS INT) AS j, CAST(floor(x / 4) AS INT) AS i, 2.3548 * sqrt(sqrt(greatest(vx, 0)) * sqrt(greatest(vy, 0))) AS fwhm, degrees(atan2(2 * vxy, vx - vy)) / 2 AS theta, peak
    FROM m JOIN positions USING (frame_id, src_id) JOIN top USING (frame_id, src_id)), good AS (SELECT * FROM w WHERE fwhm > 1.5 AND fwhm < 8),
  tile AS (SELECT frame_id, j, i, avg(fwhm) AS a, median(fwhm) AS m, stddev_pop(fwhm) AS s, avg(theta) AS t, min(peak) AS lo, max(peak) AS hi, count(*) AS n_star FROM good GROUP BY ALL),
  mid AS (SELECT frame_id, j, i, dy, dx, median(v) AS v FROM stamp JOIN good USING (frame_id, src_id) GROUP BY ALL)
  SELECT frame_id, j, i, (i + 0.5::DOUBLE) * 4 AS x_center, (j + 0.5::DOUBLE) * 4 AS y_center, round(a, 6) + 0 AS fwhm_avg, round(m, 6) + 0 AS fwhm_median, round(s, 6) + 0 AS fwhm_stddev, round(t, 4) + 0 AS theta_avg, round(lo, 6) + 0 AS peak_min, round(hi, 6) + 0 AS peak_max, n_star, dy, dx, round(v, 6) + 0 AS v FROM tile JOIN mid USING (frame_id, j, i)""")
def _(spark, d):
    """A row per pixel of each tile's median stamp."""
    tiles = im.psf_map(t.pixels(spark, d), t.positions(spark, d), 4).select("*", F.explode("psf").alias("p")).select("*", "p.dy", "p.dx", "p.v")
    out = rounded(rounded(tiles, "fwhm_avg", "fwhm_median", "fwhm_stddev", "peak_min", "peak_max", "v"), "theta_avg", digits=4)
    return out.drop("psf", "p")


TILED = "tiled AS (SELECT frame_id, CAST(y // 4 AS BIGINT) AS j, CAST(x // 4 AS BIGINT) AS i, frame_id * 4 + (y // 4) * 2 + x // 4 AS k, v FROM pixels), " + _duck_clip("tiled", "k", "v", 2.0, 3) + """, own AS (SELECT frame_id, j, i, median(v) AS own, stddev_pop(v) AS rms FROM c2 GROUP BY ALL),
  mesh AS (SELECT a.frame_id, a.j, a.i, any_value(a.rms) AS rms, median(b.own) AS level FROM own a JOIN own b ON a.frame_id = b.frame_id AND abs(a.j - b.j) <= 1 AND abs(a.i - b.i) <= 1 GROUP BY a.frame_id, a.j, a.i)"""


@query("background_mesh", t.with_("pixels") + f", {TILED} SELECT frame_id, j, i, round(level, 6) + 0 AS level, round(rms, 6) + 0 AS rms FROM mesh")
def _(spark, d):
    return rounded(im.background(t.pixels(spark, d), 4, 2.0, 3), "level", "rms")


@query("background_level", t.with_("pixels") + f", {TILED}, a AS (SELECT *, greatest(0, least((y + 0.5) / 4 - 0.5, 1))::DOUBLE AS ty, greatest(0, least((x + 0.5) / 4 - 0.5, 1))::DOUBLE AS tx FROM pixels) SELECT a.frame_id, y, x, round(sum((CASE WHEN j = 0 THEN 1 - ty ELSE ty END) * (CASE WHEN i = 0 THEN 1 - tx ELSE tx END) * level), 6) + 0 AS bg FROM a JOIN mesh ON a.frame_id = mesh.frame_id GROUP BY a.frame_id, y, x")
def _(spark, d):
    px = t.pixels(spark, d)
    return rounded(im.background_level(px, im.background(px, 4, 2.0, 3), 4), "bg").select("frame_id", "y", "x", "bg")


@query("bad_pixel_map", t.with_("pixels") + """, e AS (SELECT grp, min(frame_id) AS a, max(frame_id) AS b FROM pixels GROUP BY ALL), ratio AS (SELECT e.grp, p.y, p.x, (q.v + 5) / (p.v + 5) AS v FROM e JOIN pixels p ON p.frame_id = a JOIN pixels q ON q.frame_id = b AND q.y = p.y AND q.x = p.x),
  l AS (SELECT r.grp, r.y, r.x, any_value(r.v) - median(o.v) AS residual FROM ratio r JOIN ratio o ON r.grp = o.grp AND abs(r.y - o.y) <= 3 AND abs(r.x - o.x) <= 3 GROUP BY ALL), w AS (SELECT grp, y // 15 AS tile_y, x // 15 AS tile_x, quantile_cont(residual, 0.691) - quantile_cont(residual, 0.309) AS s FROM l GROUP BY ALL)
  SELECT l.grp, y, x, round(residual, 6) + 0 AS residual, abs(residual) > 9 * s AS bad FROM l JOIN w ON l.grp = w.grp AND y // 15 = tile_y AND x // 15 = tile_x""")
def _(spark, d):
    px = t.pixels(spark, d)
    ends = px.groupBy("grp").agg(F.min("frame_id").alias("a"), F.max("frame_id").alias("b"))
    of = lambda c: ends.join(px.select(F.col("frame_id").alias(c), "y", "x", (F.col("v") + 5).alias(f"v{c}")), c).select("grp", "y", "x", f"v{c}")
    ratio = of("a").join(of("b"), ["grp", "y", "x"]).select("grp", "y", "x", (F.col("vb") / F.col("va")).alias("v"))
    return rounded(im.bad_pixels(ratio, ["grp"]), "residual")


def _in_fields(table: str, scale: float, size: int, pad: int = 0) -> str:
    x, y = fx.sky_to_pixel("r.ra", "r.dec", "f.ra", "f.dec", f"{scale}e0", str(size // 2), str(size // 2))
    gap = fx.angular_separation("r.ra", "r.dec", "f.ra", "f.dec")
    return f"inside AS (SELECT * FROM (SELECT r.* EXCLUDE (ra, dec), f.field_id, {x} AS px, {y} AS py, {gap} AS gap FROM {table} r, fields f WHERE abs(r.dec - f.dec) < {0.75 * scale * (size + 2 * pad)}) WHERE gap < 89 AND px BETWEEN {-pad} AND {size + pad} AND py BETWEEN {-pad} AND {size + pad})"


@query("targets_in_fov", t.with_("ephemeris", "fields") + ", " + _in_fields("ephemeris", 0.002, 4096) + " SELECT eph_id, field_id, round(px, 4) + 0 AS x, round(py, 4) + 0 AS y FROM inside")
def _(spark, d):
    return ops.in_fields(t.ephemeris(spark, d).select("eph_id", "ra", "dec"), t.fields(spark, d), 0.002, 4096, digits=4).select("eph_id", "field_id", "x", "y")


@query("field_catalog", t.with_("stars", "fields") + ", " + _in_fields("stars", 0.002, 4096, 10) + """, k AS (SELECT * FROM inside WHERE mag > 12.5 AND mag < 18), lights AS (SELECT * FROM inside WHERE mag <= 12.5)
  SELECT field_id, star_id, mag, round(px, 4) + 0 AS x, round(py, 4) + 0 AS y FROM k a WHERE NOT EXISTS (SELECT 1 FROM k b WHERE a.field_id = b.field_id AND a.star_id <> b.star_id AND sqrt(power(a.px - b.px, 2) + power(a.py - b.py, 2)) < 150)
    AND NOT EXISTS (SELECT 1 FROM lights b WHERE a.field_id = b.field_id AND sqrt(power(a.px - b.px, 2) + power(a.py - b.py, 2)) < 500)""")
def _(spark, d):
    """The stars of a range of magnitudes on each field's image and ten pixels about it, away from each other and from the brighter ones."""
    stars = t.stars(spark, d)
    alone = ops.isolated_in_fields(stars.where("mag > 12.5 AND mag < 18"), t.fields(spark, d), 0.002, 4096, 150.0, stars.where("mag <= 12.5"), 500.0, 10)
    return rounded(alone, "x", "y", digits=4).select("field_id", "star_id", "mag", "x", "y")


@query("merge_boxes")
def _(spark, d):
    return im.merge_boxes(ops.field_boxes(t.fields(spark, d), 4.0))
