"""Queries from pixels to zero points, over mosaics that are made of all vectors: detection, shapes, masks, apertures, photometry."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import formulas as fx
from ..operators import detection as de
from ..operators import imaging as im
from ..operators import survey as ops
from ..operators import zeropoints as zp
from ..operators.survey import checkpointed
from ..sources import products
from ..sources import tables as t
from .survey_queries import query, rounded

BOX, TILE, SIDE, FULL, EXPTIME, LEAST = 16, 16, 32, 3000.0, 30.0, 7
GAIN, NOISE = 18.69, 3.7
#: Thresholds of the small mosaics, whose brightest stars cover about 70 pixels.
PEAKS, BLOB = (100.0, 2500.0), 60

def _named_clip(source: str, key: str, col: str, k: float, rounds: int, tag: str) -> str:
    """_duck_clip with names of its own, as several stand in one query."""
    out, last = [], source
    for n in range(rounds):
        out.append(f"{tag}f{n} AS (SELECT {key} AS fk, median({col}) AS m, stddev_pop({col}) AS s FROM {last} GROUP BY 1), {tag}c{n} AS (SELECT z.* FROM {last} z JOIN {tag}f{n} ON z.{key} = fk WHERE abs({col} - m) <= {k} * {tag}f{n}.s)")
        last = f"{tag}c{n}"
    return ", ".join(out)


MOSAIC = t.with_("planted", "mosaic").replace("WITH", "WITH RECURSIVE") + f", good AS (SELECT * FROM mosaic WHERE v < {FULL}), "
MESH = f"""tiled AS (SELECT frame_id, y // {BOX} AS j, x // {BOX} AS i, frame_id * 65536 + y // {BOX} * 256 + x // {BOX} AS k, v FROM good), {_named_clip('tiled', 'k', 'v', 3.0, 5, 'b')},
  own AS (SELECT frame_id, j, i, median(v) AS own, stddev_pop(v) AS rms FROM bc4 GROUP BY ALL), mesh AS (SELECT a.frame_id, a.j, a.i, any_value(a.rms) AS rms, median(b.own) AS level FROM own a JOIN own b ON a.frame_id = b.frame_id AND abs(a.j - b.j) <= 1 AND abs(a.i - b.i) <= 1 GROUP BY a.frame_id, a.j, a.i),
  ends AS (SELECT frame_id, max(j) AS lj, max(i) AS li FROM mesh GROUP BY ALL), placed AS (SELECT g.*, greatest(0, least((y + 0.5::DOUBLE) / {BOX} - 0.5::DOUBLE, lj)) AS ty, greatest(0, least((x + 0.5::DOUBLE) / {BOX} - 0.5::DOUBLE, li)) AS tx FROM good g JOIN ends USING (frame_id)),
  weighed AS (SELECT p.frame_id, p.y, p.x, p.v, (1 - abs(m.j - ty)) * (1 - abs(m.i - tx)) AS w, level, rms FROM placed p JOIN mesh m ON p.frame_id = m.frame_id AND abs(m.j - ty) < 1 AND abs(m.i - tx) < 1),
  net AS (SELECT frame_id, y, x, v, v - sum(w * level) / sum(w) AS net, sum(w * rms) / sum(w) AS rms FROM weighed GROUP BY frame_id, y, x, v), """
FOUND = f"""hot AS (SELECT frame_id, y, x, net, y * 65536 + x AS id FROM net WHERE net > 3 * rms), reach(frame_id, a, b) AS (SELECT frame_id, id, id FROM hot UNION SELECT r.frame_id, r.a, h.id FROM reach r JOIN hot h ON r.frame_id = h.frame_id AND abs(h.y - r.b // 65536) <= 1 AND abs(h.x - r.b % 65536) <= 1),
  named AS (SELECT frame_id, a AS id, min(b) AS label, count(*) AS n FROM reach GROUP BY ALL), found AS (SELECT h.*, label, label // 65536 AS label_y, label % 65536 AS label_x FROM hot h JOIN named n ON h.frame_id = n.frame_id AND h.id = n.id WHERE n >= {LEAST}), """
SHAPES = f"""sums AS (SELECT frame_id, label_y, label_x, count(*) AS npix, sum(net) AS flux, max(net) AS peak, sum(net * (x - label_x)) / sum(net) AS mx, sum(net * (y - label_y)) / sum(net) AS my, sum(net * power(x - label_x, 2)) / sum(net) AS mxx, sum(net * power(y - label_y, 2)) / sum(net) AS myy, sum(net * (x - label_x) * (y - label_y)) / sum(net) AS mxy FROM found GROUP BY frame_id, label_y, label_x),
  raw AS (SELECT *, mxx - mx * mx AS rxx, myy - my * my AS ryy, mxy - mx * my AS sxy FROM sums), fat AS (SELECT *, rxx + CASE WHEN rxx * ryy - sxy * sxy < 1 / 144.0::DOUBLE THEN 1 / 12.0::DOUBLE ELSE 0 END AS sxx, ryy + CASE WHEN rxx * ryy - sxy * sxy < 1 / 144.0::DOUBLE THEN 1 / 12.0::DOUBLE ELSE 0 END AS syy FROM raw),
  src AS (SELECT frame_id, label_y * {de.WIDE} + label_x AS src_id, label_y, label_x, npix, flux, peak, label_x + mx AS x, label_y + my AS y, sqrt((sxx + syy) / 2 + sqrt(power((sxx - syy) / 2, 2) + sxy * sxy)) AS a, sqrt(greatest((sxx + syy) / 2 - sqrt(power((sxx - syy) / 2, 2) + sxy * sxy), 0)) AS b, degrees(atan2(2 * sxy, sxx - syy)) / 2 AS theta FROM fat)"""
DETECTED = MOSAIC + MESH + FOUND + SHAPES


def image(spark, d, frames: DataFrame | None = None) -> DataFrame:
    """The mosaics (of the given frames), written once, as every query reads them several times; full pixels are bad."""
    px = t.mosaic(spark, d, frames).withColumn("bad", F.col("v") >= FULL)
    return checkpointed(px.withColumn("err", F.sqrt(F.greatest("v", F.lit(0.0)) / GAIN + (NOISE / GAIN) ** 2)))


DETECT = {"k": 3.0, "least": LEAST, "box": BOX, "tile": TILE}


def members(px: DataFrame) -> DataFrame:
    return de.detect_sources(px, bad="bad", **DETECT)


@query("detect_sources", DETECTED + " SELECT frame_id, label_y, label_x, npix, round(flux, 4) + 0 AS flux, round(peak, 4) + 0 AS peak FROM src")
def _(spark, d):
    return rounded(de.source_table(members(image(spark, d))), "flux", "peak", digits=4).select("frame_id", "label_y", "label_x", "npix", "flux", "peak")


@query("source_moments", DETECTED + " SELECT frame_id, src_id, npix, round(x, 5) + 0 AS x, round(y, 5) + 0 AS y, round(a, 5) + 0 AS a, round(b, 5) + 0 AS b, round(theta, 2) + 0 AS theta FROM src")
def _(spark, d):
    out = de.source_table(members(image(spark, d))).select("frame_id", "src_id", "npix", "x", "y", "a", "b", "theta")
    return rounded(rounded(out, "x", "y", "a", "b", digits=5), "theta", digits=2)


ROUND = f"peak > {PEAKS[0]} AND peak < {PEAKS[1]} AND a / b <= 2"


@query("shape_filter", DETECTED + f" SELECT frame_id, src_id, round(peak, 4) + 0 AS peak, round(a / b, 5) + 0 AS ratio FROM src WHERE {ROUND}")
def _(spark, d):
    kept = de.round_stars(de.source_table(members(image(spark, d))), *PEAKS)
    return rounded(rounded(kept.select("frame_id", "src_id", "peak", (F.col("a") / F.col("b")).alias("ratio")), "peak", digits=4), "ratio", digits=5)


KIND = f"CASE WHEN a / b < 2 AND npix >= {BLOB} THEN 'bright' WHEN a / b >= 3 THEN 'streak' ELSE 'other' END"


@query("classify_blobs", DETECTED + f" SELECT frame_id, src_id, {KIND} AS kind FROM src")
def _(spark, d):
    return de.source_table(members(image(spark, d))).select("frame_id", "src_id", de.blob_kind(BLOB).alias("kind"))


@query("source_mask", DETECTED + f""", kinds AS (SELECT frame_id, label_y, label_x, x AS cx, y AS cy, {KIND} AS kind FROM src), mine AS (SELECT f.frame_id, f.y, f.x, f.label_y, f.label_x, cx, cy, kind FROM found f JOIN kinds k ON f.frame_id = k.frame_id AND f.label_y = k.label_y AND f.label_x = k.label_x),
  ring AS (SELECT frame_id, label_y, label_x, cx, cy, max(sqrt(power(x - cx, 2) + power(y - cy, 2))) + 1 AS r FROM mine WHERE kind = 'bright' GROUP BY ALL) SELECT m.frame_id, m.y, m.x FROM mosaic m JOIN ring r ON m.frame_id = r.frame_id AND sqrt(power(m.x - cx, 2) + power(m.y - cy, 2)) <= r.r UNION SELECT frame_id, y, x FROM mine WHERE kind = 'streak'""")
def _(spark, d):
    px = image(spark, d)
    return de.mask_sources(px, members(px), de.blob_kind(BLOB))


def catalogue_stars(spark, d, frames: DataFrame | None = None) -> DataFrame:
    """What a catalogue has of the planted stars: places a little off, some far off, and magnitudes about a zero point of 20."""
    far = F.when(F.col("star_id") % 11 == 3, 2.0).otherwise(0.0)
    mag = 20 - 2.5 * F.log10("flux") + (F.col("star_id") % 5 - 2) * 0.01
    return t.planted(spark, d, frames).select("frame_id", "star_id", (F.col("x") + (F.col("star_id") % 3 - 1) * 0.125 + far).alias("x"), "y", mag.alias("mag"))


CATALOGUE = ", cat AS (SELECT frame_id, star_id, x + (star_id % 3 - 1) * 0.125::DOUBLE + CASE WHEN star_id % 11 = 3 THEN 2 ELSE 0 END AS x, y, 20 - 2.5::DOUBLE * log10(flux) + (star_id % 5 - 2) * 0.01::DOUBLE AS mag FROM planted)"
MATCHED = CATALOGUE + ", close AS (SELECT s.frame_id, s.src_id, star_id, mag, sqrt(power(s.x - c.x, 2) + power(s.y - c.y, 2)) AS sep FROM src s JOIN cat c ON s.frame_id = c.frame_id AND abs(s.x - c.x) < 3 AND abs(s.y - c.y) < 3), best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY frame_id, src_id ORDER BY sep, star_id) AS nth FROM close WHERE sep < 3) WHERE nth = 1), " + _named_clip("best", "frame_id", "sep", 1.5, 5, "s")


@query("match_sources", DETECTED + MATCHED + " SELECT frame_id, src_id, star_id, round(sep, 5) + 0 AS sep FROM sc4")
def _(spark, d):
    """Detected sources and catalogue stars, outlying separations clipped frame by frame."""
    src = de.source_table(members(image(spark, d)))
    return rounded(ops.match_nearest(src, catalogue_stars(spark, d), 3.0, clip=1.5), "sep", digits=5)


_TX, _TY = fx.tile_index("x", 64, SIDE), fx.tile_index("y", 64, SIDE)
WIDTHS = f", wide AS (SELECT frame_id, {_TX} AS i, {_TY} AS j, 2.3548::DOUBLE * sqrt(a * b) AS w FROM src WHERE {ROUND}), tw AS (SELECT frame_id, i, j, avg(w) AS fw FROM wide WHERE w > 1.5 AND w < 8 GROUP BY ALL), tm AS (SELECT frame_id, median(fw) AS fm FROM tw GROUP BY ALL)"
AT = f", spot AS (SELECT q.frame_id, q.src_id, q.x, q.y, greatest(least(coalesce(tw.fw, tm.fm, 2.5::DOUBLE), 10), 1.5::DOUBLE) AS fwhm FROM (SELECT frame_id, src_id, x, y, {_TX} AS i, {_TY} AS j FROM src) q LEFT JOIN tw ON q.frame_id = tw.frame_id AND q.i = tw.i AND q.j = tw.j LEFT JOIN tm ON q.frame_id = tm.frame_id)"
_AREA = {c: fx.disc_share("dx", "dy", c) for c in ("r", "r1", "r2")}
MEASURED = AT + f""", beside AS (SELECT a.frame_id, a.src_id, a.frame_id * {1 << 40} + a.src_id AS k, p.x - a.x AS dx, p.y - a.y AS dy, p.v, 2.5::DOUBLE * fwhm AS r, 4.0::DOUBLE * fwhm AS r1, 6.0::DOUBLE * fwhm AS r2 FROM spot a JOIN mosaic p ON a.frame_id = p.frame_id AND abs(p.x - a.x) <= 6 * fwhm + 1 AND abs(p.y - a.y) <= 6 * fwhm + 1),
  inner_ AS (SELECT frame_id, src_id, v, {_AREA['r']} AS share FROM beside WHERE dx * dx + dy * dy <= power(r + 0.70711, 2)), circle AS (SELECT frame_id, src_id, coalesce(sum(share * v) FILTER (WHERE v < {FULL}), 0) AS s, sqrt(coalesce(sum(share * (greatest(v, 0) / {GAIN} + power({NOISE}::DOUBLE / {GAIN}, 2))) FILTER (WHERE v < {FULL}), 0)) AS e, coalesce(sum(share) FILTER (WHERE v >= {FULL}), 0) AS n_bad FROM inner_ WHERE share > 1e-9 GROUP BY frame_id, src_id),
  ringed AS (SELECT * FROM beside WHERE dx * dx + dy * dy > r1 * r1 AND dx * dx + dy * dy <= r2 * r2 AND v < {FULL}), {_named_clip("ringed", "k", "v", 3.0, 5, "r")}, sky_ AS (SELECT frame_id, src_id, median(v) AS sky, stddev_pop(v) AS std, sum({_AREA['r2']} - {_AREA['r1']}) AS nsky FROM rc4 GROUP BY frame_id, src_id),
  meas AS (SELECT a.*, {math.pi}::DOUBLE * power(2.5::DOUBLE * fwhm, 2) AS area, s, e, n_bad, sky, std, nsky FROM spot a LEFT JOIN circle c ON a.frame_id = c.frame_id AND a.src_id = c.src_id LEFT JOIN sky_ k ON a.frame_id = k.frame_id AND a.src_id = k.src_id),
  phot AS (SELECT *, s - area * sky AS net, sqrt(e * e + area * std * std + area * area * std * std / nsky) AS err, n_bad > 0 OR NOT coalesce(s - area * sky > 0, false) AS bad, CASE WHEN s - area * sky > 0 THEN -2.5::DOUBLE * log10((s - area * sky) / {EXPTIME}) END AS mag_inst FROM meas)"""


PHOTOMETRY = {"side": SIDE, "size": (64, 64), "peaks": PEAKS}


@query("photometry", DETECTED + WIDTHS + MEASURED + " SELECT frame_id, src_id, round(fwhm, 5) + 0 AS fwhm, round(net, 3) + 0 AS net, round(err, 4) + 0 AS err, round(sky, 4) + 0 AS sky, round(nsky, 4) + 0 AS n_sky, round(n_bad, 4) + 0 AS n_bad, round(mag_inst, 5) + 0 AS mag_inst, bad FROM phot")
def _(spark, d):
    """Every detected source through a circle and a ring as wide as its own tile's stars."""
    px = image(spark, d)
    out = zp.frame_photometry(px, checkpointed(de.source_table(members(px))), EXPTIME, **PHOTOMETRY)
    out = rounded(rounded(rounded(out, "net", digits=3), "net_err", "sky", "n_sky", "n_bad", digits=4), "fwhm", "mag_inst", digits=5)
    return out.select("frame_id", "src_id", "fwhm", "net", F.col("net_err").alias("err"), "sky", "n_sky", "n_bad", "mag_inst", "bad")


@query("frame_zeropoints", DETECTED + MATCHED + WIDTHS + MEASURED + ", dm AS (SELECT p.frame_id, mag - mag_inst AS dm FROM phot p JOIN sc4 m ON p.frame_id = m.frame_id AND p.src_id = m.src_id WHERE NOT bad AND mag_inst IS NOT NULL AND mag BETWEEN 8.5 AND 12.5), " + _named_clip("dm", "frame_id", "dm", 3.0, 5, "z") + " SELECT frame_id, round(median(dm), 5) + 0 AS zp, round(stddev_samp(dm), 5) + 0 AS zp_err, count(*) AS n FROM zc4 GROUP BY frame_id")
def _(spark, d):
    """Pixels to sources, to matches with the catalogue, to photometry with the tiles' widths, to a zero point for each frame."""
    out = zp.frame_zeropoints(image(spark, d), catalogue_stars(spark, d), EXPTIME, 8.5, 12.5, detect=DETECT, photometry=PHOTOMETRY, match_clip=1.5)
    return rounded(out, "zp", "zp_err", digits=5)


@query("read_psf_table", t.with_("positions") + """, s AS (SELECT frame_id, src_id, CAST(floor(x / 4) AS INT) AS i, CAST(floor(y / 4) AS INT) AS j, 1 + src_id % 23 / 2.0::DOUBLE AS w FROM positions), p AS (SELECT frame_id, i, j, round(avg(w), 6) AS w FROM s WHERE frame_id % 2 = 0 AND src_id % 2 = 0 GROUP BY ALL), mid AS (SELECT frame_id, median(w) AS m FROM p GROUP BY ALL)
  SELECT src_id, round(greatest(least(coalesce(p.w, m, 2.5), 10), 1.5), 6) + 0 AS fwhm FROM s LEFT JOIN p ON s.frame_id = p.frame_id AND s.i = p.i AND s.j = p.j LEFT JOIN mid ON s.frame_id = mid.frame_id""")
def _(spark, d):
    """Odd frames have no table, and even ones lack tiles, so that all three ways to a width are met."""
    at = t.positions(spark, d).select("frame_id", "src_id", F.floor(F.col("x") / 4).cast("int").alias("i"), F.floor(F.col("y") / 4).cast("int").alias("j"), (1 + F.col("src_id") % 23 / 2.0).alias("w"))
    tiles = at.where("frame_id % 2 = 0 AND src_id % 2 = 0").groupBy("frame_id", "i", "j").agg(F.round(F.avg("w"), 6).alias("fwhm_avg"), F.count("*").alias("n_star"))
    path = products.fresh_folder(spark, "psf")
    products.write_psf_table(tiles, path)
    return rounded(zp.tile_fwhm(at, products.read_psf_table(spark, path)), "fwhm").select("src_id", "fwhm")


#: Pixels of the mosaics in degrees, wide enough for predictions that are spread over the sky; the width of stars that headers give; radii in widths.
SCALE, WIDTH, RADII = 2.0, 2.5, (1.5, 3.0, 4.0)
#: Predictions of a task.
ROWS = 10_000


@query("moving_object_photometry")
def _(spark, d):
    """Each frame's own predictions, seven widths away from its border, centred above the background, measured through circles as wide as their
    tile's stars, and joined with what their frame's header and zero point say. Frames without predictions have no pixels here, and predictions at one
    place of a frame are measured once."""
    frames = t.mosaic_frames(spark, d)
    x, y = fx.sky_to_pixel("ra", "dec", "ra0", "dec0", f"{SCALE}e0", "32", "32")
    own = t.ephemeris(spark, d).withColumnRenamed("obsid", "frame_id").join(frames.select("frame_id", "ra0", "dec0"), "frame_id").where(F.expr(f"{fx.angular_separation('ra', 'dec', 'ra0', 'dec0')} < 89"))
    # the projection is made once, and not again in each expression on it
    placed = own.select("frame_id", "eph_id", "vmag", F.explode(F.array(F.struct(F.expr(x).alias("x"), F.expr(y).alias("y")))).alias("p")).select("frame_id", "eph_id", "vmag", "p.x", "p.y")
    every = checkpointed(placed.where(f"least(x, y, 64 - x, 64 - y) > {7 * WIDTH}"))
    once = every.groupBy("frame_id", "x", "y").agg(F.min("eph_id").alias("src_id"))
    used = checkpointed(every.select("frame_id").distinct())
    px = image(spark, d, used)
    net = de.background_at(px, im.background(px.where("NOT bad"), BOX), BOX).select("frame_id", "y", "x", (F.col("v") - F.col("bg")).alias("v"))
    at = checkpointed(im.windowed_centroids(net, once.select("frame_id", "src_id", "x", "y"), WIDTH, 3, ROWS))
    sources = checkpointed(de.source_table(members(px)))
    psf = zp.tile_widths(de.round_stars(zp.tiles_of(sources, SIDE, size=(64, 64)), *PEAKS))
    phot = zp.frame_photometry(px, at, EXPTIME, SIDE, (64, 64), psf=psf, fallback=WIDTH, radii=RADII, dense=ROWS)
    zero = zp.frame_zeropoints(px, catalogue_stars(spark, d, used), EXPTIME, 8.5, 12.5, photometry=PHOTOMETRY, match_clip=1.5, sources=sources)
    known = frames.drop("ra0", "dec0").withColumn("fwhm_global", F.lit(WIDTH)).join(zero.select("frame_id", F.col("zp").alias("zp_global"), F.col("zp_err").alias("zperr_global")), "frame_id", "left")
    named = every.withColumnsRenamed({"x": "x_init", "y": "y_init"}).join(once.withColumnsRenamed({"x": "x_init", "y": "y_init"}), ["frame_id", "x_init", "y_init"])
    out = named.join(phot.drop("exptime").withColumnsRenamed({"x": "x_winpos", "y": "y_winpos", "net_err": "err"}), ["frame_id", "src_id"]).join(known, "frame_id")
    return out.select("frame_id", F.col("eph_id").alias("src_id"), "vmag", "x_init", "y_init", "x_winpos", "y_winpos", "fwhm", "aperture_sum", "area", "sky", "sky_std", "n_sky", "n_bad", "net", "err", "snr", "mag_inst", "mag_err", "bad", *(c for c in known.columns if c != "frame_id"))
