"""Aperture photometry from pixels, with radii that are columns: every position has its own circle and ring.

Positions are rows (frame_id, src_id, x, y, ...), pixels rows (frame_id, y, x, v, ...); pixel centres are whole numbers. A position meets
the cells of a fixed grid that its circle touches, so a small circle meets few pixels and a large one each of its cells once. Where positions
are more than pixels (`dense`: a task for so many positions), they stay in their cells, to which the pixels go that they can reach, and what
a position gathers lies in one task, so that its pixels are not shuffled. Positions with a null place or radius, or a radius that is not positive, have no pixels. Null and NaN values are left out of sums and skies. What a
source gathers is bounded by its own circle.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .survey import narrowed, pairs_within

SOURCE = ["frame_id", "src_id"]
CELL = 16


def key(dense: int) -> list[str]:
    """What tells apart a position's rows of near_pixels: with `dense`, with its cell, by which they are dealt."""
    return [*SOURCE, "cx", "cy"] if dense else SOURCE


def near_pixels(pixels: DataFrame, positions: DataFrame, reach: str, cell: int = CELL, dense: int = 0) -> DataFrame:
    """frame_id, src_id, dx, dy, pixel: pairs of a position and a pixel whose centre lies within the column `reach` of it (and half
    a diagonal more, so that all pixels that a circle touches are there). pixel is a struct of the pixel's columns; r_in, r_out or r of
    the positions come along, and with `dense` the position's cell, cx and cy."""
    radii = [c for c in positions.columns if c in ("r", "r_in", "r_out")]
    wide = F.col(reach) + 0.70711
    if dense:
        known = positions.where(f"x IS NOT NULL AND y IS NOT NULL AND {reach} > 0")
        most = known.agg(F.max(reach)).first()[0] or 0.0
        own = pixels.select("frame_id", "x", "y", F.struct(*(c for c in pixels.columns if c != "frame_id")).alias("pixel"))
        met = pairs_within(known.select(*SOURCE, "x", "y", *radii), own, most + 0.70711, closed=True, rows=dense, cell=True)
        met = met.where(F.col("sep") <= wide).withColumns({"dx": F.col("r_x") - F.col("x"), "dy": F.col("r_y") - F.col("y")})
        return met.select(*key(dense), *radii, "dx", "dy", F.col("r_pixel").alias("pixel"))
    steps = lambda c: F.sequence(F.floor((F.col(c) - wide) / cell), F.floor((F.col(c) + wide) / cell))
    at = positions.where(f"x IS NOT NULL AND y IS NOT NULL AND {reach} > 0").select(*SOURCE, F.col("x").alias("cx"), F.col("y").alias("cy"), *radii, F.explode(steps("x")).alias("i"), steps("y").alias("js"), wide.alias("wide"))
    at = at.withColumn("j", F.explode("js")).drop("js")
    places = pixels.select("frame_id", F.struct(*(c for c in pixels.columns if c != "frame_id")).alias("pixel"), F.floor(F.col("x") / cell).alias("i"), F.floor(F.col("y") / cell).alias("j"))
    both = places.join(at, ["frame_id", "i", "j"]).withColumns({"dx": F.col("pixel.x") - F.col("cx"), "dy": F.col("pixel.y") - F.col("cy")})
    return both.where("dx * dx + dy * dy <= wide * wide").select(*SOURCE, *radii, "dx", "dy", "pixel")


def covered(dx: pd.Series, dy: pd.Series, r: pd.Series) -> pd.Series:
    """The area of the unit pixel at dx, dy that the circle of radius r about 0 covers: formulas.disc_share for many pixels at once, since
    as an expression it makes methods so long that Java doesn't compile them."""
    x, y, r = (c.to_numpy(float) for c in (dx, dy, r))
    rr = r * r

    def corner(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        a, b = np.minimum(np.abs(x), r), np.minimum(np.abs(y), r)
        start = np.sqrt(np.maximum(rr - b * b, 0))
        under = lambda u: 0.5 * (u * np.sqrt(np.maximum(rr - u * u, 0)) + rr * np.arcsin(np.minimum(u / r, 1)))
        return np.sign(x) * np.sign(y) * np.where(a * a + b * b <= rr, a * b, start * b + under(a) - under(start))

    x1, x2, y1, y2 = x - 0.5, x + 0.5, y - 0.5, y + 0.5
    return pd.Series(np.clip(corner(x2, y2) - corner(x1, y2) - corner(x2, y1) + corner(x1, y1), 0, 1))


def ring_area(dx: pd.Series, dy: pd.Series, r_in: pd.Series, r_out: pd.Series) -> pd.Series:
    """The area in the ring of all pixels of each row (arrays dx, dy of one pixel or more)."""
    n = dx.str.len().to_numpy(int)
    if not len(n):
        return pd.Series(dtype=float)
    x, y = (pd.Series(np.concatenate(c.to_numpy())) for c in (dx, dy))
    inner, outer = (covered(x, y, pd.Series(np.repeat(r.to_numpy(float), n))).to_numpy() for r in (r_in, r_out))
    return pd.Series(np.add.reduceat(outer - inner, np.cumsum(n) - n))


def shares(near: DataFrame, r: str, name: str = "share") -> DataFrame:
    """Add the area of each pixel that lies in the circle of radius r (a column), exactly."""
    return near.withColumn(name, F.pandas_udf(covered, "double")("dx", "dy", r))


def aperture_sums(pixels: DataFrame, positions: DataFrame, dense: int = 0) -> DataFrame:
    """frame_id, src_id, aperture_sum, aperture_sum_err, n_bad: over the circle of radius r of each position.

    Pixels may have the columns err (their error, added in squares) and bad; bad pixels are left out of the sums, and n_bad is their
    area in the circle. A circle without pixels has no row.
    """
    have = set(pixels.columns)
    rows = shares(near_pixels(pixels, positions.drop("r_in", "r_out"), "r", dense=dense), "r").where("share > 1e-9")
    bad = F.coalesce(F.col("pixel.bad").cast("boolean"), F.lit(False)) if "bad" in have else F.lit(False)
    v = F.nanvl(F.col("pixel.v").cast("double"), F.lit(None))
    rows = rows.select(*key(dense), "share", bad.alias("bad"), v.alias("v"), (F.col("pixel.err") if "err" in have else F.lit(0.0)).alias("err"))
    good = lambda e: F.coalesce(F.sum(F.when(~F.col("bad"), e)), F.lit(0.0))
    return rows.groupBy(*key(dense)).agg(good(F.col("share") * F.col("v")).alias("aperture_sum"), F.sqrt(good(F.col("share") * F.col("err") ** 2)).alias("aperture_sum_err"), F.coalesce(F.sum(F.when(F.col("bad"), F.col("share"))), F.lit(0.0)).alias("n_bad")).drop("cx", "cy")


def ring_sky(pixels: DataFrame, positions: DataFrame, k: float = 3.0, rounds: int = 5, dense: int = 0) -> DataFrame:
    """frame_id, src_id, sky, sky_std, n_sky: median and deviation of the good pixels whose centres lie in the ring from r_in to r_out, after
    clipping, and the exact area in the ring of the pixels that stay. A ring without good pixels has no row."""
    used = pixels.where(F.col("v").isNotNull() & ~F.isnan("v"))
    if "bad" in pixels.columns:
        used = used.where(~F.coalesce(F.col("bad").cast("boolean"), F.lit(False)))
    near = near_pixels(used.select("frame_id", "y", "x", "v"), positions, "r_out", dense=dense)
    ring = near.where("dx * dx + dy * dy > r_in * r_in AND dx * dx + dy * dy <= r_out * r_out").withColumn("v", F.col("pixel.v").cast("double"))
    # a ring's pixels meet once: what a source gathers is clipped and summed where it lies, and not read again
    own = ring.groupBy(*key(dense)).agg(F.first("r_in").alias("r_in"), F.first("r_out").alias("r_out"), F.sort_array(F.collect_list(F.struct("v", "dx", "dy"))).alias("px")).withColumn("vs", F.expr("transform(px, p -> p.v)"))
    once = lambda rows, name, value: rows.withColumn(name, F.explode(F.array(F.expr(value))))
    kept = once(narrowed(own, k, rounds), "kept", "filter(px, p -> p.v >= lo AND p.v <= hi)").where("size(kept) > 0").select(*SOURCE, "r_in", "r_out", "kept")
    kept = once(kept, "sky", "(kept[cast((size(kept) - 1) div 2 AS int)].v + kept[cast(size(kept) div 2 AS int)].v) / 2")
    kept = once(kept, "sums", "aggregate(kept, named_struct('d', 0D, 'dd', 0D), (a, p) -> named_struct('d', a.d + (p.v - sky), 'dd', a.dd + (p.v - sky) * (p.v - sky)))")
    area = F.pandas_udf(ring_area, "double")(F.expr("transform(kept, p -> p.dx)"), F.expr("transform(kept, p -> p.dy)"), "r_in", "r_out")
    return kept.select(*SOURCE, "sky", F.expr("sqrt(greatest(sums.dd / size(kept) - power(sums.d / size(kept), 2), 0D))").alias("sky_std"), area.alias("n_sky"))


def photometric(m: DataFrame) -> DataFrame:
    """Add net, net_err, snr, mag_inst, mag_err and bad to sums (aperture_sum, aperture_sum_err, area, sky, sky_std, n_sky, n_bad, exptime).

    A source is bad with bad pixels in its circle, without a sky, or with a net flux that is not positive; the latter two, and an
    exposure that is not positive, have no magnitude.
    """
    sky_var = F.when(F.col("n_sky") > 0, F.pow("area", F.lit(2)) * F.pow("sky_std", F.lit(2)) / F.col("n_sky")).otherwise(0.0)
    out = m.withColumns({"net": F.col("aperture_sum") - F.col("area") * F.col("sky"), "net_err": F.sqrt(F.pow("aperture_sum_err", F.lit(2)) + F.col("area") * F.pow("sky_std", F.lit(2)) + sky_var)})
    out = out.withColumn("snr", F.try_divide("net", "net_err"))
    lit = F.coalesce((F.col("net") > 0) & (F.col("exptime") > 0), F.lit(False))
    dark = ~F.coalesce(F.col("net") > 0, F.lit(False))
    return out.withColumns({"mag_inst": F.when(lit, -2.5 * F.log10(F.col("net") / F.col("exptime"))), "mag_err": F.when(F.col("snr") > 0, 2.5 / math.log(10) / F.col("snr")), "bad": (F.coalesce("n_bad", F.lit(0.0)) > 0) | dark})


def measure(pixels: DataFrame, positions: DataFrame, radii: tuple[float, float, float] = (2.5, 4.0, 6.0), k: float = 3.0, rounds: int = 5, dense: int = 0) -> DataFrame:
    """Photometry of every position (frame_id, src_id, x, y, fwhm, exptime, ...): a circle of radii[0] times its own fwhm against a sky
    from the ring between radii[1] and radii[2] times that. All columns of positions, and r, area, aperture_sum, aperture_sum_err, n_bad, sky,
    sky_std, n_sky, net, net_err, snr, mag_inst, mag_err, bad. (frame_id, src_id) must name a position."""
    at = positions.withColumns({"r": radii[0] * F.col("fwhm"), "r_in": radii[1] * F.col("fwhm"), "r_out": radii[2] * F.col("fwhm")})
    out = at.drop("r_in", "r_out").withColumn("area", math.pi * F.pow("r", F.lit(2)))
    out = out.join(aperture_sums(pixels, at, dense), SOURCE, "left").join(ring_sky(pixels, at, k, rounds, dense), SOURCE, "left")
    return photometric(out)
