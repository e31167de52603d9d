"""Apertures, centroids, detection, stamps and backgrounds over pixels (frame_id, y, x, v) and positions (frame_id, src_id,
x, y; pixel centres are whole numbers). Groups are a frame, a tile of it or the pixels of one aperture."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import formulas as fx
from .graphs import Steps
from .survey import checkpointed, pairs_within, sigma_clip

SOURCE = ["frame_id", "src_id"]


def apertures(pixels: DataFrame, positions: DataFrame, radius: float) -> DataFrame:
    """frame_id, src_id, px, py, v, share: the pixels that a circle about each position touches, and the area it covers."""
    near = pairs_within(pixels.select("frame_id", "x", "y", "v"), positions.select(*SOURCE, "x", "y"), radius + 0.70711, closed=True)
    # the sides of a pixel and its corners' areas are columns of their own, so that none is worked out again in the next
    sides = near.withColumns({"x1": F.expr("x - r_x - 0.5e0"), "x2": F.expr("x - r_x + 0.5e0"), "y1": F.expr("y - r_y - 0.5e0"), "y2": F.expr("y - r_y + 0.5e0")})
    corners = sides.withColumns({f"c{i}{j}": F.expr(fx.disc_corner(f"x{i}", f"y{j}", radius)) for i in (1, 2) for j in (1, 2)})
    rows = corners.withColumn("share", F.expr("c22 - c12 - c21 + c11")).where("share > 1e-9")
    return rows.select("frame_id", F.col("r_src_id").alias("src_id"), F.col("x").alias("px"), F.col("y").alias("py"), "v", "share")


def aperture_sum(pixels: DataFrame, positions: DataFrame, radius: float, bad: str = "false", error: str = "0e0") -> DataFrame:
    """Sum, area and error over the good pixels of each circle, and how much of it is bad. `bad` and `error` are SQL over v."""
    rows = apertures(pixels, positions, radius).withColumns({"bad": F.expr(bad), "err": F.expr(error)})
    good = lambda e: F.coalesce(F.sum(F.when(~F.col("bad"), e)), F.lit(0.0))
    out = rows.groupBy(*SOURCE).agg(good(F.col("share") * F.col("v")).alias("aperture_sum"), good(F.col("share")).alias("area"), F.sqrt(good(F.col("share") * F.col("err") ** 2)).alias("aperture_sum_err"), F.coalesce(F.sum(F.when(F.col("bad"), F.col("share"))), F.lit(0.0)).alias("n_bad"))
    return out.withColumn("flagged", F.col("n_bad") > 0)


def annulus_sky(pixels: DataFrame, positions: DataFrame, inner: float, outer: float, k: float = 3.0, rounds: int = 5) -> DataFrame:
    """Median, deviation, pixels and area of each ring after clipping. A pixel is in if its centre is."""
    ring = pairs_within(pixels.select("frame_id", "x", "y", "v"), positions.select(*SOURCE, "x", "y"), outer, closed=True).where(F.col("sep") > inner)
    kept = sigma_clip(ring.select("frame_id", F.col("r_src_id").alias("src_id"), "v"), SOURCE, "v", k, rounds)
    return kept.groupBy(*SOURCE).agg(F.median("v").alias("sky"), F.stddev_pop("v").alias("sky_std"), F.count("*").alias("n_sky"))


def windowed_centroids(pixels: DataFrame, positions: DataFrame, fwhm: float, rounds: int = 3, dense: int = 0) -> DataFrame:
    """frame_id, src_id, x, y: each position moved `rounds` times by twice the offset of the mean that a Gaussian window
    weights. A position without positive pixels within two widths is dropped. The pixels of an aperture are one array. With `dense`,
    where positions are more than pixels, pixels go to the positions' cells, with a task for so many positions."""
    lit, at = pixels.where("v > 0").select("frame_id", "x", "y", "v"), positions.select(*SOURCE, "x", "y")
    if dense:
        near = pairs_within(at, lit, 2 * fwhm, closed=True, rows=dense, cell=True)
        rows = near.groupBy("frame_id", "cx", "cy", "src_id").agg(F.first("x").alias("x"), F.first("y").alias("y"), F.collect_list(F.struct(F.col("r_x").alias("px"), F.col("r_y").alias("py"), F.col("r_v").alias("v"))).alias("near"))
    else:
        near = pairs_within(lit, at, 2 * fwhm, closed=True)
        rows = near.groupBy("frame_id", F.col("r_src_id").alias("src_id")).agg(F.first("r_x").alias("x"), F.first("r_y").alias("y"), F.collect_list(F.struct(F.col("x").alias("px"), F.col("y").alias("py"), "v")).alias("near"))
    two = 2 * (fwhm / 2.355) ** 2
    weight = f"p.v * exp(-(power(p.px - x, 2) + power(p.py - y, 2)) / {two}e0)"
    step = f"named_struct('w', a.w + {weight}, 'sx', a.sx + (p.px - x) * {weight}, 'sy', a.sy + (p.py - y) * {weight})"
    for _ in range(rounds):
        rows = rows.withColumn("m", F.expr(f"aggregate(near, named_struct('w', 0D, 'sx', 0D, 'sy', 0D), (a, p) -> {step})"))
        rows = rows.withColumns({"x": F.col("x") + 2 * F.try_divide("m.sx", "m.w"), "y": F.col("y") + 2 * F.try_divide("m.sy", "m.w")})
    return rows.select(*SOURCE, "x", "y")


def _labels(runs: pd.DataFrame) -> pd.DataFrame:
    """The first run of each group of runs of one frame that touch, corners included."""
    runs = runs.sort_values(["y", "x1"], ignore_index=True)
    y, x1, x2 = (runs[c].to_numpy(np.int64) for c in ("y", "x1", "x2"))
    wide = int(x2.max()) + 3
    lo = np.searchsorted(y * wide + x2, (y + 1) * wide + x1 - 1)
    hi = np.searchsorted(y * wide + x1, (y + 1) * wide + x2 + 1, side="right")
    n = np.maximum(hi - lo, 0)
    u = np.repeat(np.arange(len(y)), n)
    v = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
    root = np.arange(len(y))
    while True:
        new, low = root.copy(), np.minimum(root[u], root[v])
        for end in (u, v):
            np.minimum.at(new, end, low)
            np.minimum.at(new, root[end], low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    return pd.DataFrame({"frame_id": runs["frame_id"], "y": y, "x1": x1, "label_y": y[root], "label_x": x1[root]})


def detect(pixels: DataFrame, k: float, least: int) -> DataFrame:
    """frame_id, label_y, label_x, y, x, v: pixels more than k deviations above their frame's median, in groups of `least`
    or more that touch, corners included. A group is named by its first pixel. Runs of a frame are labelled together."""
    facts = pixels.groupBy("frame_id").agg(F.median("v").alias("m"), F.stddev_pop("v").alias("s"))
    hot = pixels.join(facts, "frame_id").where(F.col("v") > F.col("m") + k * F.col("s")).select("frame_id", "y", "x", "v")
    # the pixels of a run share the difference of place and rank
    hot = hot.withColumn("_run", F.col("x") - F.row_number().over(Window.partitionBy("frame_id", "y").orderBy("x")))
    runs = hot.groupBy("frame_id", "y", "_run").agg(F.min("x").alias("x1"), F.max("x").alias("x2"))
    named = runs.select("frame_id", "y", "x1", "x2").groupBy("frame_id").applyInPandas(_labels, "frame_id long, y long, x1 long, label_y long, label_x long")
    starts = hot.withColumn("x1", F.min("x").over(Window.partitionBy("frame_id", "y", "_run")))
    rows = starts.join(named, ["frame_id", "y", "x1"]).select("frame_id", "label_y", "label_x", "y", "x", "v")
    return rows.withColumn("npix", F.count("*").over(Window.partitionBy("frame_id", "label_y", "label_x"))).where(F.col("npix") >= least).drop("npix")


def source_mask(pixels: DataFrame, labelled: DataFrame, cell: int = 64) -> DataFrame:
    """frame_id, y, x of the pixels within each group's circle: its centre, and its farthest member and one pixel more."""
    key = ["frame_id", "label_y", "label_x"]
    centre = labelled.groupBy(*key).agg(F.avg("x").alias("cx"), F.avg("y").alias("cy"))
    ring = labelled.join(centre, key).groupBy(*key, "cx", "cy").agg((F.max(F.hypot(F.col("x") - F.col("cx"), F.col("y") - F.col("cy"))) + 1).alias("r"))
    steps = lambda c: F.explode(F.sequence(F.floor((F.col(c) - F.col("r")) / cell), F.floor((F.col(c) + F.col("r")) / cell)))
    ring = ring.withColumn("i", steps("cx")).withColumn("j", steps("cy"))
    rows = pixels.select("frame_id", "y", "x", F.floor(F.col("x") / cell).alias("i"), F.floor(F.col("y") / cell).alias("j"))
    same = [rows[c] == ring[c] for c in ("frame_id", "i", "j")]
    within = F.hypot(F.col("x") - F.col("cx"), F.col("y") - F.col("cy")) <= F.col("r")
    return rows.join(ring, [*same, within], "left_semi").select("frame_id", "y", "x")


def stamps(pixels: DataFrame, positions: DataFrame, half: int = 1) -> DataFrame:
    """frame_id, src_id, dy, dx, v, peak: the pixels about each position above their smallest one, with sum 1, and the largest
    pixel as it was. Stamps that the border cuts are left out."""
    around = F.explode(F.sequence(F.lit(-half), F.lit(half)))
    at = positions.select(*SOURCE, F.round("x").cast("int").alias("cx"), F.round("y").cast("int").alias("cy")).withColumn("dx", around).withColumn("dy", around)
    at = at.withColumns({"x": F.col("cx") + F.col("dx"), "y": F.col("cy") + F.col("dy")})
    rows = at.join(pixels.select("frame_id", "y", "x", "v"), ["frame_id", "y", "x"])
    facts = rows.groupBy(*SOURCE).agg(F.min("v").alias("low"), F.max("v").alias("peak"), F.sum("v").alias("all"), F.count("*").alias("n")).where(F.col("n") == (2 * half + 1) ** 2)
    value = F.try_divide(F.col("v") - F.col("low"), F.col("all") - F.col("n") * F.col("low"))
    return rows.join(facts, SOURCE).select(*SOURCE, "dy", "dx", value.alias("v"), "peak")


def star_width(stamp: DataFrame) -> DataFrame:
    """frame_id, src_id, fwhm, theta, peak: 2.3548 times the geometric mean of the two second moments' roots, and the angle
    of the long axis from x in degrees."""
    moment = lambda e: F.sum(F.col("v") * e)
    m = stamp.groupBy(*SOURCE).agg(*(moment(F.col(c) ** p).alias(f"{c}{p}") for c in ("dx", "dy") for p in (1, 2)), moment(F.col("dx") * F.col("dy")).alias("dxy"), F.max("peak").alias("peak"))
    variance = lambda c: F.col(f"{c}2") - F.col(f"{c}1") ** 2
    spread = lambda c: F.sqrt(F.greatest(variance(c), F.lit(0.0)))
    theta = F.degrees(F.atan2(2 * (F.col("dxy") - F.col("dx1") * F.col("dy1")), variance("dx") - variance("dy"))) / 2
    return m.select(*SOURCE, (2.3548 * F.sqrt(spread("dx") * spread("dy"))).alias("fwhm"), theta.alias("theta"), "peak")


def psf_map(pixels: DataFrame, positions: DataFrame, tile: int, half: int = 1, least: float = 1.5, most: float = 8.0) -> DataFrame:
    """A row per frame and tile of tile x tile pixels: frame_id, j, i, the tile's centre, widths, angle and peaks of its stars of
    a width between least and most, and psf: their median stamp as an array of (dy, dx, v). Tiles without such a star are
    left out, as are stars without a width (flat or cut stamps)."""
    at = positions.select(*SOURCE, F.floor(F.col("y") / tile).cast("int").alias("j"), F.floor(F.col("x") / tile).cast("int").alias("i"))
    cut = stamps(pixels, positions, half)
    good = star_width(cut).where((F.col("fwhm") > least) & (F.col("fwhm") < most)).join(at, SOURCE)
    key = ["frame_id", "j", "i"]
    facts = good.groupBy(*key).agg(
        F.avg("fwhm").alias("fwhm_avg"), F.median("fwhm").alias("fwhm_median"), F.stddev_pop("fwhm").alias("fwhm_stddev"),
        F.avg("theta").alias("theta_avg"), F.min("peak").alias("peak_min"), F.max("peak").alias("peak_max"), F.count("*").alias("n_star"))
    middle = cut.join(good.select(*SOURCE, "j", "i"), SOURCE).groupBy(*key, "dy", "dx").agg(F.median("v").alias("v"))
    psf = middle.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("dy", "dx", "v"))).alias("psf"))
    return facts.join(psf, key).withColumns({f"{c}_center": (F.col(k) + 0.5) * tile for c, k in (("x", "i"), ("y", "j"))})


def background(pixels: DataFrame, box: int, k: float = 3.0, rounds: int = 5) -> DataFrame:
    """frame_id, j, i, level, rms: each tile's clipped median, then the median over it and its neighbours."""
    tiled = pixels.select("frame_id", F.floor(F.col("y") / box).alias("j"), F.floor(F.col("x") / box).alias("i"), "v")
    key = ["frame_id", "j", "i"]
    mesh = sigma_clip(tiled, key, "v", k, rounds).groupBy(*key).agg(F.median("v").alias("own"), F.stddev_pop("v").alias("rms"))
    near = F.explode(F.sequence(F.lit(-1), F.lit(1)))
    spread = mesh.select(*key, "own").withColumn("a", near).withColumn("b", near)
    smooth = spread.select("frame_id", (F.col("j") + F.col("a")).alias("j"), (F.col("i") + F.col("b")).alias("i"), "own").groupBy(*key).agg(F.median("own").alias("level"))
    return mesh.join(smooth, key).select(*key, "level", "rms")


def background_level(pixels: DataFrame, mesh: DataFrame, box: int) -> DataFrame:
    """frame_id, y, x, v, bg: the mesh between the centres of its tiles, bilinear, and its nearest tile outside them."""
    tiles = mesh.groupBy("frame_id").agg(F.max("j").alias("last_j"), F.max("i").alias("last_i"))
    rows = pixels.select("frame_id", "y", "x", "v").join(tiles, "frame_id")

    def ends(c: str, last: str) -> Column:
        at = F.greatest(F.lit(0.0), F.least((F.col(c) + 0.5) / box - 0.5, F.col(last).cast("double")))
        low = F.floor(at)
        return F.explode(F.array(F.struct(low.alias("k"), (1 - (at - low)).alias("w")), F.struct(F.least(low + 1, F.col(last)).alias("k"), (at - low).alias("w"))))

    rows = rows.withColumn("a", ends("y", "last_j")).withColumn("b", ends("x", "last_i"))
    rows = rows.select("frame_id", "y", "x", "v", F.col("a.k").alias("j"), F.col("b.k").alias("i"), (F.col("a.w") * F.col("b.w")).alias("w")).where("w > 0")
    both = rows.join(mesh.select("frame_id", "j", "i", "level"), ["frame_id", "j", "i"])
    return both.groupBy("frame_id", "y", "x", "v").agg((F.sum(F.col("w") * F.col("level")) / F.sum("w")).alias("bg"))


def bad_pixels(ratio: DataFrame, keys: list[str], k: float = 9.0, half: int = 3, box: int = 15) -> DataFrame:
    """keys, y, x, residual, bad: v against the median of the pixels within half of it in y and x (fewer at the border), and
    that residual against k times the middle spread (from 30.9 to 69.1 %, one deviation of a normal) of its box x box tile."""
    near = F.explode(F.sequence(F.lit(-half), F.lit(half)))
    spread = ratio.withColumn("a", near).withColumn("b", near).select(*keys, (F.col("y") + F.col("a")).alias("y"), (F.col("x") + F.col("b")).alias("x"), F.col("v").alias("other"))
    local = spread.groupBy(*keys, "y", "x").agg(F.median("other").alias("m"))
    tile = [F.floor(F.col(c) / box).alias(f"tile_{c}") for c in "yx"]
    rows = ratio.join(local, [*keys, "y", "x"]).select(*keys, "y", "x", (F.col("v") - F.col("m")).alias("residual"), *tile)
    wide = rows.groupBy(*keys, "tile_y", "tile_x").agg((F.percentile("residual", 0.691) - F.percentile("residual", 0.309)).alias("s"))
    return rows.join(wide, [*keys, "tile_y", "tile_x"]).select(*keys, "y", "x", "residual", (F.abs("residual") > k * F.col("s")).alias("bad"))


def _point(low: str, high: str) -> Column:
    """A point within low and high that near boxes of like width have in common: a multiple of a power of two of a quarter to a half of
    the width (exact in floating point), or the edge itself of a box without width."""
    step = F.pow(F.lit(2.0), F.floor(F.log2(F.col(high) - F.col(low))) - 1)
    return F.struct(step.alias("step"), F.when(step > 0, F.ceil(F.col(low) / step) * step).otherwise(F.col(low)).alias("at"))


def merge_boxes(boxes: DataFrame, band: float = 5.0) -> DataFrame:
    """ra1, ra2, dec1, dec2, n: boxes that overlap become their hull, until none overlap. Boxes that have a point in common are one hull by an
    aggregate, however many they are. Then a box goes to the smallest one that it overlaps, and on to where that one goes, four
    steps of each round; a round's boxes are written (a checkpoint would keep the size that Spark expects of them, which is squared by
    every round's joins), and their number falls until nothing overlaps."""
    edges = ["ra1", "ra2", "dec1", "dec2"]
    steps = Steps()
    hull = [F.min("ra1").alias("ra1"), F.max("ra2").alias("ra2"), F.min("dec1").alias("dec1"), F.max("dec2").alias("dec2"), F.sum("n").alias("n")]
    now = boxes.select(*edges).withColumn("n", F.lit(1).cast("long"))
    over = lambda a, b: F.explode(F.sequence(F.floor(F.col(a) / band), F.floor(F.col(b) / band)))
    touch = (F.col("ra1") <= F.col("o_ra2")) & (F.col("o_ra1") <= F.col("ra2")) & (F.col("dec1") <= F.col("o_dec2")) & (F.col("o_dec1") <= F.col("dec2"))
    while True:
        now = now.groupBy(_point("ra1", "ra2").alias("px"), _point("dec1", "dec2").alias("py")).agg(*hull).drop("px", "py")
        # hulls can come out equal
        now = steps.write("now", now.groupBy(*edges).agg(F.sum("n").alias("n")))
        name = F.struct(*edges)
        spread = now.select(*edges, name.alias("name")).withColumn("i", over("ra1", "ra2")).withColumn("j", over("dec1", "dec2"))
        # in a cell, its smallest box is a hub: what overlaps it joins it; where no box meets its hub any more, all of a cell are compared
        other = spread.select("i", "j", *(F.col(c).alias(f"o_{c}") for c in edges), F.col("name").alias("o_name"))
        hub = other.groupBy("i", "j").agg(F.min(F.struct("o_name", *(f"o_{c}" for c in edges))).alias("h")).select("i", "j", "h.*")
        least = lambda pairs: steps.write("met", pairs.groupBy("name").agg(F.min("o_name").alias("to")))
        met = least(spread.join(hub, ["i", "j"]).where(touch & (F.col("name") > F.col("o_name"))))
        if met.isEmpty():
            met = least(spread.join(other, ["i", "j"]).where(touch & (F.col("name") > F.col("o_name"))))
            if met.isEmpty():
                steps.drop(now, "met")
                return now
        for _ in range(2):
            onward = met.select(F.col("name").alias("to"), F.col("to").alias("next"))
            met = met.join(onward, "to", "left").select("name", F.coalesce("next", "to").alias("to"))
        named = now.withColumn("name", name).join(met, "name", "left").withColumn("to", F.coalesce("to", "name"))
        now = named.groupBy("to").agg(*hull).drop("to")
