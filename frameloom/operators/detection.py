"""Sources from pixels: background, detection across tiles, second moments, shapes and masks.

Pixels are rows (frame_id, y, x, v); a frame of any size is spread over tasks by its tiles, and no step takes a frame as a whole. Null
and NaN values are no part of a background and are never detected; a pixel that is given twice counts once, with its larger
value; empty tables give empty results.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .graphs import connected
from .imaging import _labels, background
from .survey import checkpointed

LABEL = ["frame_id", "label_y", "label_x"]
#: A source's number is label_y * WIDE + label_x: its first pixel in reading order.
WIDE = 1 << 20


def background_at(pixels: DataFrame, mesh: DataFrame, box: int) -> DataFrame:
    """pixels' columns, bg and bg_rms: the mesh's level and rms between the centres of its tiles, bilinear, and at its border
    those of the nearest tile. mesh: frame_id, j, i, level, rms. Each pixel meets one row that holds the four corners about it; frames
    without a mesh have no rows."""
    ends = mesh.groupBy("frame_id").agg(F.max("j").alias("last_j"), F.max("i").alias("last_i"))
    step = F.explode(F.array(F.lit(0), F.lit(1)))
    # a tile is a corner of the cells that begin at it and before it
    corner = mesh.withColumn("a", step).withColumn("b", step).select("frame_id", (F.col("j") - F.col("a")).alias("j"), (F.col("i") - F.col("b")).alias("i"), "a", "b", "level", "rms")
    pick = lambda a, b, c: F.max(F.when((F.col("a") == a) & (F.col("b") == b), F.col(c)))
    cell = corner.groupBy("frame_id", "j", "i").agg(*(pick(a, b, c).alias(f"{c}{a}{b}") for c in ("level", "rms") for a in (0, 1) for b in (0, 1)))
    at = lambda c, last: F.greatest(F.lit(0.0), F.least((F.col(c) + 0.5) / box - 0.5, F.col(last).cast("double")))
    rows = pixels.join(ends, "frame_id").withColumns({"_t": at("y", "last_j"), "_u": at("x", "last_i")})
    rows = rows.withColumns({"j": F.floor("_t"), "i": F.floor("_u")}).withColumns({"_t": F.col("_t") - F.col("j"), "_u": F.col("_u") - F.col("i")})
    both = rows.join(cell, ["frame_id", "j", "i"])

    def between(c: str) -> Column:
        # a corner beyond the last tile, or a tile without a value, has no weight
        parts = [(F.col(f"{c}{a}{b}"), (F.col("_t") if a else 1 - F.col("_t")) * (F.col("_u") if b else 1 - F.col("_u"))) for a in (0, 1) for b in (0, 1)]
        total = sum((F.when(v.isNotNull(), w).otherwise(0.0) for v, w in parts), F.lit(0.0))
        return F.try_divide(sum((F.coalesce(v * w, F.lit(0.0)) for v, w in parts), F.lit(0.0)), total)

    return both.select(*pixels.columns, between("level").alias("bg"), between("rms").alias("bg_rms"))


def above_background(pixels: DataFrame, k: float, box: int, clip: float = 3.0, rounds: int = 5, bad: str | None = None) -> DataFrame:
    """frame_id, y, x, v, net: pixels more than k times the local rms above the local background. `bad` names a column whose
    pixels take no part."""
    used = pixels.where(F.col("v").isNotNull() & ~F.isnan("v"))
    if bad:
        used = used.where(~F.coalesce(F.col(bad).cast("boolean"), F.lit(False)))
    used = used.select("frame_id", "y", "x", "v")
    rows = background_at(used, background(used, box, clip, rounds), box).withColumn("net", F.col("v") - F.col("bg"))
    return rows.where(F.col("net") > k * F.col("bg_rms")).select("frame_id", "y", "x", "v", "net")


def _tile_labels(pixels: pd.DataFrame) -> pd.DataFrame:
    """The pixels of one tile, each with the first pixel of its group."""
    p = pixels.sort_values(["y", "x", "net"], ascending=[True, True, False]).drop_duplicates(["y", "x"], ignore_index=True)
    y, x = p["y"].to_numpy(), p["x"].to_numpy()
    new = np.ones(len(p), bool)
    new[1:] = (y[1:] != y[:-1]) | (x[1:] != x[:-1] + 1)
    first, run = np.flatnonzero(new), np.cumsum(new) - 1
    last = np.append(first[1:], len(p)) - 1
    # runs are in reading order, as _labels returns them
    named = _labels(pd.DataFrame({"frame_id": p["frame_id"].to_numpy()[first], "y": y[first], "x1": x[first] - x.min(), "x2": x[last] - x.min()}))
    return p[["frame_id", "y", "x", "v", "net"]].assign(label_y=named["label_y"].to_numpy()[run], label_x=named["label_x"].to_numpy()[run] + x.min())


def labelled(hot: DataFrame, tile: int = 256) -> DataFrame:
    """hot's pixels (frame_id, y, x, v, net) with label_y, label_x: the first pixel, in reading order, of the group of pixels that
    touch, corners included.

    Each tile is labelled in a task of its own. Pixels at its border then meet the neighbours that lie in other tiles, by a join on their
    places; the labels that so touch are the edges of a graph, whose groups give the names that hold across tiles.
    """
    cut = [F.floor(F.col(c) / tile).alias(f"tile_{c}") for c in "yx"]
    schema = "frame_id long, y long, x long, v double, net double, label_y long, label_x long"
    rows = hot.select(F.col("frame_id").cast("long"), F.col("y").cast("long"), F.col("x").cast("long"), F.col("v").cast("double"), F.col("net").cast("double"))
    own = checkpointed(rows.groupBy("frame_id", *cut).applyInPandas(_tile_labels, schema))
    edge = lambda c: F.pmod(F.col(c), F.lit(tile)).isin(0, tile - 1)
    border = own.where(edge("y") | edge("x")).select("frame_id", "y", "x", F.struct(*LABEL).alias("u"))
    # each touching pair once: right, and the three below
    ahead = F.explode(F.array(*(F.struct((F.col("y") + a).alias("y"), (F.col("x") + b).alias("x")) for a, b in ((0, 1), (1, -1), (1, 0), (1, 1)))))
    other = lambda c: F.floor(F.col(f"n.{c}") / tile) != F.floor(F.col(c) / tile)
    near = border.withColumn("n", ahead).where(other("y") | other("x")).select("frame_id", "n.y", "n.x", F.col("u").alias("v"))
    roots = connected(border.join(near, ["frame_id", "y", "x"]).select("u", "v"))
    roots = roots.select("node.*", F.col("root.label_y").alias("root_y"), F.col("root.label_x").alias("root_x"))
    names = {c: F.coalesce(f"root_{c[-1]}", c) for c in LABEL[1:]}
    return own.join(roots, LABEL, "left").withColumns(names).drop("root_y", "root_x")


def detect_sources(pixels: DataFrame, k: float = 3.0, least: float = 7.0, box: int = 64, tile: int = 256, clip: float = 3.0, rounds: int = 5, bad: str | None = None) -> DataFrame:
    """frame_id, label_y, label_x, y, x, v, net: the pixels above the background, in groups of `least` or more."""
    rows = labelled(above_background(pixels, k, box, clip, rounds, bad), tile)
    large = rows.groupBy(*LABEL).agg(F.count("*").alias("npix")).where(F.col("npix") >= least)
    return rows.join(large.drop("npix"), LABEL, "left_semi")


def source_table(members: DataFrame) -> DataFrame:
    """A row per source: frame_id, src_id, label_y, label_x, npix, flux, peak, x, y (the flux-weighted centre), a, b (roots of the second
    moments' eigenvalues, a the larger), theta (degrees from x to the long axis).

    A source so thin that its moments' determinant is below 1/144 gets the variance of a uniform pixel, 1/12, along both axes, so that b is
    never 0. Members above a background have a positive flux; sources without one are left out.
    """
    dx, dy = F.col("x") - F.col("label_x"), F.col("y") - F.col("label_y")
    mean = lambda e: F.sum(F.col("net") * e) / F.sum("net")
    sums = members.groupBy(*LABEL).agg(F.count("*").alias("npix"), F.sum("net").alias("flux"), F.max("net").alias("peak"), mean(dx).alias("mx"), mean(dy).alias("my"), mean(dx * dx).alias("mxx"), mean(dy * dy).alias("myy"), mean(dx * dy).alias("mxy")).where("flux > 0")
    m = sums.withColumns({"sxx": F.col("mxx") - F.col("mx") ** 2, "syy": F.col("myy") - F.col("my") ** 2, "sxy": F.col("mxy") - F.col("mx") * F.col("my")})
    thin = F.when(F.col("sxx") * F.col("syy") - F.col("sxy") ** 2 < 1 / 144, 1 / 12).otherwise(0.0)
    m = m.withColumn("thin", thin).withColumns({"sxx": F.col("sxx") + F.col("thin"), "syy": F.col("syy") + F.col("thin")})
    half, spread = (F.col("sxx") + F.col("syy")) / 2, F.sqrt(((F.col("sxx") - F.col("syy")) / 2) ** 2 + F.col("sxy") ** 2)
    theta = F.degrees(F.atan2(2 * F.col("sxy"), F.col("sxx") - F.col("syy"))) / 2
    return m.select(
        "frame_id", (F.col("label_y") * WIDE + F.col("label_x")).alias("src_id"), "label_y", "label_x", "npix", "flux", "peak",
        (F.col("label_x") + F.col("mx")).alias("x"), (F.col("label_y") + F.col("my")).alias("y"),
        F.sqrt(half + spread).alias("a"), F.sqrt(F.greatest(half - spread, F.lit(0.0))).alias("b"), theta.alias("theta"))


def round_stars(sources: DataFrame, low: float = 300.0, high: float = 3000.0, ratio: float = 2.0) -> DataFrame:
    """Sources whose peak lies between low and high, both excluded, and whose a is at most `ratio` times b. A null goes."""
    return sources.where((F.col("peak") > low) & (F.col("peak") < high) & (F.try_divide("a", "b") <= ratio))


def blob_kind(least: float = np.pi * 144, roundness: float = 2.0, streak: float = 3.0) -> Column:
    """'bright' for round sources (a/b below roundness) of `least` pixels or more, 'streak' for a/b of `streak` or more, else 'other'."""
    ratio = F.try_divide("a", "b")
    return F.when((ratio < roundness) & (F.col("npix") >= least), "bright").when(ratio >= streak, "streak").otherwise("other")


def mask_sources(pixels: DataFrame, members: DataFrame, kinds: Column | None = None, cell: int = 64) -> DataFrame:
    """frame_id, y, x: the pixels in the circle about each bright source's centre (to its farthest member, and one pixel more), and the
    members of streaks. kinds: of the source table, by default blob_kind(). A pixel is named once; only pixels of the image are."""
    kind = source_table(members).withColumn("kind", blob_kind() if kinds is None else kinds).where("kind <> 'other'").select(*LABEL, "kind", F.col("x").alias("cx"), F.col("y").alias("cy"))
    rows = members.join(kind, LABEL)
    streaks = rows.where("kind = 'streak'").select("frame_id", "y", "x")
    ring = rows.where("kind = 'bright'").groupBy(*LABEL, "cx", "cy").agg((F.max(F.hypot(F.col("x") - F.col("cx"), F.col("y") - F.col("cy"))) + 1).alias("r"))
    steps = lambda c: F.explode(F.sequence(F.floor((F.col(c) - F.col("r")) / cell), F.floor((F.col(c) + F.col("r")) / cell)))
    ring = ring.withColumn("i", steps("cx")).withColumn("j", steps("cy"))
    places = pixels.select("frame_id", "y", "x", F.floor(F.col("x") / cell).alias("i"), F.floor(F.col("y") / cell).alias("j"))
    same = [places[c] == ring[c] for c in ("frame_id", "i", "j")]
    within = F.hypot(F.col("x") - F.col("cx"), F.col("y") - F.col("cy")) <= F.col("r")
    circles = places.join(ring, [*same, within], "left_semi").select("frame_id", "y", "x")
    return circles.union(streaks).distinct()
