"""From pixels to zero points: detection, star widths by tile, photometry as wide as the tile's stars, and the match with a catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import detection as de
from .apertures import measure
from .survey import checkpointed, match_nearest, zeropoint


def tiles_of(rows: DataFrame, side: int, frames: DataFrame | None = None, size: tuple[int, int] = (4096, 4096)) -> DataFrame:
    """rows (frame_id, x, y, ...) with their tile (i, j) of side x side pixels; what is left over at an edge goes to the last tile. Sizes
    come from frames (frame_id, naxis1, naxis2), or are the same for all."""
    rows = rows.join(frames.select("frame_id", "naxis1", "naxis2"), "frame_id") if frames is not None else rows.withColumns({"naxis1": F.lit(size[0]), "naxis2": F.lit(size[1])})
    index = lambda c, n: F.least(F.floor(F.col(c) / side), F.greatest(F.floor(F.col(n) / side), F.lit(1)) - 1).cast("int")
    return rows.withColumns({"i": index("x", "naxis1"), "j": index("y", "naxis2")}).drop("naxis1", "naxis2")


def tile_widths(tiled: DataFrame, low: float = 1.5, high: float = 8.0) -> DataFrame:
    """A row per frame and tile of sources (frame_id, i, j, a, b, theta, peak): frame_id, i, j, fwhm_avg, fwhm_median, fwhm_stddev, theta_avg,
    peak_min, peak_max, n_star, of the sources with a width 2.3548 sqrt(a b) between low and high, both excluded."""
    stars = tiled.withColumn("w", 2.3548 * F.sqrt(F.col("a") * F.col("b"))).where((F.col("w") > low) & (F.col("w") < high))
    return stars.groupBy("frame_id", "i", "j").agg(
        F.avg("w").alias("fwhm_avg"), F.median("w").alias("fwhm_median"), F.stddev_pop("w").alias("fwhm_stddev"), F.avg("theta").alias("theta_avg"),
        F.min("peak").alias("peak_min"), F.max("peak").alias("peak_max"), F.count("*").alias("n_star"))


def tile_fwhm(sources: DataFrame, tiles: DataFrame, fallback: float = 2.5, least: float = 1.5, most: float = 10.0) -> DataFrame:
    """sources (frame_id, i, j, ...) with fwhm: their tile's fwhm_avg; in a tile without one, the median over the frame's tiles; on a frame
    without tiles, the fallback. Widths are kept between least and most."""
    known = tiles.select("frame_id", "i", "j", F.col("fwhm_avg").alias("_own"))
    middle = known.groupBy("frame_id").agg(F.median("_own").alias("_middle"))
    out = sources.join(known, ["frame_id", "i", "j"], "left").join(middle, "frame_id", "left")
    width = F.greatest(F.least(F.coalesce("_own", "_middle", F.lit(fallback)), F.lit(most)), F.lit(least))
    return out.withColumn("fwhm", width).drop("_own", "_middle")


def frame_photometry(pixels: DataFrame, sources: DataFrame, exptime: float | DataFrame, side: int = 500, size: tuple[int, int] = (4096, 4096), peaks: tuple[float, float] = (300.0, 3000.0), psf: DataFrame | None = None, fallback: float = 2.5, **options) -> DataFrame:
    """Photometry (apertures.measure, with its options) of all sources, each with the width of its tile: of psf (frame_id, i, j, fwhm_avg), or of the
    round sources themselves. exptime is one for all, or a table (frame_id, exptime); a frame that it lacks has no magnitudes."""
    tiled = tiles_of(sources, side, size=size)
    at = tile_fwhm(tiled.select("frame_id", "src_id", "x", "y", "i", "j"), tile_widths(de.round_stars(tiled, *peaks)) if psf is None else psf, fallback)
    at = at.join(exptime.select("frame_id", "exptime"), "frame_id", "left") if isinstance(exptime, DataFrame) else at.withColumn("exptime", F.lit(exptime))
    return measure(pixels, checkpointed(at), **options)


def frame_zeropoints(pixels: DataFrame, catalogue: DataFrame, exptime: float | DataFrame, low: float = 13.0, high: float = 18.0, detect: dict | None = None, photometry: dict | None = None, tolerance: float = 3.0, match_clip: float | None = 3.0, k: float = 3.0, rounds: int = 5, sources: DataFrame | None = None) -> DataFrame:
    """frame_id, zp, zp_err, n: sources of the pixels (or those given), matched with the catalogue (frame_id, star_id, x, y, mag) within the tolerance, those of
    low to high magnitude (both included) measured, and the clipped median of catalogue minus instrumental magnitude.

    A frame without a good match has no row; one with a single match has no zp_err. `detect` and `photometry` are options of
    detection.detect_sources and frame_photometry; a pixel column bad, if there is one, is used by both.
    """
    options = {"bad": "bad"} if "bad" in pixels.columns else {}
    sources = checkpointed(de.source_table(de.detect_sources(pixels, **(options | (detect or {}))))) if sources is None else sources
    stars = catalogue.select("frame_id", "star_id", F.col("mag").alias("cat_mag")).where(F.col("cat_mag").between(low, high))
    matched = match_nearest(sources, catalogue, tolerance, match_clip).join(stars, ["frame_id", "star_id"])
    phot = frame_photometry(pixels, sources, exptime, **(photometry or {})).join(matched.select("frame_id", "src_id", "cat_mag"), ["frame_id", "src_id"])
    return zeropoint(phot, k, rounds)
