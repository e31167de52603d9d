"""Calibration by masters that are resolved in time: every frame gets the ids of its own masters, and its pixels meet the master table by
(master_id, y, x).

Frames are rows (frame_id, imagetyp, detector, us, exptime, filter, night); pixels (frame_id, y, x, v). Masters have the columns of frames, with
master_id in place of frame_id, and master pixels (master_id, y, x, v). A master's id is the smallest of its frames', its time the first of theirs.

Defined cases: a frame without a bias master of its detector, or without an exposure, is left uncorrected in that step (no row is lost), and its
bias_id or dark_id is null; a pixel that the master lacks becomes null; null and NaN pixels stay null; empty tables give empty results.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .detection import background_at
from .imaging import background
from .selection import medians
from .survey import checkpointed, nearest_dark, nearest_in_time, stack

META = ["imagetyp", "detector", "us", "exptime", "filter", "night"]


@dataclass
class Masters:
    """Masters of one type: what they are, and their pixels (written)."""

    meta: DataFrame
    pixels: DataFrame

    def frames(self) -> DataFrame:
        return self.meta.withColumnRenamed("master_id", "frame_id")


def build(frames: DataFrame, pixels: DataFrame, by: list[str], k: float) -> Masters:
    """A master for each group of frames that agree in `by`: the clipped median of their pixels, n frames."""
    group = frames.groupBy(*by).agg(F.min("frame_id").alias("master_id"), F.min("us").alias("first_us"), F.count("*").alias("n"))
    group = group.withColumnsRenamed({c: f"_{c}" for c in by})
    named = frames.join(group, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by])
    named = named.select("frame_id", *(F.col("first_us").alias("us") if c == "us" else c for c in META), "master_id", "n")
    named = checkpointed(named)
    meta = named.where("frame_id = master_id").select("master_id", *META, "n")
    stacked = stack(pixels.join(named.select("frame_id", "master_id"), "frame_id"), ["master_id", "y", "x"], k)
    return Masters(meta, checkpointed(stacked.select("master_id", "y", "x", "v")))


def subtract(pixels: DataFrame, chosen: DataFrame, masters: Masters) -> DataFrame:
    """pixels minus those of each frame's master: chosen has frame_id, master_id. Frames without one stay as they are."""
    rows = pixels.join(chosen.select("frame_id", "master_id"), "frame_id", "left")
    other = masters.pixels.withColumnRenamed("v", "_m")
    out = rows.join(other, ["master_id", "y", "x"], "left")
    return out.withColumn("v", F.when(F.col("master_id").isNull(), F.col("v")).otherwise(F.col("v") - F.col("_m"))).select(*pixels.columns)


def nearest_bias_of(frames: DataFrame, biases: Masters) -> DataFrame:
    """frame_id, master_id: the detector's master nearest in time."""
    return nearest_in_time(frames.select("frame_id", "detector", "us"), biases.frames().select("frame_id", "detector", "us"))


def nearest_dark_of(frames: DataFrame, darks: Masters) -> DataFrame:
    """frame_id, master_id, exp_gap: of the detector's masters with the closest exposure the one nearest in time."""
    cols = ["frame_id", "detector", "us", "exptime"]
    return nearest_dark(frames.where("exptime IS NOT NULL").select(*cols), darks.frames().select(*cols))


def mask_outliers(pixels: DataFrame, n: float, box: int = 64, clip: float = 3.0, rounds: int = 5) -> tuple[DataFrame, DataFrame]:
    """pixels, null where they lie more than n times the frame's rms off the local background; and frame_id, bkg, rms: the medians over the
    frame's mesh."""
    used = pixels.where(F.col("v").isNotNull() & ~F.isnan("v"))
    mesh = checkpointed(background(used.select("frame_id", "y", "x", "v"), box, clip, rounds))
    facts = mesh.groupBy("frame_id").agg(F.median("level").alias("bkg"), F.median("rms").alias("rms"))
    rows = background_at(used, mesh, box).join(facts.select("frame_id", F.col("rms").alias("_rms")), "frame_id")
    kept = F.when(F.abs(F.col("v") - F.col("bg")) <= n * F.col("_rms"), F.col("v"))
    return rows.withColumn("v", kept).select(*pixels.columns), facts


def scaled(pixels: DataFrame, most: int = 4096) -> DataFrame:
    """pixels over the median of their frame; frames whose median is 0 or null have none."""
    scale = medians(pixels, ["frame_id"], "v", most).where("median <> 0").withColumnRenamed("median", "_scale")
    return pixels.join(scale, "frame_id").withColumn("v", F.col("v") / F.col("_scale")).select(*pixels.columns)


@dataclass
class Library:
    """The masters of all types."""

    bias: Masters
    dark: Masters
    flat: Masters


def of_kind(frames: DataFrame, kind: str) -> DataFrame:
    return frames.where(F.upper("imagetyp") == kind).select("frame_id", *META)


def pixels_of(frames: DataFrame, pixels: DataFrame, kind: str) -> DataFrame:
    """The pixels of the frames, which are those of a kind; pixels that have an imagetyp are cut by it, without a join."""
    own = pixels.where(F.upper("imagetyp") == kind) if "imagetyp" in pixels.columns else pixels.join(frames.select("frame_id"), "frame_id", "left_semi")
    return own.select("frame_id", "y", "x", "v")


def dark_free(frames: DataFrame, pixels: DataFrame, bias: Masters, dark: Masters) -> DataFrame:
    """The frames' pixels without their nearest bias and dark."""
    return subtract(subtract(pixels, nearest_bias_of(frames, bias), bias), nearest_dark_of(frames, dark), dark)


def build_darks(frames: DataFrame, pixels: DataFrame, k: float = 5.0) -> tuple[Masters, Masters]:
    """Bias masters by detector and night, and darks, free of their nearest bias, by detector, night and exposure."""
    biases, darks = of_kind(frames, "BIAS"), of_kind(frames, "DARK")
    bias = build(biases, pixels_of(biases, pixels, "BIAS"), ["detector", "night"], k)
    return bias, build(darks, subtract(pixels_of(darks, pixels, "DARK"), nearest_bias_of(darks, bias), bias), ["detector", "night", "exptime"], k)


def build_library(frames: DataFrame, pixels: DataFrame, k: float = 5.0, k_flat: float = 3.0, outliers: float = 2.5, box: int = 64, clip: float = 3.0, rounds: int = 5) -> Library:
    """Bias masters by detector and night; darks, free of their nearest bias, by detector, night and exposure; flats, free of their nearest
    bias and dark, without outliers and brought to one level, by detector, night and filter. Pixels may have an imagetyp; they are then those of the
    frames only."""
    bias, dark = build_darks(frames, pixels, k)
    flats = of_kind(frames, "FLAT")
    masked, _ = mask_outliers(checkpointed(dark_free(flats, pixels_of(flats, pixels, "FLAT"), bias, dark)), outliers, box, clip, rounds)
    flat = build(flats, scaled(masked), ["detector", "night", "filter"], k_flat)
    return Library(bias, dark, flat)


def level1_bits(raw: Column, dark: Column, value: Column, flat: Column, x: Column, y: Column, width: int, height: int, high: float, margin: int) -> Column:
    """1 saturated, 2 edge, 4 negative before the flat, 8 bad: a result that is no positive number, or a flat that is none, above 1.5 or up to 0.4."""
    number = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    good = number(value) & (value > 0) & number(flat) & (flat <= 1.5) & (flat > 0.4)
    edge = F.least(x, y, width - 1 - x, height - 1 - y) < margin
    bit = lambda c, n: F.when(F.coalesce(c, F.lit(False)), n).otherwise(0)
    return bit(raw >= high, 1) + bit(edge, 2) + bit(dark < 0, 4) + F.when(F.coalesce(good, F.lit(False)), 0).otherwise(8)


def correct_level1(frames: DataFrame, pixels: DataFrame, library: Library, size: tuple[int, int], high: float = 3800.0, margin: int = 100) -> DataFrame:
    """frame_id, y, x, v, bits, bias_id, dark_id, flat_id of the frames, each with its own masters: the nearest bias of its detector, the nearest
    dark of the closest exposure, and the nearest flat of its detector and filter, over the flat's mean."""
    masters = {
        "bias_id": nearest_bias_of(frames, library.bias), "dark_id": nearest_dark_of(frames, library.dark),
        "flat_id": nearest_in_time(frames.select("frame_id", "detector", "filter", "us"), library.flat.frames().select("frame_id", "detector", "filter", "us"), ("detector", "filter"))}
    ids = frames.select("frame_id")
    for name, chosen in masters.items():
        ids = ids.join(chosen.select("frame_id", F.col("master_id").alias(name)), "frame_id", "left")
    ids = checkpointed(ids)
    rows = pixels.join(ids, "frame_id").select("frame_id", *masters, "y", "x", F.col("v").cast("double").alias("raw"))
    for name, kind in (("bias_id", library.bias), ("dark_id", library.dark), ("flat_id", library.flat)):
        rows = rows.join(kind.pixels.select(F.col("master_id").alias(name), "y", "x", F.col("v").alias(name[:4])), [name, "y", "x"], "left")
    mean = library.flat.pixels.where("v IS NOT NULL AND NOT isnan(v)").groupBy("master_id").agg(F.avg("v").alias("mean"))
    rows = rows.join(mean.withColumnRenamed("master_id", "flat_id"), "flat_id", "left")
    less = lambda v, name: F.when(F.col(name).isNull(), v).otherwise(v - F.col(name[:4]))
    rows = rows.withColumn("_dark", less(less(F.col("raw"), "bias_id"), "dark_id")).withColumn("_flat", F.try_divide("flat", "mean"))
    rows = rows.withColumn("v", F.when(F.col("flat_id").isNull(), F.col("_dark")).otherwise(F.try_divide("_dark", "_flat")))
    flat = F.when(F.col("flat_id").isNull(), F.lit(1.0)).otherwise(F.col("flat"))
    bits = level1_bits(F.col("raw"), F.col("_dark"), F.col("v"), flat, F.col("x"), F.col("y"), *size, high, margin)
    return rows.select("frame_id", "y", "x", "v", bits.alias("bits"), *masters)
