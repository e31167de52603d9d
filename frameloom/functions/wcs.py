"""Pixel and sky places through a WCS column: a tangent plane with a CD matrix and SIP polynomials.

A WCS is a struct with crval1, crval2, crpix1, crpix2, cd11, cd12, cd21, cd22 (degrees) and sip: array of (p, q, a, b), the coefficients of u^p v^q of the
distortion of u and v (u, v: pixels from crpix), or null for none. Null places, or a null WCS, give null; places on the far half of the sky have
no pixel.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCHEMA = "struct<crval1: double, crval2: double, crpix1: double, crpix2: double, cd11: double, cd12: double, cd21: double, cd22: double, sip: array<struct<p: int, q: int, a: double, b: double>>>"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _distortion(wcs: Column, u: Column, v: Column) -> Column:
    """A struct (f, g): what SIP adds to u and v."""
    start = F.struct(F.lit(0.0).alias("f"), F.lit(0.0).alias("g"))
    term = lambda s: F.pow(u, s["p"]) * F.pow(v, s["q"])
    none = F.array().cast("array<struct<p: int, q: int, a: double, b: double>>")
    return F.aggregate(F.coalesce(wcs["sip"], none), start, lambda t, s: F.struct((t["f"] + s["a"] * term(s)).alias("f"), (t["g"] + s["b"] * term(s)).alias("g")))


def pixel_to_sky(x: Column | str, y: Column | str, wcs: Column | str) -> Column:
    """A struct (ra, dec), in degrees."""
    w = _col(wcs)
    u, v = _col(x) - w["crpix1"], _col(y) - w["crpix2"]
    # an array of one, so that what the polynomials give is worked out once
    at = F.transform(F.array(F.struct(u.alias("u"), v.alias("v"), _distortion(w, u, v).alias("d"))), lambda p: F.struct((p["u"] + p["d"]["f"]).alias("u"), (p["v"] + p["d"]["g"]).alias("v")))
    plane = F.transform(at, lambda p: F.struct(F.radians(w["cd11"] * p["u"] + w["cd12"] * p["v"]).alias("xi"), F.radians(w["cd21"] * p["u"] + w["cd22"] * p["v"]).alias("eta")))
    d0 = F.radians(w["crval2"])

    def sky(p: Column) -> Column:
        den = F.cos(d0) - p["eta"] * F.sin(d0)
        ra = w["crval1"] + F.degrees(F.atan2(p["xi"], den))
        dec = F.degrees(F.atan2(F.sin(d0) + p["eta"] * F.cos(d0), F.sqrt(p["xi"] * p["xi"] + den * den)))
        return F.struct((ra - 360 * F.floor(ra / 360)).alias("ra"), dec.alias("dec"))

    return F.transform(plane, sky)[0]


def sky_to_pixel(ra: Column | str, dec: Column | str, wcs: Column | str, rounds: int = 20) -> Column:
    """A struct (x, y). The polynomials are inverted by fixed-point iteration: u is what the plane gives, less the distortion at the last u, v."""
    w = _col(wcs)
    d, d0, da = F.radians(_col(dec)), F.radians(w["crval2"]), F.radians(_col(ra) - w["crval1"])
    c = F.sin(d0) * F.sin(d) + F.cos(d0) * F.cos(d) * F.cos(da)
    near = F.when(c > 0, c)
    xi, eta = F.degrees(F.cos(d) * F.sin(da) / near), F.degrees((F.cos(d0) * F.sin(d) - F.sin(d0) * F.cos(d) * F.cos(da)) / near)
    det = w["cd11"] * w["cd22"] - w["cd12"] * w["cd21"]
    goal = F.array(F.struct(F.try_divide(w["cd22"] * xi - w["cd12"] * eta, det).alias("u"), F.try_divide(w["cd11"] * eta - w["cd21"] * xi, det).alias("v")))

    def solve(g: Column) -> Column:
        step = lambda p, _: F.transform(F.array(_distortion(w, p["u"], p["v"])), lambda t: F.struct((g["u"] - t["f"]).alias("u"), (g["v"] - t["g"]).alias("v")))[0]
        p = F.aggregate(F.sequence(F.lit(1), F.when(w["sip"].isNull(), 1).otherwise(rounds)), g, step)
        return F.struct((p["u"] + w["crpix1"]).alias("x"), (p["v"] + w["crpix2"]).alias("y"))

    return F.transform(goal, solve)[0]


def corner_boxes(frames: DataFrame, pad: float = 0.1) -> DataFrame:
    """frame_id, ra1, ra2, dec1, dec2 of frames (frame_id, naxis1, naxis2, wcs): the smallest and largest place of the four corners and the
    middles of the sides, and `pad` degrees; a box across right ascension 0 is two. Frames without a size or a WCS have none. A pole inside a
    frame isn't seen."""
    half = lambda n: F.array(F.lit(0.5), F.col(n) / 2 + 0.5, F.col(n) + 0.5)
    at = frames.where("naxis1 IS NOT NULL AND naxis2 IS NOT NULL AND wcs IS NOT NULL").withColumn("_x", F.explode(half("naxis1"))).withColumn("_y", F.explode(half("naxis2")))
    at = at.select("frame_id", pixel_to_sky("_x", "_y", "wcs").alias("s")).select("frame_id", "s.ra", "s.dec")
    facts = at.groupBy("frame_id").agg(F.min("ra").alias("lo"), F.max("ra").alias("hi"), F.min(F.when(F.col("ra") >= 180, F.col("ra"))).alias("west"), F.max(F.when(F.col("ra") < 180, F.col("ra"))).alias("east"), F.min("dec").alias("dec1"), F.max("dec").alias("dec2"))
    box = lambda a, b: F.struct(F.greatest(a, F.lit(0.0)).alias("ra1"), F.least(b, F.lit(360.0)).alias("ra2"))
    wraps = F.col("hi") - F.col("lo") > 180
    low, high = F.when(wraps, F.col("west") - pad).otherwise(F.col("lo") - pad), F.when(wraps, F.col("east") + pad + 360).otherwise(F.col("hi") + pad)
    turns = F.struct(low.alias("a"), high.alias("b"))
    parts = F.when(F.col("t.a") < 0, F.array(box(F.col("t.a") + 360, F.lit(360.0)), box(F.lit(0.0), F.col("t.b")))).when(F.col("t.b") > 360, F.array(box(F.col("t.a"), F.lit(360.0)), box(F.lit(0.0), F.col("t.b") - 360))).otherwise(F.array(box(F.col("t.a"), F.col("t.b"))))
    return facts.withColumn("t", turns).select("frame_id", F.explode(parts).alias("q"), (F.col("dec1") - pad).alias("dec1"), (F.col("dec2") + pad).alias("dec2")).select("frame_id", "q.ra1", "q.ra2", "dec1", "dec2")
