"""Queries of places through a WCS of each frame, with rotation and distortion."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import wcs
from ..sources import tables as t
from .survey_queries import query, rounded

#: Third-order distortion of the queries: p, q, a, b.
SIP = ((2, 0, 2e-3, -1e-3), (1, 1, -1e-3, 1.5e-3), (0, 2, 1e-3, 2e-3), (3, 0, 1e-4, 0.0), (2, 1, 0.0, -1e-4), (1, 2, 5e-5, 0.0), (0, 3, 0.0, 1e-4))
SCALE, TURN = 0.05, 30.0
CD = (-SCALE * math.cos(math.radians(TURN)), SCALE * math.sin(math.radians(TURN)), SCALE * math.sin(math.radians(TURN)), SCALE * math.cos(math.radians(TURN)))


def frames_wcs(frames: DataFrame) -> DataFrame:
    """Each frame's own centre; the same scale, rotation and distortion."""
    sip = F.array(*(F.struct(F.lit(p).alias("p"), F.lit(q).alias("q"), F.lit(a).alias("a"), F.lit(b).alias("b")) for p, q, a, b in SIP))
    k = F.col("frame_id")
    return frames.withColumn("wcs", F.struct((k * 37 % 360 + 0.25).alias("crval1"), (k * 11 % 120 - 60.0).alias("crval2"), F.lit(4.0).alias("crpix1"), F.lit(4.0).alias("crpix2"), *(F.lit(v).alias(n) for n, v in zip(("cd11", "cd12", "cd21", "cd22"), CD, strict=True)), sip.alias("sip")))


def _poly(which: int) -> str:
    return " + ".join(f"({s[which]!r})::DOUBLE * power(u, {s[0]}) * power(v, {s[1]})" for s in SIP)


def _sky(source: str) -> str:
    """CTE sky(frame_id, ..., ra, dec) of the x, y of a source."""
    return f"""uv AS (SELECT *, x - 4 AS u, y - 4 AS v, radians(frame_id * 11 % 120 - 60.0::DOUBLE) AS d0 FROM {source}), bent AS (SELECT *, u + {_poly(2)} AS bu, v + {_poly(3)} AS bv FROM uv),
  plane AS (SELECT *, radians({CD[0]!r}::DOUBLE * bu + {CD[1]!r}::DOUBLE * bv) AS xi, radians({CD[2]!r}::DOUBLE * bu + {CD[3]!r}::DOUBLE * bv) AS eta FROM bent), turned AS (SELECT *, frame_id * 37 % 360 + 0.25::DOUBLE + degrees(atan2(xi, cos(d0) - eta * sin(d0))) AS r, degrees(atan2(sin(d0) + eta * cos(d0), sqrt(xi * xi + power(cos(d0) - eta * sin(d0), 2)))) AS dec FROM plane),
  sky AS (SELECT *, r - 360 * floor(r / 360) AS ra FROM turned)"""


@query("wcs_pixel_to_sky", t.with_("positions") + ", " + _sky("positions") + " SELECT src_id, round(ra, 7) + 0 AS ra, round(dec, 7) + 0 AS dec FROM sky")
def _(spark, d):
    at = frames_wcs(t.positions(spark, d)).select("src_id", wcs.pixel_to_sky("x", "y", "wcs").alias("s"))
    return rounded(at.select("src_id", "s.ra", "s.dec"), "ra", "dec", digits=7)


@query("wcs_sky_to_pixel", t.with_("positions") + "SELECT src_id, round(x, 6) + 0 AS x, round(y, 6) + 0 AS y FROM positions")
def _(spark, d):
    """Back from the sky to where the positions came from."""
    at = frames_wcs(t.positions(spark, d)).withColumn("s", wcs.pixel_to_sky("x", "y", "wcs"))
    back = at.select("src_id", wcs.sky_to_pixel("s.ra", "s.dec", "wcs").alias("p"))
    return rounded(back.select("src_id", "p.x", "p.y"), "x", "y")


_BOX = "corners AS (SELECT vec_id AS frame_id, x, y FROM embeddings, (SELECT unnest([0.5, 4.5, 8.5])::DOUBLE AS x), (SELECT unnest([0.5, 4.5, 8.5])::DOUBLE AS y)), " + _sky("corners") + """, f AS (SELECT frame_id, min(ra) AS lo, max(ra) AS hi, min(ra) FILTER (WHERE ra >= 180) AS west, max(ra) FILTER (WHERE ra < 180) AS east, min(dec) - 0.1::DOUBLE AS dec1, max(dec) + 0.1::DOUBLE AS dec2 FROM sky GROUP BY frame_id),
  ab AS (SELECT *, CASE WHEN hi - lo > 180 THEN west ELSE lo END - 0.1::DOUBLE AS a, CASE WHEN hi - lo > 180 THEN east + 360 ELSE hi END + 0.1::DOUBLE AS b FROM f),
  parts AS (SELECT frame_id, dec1, dec2, CASE WHEN a < 0 THEN a + 360 ELSE a END AS ra1, CASE WHEN a < 0 OR b > 360 THEN 360 ELSE b END AS ra2 FROM ab UNION ALL SELECT frame_id, dec1, dec2, 0, CASE WHEN a < 0 THEN b ELSE b - 360 END FROM ab WHERE a < 0 OR b > 360)"""


@query("wcs_fov_box", f"WITH {_BOX} SELECT frame_id, round(ra1, 6) + 0 AS ra1, round(ra2, 6) + 0 AS ra2, round(dec1, 6) + 0 AS dec1, round(dec2, 6) + 0 AS dec2 FROM parts")
def _(spark, d):
    """The boxes of all frames, from their projected corners."""
    frames = t.read(spark, d, "embeddings").select(F.col("vec_id").alias("frame_id"), F.lit(8).alias("naxis1"), F.lit(8).alias("naxis2"))
    return rounded(wcs.corner_boxes(frames_wcs(frames)), "ra1", "ra2", "dec1", "dec2")
