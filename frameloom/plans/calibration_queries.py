"""Queries of masters by night and frames corrected by their own masters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import calibration as ca
from ..operators.survey import checkpointed
from ..sources import tables as t
from .imaging_queries import TILED
from .survey_queries import _duck_stack, query, rounded

NIGHT = 21_600_000_000


def cal_frames(spark, d) -> DataFrame:
    """Frames of two detectors and filters, in nights of six hours; those that have pixels are the ones that vectors stand for."""
    return t.frames(spark, d).select("frame_id", "imagetyp", (F.col("detector") % 2).alias("detector"), "us", (10.0 * (F.col("frame_id") % 2 + 1)).alias("exptime"), F.when(F.col("frame_id") % 3 == 0, "r").otherwise("g").alias("filter"), F.floor(F.col("us") / NIGHT).alias("night"))


def cal_pixels(spark, d, frames: DataFrame | None = None) -> DataFrame:
    """The vectors as noise on the levels of each type of frame; flats and lights have a slope, flats a star now and then."""
    kind = (cal_frames(spark, d) if frames is None else frames).select("frame_id", "imagetyp", "exptime")
    slope = 1 + (F.col("x") + F.col("y")) * 0.02
    level = F.when(F.col("imagetyp") == "BIAS", 10.0).when(F.col("imagetyp") == "DARK", 10 + F.col("exptime") / 10).when(F.col("imagetyp") == "FLAT", 10 + F.col("exptime") / 10 + 100 * slope + F.when((F.col("frame_id") + F.col("x") * 8 + F.col("y")) % 61 == 0, 500.0).otherwise(0.0)).otherwise(10 + F.col("exptime") / 10 + 50 * slope)
    return t.pixels(spark, d, kind).select("frame_id", "imagetyp", F.col("y").cast("long").alias("y"), F.col("x").cast("long").alias("x"), (F.col("v") + level).alias("v"))


CAL = t.with_("frames", "pixels") + f""", cf AS (SELECT frame_id, imagetyp, detector % 2 AS detector, us, 10.0::DOUBLE * (frame_id % 2 + 1) AS exptime, CASE WHEN frame_id % 3 = 0 THEN 'r' ELSE 'g' END AS filter, us // {NIGHT} AS night FROM frames),
  cp AS (SELECT frame_id, imagetyp, p.y, p.x, p.v + CASE WHEN imagetyp = 'BIAS' THEN 10 WHEN imagetyp = 'DARK' THEN 10 + exptime / 10 WHEN imagetyp = 'FLAT' THEN 10 + exptime / 10 + 100 * (1 + (p.x + p.y) * 0.02::DOUBLE) + CASE WHEN (frame_id + p.x * 8 + p.y) % 61 = 0 THEN 500 ELSE 0 END ELSE 10 + exptime / 10 + 50 * (1 + (p.x + p.y) * 0.02::DOUBLE) END AS v FROM pixels p JOIN cf USING (frame_id)),
  have AS (SELECT cf.* FROM cf WHERE frame_id IN (SELECT frame_id FROM pixels))"""


def _duck_masters(kind: str, source: str, by: str, k: float, tag: str) -> str:
    """CTEs {tag}m (meta) and {tag}p (pixels) of the masters of a type."""
    stacked = _duck_stack(f"{tag}in", "master_id, y, x", k)
    for name in ("stacked", "m", "s"):
        stacked = stacked.replace(f"{name} AS (SELECT", f"{tag}_{name} AS (SELECT").replace(f"JOIN {name} ON", f"JOIN {tag}_{name} {name} ON")
    own = " AND ".join(f"f.{c} = g.{c}" for c in by.split(", "))
    return f"""{tag}g AS (SELECT {by}, min(frame_id) AS master_id, min(us) AS first_us FROM have WHERE imagetyp = '{kind}' GROUP BY ALL), {tag}n AS (SELECT f.frame_id, g.master_id FROM have f JOIN {tag}g g ON {own} WHERE imagetyp = '{kind}'),
  {tag}m AS (SELECT master_id, detector, first_us AS us, exptime, filter FROM have f JOIN (SELECT master_id, first_us FROM {tag}g) ON frame_id = master_id), {tag}in AS (SELECT master_id, y, x, v FROM {source} JOIN {tag}n USING (frame_id) WHERE v IS NOT NULL), {stacked}, {tag}p AS (SELECT master_id, y, x, v FROM {tag}_stacked)"""


def _nearest(kind: str, tag: str, cond: str, order: str, name: str) -> str:
    return f"{name} AS (SELECT frame_id, master_id FROM (SELECT f.frame_id, m.master_id, row_number() OVER (PARTITION BY f.frame_id ORDER BY {order}abs(f.us - m.us), m.us, m.master_id) AS nth FROM have f JOIN {tag}m m ON f.detector = m.detector{cond} WHERE f.imagetyp = '{kind}') WHERE nth = 1)"


DARK_ORDER = "abs(f.exptime - m.exptime), m.exptime, "
LIB = CAL + ", " + _duck_masters("BIAS", "cp", "detector, night", 5, "b") + ", " + _nearest("DARK", "b", "", "", "nb_d") + ", cd AS (SELECT c.frame_id, c.y, c.x, CASE WHEN n.master_id IS NULL THEN c.v ELSE c.v - b.v END AS v FROM cp c LEFT JOIN nb_d n USING (frame_id) LEFT JOIN bp b ON b.master_id = n.master_id AND b.y = c.y AND b.x = c.x WHERE imagetyp = 'DARK'), " + _duck_masters("DARK", "cd", "detector, night, exptime", 5, "d") + ", " + _nearest("FLAT", "b", "", "", "nb_f") + ", " + _nearest("FLAT", "d", "", DARK_ORDER, "nd_f") + """, cfl AS (SELECT c.frame_id, c.y, c.x, c.v - coalesce(b.v, 0) - coalesce(k.v, 0) AS v FROM cp c LEFT JOIN nb_f n USING (frame_id) LEFT JOIN bp b ON b.master_id = n.master_id AND b.y = c.y AND b.x = c.x LEFT JOIN nd_f q ON q.frame_id = c.frame_id LEFT JOIN dp k ON k.master_id = q.master_id AND k.y = c.y AND k.x = c.x WHERE imagetyp = 'FLAT'), """
LIB += TILED.replace("FROM pixels", "FROM cfl") + """, facts AS (SELECT frame_id, median(rms) AS g FROM mesh GROUP BY ALL), pl AS (SELECT *, greatest(0, least((y + 0.5::DOUBLE) / 4 - 0.5::DOUBLE, 1)) AS ty, greatest(0, least((x + 0.5::DOUBLE) / 4 - 0.5::DOUBLE, 1)) AS tx FROM cfl),
  lv AS (SELECT p.frame_id, p.y, p.x, p.v, sum((1 - abs(h.j - ty)) * (1 - abs(h.i - tx)) * level) / sum((1 - abs(h.j - ty)) * (1 - abs(h.i - tx))) AS bg FROM pl p JOIN mesh h ON p.frame_id = h.frame_id AND abs(h.j - ty) < 1 AND abs(h.i - tx) < 1 GROUP BY p.frame_id, p.y, p.x, p.v),
  mk AS (SELECT frame_id, y, x, CASE WHEN abs(v - bg) <= 2.5 * g THEN v END AS v FROM lv JOIN facts USING (frame_id)), fsc AS (SELECT frame_id, median(v) AS sc FROM mk GROUP BY ALL), fl AS (SELECT frame_id, y, x, v / sc AS v FROM mk JOIN fsc USING (frame_id)), """ + _duck_masters("FLAT", "fl", "detector, night, filter", 3, "f")


def pictures(spark, d) -> tuple[DataFrame, DataFrame]:
    """The frames that have pixels, and these, both written. Vectors meet frames before they are pixels."""
    have = t.read(spark, d, "embeddings").where("size(embedding) > 0").select(F.col("vec_id").alias("frame_id"))
    frames = checkpointed(cal_frames(spark, d).join(have, "frame_id", "left_semi"))
    return frames, checkpointed(cal_pixels(spark, d, frames))


def library(spark, d) -> tuple[DataFrame, DataFrame, ca.Library]:
    frames, px = pictures(spark, d)
    return frames, px, ca.build_library(frames, px, box=4, clip=2.0, rounds=3)


@query("build_masters", LIB + " SELECT 'BIAS' AS imagetyp, master_id, y, x, round(v, 5) + 0 AS v FROM bp UNION ALL SELECT 'DARK', master_id, y, x, round(v, 5) + 0 FROM dp UNION ALL SELECT 'FLAT', master_id, y, x, round(v, 5) + 0 FROM fp")
def _(spark, d):
    """Masters of each detector and night, darks and flats freed of the nearest masters before they are stacked."""
    lib = library(spark, d)[2]
    kinds = [m.pixels.where("v IS NOT NULL").select(F.lit(kind).alias("imagetyp"), "master_id", "y", "x", "v") for kind, m in (("BIAS", lib.bias), ("DARK", lib.dark), ("FLAT", lib.flat))]
    return rounded(kinds[0].unionByName(kinds[1]).unionByName(kinds[2]), "v", digits=5)


LEVEL1 = LIB + ", " + _nearest("LIGHT", "b", "", "", "nb_l") + ", " + _nearest("LIGHT", "d", "", DARK_ORDER, "nd_l") + ", " + _nearest("LIGHT", "f", " AND f.filter = m.filter", "", "nf_l") + """, fmean AS (SELECT master_id, avg(v) AS mean FROM fp GROUP BY ALL),
  cl AS (SELECT c.frame_id, c.y, c.x, c.v AS raw, n.master_id AS bias_id, q.master_id AS dark_id, w.master_id AS flat_id, c.v - CASE WHEN n.master_id IS NULL THEN 0 ELSE b.v END - CASE WHEN q.master_id IS NULL THEN 0 ELSE k.v END AS dk, fl_.v AS fv, fl_.v / mean AS fr FROM cp c LEFT JOIN nb_l n USING (frame_id) LEFT JOIN bp b ON b.master_id = n.master_id AND b.y = c.y AND b.x = c.x
    LEFT JOIN nd_l q ON q.frame_id = c.frame_id LEFT JOIN dp k ON k.master_id = q.master_id AND k.y = c.y AND k.x = c.x LEFT JOIN nf_l w ON w.frame_id = c.frame_id LEFT JOIN fp fl_ ON fl_.master_id = w.master_id AND fl_.y = c.y AND fl_.x = c.x LEFT JOIN fmean ON fmean.master_id = w.master_id WHERE imagetyp = 'LIGHT'),
  lvl AS (SELECT *, CASE WHEN flat_id IS NULL THEN dk ELSE dk / fr END AS v FROM cl)
  SELECT frame_id, y, x, round(v, 4) + 0 AS v, bias_id, dark_id, flat_id, CASE WHEN raw >= 75.0 THEN 1 ELSE 0 END + CASE WHEN least(x, y, 7 - x, 7 - y) < 1 THEN 2 ELSE 0 END + CASE WHEN dk < 0 THEN 4 ELSE 0 END + CASE WHEN coalesce(v > 0 AND (flat_id IS NULL OR (fv <= 1.5 AND fv > 0.4)), false) THEN 0 ELSE 8 END AS bits FROM lvl"""


@query("correct_level1", LEVEL1)
def _(spark, d):
    """Lights with the masters that are nearest to each."""
    frames, px, lib = library(spark, d)
    return rounded(ca.correct_level1(frames.where("imagetyp = 'LIGHT'"), px.where("imagetyp = 'LIGHT'"), lib, (8, 8), 75.0, 1), "v", digits=4)


@query("mask_outliers", LIB + " SELECT frame_id, y, x, round(v, 5) + 0 AS v, round(g, 5) + 0 AS rms FROM mk JOIN facts USING (frame_id)")
def _(spark, d):
    """Flats without what lies off their background, and the rms that decided it."""
    frames, px = pictures(spark, d)
    flats = ca.of_kind(frames, "FLAT")
    clean = ca.dark_free(flats, ca.pixels_of(flats, px, "FLAT"), *ca.build_darks(frames, px))
    masked, facts = ca.mask_outliers(checkpointed(clean), 2.5, 4, 2.0, 3)
    return rounded(masked.join(facts.select("frame_id", "rms"), "frame_id"), "v", "rms", digits=5)
