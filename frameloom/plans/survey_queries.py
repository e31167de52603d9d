"""The survey's queries by name, each with SQL that DuckDB can run on the same tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import formulas as fx
from ..operators import survey as ops
from ..sources import tables as t

QUERIES: dict[str, Callable] = {}
SQL: dict[str, str] = {}
SIZE = 4096


def query(name: str, sql: str | None = None):
    def add(f: Callable) -> Callable:
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


def rounded(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    """Round the named columns; adding zero makes -0 a 0."""
    return df.withColumns({n: F.round(F.col(n), digits) + 0.0 for n in names})


def formulas(name: str, table: str, key: str, exprs: dict[str, str], where: str = "true") -> None:
    """A query of formulas over one table, in both engines."""
    cols = ", ".join(f"round({e}, 6) + 0 AS {c}" for c, e in exprs.items())

    @query(name, f"{t.with_(table)} SELECT {key}, {cols} FROM {table} WHERE {where}")
    def run(spark, d):
        return getattr(t, table)(spark, d).where(where).select(key, *(F.expr(f"round({e}, 6) + 0").alias(c) for c, e in exprs.items()))


# --- headers, names, times -----------------------------------------------------------------------------------------------
@query("normalize_headers", t.with_("frames") + """SELECT frame_id, upper(trim(imagetyp)) AS imagetyp, coalesce(TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE), 0.0) AS gain_key,
  coalesce(exptime, 0.0) AS exptime, 'CLEAR' AS filter, 0 AS level, 18.69::DOUBLE AS egain FROM frames""")
def _(spark, d):
    site = spark.createDataFrame([("CLEAR", 0, 18.69)], "filter string, level int, egain double")
    rows = t.frames(spark, d).select("frame_id", F.upper(F.trim("imagetyp")).alias("imagetyp"), F.coalesce(F.get_json_object("props", "$.k").try_cast("double"), F.lit(0.0)).alias("gain_key"), F.coalesce("exptime", F.lit(0.0)).alias("exptime"))
    return rows.join(F.broadcast(site), how="cross")  # one row of constants


@query("object_name", t.with_("frames") + "SELECT frame_id, trim(list_last(string_split('field\\' || detector || '\\ ' || file || ' ', '\\'))) AS object FROM frames")
def _(spark, d):
    raw = F.concat(F.lit("field\\"), "detector", F.lit("\\ "), "file", F.lit(" "))
    return t.frames(spark, d).select("frame_id", F.trim(F.element_at(F.split(raw, r"\\"), -1)).alias("object"))


@query("filter_imagetyp", t.with_("frames") + "SELECT frame_id, imagetyp FROM frames WHERE upper(imagetyp) = upper('dark')")
def _(spark, d):
    return t.frames(spark, d).where(F.upper("imagetyp") == F.upper(F.lit("dark"))).select("frame_id", "imagetyp")


@query("pick_files", t.with_("frames") + "SELECT frame_id, file, file = 'img_000250.fits' AS is_ref FROM frames WHERE TRY_CAST(regexp_extract(file, '^img_([0-9]+)', 1) AS INT) BETWEEN 100 AND 400 OR file = 'img_000250.fits'")
def _(spark, d):
    number = F.regexp_extract("file", "^img_([0-9]+)", 1).try_cast("int")
    ref = F.col("file") == "img_000250.fits"
    return t.frames(spark, d).where(number.between(100, 400) | ref).select("frame_id", "file", ref.alias("is_ref"))


@query("glob_filter", t.with_("frames") + "SELECT frame_id, file FROM frames WHERE regexp_matches(file, '^img_.*[.]fits$') AND NOT regexp_matches(file, '7[.]fits$')")
def _(spark, d):
    return t.frames(spark, d).where(F.col("file").rlike("^img_.*[.]fits$") & ~F.col("file").rlike("7[.]fits$")).select("frame_id", "file")


@query("true_stem", t.with_("frames") + "SELECT frame_id, regexp_replace(file || CASE WHEN frame_id % 2 = 0 THEN '.bz2' ELSE '' END, '[.]fits([.]bz2)?$', '') AS stem FROM frames")
def _(spark, d):
    name = F.concat("file", F.when(F.col("frame_id") % 2 == 0, ".bz2").otherwise(""))
    return t.frames(spark, d).select("frame_id", F.regexp_replace(name, "[.]fits([.]bz2)?$", "").alias("stem"))


@query("lv1_name", t.with_("frames", "stars") + """SELECT f.frame_id, CASE WHEN ra IS NULL THEN regexp_replace(file, '[.]fits$', '') || '.lv1.fits' ELSE
  printf('kl4040.sci.lv1.%03d.%s%02d.%03d.', CAST(round_even(ra, 0) AS INT), CASE WHEN round_even(dec, 0) >= 0 THEN 'p' ELSE 'n' END, CAST(abs(round_even(dec, 0)) AS INT), CAST(round_even(exptime, 0) AS INT)) || strftime(obs_ts, '%Y%m%d%H%M%S') || '.fits' END AS name
  FROM frames f LEFT JOIN stars s ON f.frame_id = s.star_id""")
def _(spark, d):
    """Stars stand for the centres of frames; a frame without one gets the default name."""
    at = t.stars(spark, d).select(F.col("star_id").alias("frame_id"), "ra", "dec")
    return t.frames(spark, d).join(at, "frame_id", "left").select("frame_id", ops.lv1_name("file", "ra", "dec", "exptime", "obs_ts").alias("name"))


@query("master_name", t.with_("frames") + "SELECT frame_id, 'kl4040.' || CASE imagetyp WHEN 'BIAS' THEN 'bias' WHEN 'DARK' THEN 'dark.' || CAST(round_even(exptime, 0) AS INT) || 's' ELSE 'flat.CLEAR' END || '.comb.' || strftime(obs_ts, '%Y%m%d') AS name FROM frames")
def _(spark, d):
    kind = F.when(F.col("imagetyp") == "BIAS", F.lit("bias")).when(F.col("imagetyp") == "DARK", F.concat(F.lit("dark."), F.bround("exptime").cast("int"), F.lit("s"))).otherwise("flat.CLEAR")
    return t.frames(spark, d).select("frame_id", F.concat_ws(".", F.lit("kl4040"), kind, F.lit("comb"), F.date_format("obs_ts", "yyyyMMdd")).alias("name"))


@query("mid_exposure", t.with_("frames") + "SELECT frame_id, us - CAST(exptime * 500000 AS BIGINT) AS mid_us, us - CAST(exptime * 1000000 AS BIGINT) AS start_us, us AS end_us, strftime(obs_ts, '%Y%m%d') AS obsdate FROM frames")
def _(spark, d):
    half = (F.col("exptime") * 500000).cast("long")
    mid = F.col("us") - half
    return t.frames(spark, d).select("frame_id", mid.alias("mid_us"), (mid - half).alias("start_us"), (mid + half).alias("end_us"), F.date_format("obs_ts", "yyyyMMdd").alias("obsdate"))


formulas("julian_date", "frames", "frame_id", {"days": f"{fx.julian_date('us')} - 2460000.5e0", "mjd": f"{fx.julian_date('us')} - 2400000.5e0"})


@query("sexagesimal", t.with_("stars") + """, s AS (SELECT star_id, printf('%02d:%02d:%04.1f', star_id % 24, star_id % 60, (star_id % 600) / 10.0::DOUBLE) AS ra, printf('-%02d:%02d:%02d', star_id % 90, star_id % 60, star_id % 59) AS dec FROM stars)
  SELECT star_id, round(15 * (CAST(split_part(ra, ':', 1) AS DOUBLE) + CAST(split_part(ra, ':', 2) AS DOUBLE) / 60 + CAST(split_part(ra, ':', 3) AS DOUBLE) / 3600), 6) + 0 AS ra_deg,
   round(-(CAST(substr(split_part(dec, ':', 1), 2) AS DOUBLE) + CAST(split_part(dec, ':', 2) AS DOUBLE) / 60 + CAST(split_part(dec, ':', 3) AS DOUBLE) / 3600), 6) + 0 AS dec_deg FROM s""")
def _(spark, d):
    k = F.col("star_id")
    s = t.stars(spark, d).select("star_id", F.format_string("%02d:%02d:%04.1f", k % 24, k % 60, k % 600 / 10.0).alias("ra"), F.format_string("-%02d:%02d:%02d", k % 90, k % 60, k % 59).alias("dec"))

    def angle(c, factor):
        p = F.split(c, ":")
        sign = F.when(F.trim(c).startswith("-"), -1).otherwise(1)
        whole = F.abs(p[0].try_cast("double")) + p[1].try_cast("double") / 60 + p[2].try_cast("double") / 3600
        return F.coalesce(F.when(F.size(p) == 3, factor * sign * whole), F.col(c).try_cast("double"))

    return rounded(s.select("star_id", angle("ra", 15).alias("ra_deg"), angle("dec", 1).alias("dec_deg")), "ra_deg", "dec_deg")


# --- sky -----------------------------------------------------------------------------------------------------------------
JD = "(2460310.5e0 + star_id * 0.37e0)"
_l, _b = fx.galactic("ra", "dec")
formulas("to_galactic", "stars", "star_id", {"l": _l, "b": _b})
_lon, _lat = fx.ecliptic("ra", "dec", JD)
formulas("to_ecliptic", "stars", "star_id", {"lon": _lon, "lat": _lat})
formulas("sun_elongation", "stars", "star_id", {"elong": fx.angular_separation("ra", "dec", *fx.sun(JD))})
formulas("moon_elongation", "stars", "star_id", {"elong": fx.angular_separation("ra", "dec", *fx.moon(JD))})
formulas("angular_separation", "stars", "star_id", {"sep": fx.angular_separation("ra", "dec", "180.0", "20.0")})
_alt, _az = fx.alt_az("ra", "dec", "37.4", "127.0", JD)
formulas("alt_az", "stars", "star_id", {"alt": _alt, "az": _az})
_px, _py = fx.sky_to_pixel("ra", "dec", "ra - 0.4", "dec + 0.3", "0.0005", "2048", "2048")
formulas("sky_to_pixel", "stars", "star_id", {"px": _px, "py": _py})
_ra, _dec = fx.pixel_to_sky("x", "y", "359.9", "40.0", "0.0005", "2048", "2048")
formulas("pixel_to_sky", "sources", "src_id", {"ra": _ra, "dec": _dec})
_i, _j = fx.tile_index("x", SIZE), fx.tile_index("y", SIZE)
formulas("tile_index", "sources", "src_id", {"i": _i, "j": _j})
_x1, _x2 = fx.tile_bounds(_i, SIZE)
formulas("tile_bounds", "sources", "src_id", {"x1": _x1, "x2": _x2, "size": f"{_x2} - {_x1}", "centre": f"({_x1} + {_x2}) * 0.5e0"})
_edge = f"least(x, {SIZE} - x, y, {SIZE} - y)"
formulas("mag_range", "stars", "star_id", {"mag": "mag"}, "mag > 13.0 AND mag < 18.0")
formulas("image_bounds", "stars", "star_id", {"x": "x", "y": "y"}, f"x BETWEEN -10 AND {SIZE - 800} AND y BETWEEN -10 AND {SIZE - 800}")
formulas("edge_exclusion", "sources", "src_id", {"gap": _edge}, f"{_edge} > 7 * 2.5")
formulas("sky_box", "stars", "star_id", {"ra": "ra", "dec": "dec"}, "(ra >= 355.0 - 0.1 OR ra <= 5.0 + 0.1) AND dec BETWEEN -40.1 AND 40.1")


@query("pixel_error", t.with_("pixels") + f"SELECT frame_id, y, x, round({fx.pixel_error('1000 * v')}, 6) AS err FROM pixels")
def _(spark, d):
    return t.pixels(spark, d).select("frame_id", "y", "x", F.expr(f"round({fx.pixel_error('1000 * v')}, 6)").alias("err"))


# --- pixels --------------------------------------------------------------------------------------------------------------
@query("transpose", t.with_("pixels") + "SELECT frame_id, x AS y, y AS x, v FROM pixels")
def _(spark, d):
    return t.pixels(spark, d).select("frame_id", F.col("x").alias("y"), F.col("y").alias("x"), "v")


@query("flip_xy", t.with_("pixels") + "SELECT frame_id, 7 - y AS y, 7 - x AS x, v FROM pixels")
def _(spark, d):
    return t.pixels(spark, d).select("frame_id", (7 - F.col("y")).alias("y"), (7 - F.col("x")).alias("x"), "v")


@query("cutout", t.with_("pixels") + "SELECT frame_id, y - (frame_id % 8 - 2) AS y, x - (frame_id % 7 - 2) AS x, v FROM pixels WHERE y BETWEEN frame_id % 8 - 2 AND frame_id % 8 + 2 AND x BETWEEN frame_id % 7 - 2 AND frame_id % 7 + 2")
def _(spark, d):
    cy, cx = F.col("frame_id") % 8, F.col("frame_id") % 7
    near = F.col("y").between(cy - 2, cy + 2) & F.col("x").between(cx - 2, cx + 2)
    return t.pixels(spark, d).where(near).select("frame_id", (F.col("y") - (cy - 2)).alias("y"), (F.col("x") - (cx - 2)).alias("x"), "v")


def _duck_stack(source: str, keys: str, k: float) -> str:
    on = " AND ".join(f"p.{c} = m.{c}" for c in keys.split(", "))
    named = ", ".join(f"p.{c} AS {c}" for c in keys.split(", "))
    own = ", ".join(f"p.{c}" for c in keys.split(", "))
    return f"""m AS (SELECT {keys}, median(v) AS m, count(*) AS n FROM {source} GROUP BY ALL),
      s AS (SELECT {named}, 1.4826 * median(abs(p.v - m.m)) AS s FROM {source} p JOIN m ON {on} GROUP BY {own}),
      stacked AS (SELECT {named}, median(p.v) AS v, any_value(m.n) AS n, count(*) AS n_kept FROM {source} p JOIN m ON {on} JOIN s ON {on.replace("m.", "s.")} WHERE abs(p.v - m.m) <= {k} * s.s GROUP BY {own})"""


@query("stack_bias", t.with_("pixels") + ", " + _duck_stack("pixels", "y, x", 5) + " SELECT y, x, round(v, 6) + 0 AS v, CAST(n AS INT) AS n, CAST(n_kept AS INT) AS n_kept FROM stacked")
def _(spark, d):
    return rounded(ops.stack(t.pixels(spark, d), ["y", "x"], 5), "v")


BIAS = "bias AS (SELECT grp AS b_grp, y, x, median(v) AS b FROM pixels WHERE grp = 0 GROUP BY ALL)"


def _minus_bias(spark, d):
    px = t.pixels(spark, d)
    bias = px.where("grp = 0").groupBy("y", "x").agg(F.median("v").alias("b"))
    return px.where("grp <> 0").join(bias, ["y", "x"]).select("frame_id", "grp", "y", "x", (F.col("v") - F.col("b")).alias("v"))


SUB = f"{BIAS}, sub AS (SELECT frame_id, grp, p.y, p.x, v - b AS v FROM pixels p JOIN bias ON p.y = bias.y AND p.x = bias.x WHERE grp <> 0)"


@query("subtract_bias", t.with_("pixels") + f", {SUB} SELECT frame_id, y, x, round(v, 6) + 0 AS v FROM sub")
def _(spark, d):
    return rounded(_minus_bias(spark, d), "v").select("frame_id", "y", "x", "v")


@query("stack_darks", t.with_("pixels") + f", {SUB}, " + _duck_stack("sub", "grp, y, x", 5) + " SELECT grp, y, x, round(v, 6) + 0 AS v, CAST(n AS INT) AS n, CAST(n_kept AS INT) AS n_kept FROM stacked")
def _(spark, d):
    return rounded(ops.stack(_minus_bias(spark, d), ["grp", "y", "x"], 5), "v")


def _minus_dark(spark, d):
    sub = _minus_bias(spark, d)
    dark = sub.where("grp = 1").groupBy("y", "x").agg(F.median("v").alias("k"))
    return sub.where("grp > 1").join(dark, ["y", "x"]).select("frame_id", "grp", "y", "x", (F.col("v") - F.col("k")).alias("v"))


DARK = f"{SUB}, dark AS (SELECT y, x, median(v) AS k FROM sub WHERE grp = 1 GROUP BY ALL), dsub AS (SELECT frame_id, grp, s.y, s.x, v - k AS v FROM sub s JOIN dark ON s.y = dark.y AND s.x = dark.x WHERE grp > 1)"


@query("subtract_dark", t.with_("pixels") + f", {DARK} SELECT frame_id, y, x, round(v, 6) + 0 AS v FROM dsub")
def _(spark, d):
    return rounded(_minus_dark(spark, d), "v").select("frame_id", "y", "x", "v")


FLAT = "flat AS (SELECT y, x, median(v) + 5 AS f FROM pixels WHERE grp = 2 GROUP BY ALL), mean AS (SELECT avg(f) AS mf FROM flat)"


def _flat(spark, d):
    flat = t.pixels(spark, d).where("grp = 2").groupBy("y", "x").agg((F.median("v") + 5).alias("f"))
    mean = flat.agg(F.avg("f").alias("mf"))  # one row
    return flat.join(F.broadcast(mean), how="cross")


@query("flat_correct", t.with_("pixels") + f", {DARK}, {FLAT} SELECT frame_id, p.y, p.x, round(v / (f / mf), 6) + 0 AS v FROM dsub p JOIN flat ON p.y = flat.y AND p.x = flat.x, mean WHERE grp > 2")
def _(spark, d):
    px = _minus_dark(spark, d).where("grp > 2").join(_flat(spark, d), ["y", "x"])
    return rounded(px.select("frame_id", "y", "x", F.try_divide("v", F.col("f") / F.col("mf")).alias("v")), "v")


MASK = "CASE WHEN raw >= 0.3 THEN 1 ELSE 0 END + CASE WHEN least(x, 7 - x, y, 7 - y) < 1 THEN 2 ELSE 0 END + CASE WHEN v < 0 THEN 4 ELSE 0 END"


@query("correct_flat_chain", t.with_("pixels") + f""", {DARK}, {FLAT}, c AS (SELECT p.frame_id, p.y, p.x, q.v AS raw, p.v, p.v / (f / mf) AS cor FROM dsub p JOIN flat ON p.y = flat.y AND p.x = flat.x JOIN pixels q ON p.frame_id = q.frame_id AND p.y = q.y AND p.x = q.x, mean WHERE p.grp > 2)
  SELECT frame_id, y, x, round(cor, 6) + 0 AS v, {MASK} + CASE WHEN cor <= 0 THEN 8 ELSE 0 END AS bits FROM c""")
def _(spark, d):
    raw = t.pixels(spark, d).select("frame_id", "y", "x", F.col("v").alias("raw"))
    px = _minus_dark(spark, d).where("grp > 2").join(_flat(spark, d), ["y", "x"]).join(raw, ["frame_id", "y", "x"])
    px = px.withColumn("cor", F.try_divide("v", F.col("f") / F.col("mf")))
    bits = F.expr(MASK) + F.when(F.coalesce(F.col("cor") <= 0, F.lit(True)), 8).otherwise(0)
    return rounded(px.select("frame_id", "y", "x", F.col("cor").alias("v"), bits.alias("bits")), "v")


for _name, _rule in {"mask_saturated": "v >= 0.25", "mask_edge": "least(x, 7 - x, y, 7 - y) < 2", "mask_negative": "v < 0", "mask_badpix": "coalesce(NOT (1 + v > 0.4 AND 1 + v <= 1.15), true)"}.items():

    @query(_name, t.with_("pixels") + f"SELECT frame_id, y, x FROM pixels WHERE {_rule}")
    def _(spark, d, rule=_rule):
        return t.pixels(spark, d).where(rule).select("frame_id", "y", "x")


ALL_BITS = "CASE WHEN v >= 0.25 THEN 1 ELSE 0 END + CASE WHEN least(x, 7 - x, y, 7 - y) < 1 THEN 2 ELSE 0 END + CASE WHEN v < 0 THEN 4 ELSE 0 END"


@query("combine_masks", t.with_("pixels") + f"SELECT frame_id, y, x, CAST({ALL_BITS} AS INT) AS bits FROM pixels WHERE {ALL_BITS} <> 0")
def _(spark, d):
    px = t.pixels(spark, d)
    masks = [px.where(r).select("frame_id", "y", "x", F.lit(b).alias("bit")) for r, b in (("v >= 0.25", 1), ("least(x, 7 - x, y, 7 - y) < 1", 2), ("v < 0", 4))]
    return masks[0].unionByName(masks[1]).unionByName(masks[2]).groupBy("frame_id", "y", "x").agg(F.bit_or("bit").alias("bits"))


@query("count_masked", t.with_("pixels") + f"SELECT frame_id, count(*) FILTER (WHERE {ALL_BITS} <> 0) AS n_masked FROM pixels GROUP BY frame_id")
def _(spark, d):
    bits = ops.mask_bits(F.col("v"), F.col("x"), F.col("y"), 8, 8, 0.25, 1)
    return t.pixels(spark, d).groupBy("frame_id").agg(F.count_if(bits != 0).alias("n_masked"))


@query("normalize_image", t.with_("pixels") + "SELECT frame_id, y, x, round(v / max(v) OVER (PARTITION BY frame_id), 6) + 0 AS v FROM pixels")
def _(spark, d):
    px = t.pixels(spark, d)
    top = px.groupBy("frame_id").agg(F.max("v").alias("m"))
    return rounded(px.join(top, "frame_id").select("frame_id", "y", "x", F.try_divide("v", "m").alias("v")), "v")


@query("group_inv_median", t.with_("pixels") + "SELECT frame_id, round(1 / (5 + median(v)), 6) + 0 AS scale FROM pixels GROUP BY frame_id")
def _(spark, d):
    return rounded(t.pixels(spark, d).groupBy("frame_id").agg(F.try_divide(F.lit(1.0), 5 + F.median("v")).alias("scale")), "scale")


@query("stack_flats", t.with_("pixels") + ", sc AS (SELECT frame_id, 1 / median(v + 5) AS s FROM pixels GROUP BY ALL), fl AS (SELECT grp, y, x, (v + 5) * s AS v FROM pixels JOIN sc USING (frame_id)), " + _duck_stack("fl", "grp, y, x", 3) + " SELECT grp, y, x, round(v, 6) + 0 AS v, CAST(n AS INT) AS n, CAST(n_kept AS INT) AS n_kept FROM stacked")
def _(spark, d):
    px = t.pixels(spark, d).withColumn("v", F.col("v") + 5)
    scale = px.groupBy("frame_id").agg((1 / F.median("v")).alias("s"))
    return rounded(ops.stack(px.join(scale, "frame_id").select("grp", "y", "x", (F.col("v") * F.col("s")).alias("v")), ["grp", "y", "x"], 3), "v")


# --- joins ---------------------------------------------------------------------------------------------------------------
def _of_type(spark, d, kind):
    return t.frames(spark, d).where(F.col("imagetyp") == kind)


@query("nearest_bias", t.with_("frames") + """, c AS (SELECT f.frame_id, m.frame_id AS master_id, row_number() OVER (PARTITION BY f.frame_id ORDER BY abs(f.us - m.us), m.us, m.frame_id) AS r
  FROM frames f JOIN frames m ON f.detector = m.detector AND m.imagetyp = 'BIAS' WHERE f.imagetyp = 'LIGHT')
  SELECT f.frame_id, c.master_id FROM frames f LEFT JOIN c ON f.frame_id = c.frame_id AND r = 1 WHERE f.imagetyp = 'LIGHT'""")
def _(spark, d):
    cols = ["frame_id", "detector", "us"]
    return ops.nearest_in_time(_of_type(spark, d, "LIGHT").select(*cols), _of_type(spark, d, "BIAS").select(*cols))


@query("nearest_dark", t.with_("frames") + """, c AS (SELECT f.frame_id, m.frame_id AS master_id, abs(f.exptime - m.exptime) AS exp_gap, row_number() OVER (PARTITION BY f.frame_id ORDER BY abs(f.exptime - m.exptime), m.exptime, abs(f.us - m.us), m.us, m.frame_id) AS r
  FROM frames f JOIN frames m ON f.detector = m.detector AND m.imagetyp = 'DARK' WHERE f.imagetyp = 'LIGHT') SELECT frame_id, master_id, exp_gap FROM c WHERE r = 1""")
def _(spark, d):
    cols = ["frame_id", "detector", "us", "exptime"]
    return ops.nearest_dark(_of_type(spark, d, "LIGHT").select(*cols), _of_type(spark, d, "DARK").select(*cols))


@query("match_catalogs", t.with_("sources", "stars") + """, c AS (SELECT src_id, star_id, sqrt(power(s.x - t.x, 2) + power(s.y - t.y, 2)) AS sep FROM sources s JOIN stars t ON s.frame_id = t.frame_id AND abs(s.x - t.x) < 30 AND abs(s.y - t.y) < 30)
  SELECT src_id, star_id, round(sep, 6) AS sep FROM (SELECT *, row_number() OVER (PARTITION BY src_id ORDER BY sep, star_id) AS r FROM c WHERE sep < 30) WHERE r = 1""")
def _(spark, d):
    return rounded(ops.match_nearest(t.sources(spark, d), t.stars(spark, d), 30.0), "sep").drop("frame_id")


NEAR = "SELECT a.star_id FROM stars a JOIN stars b ON a.frame_id = b.frame_id AND a.star_id <> b.star_id AND abs(a.x - b.x) < {r} AND abs(a.y - b.y) < {r} AND power(a.x - b.x, 2) + power(a.y - b.y, 2) < {r} * {r} {w}"


@query("isolate_self", t.with_("stars") + "SELECT star_id, mag FROM stars WHERE star_id NOT IN (" + NEAR.format(r=15, w="") + ")")
def _(spark, d):
    return ops.isolated(t.stars(spark, d), 15.0).select("star_id", "mag")


@query("isolate_bright", t.with_("stars") + "SELECT star_id, mag FROM stars WHERE mag > 13 AND star_id NOT IN (" + NEAR.format(r=50, w="AND b.mag <= 13") + ")")
def _(spark, d):
    s = t.stars(spark, d)
    return ops.away_from(s.where("mag > 13"), s.where("mag <= 13"), 50.0).select("star_id", "mag")


BOXES = """boxes AS (SELECT field_id, CASE WHEN p = 0 THEN CASE WHEN ra - 4 < 0 THEN ra + 356 ELSE ra - 4 END ELSE 0 END AS ra1, CASE WHEN p = 0 THEN CASE WHEN ra - 4 < 0 OR ra + 4 > 360 THEN 360 ELSE ra + 4 END ELSE CASE WHEN ra - 4 < 0 THEN ra + 4 ELSE ra - 356 END END AS ra2, dec - 4 AS dec1, dec + 4 AS dec2
  FROM fields, (SELECT unnest([0, 1]) AS p) WHERE p = 0 OR ra - 4 < 0 OR ra + 4 > 360)"""


@query("fov_box", t.with_("fields") + f", {BOXES} SELECT field_id, round(ra1, 6) + 0 AS ra1, round(ra2, 6) + 0 AS ra2, round(dec1, 6) + 0 AS dec1, round(dec2, 6) + 0 AS dec2 FROM boxes")
def _(spark, d):
    return rounded(ops.field_boxes(t.fields(spark, d), 4.0), "ra1", "ra2", "dec1", "dec2")


@query("fov_subset", t.with_("stars", "fields") + f", {BOXES} SELECT star_id, mag FROM stars s WHERE mag > 12.5 AND mag < 18 AND EXISTS (SELECT 1 FROM boxes b WHERE s.ra BETWEEN ra1 AND ra2 AND s.dec BETWEEN dec1 AND dec2)")
def _(spark, d):
    return ops.in_boxes(t.stars(spark, d).where("mag > 12.5 AND mag < 18"), ops.field_boxes(t.fields(spark, d), 4.0)).select("star_id", "mag")


@query("nearest_on_sky", t.with_("stars", "ephemeris") + f""", c AS (SELECT eph_id, star_id, {fx.angular_separation('e.ra', 'e.dec', 's.ra', 's.dec')} AS dd FROM ephemeris e, stars s)
  SELECT eph_id, n.id AS star_id, round(n.dd * 3600, 4) + 0 AS dist FROM (SELECT eph_id, min({{'dd': dd, 'id': star_id}}) AS n FROM c GROUP BY eph_id)""")
def _(spark, d):
    return rounded(ops.nearest_on_sky(t.ephemeris(spark, d), t.stars(spark, d), 1.0), "dist", digits=4)


@query("predict_targets", t.with_("stars", "ephemeris") + f""", c AS (SELECT eph_id, star_id, {fx.angular_separation('e.ra', 'e.dec', 's.ra', 's.dec')} AS dd FROM ephemeris e, stars s WHERE vmag < 16.5),
  b AS (SELECT eph_id, min({{'dd': dd, 'id': star_id}}) AS n FROM c GROUP BY eph_id)
  SELECT e.eph_id, e.obsid, e.vmag, n.id AS star_id, round(n.dd * 3600, 4) + 0 AS dist FROM ephemeris e LEFT JOIN b ON e.eph_id = b.eph_id WHERE vmag < 16.5""")
def _(spark, d):
    e = t.ephemeris(spark, d).where("vmag < 16.5")
    near = rounded(ops.nearest_on_sky(e, t.stars(spark, d), 1.0), "dist", digits=4)
    return e.select("eph_id", "obsid", "vmag").join(near, "eph_id", "left")


@query("frame_targets", t.with_("ephemeris", "fields") + "SELECT eph_id, field_id, vmag FROM ephemeris JOIN fields ON obsid = field_id")
def _(spark, d):
    e, f = t.ephemeris(spark, d), t.fields(spark, d)
    return e.join(f, e["obsid"] == f["field_id"]).select("eph_id", "field_id", "vmag")


@query("attach_frame_meta", t.with_("measurements", "fields") + "SELECT frame_id, src_id, line, f.ra, f.dec FROM measurements LEFT JOIN fields f ON frame_id = field_id")
def _(spark, d):
    f = t.fields(spark, d).withColumnRenamed("field_id", "frame_id")
    return t.measurements(spark, d).select("frame_id", "src_id", "line").join(f, "frame_id", "left")


@query("tile_lookup", t.with_("sources") + f""", s AS (SELECT *, {_i} AS i, {_j} AS j FROM sources), p AS (SELECT frame_id, i, j, median(1 + npix / 10.0::DOUBLE) AS w FROM s WHERE (i + j) % 3 <> 0 GROUP BY ALL), mid AS (SELECT frame_id, median(w) AS mid FROM p GROUP BY ALL)
  SELECT src_id, round(least(greatest(coalesce(w, mid), 1.5), 10), 6) + 0 AS fwhm FROM s LEFT JOIN p USING (frame_id, i, j) LEFT JOIN mid USING (frame_id)""")
def _(spark, d):
    s = t.sources(spark, d).withColumns({"i": F.expr(_i), "j": F.expr(_j)})
    p = s.where((F.col("i") + F.col("j")) % 3 != 0).groupBy("frame_id", "i", "j").agg(F.median(1 + F.col("npix") / 10.0).alias("w"))
    middle = p.groupBy("frame_id").agg(F.median("w").alias("mid"))
    out = s.join(p, ["frame_id", "i", "j"], "left").join(middle, "frame_id", "left")
    return rounded(out.select("src_id", F.least(F.greatest(F.coalesce("w", "mid"), F.lit(1.5)), F.lit(10.0)).alias("fwhm")), "fwhm")


# --- photometry, counts, top -----------------------------------------------------------------------------------------------
PHOT = """phot AS (SELECT *, net / err AS snr, CASE WHEN net > 0 AND exptime > 0 THEN -2.5 * log10(net / exptime) END AS mag_inst, net <= 0 AS bad FROM (
  SELECT *, aperture_sum - area * sky AS net, sqrt(greatest(aperture_sum, 0) / 18.69 + area * 0.0025 + area * area * 0.0025 / 100) AS err FROM measurements))"""


@query("phot_math", t.with_("measurements") + f", {PHOT} SELECT frame_id, src_id, line, round(net, 6) + 0 AS net, round(err, 6) + 0 AS err, round(snr, 4) + 0 AS snr, round(mag_inst, 6) + 0 AS mag_inst, round(2.5 / ln(10) / snr, 6) + 0 AS mag_err, bad FROM phot")
def _(spark, d):
    p = rounded(rounded(ops.photometry(t.measurements(spark, d)), "net", "err", "mag_inst", "mag_err"), "snr", digits=4)
    return p.select("frame_id", "src_id", "line", "net", "err", "snr", "mag_inst", "mag_err", "bad")


def _duck_clip(source: str, key: str, col: str, k: float, rounds: int) -> str:
    out, last = [], source
    for n in range(rounds):
        out.append(f"f{n} AS (SELECT {key} AS fk, median({col}) AS m, stddev_pop({col}) AS s FROM {last} GROUP BY 1), c{n} AS (SELECT r.* FROM {last} r JOIN f{n} ON r.{key} = fk WHERE abs({col} - m) <= {k} * s)")
        last = f"c{n}"
    return ", ".join(out)


@query("zeropoint", t.with_("measurements") + f", {PHOT}, dm AS (SELECT frame_id, cat_mag - mag_inst AS dm FROM phot WHERE NOT bad AND mag_inst IS NOT NULL), " + _duck_clip("dm", "frame_id", "dm", 2.0, 5) + " SELECT frame_id, round(median(dm), 6) + 0 AS zp, round(stddev_samp(dm), 6) + 0 AS zp_err, count(*) AS n FROM c4 GROUP BY frame_id")
def _(spark, d):
    return rounded(ops.zeropoint(ops.photometry(t.measurements(spark, d)), 2.0), "zp", "zp_err")


@query("sigma_clip", t.with_("measurements") + ", " + _duck_clip("measurements", "frame_id", "aperture_sum", 1.5, 5) + " SELECT frame_id, src_id, line FROM c4")
def _(spark, d):
    return ops.sigma_clip(t.measurements(spark, d), ["frame_id"], "aperture_sum", 1.5).select("frame_id", "src_id", "line")


@query("drop_flagged", t.with_("measurements") + "SELECT frame_id, src_id, line FROM measurements WHERE NOT (aperture_sum < 20000)")
def _(spark, d):
    return t.measurements(spark, d).where(~(F.col("aperture_sum") < 20000)).select("frame_id", "src_id", "line")


@query("psf_tiles", t.with_("sources") + f""", s AS (SELECT frame_id, {_i} AS i, {_j} AS j, 1 + npix / 10.0::DOUBLE AS w, flux FROM sources) SELECT frame_id, i, j, round(avg(w), 6) + 0 AS fwhm_avg, round(median(w), 6) + 0 AS fwhm_median, round(stddev_pop(w), 6) + 0 AS fwhm_stddev, round(min(flux), 6) + 0 AS peak_min, round(max(flux), 6) + 0 AS peak_max, count(*) AS n_star FROM s WHERE w > 1.5 AND w < 8 GROUP BY ALL""")
def _(spark, d):
    s = t.sources(spark, d).select("frame_id", F.expr(_i).alias("i"), F.expr(_j).alias("j"), (1 + F.col("npix") / 10.0).alias("w"), "flux").where("w > 1.5 AND w < 8")
    out = s.groupBy("frame_id", "i", "j").agg(F.avg("w").alias("fwhm_avg"), F.median("w").alias("fwhm_median"), F.stddev_pop("w").alias("fwhm_stddev"), F.min("flux").alias("peak_min"), F.max("flux").alias("peak_max"), F.count("*").alias("n_star"))
    return rounded(out, "fwhm_avg", "fwhm_median", "fwhm_stddev", "peak_min", "peak_max")


@query("frame_counts", t.with_("frames") + "SELECT imagetyp, count(*) AS n FROM frames GROUP BY imagetyp")
def _(spark, d):
    return t.frames(spark, d).groupBy("imagetyp").agg(F.count("*").alias("n"))


@query("distinct_exposures", t.with_("frames") + "SELECT DISTINCT exptime FROM frames WHERE imagetyp = 'DARK'")
def _(spark, d):
    return _of_type(spark, d, "DARK").select("exptime").distinct()


@query("stack_meta", t.with_("frames") + "SELECT imagetyp, exptime, count(*) AS n, min(file) AS first_file, max(file) AS last_file, strftime(min(obs_ts), '%Y%m%d') AS obsdate FROM frames GROUP BY ALL")
def _(spark, d):
    g = t.frames(spark, d).groupBy("imagetyp", "exptime")
    return g.agg(F.count("*").alias("n"), F.min("file").alias("first_file"), F.max("file").alias("last_file"), F.date_format(F.min("obs_ts"), "yyyyMMdd").alias("obsdate"))


@query("first_last_by_name", t.with_("frames") + "SELECT imagetyp, arg_min(frame_id, file) AS first_id, arg_max(frame_id, file) AS last_id FROM frames GROUP BY imagetyp")
def _(spark, d):
    return t.frames(spark, d).groupBy("imagetyp").agg(F.min_by("frame_id", "file").alias("first_id"), F.max_by("frame_id", "file").alias("last_id"))


@query("nearest_row", t.with_("frames") + "SELECT detector, frame_id FROM (SELECT detector, frame_id, row_number() OVER (PARTITION BY detector ORDER BY abs(value - 100), file) AS r FROM frames) WHERE r = 1")
def _(spark, d):
    best = F.min(F.struct(F.abs(F.col("value") - 100), F.col("file"), F.col("frame_id"))).alias("b")
    return t.frames(spark, d).groupBy("detector").agg(best).select("detector", F.col("b.frame_id").alias("frame_id"))


@query("top_sources", t.with_("measurements") + "SELECT frame_id, src_id, line, CAST(r AS INT) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY frame_id ORDER BY aperture_sum DESC, src_id, line) AS r FROM measurements) WHERE r <= 50")
def _(spark, d):
    order = Window.partitionBy("frame_id").orderBy(F.desc("aperture_sum"), "src_id", "line")
    return t.measurements(spark, d).withColumn("rank", F.row_number().over(order)).where("rank <= 50").select("frame_id", "src_id", "line", "rank")


@query("top_per_tile", t.with_("sources") + f", s AS (SELECT frame_id, src_id, {_i} AS i, {_j} AS j, flux FROM sources) SELECT frame_id, i, j, src_id, CAST(r AS INT) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY frame_id, i, j ORDER BY flux DESC, src_id) AS r FROM s) WHERE r <= 20")
def _(spark, d):
    s = t.sources(spark, d).select("frame_id", "src_id", F.expr(_i).alias("i"), F.expr(_j).alias("j"), "flux")
    return ops.top_n(s, ["frame_id", "i", "j"], 20).select("frame_id", "i", "j", "src_id", "rank")


@query("union_results", t.with_("sources", "stars") + "SELECT src_id AS id, x, y, flux, NULL::DOUBLE AS mag FROM sources UNION ALL SELECT star_id, x, y, NULL, mag FROM stars")
def _(spark, d):
    a = t.sources(spark, d).select(F.col("src_id").alias("id"), "x", "y", "flux")
    return a.unionByName(t.stars(spark, d).select(F.col("star_id").alias("id"), "x", "y", "mag"), allowMissingColumns=True)


@query("append_history", t.with_("frames") + "SELECT frame_id, array_to_string(['created', imagetyp, 'level 1 from ' || file], '; ') AS history FROM frames")
def _(spark, d):
    start = t.frames(spark, d).withColumn("history", F.array(F.lit("created"), F.col("imagetyp")))
    return start.select("frame_id", F.array_join(F.array_append("history", F.concat(F.lit("level 1 from "), "file")), "; ").alias("history"))


@query("select_suffix_rename", t.with_("sources") + "SELECT src_id AS src_id_source, x AS x_source, y AS y_source FROM sources")
def _(spark, d):
    s = t.sources(spark, d).select("src_id", "x", "y")
    return s.withColumnsRenamed({c: f"{c}_source" for c in s.columns})
