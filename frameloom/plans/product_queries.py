"""Queries that write files and products of the survey's tables and read them back, and the jobs made of several operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import survey as ops
from ..sources import fits, products
from ..sources import tables as t
from ..sources.catalogue import read_catalog, write_catalog
from ..sources.fits_source import read_fits
from .survey_queries import QUERIES, SQL, _duck_stack, query, rounded


@query("scan_headers", t.with_("frames") + "SELECT file, imagetyp, detector, exptime FROM frames WHERE frame_id % 97 <> 0")
def _(spark, d):
    """A file for every frame, in archives on disk, of which one of 97 breaks off before its end, read through the data source."""
    cards = F.array(fits.card("SIMPLE", F.lit("T")), fits.card("BITPIX", F.lit(16)), fits.card("NAXIS", F.lit(0)), fits.text_card("IMAGETYP", F.col("imagetyp")), fits.card("DETECTOR", F.col("detector")), fits.card("EXPTIME", F.col("exptime")))
    whole = t.frames(spark, d).withColumn("head", fits.header_bytes(cards))
    files = whole.select(F.col("file").alias("path"), F.encode(F.when(F.col("frame_id") % 97 == 0, F.substr("head", F.lit(1), F.lit(400))).otherwise(F.col("head")), "ISO-8859-1").alias("content"))
    folder = products.fresh_folder(spark, "files")
    fits.save_archives(files, folder)
    found = read_fits(spark, folder, keys=("IMAGETYP", "DETECTOR", "EXPTIME"))
    return found.select(F.element_at(F.split("path", "/"), -1).alias("file"), F.col("IMAGETYP").alias("imagetyp"), F.col("DETECTOR").cast("long").alias("detector"), F.col("EXPTIME").cast("double").alias("exptime"))


@query("refused_files", t.with_("frames") + "SELECT file, 'no END card' AS reason FROM frames WHERE frame_id % 97 = 0")
def _(spark, d):
    """The files that can't be read, with the reason."""
    head = fits.header_bytes(F.array(fits.card("SIMPLE", F.lit("T")), fits.card("BITPIX", F.lit(16)), fits.card("NAXIS", F.lit(0))))
    broken = F.when(F.col("frame_id") % 97 == 0, F.substr("head", F.lit(1), F.lit(160))).otherwise(F.col("head"))
    folder = products.fresh_folder(spark, "files")
    fits.save_archives(t.frames(spark, d).withColumn("head", head).select(F.col("file").alias("path"), F.encode(broken, "ISO-8859-1").alias("content")), folder)
    return read_fits(spark, folder, "refused").select(F.element_at(F.split("path", "/"), -1).alias("file"), "reason")


@query("scan_pixels", t.with_("planted", "mosaic") + "SELECT frame_id, y, x, round(CAST(CAST(v AS FLOAT) AS DOUBLE), 4) + 0 AS v FROM mosaic WHERE y >= 8 AND y < 60")
def _(spark, d):
    """The mosaics as files on disk; the rows asked for are all that is read of them."""
    folder = products.fresh_folder(spark, "files")
    fits.save_files(fits.images(t.mosaic(spark, d), F.format_string("img_%d.fits", "frame_id")), folder)
    rows = read_fits(spark, folder, "pixels").where("y >= 8 AND y < 60").select(F.regexp_extract("path", r"(\d+)[.]fits$", 1).cast("long").alias("frame_id"), F.col("y").cast("long").alias("y"), F.posexplode("row").alias("x", "v"))
    whole = rows.where("v IS NOT NULL").select("frame_id", "y", F.col("x").cast("long").alias("x"), "v")
    return rounded(whole, "v", digits=4)


@query("write_masters", t.with_("pixels") + f""", nights AS (SELECT *, CAST(20240101 + frame_id % 3 AS INT) AS obsdate FROM pixels WHERE grp < 4), late AS (SELECT * REPLACE (v + 1 AS v) FROM nights WHERE obsdate = 20240102 AND grp = 2), used AS (SELECT * FROM nights WHERE NOT (obsdate = 20240102 AND grp = 2) UNION ALL SELECT * FROM late),
  {_duck_stack("used", "obsdate, grp, y, x", 5)} SELECT 'DARK' AS imagetyp, grp, obsdate, y, x, round(v, 6) + 0 AS v, CAST(n AS INT) AS n FROM stacked""")
def _(spark, d):
    """Masters of three nights, written night by night, then one night's master of one group again."""
    nights = t.pixels(spark, d).where("grp < 4").withColumn("obsdate", (20240101 + F.col("frame_id") % 3).cast("int"))
    path = products.fresh_folder(spark, "masters")
    made = lambda px: ops.stack(px, ["obsdate", "grp", "y", "x"], 5.0).withColumn("imagetyp", F.lit("DARK")).select("imagetyp", "grp", "obsdate", "y", "x", "v", "n")
    for night in (20240101, 20240102, 20240103):
        products.write_masters(made(nights.where(F.col("obsdate") == night)), path)
    products.write_masters(made(nights.where("obsdate = 20240102 AND grp = 2").withColumn("v", F.col("v") + 1)), path)
    return rounded(products.read_masters(spark, path), "v")


@query("write_level1", f"WITH c AS ({SQL['correct_flat_chain']}), {t.with_('frames')[5:]} SELECT c.frame_id, y, x, CASE WHEN c.frame_id % 10 = 3 THEN -1 ELSE v END AS v, bits, CAST(strftime(obs_ts, '%Y%m%d') AS INT) AS obsdate, 'kl4040.sci.lv1.' || c.frame_id || '.fits' AS lv1_name FROM c JOIN frames USING (frame_id)")
def _(spark, d):
    """Corrected frames with their names, then every tenth frame again: the others of its day stay."""
    day = t.frames(spark, d).select("frame_id", F.date_format("obs_ts", "yyyyMMdd").cast("int").alias("obsdate"), F.format_string("kl4040.sci.lv1.%d.fits", "frame_id").alias("lv1_name"))
    rows = QUERIES["correct_flat_chain"](spark, d).join(day, "frame_id")
    path = products.fresh_folder(spark, "level1")
    products.write_level1(rows, path)
    products.write_level1(products.read_level1(spark, path).where("frame_id % 10 = 3").withColumn("v", F.lit(-1.0)), path)
    return products.read_level1(spark, path).select("frame_id", "y", "x", "v", "bits", "obsdate", "lv1_name")


@query("write_zeropoints", f"WITH z AS ({SQL['zeropoint']}), {t.with_('frames')[5:]} SELECT z.* REPLACE (CASE WHEN z.frame_id % 7 = 2 THEN 99 ELSE zp END AS zp), CAST(strftime(obs_ts, '%Y%m%d') AS INT) AS obsdate FROM z JOIN frames USING (frame_id)")
def _(spark, d):
    day = t.frames(spark, d).select("frame_id", F.date_format("obs_ts", "yyyyMMdd").cast("int").alias("obsdate"))
    rows = QUERIES["zeropoint"](spark, d).join(day, "frame_id")
    path = products.fresh_folder(spark, "zeropoints")
    products.write_zeropoints(rows, path)
    products.write_zeropoints(products.read_zeropoints(spark, path).where("frame_id % 7 = 2").withColumn("zp", F.lit(99.0)), path)
    return products.read_zeropoints(spark, path)


@query("apply_frame_updates", f"WITH z AS ({SQL['zeropoint']}), {t.with_('frames')[5:]} SELECT f.frame_id, file, CASE WHEN f.frame_id % 7 = 2 AND zp IS NOT NULL THEN 99 ELSE zp END AS zp, zp_err, n FROM frames f LEFT JOIN z USING (frame_id)")
def _(spark, d):
    """Zero points as last written, set on their frames."""
    path = products.fresh_folder(spark, "zeropoints")
    rows = QUERIES["zeropoint"](spark, d)
    products.write_zeropoints(rows.withColumn("obsdate", F.lit(20240101)), path)
    products.write_zeropoints(rows.where("frame_id % 7 = 2").withColumns({"zp": F.lit(99.0), "obsdate": F.lit(20240102)}), path)
    return products.apply_updates(t.frames(spark, d).select("frame_id", "file"), products.read_zeropoints(spark, path), ["zp", "zp_err", "n"])


@query("read_catalog", t.with_("stars") + "SELECT star_id, ra, dec, CAST(floor((dec + 90) / 5) AS INT) AS dec_band FROM stars WHERE dec BETWEEN -31.5 AND 12.25 AND (ra >= 350 OR ra <= 40.5)")
def _(spark, d):
    """A catalogue written by bands, and a box across right ascension 0 of it."""
    path = products.fresh_folder(spark, "catalogue")
    write_catalog(t.stars(spark, d).select("star_id", "ra", "dec"), path)
    return read_catalog(spark, path, -31.5, 12.25, 350.0, 40.5).select("star_id", "ra", "dec", "dec_band")
