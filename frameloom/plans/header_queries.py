"""Queries of raw headers: those that are brought to one form, and those that are set apart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import headers as hd
from ..sources import tables as t
from .survey_queries import query

SITE = {"EGAIN": "18.69", "RDNOISE": "3.7"}


def raw(spark, d) -> DataFrame:
    """Cards of every frame; some lack a time, a size, or have a number that is none, and some give UTC in place of UTC-END."""
    k = F.col("frame_id")
    when = F.date_format("obs_ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    cards = F.create_map(
        F.lit("EXPTIME"), F.when(k % 59 == 0, "1O.0").otherwise(F.col("exptime").cast("string")), F.lit("imagetyp".upper()), F.initcap("imagetyp"), F.lit("OBJECT"), F.concat(F.lit("D:\\obs\\ field "), (k % 7).cast("string"), F.lit(" ")),
        F.lit("ELAV"), F.lit("1"), F.lit("EGAIN"), F.lit("0"), F.when(k % 7 == 0, "UTC").otherwise("UTC-END"), F.when(k % 53 == 0, " ").when(k % 67 == 0, "yesterday").otherwise(when), F.lit("NAXIS1"), F.when(k % 61 == 0, "0").otherwise("64"), F.lit("NAXIS2"), F.lit("64"))
    return t.frames(spark, d).select("frame_id", cards.alias("cards"))


_REASON = "CASE WHEN frame_id % 59 = 0 THEN 'bad EXPTIME' WHEN frame_id % 53 = 0 THEN 'no time' WHEN frame_id % 67 = 0 THEN 'bad time' WHEN frame_id % 61 = 0 THEN 'no size' END"


@query("kept_headers", t.with_("frames") + f"SELECT frame_id, imagetyp, 'field ' || frame_id % 7 AS object, exptime, us - CAST(exptime * 500000 AS BIGINT) AS mid_us, us - CAST(exptime * 1000000 AS BIGINT) AS start_us, us AS end_us, strftime(make_timestamp(us - CAST(exptime * 500000 AS BIGINT)), '%Y%m%d') AS obsdate, '18.69' AS egain, 8 AS n_cards FROM frames WHERE {_REASON} IS NULL")
def _(spark, d):
    out = hd.kept(hd.normalized(raw(spark, d), SITE))
    return out.select("frame_id", "imagetyp", "object", "exptime", "mid_us", "start_us", "end_us", "obsdate", F.col("cards")["EGAIN"].alias("egain"), F.size("cards").alias("n_cards"))


@query("quarantined_headers", t.with_("frames") + f"SELECT frame_id, {_REASON} AS reason FROM frames WHERE {_REASON} IS NOT NULL")
def _(spark, d):
    return hd.quarantine(hd.normalized(raw(spark, d), SITE)).select("frame_id", "reason")
