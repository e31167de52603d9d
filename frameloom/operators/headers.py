"""Headers brought to one form in one pass, with what can't be used set apart and the reason why.

A raw frame is a row (frame_id, cards: a map of text, ...). `normalized` adds typed columns and `reason`, which is null for the rows to keep; `kept` and
`quarantine` are its two parts, and `counted` counts both while they are written. The first of these that holds is the reason: 'no cards', 'bad KEY'
(a card that should be a number and isn't), 'no time' (neither UTC-END nor UTC), 'bad time', 'no size' (NAXIS1 or NAXIS2 is missing or not positive).
Numbers that are missing are 0, texts are empty; extra columns pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

DOUBLES = ("EXPTIME", "CCDTEMP", "PIXSZ", "FOCALLEN", "APTDIA")
DROPPED = ("ELAV", "HISTORY")


def _card(key: str) -> Column:
    return F.try_element_at("cards", F.lit(key))


def _micros(c: str) -> Column:
    return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {c})")


def object_name(text: Column) -> Column:
    """What follows the last backslash, trimmed."""
    return F.trim(F.element_at(F.split(text, r"\\"), -1))


def normalized(raw: DataFrame, site: dict[str, str] | None = None, dropped: tuple[str, ...] = DROPPED) -> DataFrame:
    """raw, its cards without the dropped keys and with those of the site, and exptime, ccdtemp, pixsz, focallen, aptdia, focus, observer, imagetyp, bunit,
    filter, object, naxis1, naxis2, mid_us, start_us, end_us (the exposure ends at the card's time), jd, obsdate, reason."""
    numbers = {k: _card(k).try_cast("double") for k in DOUBLES} | {"FOCUS": _card("FOCUS").try_cast("int")}
    time = F.coalesce(F.nullif(F.trim(_card("UTC-END")), F.lit("")), F.nullif(F.trim(_card("UTC")), F.lit("")))
    parts = {"_text": time, "_end": time.try_cast("timestamp_ntz")} | {f"_{k}": v for k, v in numbers.items()} | {f"_{k}": _card(k).try_cast("int") for k in ("NAXIS1", "NAXIS2")}
    bad = {f"_bad_{k}": _card(k).isNotNull() & v.isNull() for k, v in numbers.items()}
    # cards are made, and read, once: a filter on the reason would otherwise be pushed down with all that the reason is made of, the map again for
    # each card
    out = raw.withColumn("cards", F.explode(F.array("cards")))
    out = out.withColumn("_read", F.explode(F.array(F.struct(*(v.alias(k) for k, v in (parts | bad).items())))))
    part = lambda k: F.col("_read")[k]
    out = out.withColumns({k.lower(): F.coalesce(part(f"_{k}"), F.lit(0)) for k in numbers} | {k.lower(): part(f"_{k}") for k in ("NAXIS1", "NAXIS2")} | {"_end": part("_end")})
    reason = F.when(F.col("cards").isNull(), "no cards")
    for key in numbers:
        reason = reason.when(part(f"_bad_{key}"), f"bad {key}")
    large = (part("_NAXIS1") > 0) & (part("_NAXIS2") > 0)
    reason = reason.when(part("_text").isNull(), "no time").when(part("_end").isNull(), "bad time").when(~F.coalesce(large, F.lit(False)), "no size")
    out = out.withColumns({
        "observer": F.upper(F.coalesce(_card("OBSERVER"), F.lit(""))), "imagetyp": F.upper(F.coalesce(_card("IMAGETYP"), F.lit(""))), "bunit": F.lit("adu"),
        "filter": F.coalesce(_card("FILTER"), F.lit("CLEAR")), "object": object_name(F.coalesce(_card("OBJECT"), F.lit("Unknown"))), "reason": reason})
    half = F.round(F.col("exptime") * 500_000).cast("long")
    out = out.withColumn("end_us", _micros("_end")).withColumn("mid_us", F.col("end_us") - half).withColumn("start_us", F.col("mid_us") - half)
    out = out.withColumns({"jd": F.col("mid_us").cast("double") / 86_400_000_000 + 2440587.5, "obsdate": F.expr("date_format(timestampadd(MICROSECOND, mid_us, TIMESTAMP_NTZ'1970-01-01 00:00:00'), 'yyyyMMdd')")})
    cards = F.map_filter("cards", lambda k, _: ~k.isin(*dropped, *(site or {})))
    fixed = F.create_map(*(F.lit(x) for pair in (site or {}).items() for x in pair)) if site else None
    return out.withColumn("cards", F.map_concat(cards, fixed) if site else cards).drop("_read", "_end")


def kept(rows: DataFrame) -> DataFrame:
    return rows.where("reason IS NULL").drop("reason")


def quarantine(rows: DataFrame) -> DataFrame:
    return rows.where("reason IS NOT NULL").select("frame_id", "reason", "cards")


def counted(rows: DataFrame) -> tuple[DataFrame, Observation]:
    """rows, and an observation that has n and n_quarantined once they have been written."""
    seen = Observation("headers")
    return rows.observe(seen, F.count("*").alias("n"), F.count("reason").alias("n_quarantined")), seen
