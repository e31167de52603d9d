"""Raw headers: one form for those that can be used, a reason for the others."""

from frameloom.operators import headers as hd


def test_headers_land_on_one_side(spark):
    good = {"EXPTIME": "30", "UTC-END": "2024-01-02T00:00:10", "NAXIS1": "64", "NAXIS2": "32", "OBJECT": "a\\b\\ M31 ", "imagetyp": "x", "IMAGETYP": "Light", "ELAV": "5", "EGAIN": "0"}
    rows = [
        (1, good), (2, {**good, "UTC-END": " ", "UTC": "2024-01-02 00:00:10.5"}), (3, {k: v for k, v in good.items() if k != "UTC-END"}), (4, {**good, "UTC-END": "soon"}), (5, {**good, "EXPTIME": "abc"}),
        (6, {**good, "NAXIS2": "0"}), (7, {k: v for k, v in good.items() if k != "NAXIS1"}), (8, None), (9, {}), (10, {**good, "FOCUS": "1.5e"}), (11, {k: v for k, v in good.items() if k not in ("EXPTIME", "OBJECT")})]
    df = spark.createDataFrame(rows, "frame_id long, cards map<string, string>")
    all_, seen = hd.counted(hd.normalized(df, {"EGAIN": "18.69"}))
    got = {r["frame_id"]: r for r in all_.collect()}
    assert seen.get == {"n": 11, "n_quarantined": 8}
    assert {k: r["reason"] for k, r in got.items()} == {1: None, 2: None, 3: "no time", 4: "bad time", 5: "bad EXPTIME", 6: "no size", 7: "no size", 8: "no cards", 9: "no time", 10: "bad FOCUS", 11: None}
    one, two, last = got[1], got[2], got[11]
    assert (one["object"], one["imagetyp"], one["exptime"], one["obsdate"], one["filter"]) == ("M31", "LIGHT", 30.0, "20240101", "CLEAR")
    assert one["end_us"] - one["mid_us"] == one["mid_us"] - one["start_us"] == 15_000_000 and two["end_us"] - one["end_us"] == 500_000
    assert abs(one["jd"] - (2460311.5 - 5 / 86400)) < 1e-8 and "ELAV" not in one["cards"] and one["cards"]["EGAIN"] == "18.69"
    assert (last["exptime"], last["object"], last["mid_us"]) == (0.0, "Unknown", last["end_us"])
    both = hd.normalized(df)
    assert hd.kept(both).count() + hd.quarantine(both).count() == 11 and hd.normalized(df.limit(0)).count() == 0


def test_cards_are_made_once(spark):
    """A filter on the reason is pushed down without the map that the cards are made of."""
    from pyspark.sql import functions as F

    cards = F.create_map(F.lit("EXPTIME"), F.col("id").cast("string"), F.lit("UTC"), F.lit("2024-01-02T00:00:10"), F.lit("NAXIS1"), F.lit("64"), F.lit("NAXIS2"), F.lit("64"))
    rows = hd.normalized(spark.range(5).select(F.col("id").alias("frame_id"), cards.alias("cards")))
    for out in (hd.kept(rows), hd.quarantine(rows)):
        assert out._jdf.queryExecution().optimizedPlan().toString().count("map(EXPTIME") == 1
    assert hd.kept(rows).count() == 5
