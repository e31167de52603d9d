"""Catalogues on disk: a box reads the files it touches, and nothing is lost."""

import random

from pyspark.sql import functions as F

from frameloom.sources import products
from frameloom.sources.catalogue import bands, read_catalog, write_catalog


def test_box_reads_few_files(spark):
    rng = random.Random(6)
    stars = [(i, rng.uniform(0, 360), rng.uniform(-90, 90) if i % 3 else rng.uniform(10, 12)) for i in range(6000)] + [(9001, 359.99, 90.0), (9002, 0.0, -90.0), (9003, None, 1.0), (9004, 1.0, float("nan"))]
    path = products.fresh_folder(spark, "cat")
    write_catalog(spark.createDataFrame(stars, "star_id long, ra double, dec double"), path, rows=400)
    whole = read_catalog(spark, path)
    files = whole.select(F.input_file_name().alias("f")).distinct().count()
    assert whole.count() == 6002 and files > 36
    for box in ((10.5, 11.5, 350.0, 20.0), (-90.0, -89.0, 0.0, 360.0), (88.0, 90.0, 0.0, 360.0), (30.0, 41.0, 100.0, 110.0), (50.0, 40.0, 0.0, 1.0)):
        d1, d2, r1, r2 = box
        got = read_catalog(spark, path, *box)
        want = {i for i, ra, dec in stars if ra is not None and d1 <= dec <= d2 and (r1 <= ra <= r2 if r1 <= r2 else ra >= r1 or ra <= r2)}
        assert {r["star_id"] for r in got.collect()} == want
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [dec_band" in plan.replace("PartitionFilters: [isnotnull(dec_band", "PartitionFilters: [dec_band") or not want
        touched = {int((d + 90) // 5) for d in (d1, d2)}
        assert {r[0] for r in got.select("dec_band").distinct().collect()} <= set(range(min(touched), max(touched) + 1))
        assert got.select(F.input_file_name().alias("f")).distinct().count() < files / 2
    facts = {r["dec_band"]: r for r in bands(spark, path).collect()}
    assert sum(r["n"] for r in facts.values()) == 6002 and facts[20]["n"] > 1900 and 10 <= facts[20]["dec1"] and facts[35]["dec2"] == 90.0
