"""FITS scans and stacks with damaged files, nulls and empty tables."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from frameloom.operators import survey as ops
from frameloom.sources import fits, products, versions


def header(*cards):
    text = "".join(c.ljust(80) for c in (*cards, "END"))
    return text.ljust(-(-len(text) // 2880) * 2880).encode()


def test_scans(spark):
    data = np.arange(6, dtype=">i2").reshape(2, 3)
    head = ("SIMPLE  =                    T", "BITPIX  =                   16 / bits", "NAXIS   = 2", "NAXIS1  = 3", "NAXIS2  = 2", "BZERO   = 10", "OBJECT  = 'it''s  '  / name", "OBJECT  = 'second'")
    files = [("good", header(*head) + data.tobytes()), ("short", header(*head) + data.tobytes()[:5]), ("no end", header(*head)[:300]), ("other", b"\xff\x00 no header"), ("empty", b""), ("null", None)]
    df = spark.createDataFrame(files, "path string, content binary")
    found = fits.scan_headers(df).collect()
    assert [r["path"] for r in found] == ["good"] and found[0]["cards"]["OBJECT"] == "it's" and found[0]["cards"]["BITPIX"] == "16"
    assert {r["path"] for r in fits.damaged(df).collect()} == {p for p, _ in files[1:]}
    assert sorted((r["unit"], r["y"], r["row"]) for r in fits.scan_pixels(df).collect()) == [("adu", 0, [10.0, 11.0, 12.0]), ("adu", 1, [13.0, 14.0, 15.0])]
    assert fits.scan_headers(df.limit(0)).count() == 0


def test_stack_and_clip_of_nulls(spark):
    rows = [(0, 1.0), (0, 1.2), (0, 0.9), (0, 50.0), (0, None), (0, float("nan")), (1, None), (1, None)]
    df = spark.createDataFrame(rows, "p int, v double")
    got = {r["p"]: (r["v"], r["n"], r["n_kept"]) for r in ops.stack(df, ["p"], 3.0).collect()}
    assert got == {0: (1.0, 4, 3), 1: (None, 0, 0)}
    # 50 goes first; of the rest the deviation is 0.125 and 1.2 lies 0.2 from the median
    assert sorted(r["v"] for r in ops.sigma_clip(df, ["p"], "v", 1.5).collect()) == [0.9, 1.0]
    assert ops.stack(df.limit(0), ["p"], 3.0).count() == 0


ZP = "frame_id long, obsdate int, zp double"


def test_rerun_of_one_frame_leaves_the_others(spark):
    path = products.fresh_folder(spark, "zp")
    products.write_zeropoints(spark.createDataFrame([(1, 20240101, 21.0), (2, 20240101, 22.0), (3, 20240102, 23.0), (None, 20240102, 24.0)], ZP), path)
    products.write_zeropoints(spark.createDataFrame([(2, 20240101, 22.5), (2, 20240101, 22.6)], ZP), path)
    want = [(None, 24.0), (1, 21.0), (2, 22.5), (2, 22.6), (3, 23.0)]
    got = lambda: sorted(((r["frame_id"], r["zp"]) for r in products.read_zeropoints(spark, path).collect()), key=repr)
    assert got() == sorted(want, key=repr)
    # a frame may move to another day, a null key is a key, and a version may have no rows or new columns
    products.write_zeropoints(spark.createDataFrame([(3, 20240103, 23.5), (None, 20240103, 24.5)], ZP), path)
    products.write_zeropoints(spark.createDataFrame([], ZP), path)
    products.write_zeropoints(spark.createDataFrame([(4, 20240103, 20.0, "g")], ZP + ", band string"), path)
    assert got() == sorted([(None, 24.5), (1, 21.0), (2, 22.5), (2, 22.6), (3, 23.5), (4, 20.0)], key=repr)
    assert {r["band"] for r in products.read_zeropoints(spark, path).collect()} == {None, "g"}
    assert versions.committed(spark, path) == [1, 2, 3, 4, 5]
    assert sorted(r["zp"] for r in versions.newest(spark, path, ["frame_id"], upto=1).collect()) == [21.0, 22.0, 23.0, 24.0]


def test_broken_run_changes_nothing(spark):
    path = products.fresh_folder(spark, "zp")
    good = spark.createDataFrame([(1, 20240101, 21.0), (2, 20240101, 22.0)], ZP)
    products.write_zeropoints(good, path)
    broken = good.withColumn("zp", F.when(F.col("frame_id") == 2, F.raise_error(F.lit("stop"))).otherwise(F.lit(99.0)))
    with pytest.raises(Exception, match="stop"):
        products.write_zeropoints(broken, path)
    # files of a run that ended before its manifest
    good.withColumn("zp", F.lit(77.0)).write.partitionBy("obsdate").parquet(f"{path}/data/version=00000007")
    assert sorted(r["zp"] for r in products.read_zeropoints(spark, path).collect()) == [21.0, 22.0]
    assert products.write_zeropoints(good.where("frame_id = 1").withColumn("zp", F.lit(5.0)), path) == 3
    assert sorted(r["zp"] for r in products.read_zeropoints(spark, path).collect()) == [5.0, 22.0]
    with pytest.raises(FileNotFoundError):
        products.read_zeropoints(spark, products.fresh_folder(spark, "none"))


def test_masters_of_two_nights(spark):
    path = products.fresh_folder(spark, "masters")
    schema = "imagetyp string, grp int, obsdate int, y int, x int, v double"
    night = lambda day, v: spark.createDataFrame([("BIAS", 1, day, 0, 0, v), ("DARK", 1, day, 0, 0, v + 1)], schema)
    products.write_masters(night(20240101, 1.0), path)
    products.write_masters(night(20240102, 5.0), path)
    products.write_masters(night(20240101, 2.0).where("imagetyp = 'BIAS'"), path)
    assert sorted((r["obsdate"], r["imagetyp"], r["v"]) for r in products.read_masters(spark, path).collect()) == [(20240101, "BIAS", 2.0), (20240101, "DARK", 2.0), (20240102, "BIAS", 5.0), (20240102, "DARK", 6.0)]


def test_updates_of_frames(spark):
    frames = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (3, "c", None)], "frame_id long, file string, zp double")
    new = spark.createDataFrame([(1, 9.0, 5), (3, None, 6)], "frame_id long, zp double, n int")
    got = {r["frame_id"]: (r["zp"], r["n"]) for r in products.apply_updates(frames, new, ["zp", "n"]).collect()}
    assert got == {1: (9.0, 5), 2: (2.0, None), 3: (None, 6)}
