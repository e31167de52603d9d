"""FITS files on disk through the data source: units, damaged files, pushdown."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from frameloom.sources import fits_source as fs


def head(*cards, first="SIMPLE  =                    T"):
    text = "".join(c.ljust(80) for c in (first, *cards, "END"))
    return text.ljust(-(-len(text) // 2880) * 2880).encode("latin-1")


def padded(data: bytes) -> bytes:
    return data + b"\0" * (-len(data) % 2880)


def axes(*n, bits=16):
    return [f"BITPIX  = {bits}", f"NAXIS   = {len(n)}", *(f"NAXIS{k}  = {v}" for k, v in enumerate(n, 1))]


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    root = tmp_path_factory.mktemp("fits")
    image = np.arange(12, dtype=">i2").reshape(4, 3)
    files = {
        "good.fits": head(*axes(3, 4), "IMAGETYP= 'BIAS'", "OBJECT  = 'it''s  / not'  / name", "OBJECT  = 'second'", "BZERO   = 1.0D1", "BSCALE  = 2", "HISTORY made", "HISTORY THE END", "BLANK   = 5", "") + padded(image.tobytes()),
        # three units: pixels, a mask and a table
        "multi.fits": head(*axes(2, 2, bits=-32), "IMAGETYP= 'LIGHT'") + padded(np.array([[1, np.nan], [3, 4]], ">f4").tobytes()) + head(*axes(2, 2, bits=8), "PCOUNT  = 0", "GCOUNT  = 1", first="XTENSION= 'IMAGE   '") + padded(bytes([0, 1, 0, 1])) + head(*axes(5, 2, bits=8), "PCOUNT  = 0", "GCOUNT  = 1", first="XTENSION= 'BINTABLE'") + padded(b"x" * 10),
        "cube.fits": head(*axes(2, 3, 2)) + padded(np.arange(12, dtype=">i2").tobytes()),
        "header only.fits": head("BITPIX  = 8", "NAXIS   = 0"),
        "bits.fits": head(*axes(2, 2, bits=12)) + padded(b"\0" * 8),
        "word.fits": head("BITPIX  = 16", "NAXIS   = 2", "NAXIS1  = 'x'", "NAXIS2  = 2") + padded(b"\0" * 8),
        "negative.fits": head(*axes(-2, 2)),
        "scale.fits": head(*axes(2, 2), "BSCALE  = big") + padded(b"\0" * 8),
        "short.fits": head(*axes(300, 300)) + b"\0" * 2880,
        "cut second.fits": head(*axes(1, 1)) + padded(b"\0\7") + head(*axes(90, 90), first="XTENSION= 'IMAGE   '") + b"\0" * 10,
        "no end.fits": head(*axes(2, 2))[:400],
        "other.fits": b"\xff\x00 something else",
        "empty.fits": b"",
        "notes.txt": b"not asked for",
    }
    for name, content in files.items():
        (root / name).write_bytes(content)
    return str(root)


def read(spark, folder, table, **options):
    return fs.read_fits(spark, folder, table, pathGlobFilter="*.fits", **options).withColumn("name", F.element_at(F.split("path", "/"), -1))


def test_headers(spark, folder):
    got = {(r["name"], r["hdu"]): r for r in read(spark, folder, "headers").collect()}
    assert set(got) == {("good.fits", 0), ("multi.fits", 0), ("multi.fits", 1), ("multi.fits", 2), ("cube.fits", 0), ("header only.fits", 0), ("cut second.fits", 0)}
    good = got["good.fits", 0]
    assert good["cards"]["OBJECT"] == "it's  / not" and good["history"] == ["made", "THE END"] and good["shape"] == [3, 4] and got["cube.fits", 0]["naxis"] == 3


def test_refused_files_have_a_reason(spark, folder):
    got = {(r["name"], r["hdu"]): r["reason"] for r in read(spark, folder, "refused").collect()}
    assert got == {
        ("bits.fits", 0): "BITPIX = 12", ("word.fits", 0): "NAXIS1 = x", ("negative.fits", 0): "NAXIS1 = -2", ("scale.fits", 0): "BSCALE = big", ("short.fits", 0): "2880 bytes of data in place of 180000",
        ("cut second.fits", 1): "10 bytes of data in place of 16200", ("no end.fits", 0): "no END card", ("other.fits", 0): "no FITS header", ("empty.fits", 0): "empty file"}


@pytest.mark.parametrize("split", [64, 3000, 32 << 20])
def test_pixels_of_all_units(spark, folder, split):
    """However a file is split, each row is read once."""
    got = {}
    for r in read(spark, folder, "pixels", splitBytes=split).collect():
        assert got.setdefault((r["name"], r["hdu"], r["plane"], r["y"]), r["row"]) is r["row"]
    want = {("good.fits", 0, 0, y): [None if v == 5 else 2.0 * v + 10 for v in range(3 * y, 3 * y + 3)] for y in range(4)}
    want |= {("multi.fits", 0, 0, 0): [1.0, None], ("multi.fits", 0, 0, 1): [3.0, 4.0], ("multi.fits", 1, 0, 0): [0.0, 1.0], ("multi.fits", 1, 0, 1): [0.0, 1.0], ("cut second.fits", 0, 0, 0): [7.0]}
    want |= {("cube.fits", 0, p, y): [6.0 * p + 2 * y, 6.0 * p + 2 * y + 1] for p in range(2) for y in range(3)}
    assert got == want


def test_filters_are_pushed_down(spark, folder, monkeypatch):
    """What Spark gives the reader, and what the reader then opens and decodes."""
    df = read(spark, folder, "pixels", keys=("IMAGETYP",))
    assert [r["y"] for r in df.where("IMAGETYP = 'BIAS' AND y >= 1 AND y < 3").orderBy("y").collect()] == [1, 2]
    assert {r["hdu"] for r in df.where("hdu = 1").collect()} == {1}
    assert df.where(F.col("path") == f"{folder}/multi.fits").count() == 4
    assert df.where("plane = 1 AND y = 2").collect()[0]["row"] == [10.0, 11.0]  # plane stays with Spark
    plan = df.where("IMAGETYP = 'BIAS' AND y > 0 AND plane = 0").select("y")._jdf.queryExecution().executedPlan().toString()
    left = plan[plan.index("Filter") :].split("\n")[0]  # what Spark still filters itself
    assert "= 0)" in left and "BIAS" not in left and "> 0" not in left
    reader = fs.FitsReader({"path": folder, "table": "pixels", "keys": "IMAGETYP"})
    rest = list(reader.pushFilters([fs.EqualTo(("IMAGETYP",), "BIAS"), fs.GreaterThan(("y",), 0), fs.EqualTo(("plane",), 0), fs.In(("path",), (f"{folder}/good.fits", f"{folder}/multi.fits"))]))
    assert [f.attribute for f in rest] == [("plane",)]
    decoded = []
    monkeypatch.setattr(fs, "image_rows", lambda f, unit, low, high, rows=fs.image_rows: (decoded.append((low, high)) if high else None) or rows(f, unit, low, high))
    opened = reader.partitions()
    assert [f[0].rsplit("/", 1)[-1] for p in opened for f in p.files] == ["good.fits", "multi.fits"]
    assert sum(b.num_rows for p in opened for b in reader.read(p)) == 3 and decoded == [(1, 4)]


def test_large_image_is_many_tasks(spark, tmp_path):
    image = np.arange(500 * 40, dtype=">i4").reshape(500, 40)
    (tmp_path / "large.fits").write_bytes(head(*axes(40, 500, bits=32)) + padded(image.tobytes()))
    for k in range(30):
        (tmp_path / f"small{k}.fits").write_bytes(head(*axes(2, 2)) + padded(b"\0" * 8))
    df = fs.read_fits(spark, str(tmp_path), "pixels", splitBytes=20_000)
    assert 5 <= df.rdd.getNumPartitions() <= 16 and df.count() == 560
    rows = {r["y"]: r["row"] for r in df.where(F.col("path").endswith("large.fits")).collect()}
    assert len(rows) == 500 and rows[499][39] == 19999.0
    assert fs.read_fits(spark, str(tmp_path / "none"), "headers").count() == 0


def test_files_in_subfolders_are_listed_by_tasks(spark, tmp_path):
    """What the driver plans with doesn't grow with the files, and none is lost; pixels are found there, too."""
    import pickle

    from frameloom.sources import fits

    names = [f"f{k}.fits" for k in range(3000)]
    rows = spark.range(3000).select(F.format_string("f%d.fits", "id").alias("path"), F.when(F.col("id") % 100 == 0, F.lit(b"SIMPLE  = T")).otherwise(F.lit(head("BITPIX  = 8", "NAXIS   = 0"))).alias("content"))
    assert fits.save_files(rows, str(tmp_path)) == 3000
    plan = fs.FitsReader({"path": str(tmp_path), "table": "headers"}).partitions()
    assert len(pickle.dumps(plan)) < 100 * fits.FOLDERS + 10_000 and len(plan) <= fs.DEALT and not any(p.files for p in plan)
    base = lambda table: sorted(r["name"] for r in read(spark, str(tmp_path), table).select("name").collect())
    assert base("headers") == sorted(n for k, n in enumerate(names) if k % 100) and base("refused") == sorted(n for k, n in enumerate(names) if k % 100 == 0)
    nested = tmp_path / "a" / "b"
    nested.mkdir(parents=True)
    (nested / "deep.fits").write_bytes(head(*axes(2, 2)) + padded(b"\0" * 8))
    assert read(spark, str(tmp_path), "headers").where("name = 'deep.fits'").count() == 1 and read(spark, str(tmp_path), "pixels").count() == 2


def test_small_files_lie_in_archives(spark, tmp_path):
    """Thousands of files take few inodes, are read as if they lay in the folder, and an archive that breaks off is refused after what it still has."""
    from frameloom.sources import fits

    rows = spark.range(0, 3000, 1, 3).select(F.format_string("f%d.fits", "id").alias("path"), F.when(F.col("id") % 100 == 0, F.lit(b"SIMPLE  = T")).otherwise(F.lit(head("BITPIX  = 8", "NAXIS   = 0"))).alias("content"))
    root = tmp_path / "all"
    assert fits.save_archives(rows, str(root), 400) == 3000 and fits.save_archives(rows.limit(0), str(root)) == 0
    on_disk = [p for p in root.rglob("*") if p.is_file()]
    assert len(on_disk) == 9 and sum(p.stat().st_size for p in on_disk) < 3000 * 100
    base = lambda table, where="true": sorted(r["name"] for r in read(spark, str(root), table).where(where).select("name").collect())
    assert base("headers") == sorted(f"f{k}.fits" for k in range(3000) if k % 100) and base("refused") == sorted(f"f{k}.fits" for k in range(0, 3000, 100))
    one = read(spark, str(root), "headers").where("name = 'f1234.fits'").first()["path"]
    assert one.split(".tar.gz/")[1] == "f1234.fits" and base("headers", f"path = '{one}'") == ["f1234.fits"]
    image = spark.createDataFrame([("a.fits", head(*axes(2, 3, bits=8)) + padded(bytes(range(6)))), ("b.txt", b"no image")], "path string, content binary").coalesce(1)
    fits.save_archives(image, str(tmp_path / "images"))
    assert sorted(r["row"] for r in read(spark, str(tmp_path / "images"), "pixels").collect()) == [[0.0, 1.0], [2.0, 3.0], [4.0, 5.0]]
    whole = max(on_disk, key=lambda p: p.stat().st_size).read_bytes()
    (tmp_path / "cut").mkdir()
    (tmp_path / "cut" / "x.tar.gz").write_bytes(whole[: len(whole) // 2])
    (tmp_path / "cut" / "y.tar").write_bytes(b"something else" * 100)
    refused = [r["path"].rsplit("/", 1)[-1] for r in read(spark, str(tmp_path / "cut"), "refused").collect()]
    assert {"x.tar.gz", "y.tar"} <= set(refused) and 0 < read(spark, str(tmp_path / "cut"), "headers").count() < 400
