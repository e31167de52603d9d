"""Medians, stacks and clips of groups of any size, against numpy and DuckDB."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from frameloom.operators import survey as ops
from frameloom.operators.selection import medians


@pytest.mark.parametrize("most", [1, 7, 100_000])
def test_medians_of_awkward_groups(spark, most):
    rng = np.random.default_rng(1)
    groups = {
        "normal": rng.normal(size=501).tolist(), "even": rng.normal(size=400).tolist(), "equal": [3.25] * 300, "two": [1.0] * 150 + [2.0] * 150, "outlier": [*rng.normal(size=200).tolist(), 1e300, -1e300],
        "close": (1 + np.arange(300) * 2**-52).tolist(), "one": [5.0], "pair": [1.0, 4.0], "nulls": [None, float("nan"), 2.0, 8.0, 9.0], "none": [None, float("nan")], None: [7.0] * 20, "infinite": [float("inf")] * 3 + [1.0] * 10, "zeros": [-0.0] * 20 + [0.0] * 21}
    df = spark.createDataFrame([(k, v) for k, vs in groups.items() for v in vs], "g string, v double")
    got = {r["g"]: r["median"] for r in medians(df, ["g"], "v", most).collect()}
    want = {k: float(np.median(w)) for k, vs in groups.items() if (w := [v for v in vs if v is not None and v == v])}
    assert got == want
    assert medians(df.limit(0), ["g"], "v", most).count() == 0


def test_stack_of_a_million_rows(spark):
    """One pixel of a million frames, and a few small ones, equal to SQL."""
    df = spark.range(1_000_000).select(F.lit(0).alias("p"), (F.col("id") * 7919 % 1000003 / 1000.0 + F.when(F.col("id") % 50 == 0, 1e6).otherwise(0)).alias("v")).unionByName(spark.range(90).select((1 + F.col("id") % 3).cast("int").alias("p"), (F.col("id") * 17 % 29 / 1.0).alias("v")))
    rows = df.toPandas()  # noqa: F841  DuckDB reads it
    got = {r["p"]: (r["v"], r["n"], r["n_kept"]) for r in ops.stack(df, ["p"], 3.0).collect()}
    sql = "WITH m AS (SELECT p, median(v) AS m FROM rows GROUP BY p), s AS (SELECT r.p, 1.4826 * median(abs(v - m)) AS s FROM rows r JOIN m USING (p) GROUP BY r.p) SELECT r.p, median(v), count(*) FROM rows r JOIN m USING (p) JOIN s USING (p) WHERE abs(v - m) <= 3 * s GROUP BY r.p"
    con = duckdb.connect()
    con.register("rows", rows)
    for p, v, kept in con.execute(sql).fetchall():
        assert abs(got[p][0] - v) < 1e-9 and got[p][2] == kept and got[p][1] == (1_000_000 if p == 0 else 30)
    assert got[0][2] < 1_000_000


def test_both_ways_agree(spark):
    rng = np.random.default_rng(2)
    rows = [(int(g), int(g) % 2, float(v)) for g, v in zip(rng.integers(0, 4, 900), rng.standard_t(2, 900), strict=True)] + [(9, None, None), (9, None, float("nan")), (8, None, 1.5)]
    df = spark.createDataFrame(rows, "g int, h int, v double")
    got = lambda f: sorted(map(tuple, f.collect()), key=repr)
    assert got(ops.stack(df, ["g", "h"], 3.0, most=20)) == got(ops.stack(df, ["g", "h"], 3.0))
    few, many = (got(ops.sigma_clip(df.where("g < 5"), ["g"], "v", 2.0, 5, most=m)) for m in (20, None))
    assert few == many and len(few) < 900
