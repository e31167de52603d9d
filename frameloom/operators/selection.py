"""Exact medians of groups of any size, without an array of a group's values.

A group of up to `most` values is sorted as one array. In a larger one the middle rank is narrowed down: the values between two bounds are
counted in bins of equal width, the bin that holds the rank gives the next bounds, until it holds at most `most` values, or equal
ones only, or the two middle ranks fall into different bins. Counts are partly made where the rows are, so that a group with a third of all rows
is many tasks; a round keeps a row for each group.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BINS = 1024


def _same(keys: list[str], prefix: str = "_k_") -> Column:
    return reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(prefix + k)) for k in keys), F.lit(True))


def _named(df: DataFrame, keys: list[str], prefix: str = "_k_") -> DataFrame:
    return df.withColumnsRenamed({k: prefix + k for k in keys})


def clean(df: DataFrame, keys: list[str], col: str) -> DataFrame:
    """keys and v: the values that are numbers."""
    return df.where(F.col(col).isNotNull() & ~F.isnan(F.col(col).cast("double"))).select(*keys, (F.col(col).cast("double") + 0.0).alias("v"))


def sorted_middle(rows: DataFrame, keys: list[str], low: str, high: str) -> DataFrame:
    """keys, median: of the sorted values at places low and high."""
    arrays = rows.groupBy(*keys, low, high).agg(F.sort_array(F.collect_list("v")).alias("vs"))
    return arrays.select(*keys, F.expr(f"(vs[cast({low} AS int)] + vs[cast({high} AS int)]) / 2").alias("median"))


def medians(df: DataFrame, keys: list[str], col: str, most: int = 4096) -> DataFrame:
    """keys, median of every group with a value; null and NaN are none, null keys are keys. The two middle values of an even group are averaged. An
    infinite value counts as the largest finite number."""
    from .graphs import Steps

    huge = 1.7976931348623157e308
    rows = clean(df, keys, col).withColumn("v", F.greatest(F.least("v", F.lit(huge)), F.lit(-huge)))
    steps = Steps()
    sizes = rows.groupBy(*keys).agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    state = steps.write("sizes", sizes.withColumns({"low": F.expr("(n - 1) div 2"), "high": F.expr("n div 2")}))
    small = _named(state.where(f"n <= {most}").select(*keys, "low", "high"), keys)
    done = sorted_middle(rows.join(small, _same(keys)).select(*keys, "v", "low", "high"), keys, "low", "high")
    state = state.where(f"n > {most}")
    if state.isEmpty():
        return done
    while not state.isEmpty():
        flat = state.where("lo = hi").select(*keys, F.col("lo").alias("median"))
        open_ = _named(state.where("lo < hi").select(*keys, "lo", "hi", "low", "high"), keys)
        inside = rows.join(open_, _same(keys)).where("v >= lo AND v <= hi")
        # halves first, so that the width of the widest range is a number
        share = (F.col("v") / 2 - F.col("lo") / 2) / (F.col("hi") / 2 - F.col("lo") / 2)
        bins = inside.withColumn("bin", F.least(F.floor(share * BINS), F.lit(BINS - 1))).groupBy(*keys, "bin", "low", "high").agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        upto = F.sum("n").over(Window.partitionBy(*keys).orderBy("bin"))
        placed = bins.withColumn("before", upto - F.col("n"))
        holds = lambda r: (F.col(r) >= F.col("before")) & (F.col(r) < F.col("before") + F.col("n"))
        hit = placed.where(holds("low") | holds("high"))
        apart = F.count("*").over(Window.partitionBy(*keys)) == 2
        hit = steps.write(f"bins-{'a' if 'bins-b' in steps.paths else 'b'}", hit.withColumn("apart", apart))
        split = hit.where("apart").groupBy(*keys).agg(((F.max(F.when(holds("low"), F.col("hi"))) + F.max(F.when(holds("high"), F.col("lo")))) / 2).alias("median"))
        one = hit.where("NOT apart").select(*keys, "lo", "hi", "n", (F.col("low") - F.col("before")).alias("low"), (F.col("high") - F.col("before")).alias("high"))
        few = _named(one.where(f"n <= {most} AND lo < hi").select(*keys, "lo", "hi", "low", "high"), keys)
        last = sorted_middle(rows.join(few, _same(keys)).where("v >= lo AND v <= hi").select(*keys, "v", "low", "high"), keys, "low", "high")
        done = done.unionByName(flat).unionByName(split).unionByName(last)
        done = steps.write(f"done-{'a' if 'done-b' in steps.paths else 'b'}", done)
        # the bins' counts are kept as the next state; equal values end in the next round
        state = steps.write(f"state-{'a' if 'state-b' in steps.paths else 'b'}", one.where(f"n > {most} OR lo = hi"))
    return done
