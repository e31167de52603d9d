"""Quality rules: fixed base rules, then robust multivariate outliers per language and source.

Every text becomes a vector of transformed statistics. For each (lang, source) a minimum-covariance-determinant
estimate is found by concentration steps: rank the rows by Mahalanobis distance, keep the closest half, (n + p + 1) / 2 of
n rows in p dimensions, and estimate centre and covariance from these, until no group's determinant falls any more. Up to
half of a group may thus be junk. A step is one grouped sum: rows are binned by the logarithm of their distance, so a task
sends a few hundred rows of sums for a group, however many of its rows it holds; the bin at the boundary counts with the
share of it that is still missing, so equal rows don't enter together. Groups with fewer than
`min_rows` rows are pooled by language, and languages with too few rows all together.

Defined cases: a null or empty text has no words and fails the base rules; null lang or source is a group like any
other; repeated rows are judged alike, each for itself; an empty table gives an empty result; columns other than
those named are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from .common import keep, text_chunks
from .textkit import Words

DIMS = ("x_words", "x_length", "x_symbols", "x_upper", "x_repeat")
#: Least standard deviation of each statistic: most clean texts have no symbol at all, which is no reason to reject one.
FLOOR = (0.5, 0.35, 0.045, 0.06, 0.12)
STATS = "doc_id long, lang string, source string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_upper long"
PAIRS = [(i, j) for i in range(len(DIMS)) for j in range(i, len(DIMS))]
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rest = batch.select(["doc_id", "lang", "source"])
        for i, j, raw, off in text_chunks(batch.column("text")):
            w = Words(raw, off)
            first = (raw & 0xC0) != 0x80
            counts = [w.count(), w.per_text(first & ~w.space), w.per_text(_SYMBOL[raw]), w.repeated_lines(), w.repeated_words(8), w.per_text((raw >= 65) & (raw <= 90))]
            names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper"]
            part = rest.slice(i, j - i)
            yield pa.RecordBatch.from_arrays([*part.columns, *(pa.array(c, pa.int64()) for c in counts)], names=["doc_id", "lang", "source", *names])


def statistics(docs: DataFrame) -> DataFrame:
    """The counts of every whole text, and base_failed."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return rows.mapInArrow(_measure, STATS).withColumn("base_failed", failed)


def vectors(stats: DataFrame) -> DataFrame:
    words, chars = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("word_chars"), F.lit(1))
    return stats.withColumns({
        "x_words": F.log1p(F.col("n_words").cast("double")),
        "x_length": F.col("word_chars") / words,
        "x_symbols": F.sqrt(F.col("n_symbols") / chars),
        "x_upper": F.sqrt(F.col("n_upper") / chars),
        "x_repeat": F.sqrt(F.col("n_repeat_words") / words),
    })


def chi2_cdf(x: float, d: int) -> float:
    """Chi-squared distribution function, by the series of the incomplete gamma function."""
    a, x = d / 2, x / 2
    term = total = 1 / a
    n = a
    while term > total * 1e-15:
        n += 1
        term *= x / n
        total += term
    return min(1.0, total * math.exp(-x + a * math.log(x) - math.lgamma(a))) if x > 0 else 0.0


def chi2_quantile(p: float, d: int) -> float:
    lo, hi = 0.0, 1000.0
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi2_cdf(mid, d) < p else (lo, mid)
    return hi


def consistency(share: float, d: int) -> float:
    """What the covariance of the closest `share` of normal rows must be multiplied by."""
    return share / chi2_cdf(chi2_quantile(share, d), d + 2)


@pandas_udf(T.StructType([T.StructField("inverse", T.ArrayType(T.DoubleType())), T.StructField("spread", T.DoubleType())]))
def _inverse(n: pd.Series, sums: pd.Series, cross: pd.Series, share: pd.Series) -> pd.DataFrame:
    """Upper triangle of the inverse covariance, and its log determinant, from sums about the group's start over the closest share."""
    out, spread = [], []
    for k, s, c, q in zip(n, sums, cross, share, strict=True):
        mean = np.asarray(s) / k
        cov = np.zeros((len(DIMS),) * 2)
        for (i, j), v in zip(PAIRS, c, strict=True):
            cov[i, j] = cov[j, i] = v / k - mean[i] * mean[j]
        cov = consistency(q, len(DIMS)) * cov + np.diag(np.square(FLOOR))
        inv = np.linalg.inv(cov)
        out.append([inv[i, j] for i, j in PAIRS])
        spread.append(np.linalg.slogdet(cov)[1])
    return pd.DataFrame({"inverse": out, "spread": spread})


def _distance(centre: str = "centre", inverse: str = "inverse") -> Column:
    gap = [F.col(x) - F.col(centre)[i] for i, x in enumerate(DIMS)]
    return sum((gap[i] * gap[j] * F.col(inverse)[k] * (1 if i == j else 2) for k, (i, j) in enumerate(PAIRS)), F.lit(0.0))


KEY = ("level", "k_lang", "k_source")


def _with(rows: DataFrame, by: DataFrame) -> DataFrame:
    """Join by group; null languages and sources are groups too."""
    other = by.withColumnsRenamed({k: f"o_{k}" for k in KEY})
    on = [F.col(k).eqNullSafe(F.col(f"o_{k}")) for k in KEY]
    return rows.join(other, on, "left").drop(*(f"o_{k}" for k in KEY))


def grouped(rows: DataFrame, min_rows: int) -> DataFrame:
    """Name the group that each row's estimate comes from."""
    pairs = keep(rows.where("not base_failed").groupBy("lang", "source").count(), "groups")
    by_lang = Window.partitionBy("k_lang")
    small = F.col("count") < min_rows
    named = pairs.select(F.col("lang").alias("k_lang"), F.col("source").alias("k_source"), "count").withColumn("rest", F.sum(F.when(small, F.col("count"))).over(by_lang))
    level = F.when(~small, 0).when(F.col("rest") >= min_rows, 1).otherwise(2)
    named = named.select(F.col("k_lang").alias("p_lang"), F.col("k_source").alias("p_source"), level.alias("level"))
    on = F.col("lang").eqNullSafe(F.col("p_lang")) & F.col("source").eqNullSafe(F.col("p_source"))
    out = rows.join(named, on, "left").drop("p_lang", "p_source").withColumn("level", F.coalesce("level", F.lit(2)))
    return out.withColumn("k_lang", F.when(F.col("level") < 2, F.col("lang"))).withColumn("k_source", F.when(F.col("level") == 0, F.col("source")))


def estimates(rows: DataFrame, core: float = 0.5, steps: int = 30) -> DataFrame:
    """centre and inverse (arrays) per group, by concentration steps (at most `steps`) and one reweighting step."""
    rows = rows.where("not base_failed")
    mid = [F.percentile_approx(x, 0.5, 1000).alias(x) for x in DIMS]
    start = rows.groupBy(*KEY).agg(*mid).select(*KEY, F.array(*DIMS).alias("origin"))
    start = keep(start, "origin")
    gaps = [F.percentile_approx(F.abs(F.col(x) - F.col("origin")[i]), 0.5, 1000) for i, x in enumerate(DIMS)]
    spread = _with(rows, start).groupBy(*KEY).agg(F.first("origin").alias("centre"), *(g.alias(f"s{i}") for i, g in enumerate(gaps)))
    diagonal = [1 / (F.pow(F.col(f"s{i}") * 1.4826, 2) + FLOOR[i] ** 2) if i == j else F.lit(0.0) for i, j in PAIRS]
    now = keep(spread.select(*KEY, F.col("centre").alias("origin"), "centre", F.array(*diagonal).alias("inverse"), F.lit(None).cast("double").alias("spread")), "spread")
    near = chi2_quantile(0.975, len(DIMS))
    names = [f"s{i}" for i in range(len(DIMS))] + [f"c{k}" for k in range(len(PAIRS))]
    step, last = 0, False
    while True:
        at = _with(rows, now.drop("spread")).withColumn("d2", _distance())
        # a sixteenth of a doubling per bin; the last step takes every row within the 97.5 % ellipsoid
        bin_ = F.when(F.col("d2") <= near, 0).otherwise(1) if last else F.floor(16 * F.log2(F.col("d2") + 1e-6)).cast("int")
        gap = [F.col(x) - F.col("origin")[i] for i, x in enumerate(DIMS)]
        sums = [F.sum(g).alias(f"s{i}") for i, g in enumerate(gap)] + [F.sum(gap[i] * gap[j]).alias(f"c{k}") for k, (i, j) in enumerate(PAIRS)]
        bins = at.groupBy(*KEY, bin_.alias("bin")).agg(F.first("origin").alias("origin"), F.count("*").alias("n"), *sums)
        whole, upto = Window.partitionBy(*KEY), Window.partitionBy(*KEY).orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
        if last:
            bins = bins.where("bin = 0").withColumns({"share": F.lit(0.975), "weight": F.lit(1.0)})
        else:
            bins = bins.withColumns({"before": F.coalesce(F.sum("n").over(upto), F.lit(0)), "all": F.sum("n").over(whole)})
            need = F.least(F.col("all"), F.greatest(F.floor((F.col("all") + len(DIMS) + 1) / 2), F.ceil(core * F.col("all"))))
            bins = bins.withColumn("need", need).where("before < need")
            bins = bins.withColumns({"share": F.least(F.col("need") / F.col("all"), F.lit(0.999)), "weight": F.least(F.lit(1.0), (F.col("need") - F.col("before")) / F.col("n"))})
        total = bins.groupBy(*KEY).agg(F.first("origin").alias("origin"), F.first("share").alias("share"), F.sum(F.col("n") * F.col("weight")).alias("n"), *(F.sum(F.col(c) * F.col("weight")).alias(c) for c in names))
        arrays = total.select(*KEY, "origin", "n", "share", F.array(*names[: len(DIMS)]).alias("sums"), F.array(*names[len(DIMS) :]).alias("cross"))
        centre = F.zip_with("origin", "sums", lambda o, s: o + s / F.col("n"))
        new = arrays.select(*KEY, "origin", centre.alias("centre"), _inverse("n", "sums", "cross", "share").alias("got"))
        new = keep(new.select(*KEY, "origin", "centre", "got.inverse", "got.spread"), "estimate")
        if last:
            return new.select(*KEY, "centre", "inverse")
        step += 1
        falls = _with(new, now.select(*KEY, F.col("spread").alias("was"))).where("was IS NULL OR spread < was - 1e-3")
        last = step >= steps or falls.isEmpty()
        now = new


def quality_rules(docs: DataFrame, min_rows: int = 200, core: float = 0.5, tail: float = 1e-7) -> DataFrame:
    """One row per document: its counts, base_failed, distance2 (squared Mahalanobis) and kept.

    tail: the share of normal rows that may be rejected; the cut-off is the chi-squared quantile at 1 - tail.
    """
    rows = grouped(vectors(keep(statistics(docs), "statistics")), min_rows)
    judged = _with(rows, estimates(rows, core)).withColumn("distance2", F.coalesce(_distance(), F.lit(0.0)))
    limit = chi2_quantile(1 - tail, len(DIMS))
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("distance2") <= limit))


def query(spark, sf_dir: str) -> DataFrame:
    out = quality_rules(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.round("distance2", 3).alias("distance2"))
