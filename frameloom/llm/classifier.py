"""Quality classifier by hierarchical empirical Bayes: text evidence with host and path posteriors.

Evidence: naive Bayes over binned text statistics, fitted on all labelled documents; the model is at most `BINS` counts
for each statistic. Sites: every document's own probability is summed per host and per path. Between-host and
between-path variances, estimated by moments, give the strength of the priors: a host is shrunk toward the global mean,
a path toward its host, the more the fewer documents it has. A document's posterior combines its evidence with its
path's mean, its own share left out.

Defined cases: null or empty texts have zero statistics and are judged by these; null hosts and paths are sites of
their own; several labels of an id count as their mean, rounded; labels without a document are ignored; without
labels of both kinds every document is kept; columns with the names of added ones are replaced, all others pass; repeated rows are judged row by row; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import keep, text_chunks
from .textkit import Words

COUNTS = ("c_words", "c_chars", "c_symbols", "c_upper", "c_repeat", "c_lines", "c_exclaim")
BINS = 24
_SYMBOL, _EXCLAIM = np.zeros(256, bool), np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_EXCLAIM[list(b"!?")] = True


def measured(rows: DataFrame, with_text: bool) -> DataFrame:
    """rows (without its column text, if not wanted) and the counts of every whole text."""
    rest = rows if with_text else rows.drop("text")
    names = rest.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = batch.select(names)
            for i, j, raw, off in text_chunks(batch.column("text")):
                w = Words(raw, off)
                first = (raw & 0xC0) != 0x80
                got = [w.count(), w.per_text(first & ~w.space), w.per_text(_SYMBOL[raw]), w.per_text((raw >= 65) & (raw <= 90)), w.repeated_words(8), w.repeated_lines(), w.per_text(_EXCLAIM[raw])]
                yield pa.RecordBatch.from_arrays([*kept.slice(i, j - i).columns, *(pa.array(g, pa.int64()) for g in got)], names=[*names, *COUNTS])

    fields = [*rest.schema.fields, *(T.StructField(c, T.LongType()) for c in COUNTS)]
    return rows.mapInArrow(run, T.StructType(fields))


def bins() -> dict[str, Column]:
    """The binned statistics: square roots of shares in 1/20, logarithms and means in 1/2."""
    words, chars = F.greatest("c_words", F.lit(1)), F.greatest("c_chars", F.lit(1))
    share = lambda c, of: F.least(F.floor(20 * F.sqrt(F.col(c) / of)), F.lit(BINS - 1)).cast("int")
    return {
        "b_symbols": share("c_symbols", chars),
        "b_upper": share("c_upper", chars),
        "b_repeat": share("c_repeat", words),
        "b_lines": share("c_lines", words),
        "b_exclaim": share("c_exclaim", chars),
        "b_length": F.least(F.floor(2 * F.col("c_chars") / words), F.lit(BINS - 1)).cast("int"),
        "b_words": F.least(F.floor(2 * F.log1p(F.col("c_words").cast("double"))), F.lit(BINS - 1)).cast("int"),
    }


def evidence_model(rows: DataFrame, labels: DataFrame) -> dict[tuple[str, int], float]:
    """Log-likelihood ratio of good against bad for each bin of each statistic. rows: id and bins."""
    marks = labels.where(F.col("quality").isNotNull()).groupBy(F.col("doc_id").alias("id")).agg((F.avg("quality") >= 0.5).cast("int").alias("good"))
    names = list(bins())
    long = rows.join(marks, "id").select("good", F.explode(F.array(*(F.struct(F.lit(n).alias("name"), F.col(n).alias("bin")) for n in names))).alias("x"))
    counts = long.groupBy("good", "x.name", "x.bin").count().collect()  # at most 2 * 7 * BINS rows
    total = {g: sum(r["count"] for r in counts if r["good"] == g) / len(names) for g in (0, 1)}
    if not total[0] or not total[1]:
        return {}
    of = {(r["good"], r["name"], r["bin"]): r["count"] for r in counts}
    chance = lambda g, n, b: (of.get((g, n, b), 0) + 0.5) / (total[g] + 0.5 * BINS)
    return {(n, b): math.log(chance(1, n, b) / chance(0, n, b)) for n in names for b in range(BINS)}


def evidence(model: dict[tuple[str, int], float]) -> Column:
    if not model:
        return F.lit(0.0)
    out = F.lit(0.0)
    for name, column in bins().items():
        table = F.array(*(F.lit(model[name, b]) for b in range(BINS)))
        out = out + F.element_at(table, column + 1)
    return out


def sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-F.greatest(F.least(x, F.lit(30.0)), F.lit(-30.0))))


def logit(p: Column) -> Column:
    q = F.greatest(F.least(p, F.lit(1 - 1e-6)), F.lit(1e-6))
    return F.log(q / (1 - q))


def strength(groups: DataFrame, mean: Column) -> float:
    """How many documents the prior is worth, by moments: groups has n and s (sum of probabilities)."""
    r = F.col("s") / F.col("n")
    f = groups.agg(F.count("*").alias("k"), F.sum("n").alias("n"), F.sum(F.col("n") * F.pow(r - mean, 2)).alias("m2"), F.sum(F.col("n").cast("double") * F.col("n")).alias("nn"), F.sum(F.col("n") * mean * (1 - mean)).alias("w")).first()
    if not f["n"]:
        return 1.0
    within = max(f["w"] / f["n"], 1e-9)
    spread = f["n"] - f["nn"] / f["n"]
    between = (f["m2"] - (f["k"] - 1) * within) / spread if spread > 0 else 0.0
    return min(max(within / max(between, 1e-12), 1.0), 1e6)


def site_model(rows: DataFrame, model: dict) -> tuple[DataFrame, float]:
    """Per (host, path): site_n, site_s, site_prior (its host's shrunk mean) and the strength of the path prior."""
    own = rows.withColumn("p", sigmoid(evidence(model)))
    paths = keep(own.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("p").alias("s")), "paths")
    total = paths.agg(F.sum("s").alias("s"), F.sum("n").alias("n")).first()
    mean = F.lit((total["s"] / total["n"]) if total["n"] else 0.5)
    hosts = keep(paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("s").alias("s")), "hosts")
    k = strength(hosts, mean)
    shrunk = hosts.select(F.col("host").alias("of_host"), ((F.col("s") + k * mean) / (F.col("n") + k)).alias("site_prior"))
    named = keep(paths.join(shrunk, F.col("host").eqNullSafe(F.col("of_host"))).drop("of_host"), "sites")
    kp = strength(named, F.col("site_prior"))
    return named.select(F.col("host").alias("of_host"), F.col("path").alias("of_path"), F.col("n").alias("site_n"), F.col("s").alias("site_s"), "site_prior"), kp


def classify(docs: DataFrame, labels: DataFrame, host: Column, path: Column, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5, with_text: bool = True) -> DataFrame:
    """The rows of docs, and evidence, site (shrunk mean of the path without the row itself), posterior, accepted."""
    # the user's columns go by number, so that no name can clash
    own = {c: f"u{i}" for i, c in enumerate(docs.columns) if c != text_col}
    named = docs.select(*(F.col(f"`{c}`").alias(u) for c, u in own.items()), F.col(f"`{id_col}`").alias("id"), host.alias("host"), path.alias("path"), F.col(f"`{text_col}`").cast("string").alias("text"))
    rows = keep(measured(named, with_text), "counts").withColumns(bins())
    model = evidence_model(rows, labels)
    sites, kp = site_model(rows, model)
    out = rows.join(sites, F.col("host").eqNullSafe(F.col("of_host")) & F.col("path").eqNullSafe(F.col("of_path")), "left")
    out = out.withColumn("evidence", evidence(model)).withColumn("own_p", sigmoid(F.col("evidence")))
    out = out.withColumn("site", (F.col("site_s") - F.col("own_p") + kp * F.col("site_prior")) / (F.col("site_n") - 1 + kp))
    out = out.withColumn("posterior", sigmoid(F.col("evidence") + logit(F.col("site"))))
    out = out.withColumn("accepted", F.lit(True) if not model else F.col("posterior") >= threshold)
    added = ("evidence", "site", "posterior", "accepted")
    base = [F.col("text" if c == text_col else own[c]).alias(c) for c in docs.columns if c not in added and (c != text_col or with_text)]
    return out.select(*base, *added)


def sites_of(docs: DataFrame) -> tuple[Column, Column]:
    """Documents have no URL: the source stands for the host, and source and language for the path."""
    return F.col("source"), F.concat_ws("/", "source", "lang")


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = classify(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), *sites_of(docs), with_text=False)
    return out.select("doc_id", F.round("evidence", 4).alias("evidence"), F.round("site", 4).alias("site"), F.round("posterior", 6).alias("posterior"), F.col("accepted").alias("kept"))
