"""URL filter: host and path rules, then a character language-model ratio for the rest.

Two variable-order Markov models are trained on the URLs that rules allow and block: counts of a byte after every context of
0 to 6 bytes, gathered from all of them by grouped aggregation into written tables, which grow with the input. A byte's
probability blends the orders: each context trusts its own counts by the Witten-Bell rule and leaves the rest to the next
shorter one. It is worked out once for each different window of seven bytes, and joined to the URLs that hold the window:
windows with 1/65536 of all places or more (65,536 at most, so they can be sent to all tasks) by broadcast, others by a
shuffle. URLs that are equal without their scheme, query and fragment are scored once. The verdict comes from the mean
log-likelihood difference per byte. It is calibrated on held-out rule URLs: models of one half of the rule URLs
score the other half, and the threshold is where the sum of both error rates is least; a URL must fall below it by
`margin` standard deviations of the allowed ones to be blocked. Host labels and the path take part, not the scheme.

Defined cases: null URLs, and those without "://", have an empty host and path; an empty URL, like any URL while one of
the models has no URLs, is allowed; repeated rows are judged alike; an empty table gives an empty result; a null id
stays null; other columns are ignored. URLs are told apart by 64-bit hashes (two different ones agree with a chance of 2^-64).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import keep, text_chunks

RULES = (("block", "com", "/en/"), ("allow", "example.com", "/en/7"), ("allow", "net", "/de/"), ("block", "example.net", "/de/8"), ("block", "org", "/es/"))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WIDTH = 7  # bytes of a window: one and the six before it
START, END = 255, 254  # bytes that UTF-8 never holds
SYMBOLS = 257
HOT = 1 << 16
VERDICTS = ("allow", "block")
MODELS = [f"{v}{f}" for v in VERDICTS for f in (0, 1, 2)]  # of either half of the rule URLs, and of both


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or without ://."""
    text = F.coalesce(url.cast("string"), F.lit(""))
    rest = F.when(F.instr(text, "://") > 0, F.regexp_replace(text, r"(?s)^.*?://", "")).otherwise("")
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null without one."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1], r[2])):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        name, verdict = F.when(fits, h + p).otherwise(name), F.when(fits, kind).otherwise(verdict)
    return name, verdict


def windows(texts: DataFrame) -> DataFrame:
    """Put `windows` in place of `text`: for each of its bytes and the end, that byte and the six before it as one number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, raw, off in text_chunks(batch.column("text")):
                size = np.diff(off)
                lead = np.arange(len(size)) * WIDTH + WIDTH - 1
                line = np.full(len(raw) + WIDTH * len(size), START, np.int64)
                line[np.arange(len(raw)) + np.repeat(lead, size)] = raw
                line[off[1:] + lead] = END
                # windows begin everywhere but at the last WIDTH - 1 bytes of a text's run
                at = np.arange(len(raw) + len(size)) + np.repeat(np.arange(len(size)) * (WIDTH - 1), size + 1)
                code = np.zeros(len(at), np.int64)
                for k in range(WIDTH):
                    code = (code << 8) | line[at + k]
                lists = pa.LargeListArray.from_arrays(pa.array(off + np.arange(len(off))), pa.array(code)).cast(pa.list_(pa.int64()))
                part = batch.slice(i, j - i).drop_columns("text")
                yield pa.RecordBatch.from_arrays([*part.columns, lists], names=[*part.schema.names, "windows"])

    fields = [f for f in texts.schema.fields if f.name != "text"]
    return texts.select(*(f.name for f in fields), "text").mapInArrow(run, T.StructType([*fields, T.StructField("windows", T.ArrayType(T.LongType()))]))


def count_windows(texts: DataFrame) -> DataFrame:
    """gram, uses (URLs' places that hold it), and its count in each model's training rows."""
    each = texts.select("verdict", "fold", "n", F.explode("windows").alias("gram"))
    count = lambda v, f: F.sum(F.when((F.col("verdict") == v) & (F.col("fold") == f), F.col("n")).otherwise(0)).alias(f"{v}{f}")
    return each.groupBy("gram").agg(F.count("*").alias("uses"), *(count(v, f) for v in VERDICTS for f in (0, 1)))


def blended(counts: DataFrame) -> DataFrame:
    """gram, uses, and the logarithm of the probability of its last byte after the others by each of MODELS."""
    names = [f"{v}{f}" for v in VERDICTS for f in (0, 1)]
    levels = {WIDTH: counts}
    for k in range(WIDTH - 1, 0, -1):
        short = F.col("gram").bitwiseAND(F.lit((1 << 8 * k) - 1)).alias("gram")
        levels[k] = keep(levels[k + 1].groupBy(short).agg(*(F.sum(c).alias(c) for c in names)), f"windows{k}")
    shorter = None
    for k in range(1, WIDTH + 1):
        rows = levels[k]
        for v in VERDICTS:
            rows = rows.withColumn(f"{v}2", F.col(f"{v}0") + F.col(f"{v}1"))
        # a context has 258 followers at most
        context = Window.partitionBy(F.shiftright("gram", 8))
        rows = rows.withColumns({f"{m}_all": F.sum(m).over(context) for m in MODELS} | {f"{m}_kinds": F.count_if(F.col(m) > 0).over(context) for m in MODELS})
        if shorter is None:
            rows = rows.withColumns({f"{m}_less": F.lit(1 / SYMBOLS) for m in MODELS})
        else:
            less = shorter.select(F.col("gram").alias("less"), *(F.col(f"{m}_p").alias(f"{m}_less") for m in MODELS))
            rows = rows.join(less, F.col("gram").bitwiseAND(F.lit((1 << 8 * (k - 1)) - 1)) == F.col("less"))
        # trust in a context's own counts is all / (all + kinds)
        p = lambda m: (F.col(m) + F.col(f"{m}_kinds") * F.col(f"{m}_less")) / (F.col(f"{m}_all") + F.col(f"{m}_kinds"))
        p_or_less = lambda m: F.when(F.col(f"{m}_all") > 0, p(m)).otherwise(F.col(f"{m}_less"))
        uses = ["uses"] if k == WIDTH else []
        shorter = keep(rows.select("gram", *uses, *(p_or_less(m).alias(f"{m}_p") for m in MODELS)), f"model{k}")
    return shorter.select("gram", "uses", *(F.log(f"{m}_p").alias(m) for m in MODELS))


def hot_join(rows: DataFrame, table: DataFrame, key: str, uses: str) -> DataFrame:
    """rows joined with table on key, each key once in table; keys with 1/65536 of all uses or more by broadcast."""
    total = table.agg(F.sum(uses)).first()[0] or 0
    often = F.col(uses) * HOT >= total
    few, many = F.broadcast(table.where(often)), table.where(~often)
    cold = rows.join(few.select(key), key, "left_anti").join(many, key)
    return rows.join(few, key).unionByName(cold)


def scored(texts: DataFrame, model: DataFrame) -> DataFrame:
    """key, verdict, n, score of each URL: by the other half's models if a rule decides on it, else by those of all."""
    ratio = [F.round(F.col(f"{VERDICTS[0]}{f}") - F.col(f"{VERDICTS[1]}{f}"), 12) for f in (1, 0, 2)]
    model = keep(model.select("gram", "uses", F.array(*ratio).alias("ratio")), "ratios")
    each = texts.select("key", F.when(F.col("verdict").isNull(), 2).otherwise(F.col("fold")).alias("by"), F.explode("windows").alias("gram"))
    each = hot_join(each, model, "gram", "uses").select("key", F.get("ratio", F.col("by")).cast("decimal(30,12)").alias("ratio"))
    # sums of decimals don't depend on their order
    score = each.groupBy("key").agg((F.sum("ratio").cast("double") / F.count("*")).alias("score"))
    return keep(texts.select("key", "verdict", "n").join(score, "key"), "scores")


def threshold(labelled: DataFrame, margin: float) -> float:
    """Where the sum of both error rates is least, from the counts of rule URLs in score bins of 1/100."""
    bins = labelled.groupBy("verdict", F.floor(F.col("score") * 100).cast("int").alias("bin")).agg(F.sum("n").alias("n")).collect()
    lo = min(r["bin"] for r in bins)
    size = max(r["bin"] for r in bins) - lo + 2
    hist = {v: np.zeros(size) for v in VERDICTS}
    for r in bins:
        hist[r["verdict"]][r["bin"] - lo] += r["n"]
    rate = {v: np.concatenate([[0], np.cumsum(h)]) / max(h.sum(), 1) for v, h in hist.items()}
    error = rate["allow"] + 1 - rate["block"]
    best = np.flatnonzero(error <= error.min() + 1e-12)
    centre = (lo + np.arange(size) + 0.5) / 100
    mean = (hist["allow"] * centre).sum() / max(hist["allow"].sum(), 1)
    spread = np.sqrt((hist["allow"] * (centre - mean) ** 2).sum() / max(hist["allow"].sum(), 1))
    return float((lo + best[len(best) // 2]) / 100 - margin * spread)


def url_filter(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES, margin: float = 0.0) -> DataFrame:
    """One row per row of pages: id, host, path, rule, verdict, score (null where a rule decides)."""
    host, path = host_path(F.col(url_col))
    rows = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": name, "by_rule": verdict, "key": F.xxhash64(F.concat("host", "path"))})
    texts = rows.groupBy("key").agg(F.first("by_rule").alias("verdict"), F.first(F.concat("host", "path")).alias("text"), F.count("*").alias("n"))
    texts = keep(windows(texts.withColumn("fold", F.pmod("key", F.lit(2)).cast("int"))), "urls")
    sums = {r["verdict"]: r["count"] for r in texts.where("verdict IS NOT NULL").groupBy("verdict").count().collect()}
    if len(sums) < 2:
        judged = rows.withColumn("score", F.lit(None).cast("double")).withColumn("own", F.lit("allow"))
    else:
        scores = scored(texts, blended(keep(count_windows(texts), "windows")))
        least = threshold(scores.where("verdict IS NOT NULL"), margin)
        judged = hot_join(rows, scores.select("key", "n", "score"), "key", "n")
        judged = judged.withColumn("own", F.when((F.col("score") < F.lit(least)) & (F.length(F.concat("host", "path")) > 0), "block").otherwise("allow"))
    score = F.when(F.col("rule").isNull(), F.col("score")).alias("score")
    return judged.select(F.col("id").alias(id_col), "host", "path", "rule", F.coalesce("by_rule", "own").alias("verdict"), score)


def query(spark, sf_dir: str) -> DataFrame:
    out = url_filter(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    rule = F.expr("CASE WHEN rule IS NOT NULL THEN rule END")
    return out.select("page_id", "host", "path", rule.alias("rule"), "verdict", F.round("score", 4).alias("score"))
