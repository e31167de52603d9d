"""Exact top-k by integer inner product, through M-trees of metric pages searched best-first.

Vectors x are lifted to (x, sqrt(M - |x|^2)) with M the largest squared length, so that a larger inner product with a
query is a smaller Euclidean distance, and the triangle inequality holds. All vectors are dealt out to groups of about
`group` rows: near the pivot (of a bounded sample) that they lie closest to, and by a hash within a pivot's cell, so
that a cell with a third of all rows, or of equal vectors, is many groups. A group's tree has pages of about `page`
vectors, each with its routing vector, covering radius, and every member's distance to the routing vector. Queries come
in blocks of about `block`; each block meets each group once. A query first searches the pages of its nearest group
alone, which gives it a score to beat; in every other group it takes pages best-first by the bound from the covering
radius, skips members whose stored distance shows by the triangle inequality that they are too far, and computes exact
integer scores for the rest. The bounds carry a slack for rounding; scores are compared as integers.

Defined cases: vectors that are null, empty, or hold null or non-finite components take no part; shorter vectors count
as filled up with zeros; components are taken as floor(scale * x) and must keep scores within 64 bits; equal scores go
by smaller id; a repeated id is one candidate per row, and rows with the query's own id are not its candidates; of
several query rows with one id the smallest vector asks; null ids take no part; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import keep

SLACK = 1e-6


def whole_vectors(df: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """id, v (array<long>) of the rows that take part."""
    x = F.transform(vector_col, lambda e: e.cast("double"))
    rows = df.select(F.col(id_col).cast("long").alias("id"), x.alias("x")).where(F.col("id").isNotNull() & F.col("x").isNotNull())
    good = F.expr("size(x) > 0 AND forall(x, e -> e IS NOT NULL AND NOT isnan(e) AND abs(e) < double('inf'))")
    return rows.where(F.coalesce(good, F.lit(False))).select("id", F.transform("x", lambda e: F.floor(e * scale).cast("long")).alias("v"))


def matrix(column: pa.ListArray, width: int) -> np.ndarray:
    """Rows of a list column, filled up with zeros to `width`."""
    ends = column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), width), np.int64)
    size = np.diff(ends)
    if len(size) and (size == width).all():
        return flat[ends[0] : ends[-1]].reshape(-1, width)
    for i, n in enumerate(size):
        out[i, :n] = flat[ends[i] : ends[i] + n]
    return out


class MTree:
    """A bulk-loaded M-tree over lifted vectors: leaf pages under routing vectors."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, lift: float, page: int):
        self.ids, self.rows, self.lift = ids, rows, lift
        points = rows.astype(float)
        extra = np.sqrt(np.maximum(lift - (points**2).sum(1), 0))
        points = np.column_stack([points, extra])
        n = max(1, len(rows) // page)
        # routing vectors: farthest-first among a spread of the rows, which keeps covering radii small
        some = points[np.linspace(0, len(points) - 1, min(len(points), 8 * n)).astype(int)]
        chosen, far = [0], ((some - some[0]) ** 2).sum(1)
        while len(chosen) < n and far.max() > 0:
            chosen.append(int(far.argmax()))
            far = np.minimum(far, ((some - some[chosen[-1]]) ** 2).sum(1))
        self.routing = some[chosen]
        gap = np.sqrt(np.maximum((points**2).sum(1)[:, None] + (self.routing**2).sum(1) - 2 * points @ self.routing.T, 0))
        own = gap.argmin(1)
        order = np.argsort(own, kind="stable")
        parts = np.split(order, np.cumsum(np.bincount(own, minlength=len(self.routing)))[:-1])
        self.pages = [p[np.argsort(gap[p, k])] for k, p in enumerate(parts)]  # members by distance to the routing vector
        self.parent = [gap[p, k] for k, p in enumerate(self.pages)]
        self.radius = np.array([d[-1] if len(d) else -1.0 for d in self.parent])
        self.computed = 0

    def search(self, qid: int, q: np.ndarray, best: list[tuple[int, int]], k: int) -> list[tuple[int, int]]:
        """Improve a heap of (score, -id) with what this tree holds."""
        point = np.append(q.astype(float), 0.0)
        norm = float(point @ point)
        gap = np.sqrt(np.maximum(((self.routing - point) ** 2).sum(1), 0))
        lower = np.maximum(gap - self.radius, 0)
        for p in np.argsort(lower, kind="stable"):
            if not len(self.pages[p]):
                continue
            # |q - x|^2 = |q|^2 + lift - 2 score: whoever beats or ties the worst of the best lies within `reach`
            reach = np.sqrt(max(norm + self.lift - 2.0 * best[0][0], 0)) * (1 + SLACK) + SLACK if len(best) == k else np.inf
            if lower[p] > reach:
                break
            lo, hi = np.searchsorted(self.parent[p], [gap[p] - reach, gap[p] + reach]) if reach < np.inf else (0, len(self.pages[p]))
            hi = min(len(self.pages[p]), hi + 1)
            at = self.pages[p][max(0, lo - 1) : hi]
            self.computed += len(at)
            scores = self.rows[at] @ q
            for i in np.lexsort((self.ids[at], -scores)):
                item = (int(scores[i]), -int(self.ids[at[i]]))
                if -item[1] == qid:
                    continue
                if len(best) < k:
                    heapq.heappush(best, item)
                elif item > best[0]:
                    heapq.heapreplace(best, item)
                else:
                    break
        return best


def top_k(df: DataFrame, queries, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 5, scale: int = 256, page: int = 64, group: int = 4096, block: int = 512, sample: int = 4096) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k best rows. queries: a condition on id_col (a Column)."""
    spark = df.sparkSession
    vectors = whole_vectors(df, id_col, vector_col, scale)
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x)
    facts = vectors.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("width"), F.max(square).alias("lift")).first()
    schema = f"query_id long, rank int, {id_col} long, score long"
    if not facts["n"]:
        return spark.createDataFrame([], schema)
    n, width, lift = facts["n"], facts["width"], facts["lift"]
    # pivots: spread over a bounded sample of the rows that a hash picks; they only decide who shares a tree
    share = min(1.0, sample / n)
    picked = vectors.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)) + 1)).limit(2 * sample).select("v").toArrow()
    some = matrix(picked.column("v").combine_chunks() if picked.num_rows else pa.array([[0]], pa.list_(pa.int64())), width).astype(float)
    cells = max(1, min(64, n // group))
    chosen, far = [0], ((some - some[0]) ** 2).sum(1)
    while len(chosen) < cells and far.max() > 0:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, ((some - some[chosen[-1]]) ** 2).sum(1))
    pivots = spark.sparkContext.broadcast(some[chosen])

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pivots.value
        for batch in batches:
            m = matrix(batch.column("v"), width).astype(float)
            cell = ((p**2).sum(1) - 2 * m @ p.T).argmin(1).astype(np.int32) if len(m) else np.zeros(0, np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell)], names=[*batch.schema.names, "cell"])

    dealt = keep(vectors.mapInArrow(assign, "id long, v array<long>, cell int"), "vectors")
    sizes = {r["cell"]: r["count"] for r in dealt.groupBy("cell").count().collect()}  # at most 64 rows
    groups, parts = {}, {}
    for cell, size in sorted(sizes.items()):
        groups[cell] = (sum(parts.values()), -(-size // group))
        parts[cell] = -(-size // group)
    total = sum(parts.values())
    table = F.create_map(*(F.lit(x) for c, (first, m) in groups.items() for x in (c, [first, m])))
    place = table[F.col("cell")]
    candidates = dealt.select(F.col("id").alias("cid"), F.col("v").alias("cv"), (place[0] + F.pmod(F.xxhash64("id"), place[1])).cast("int").alias("cg"))
    asked = dealt.withColumnRenamed("id", id_col).where(queries).groupBy(F.col(id_col).alias("id")).agg(F.min(F.struct("v", "cell")).alias("q")).select("id", "q.*")
    blocks = max(1, -(-asked.count() // block))
    home = (place[0] + F.pmod(F.xxhash64("id"), place[1])).cast("int")
    asked = asked.select("id", "v", home.alias("home"), F.pmod(F.xxhash64("id", F.lit(7)), F.lit(blocks)).cast("int").alias("b"))

    def found(ids: list[int], bests: list[list[tuple[int, int]]]) -> pa.Table:
        rows = [(q, s, -i) for q, best in zip(ids, bests, strict=True) for s, i in best]
        q, s, i = zip(*rows, strict=True) if rows else ((), (), ())
        return pa.table({"query_id": pa.array(q, pa.int64()), "score": pa.array(s, pa.int64()), "id": pa.array(i, pa.int64())})

    def meet(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        qid, qs = left.column("id").to_pylist(), matrix(left.column("v").combine_chunks(), width) if left.num_rows else None
        if not left.num_rows or not right.num_rows:
            return found([], [])
        tree = MTree(right.column("cid").to_numpy(), matrix(right.column("cv").combine_chunks(), width), lift, page)
        floor = left.column("floor").to_pylist()
        bests = []
        for i, q, low in zip(qid, qs, floor, strict=True):
            # a floor stands for k results as good as it, of the query's nearest group
            start = [(low, -(1 << 62))] * k if low is not None else []
            bests.append([b for b in tree.search(i, q, start, k) if b[1] != -(1 << 62)])
        return found(qid, bests)

    out = "query_id long, score long, id long"
    own = asked.select("id", "v", "home", "b", F.lit(None).cast("long").alias("floor"))
    copies = candidates.withColumn("cb", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    near = keep(own.groupBy("home", "b").cogroup(copies.groupBy("cg", "cb")).applyInArrow(meet, out), "near")
    floors = near.groupBy("query_id").agg(F.count("*").alias("c"), F.min("score").alias("floor")).select(F.col("query_id").alias("id"), F.when(F.col("c") >= k, F.col("floor")).alias("floor"))
    rest = asked.join(floors, "id", "left").withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(total - 1)))).where(F.col("g") != F.col("home"))
    far_ = rest.select("id", "v", "floor", "g", "b").groupBy("g", "b").cogroup(copies.groupBy("cg", "cb")).applyInArrow(meet, out)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    ranked = near.unionByName(far_).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score")


def query(spark, sf_dir: str) -> DataFrame:
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 50 == 0)


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
    CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
), ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scores)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""
