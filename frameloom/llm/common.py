"""What several operators share: written tables, Arrow text batches and connected groups."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class _Kept(threading.local):
    """The tables that this thread has written, so that runs in several threads leave each other's alone."""

    def __init__(self) -> None:
        self.paths: list[str] = []


_own = _Kept()


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or a temporary one where it is unset and all run here."""
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
    return f"file://{tempfile.gettempdir()}/frameloom-checkpoints"


def kept() -> list[str]:
    """The tables that this thread has written so far and not deleted."""
    return list(_own.paths)


def clear(spark: SparkSession, paths: list[str]) -> None:
    """Delete written tables; results that read them can't be used any more."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for name in paths:
        path = jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(conf).delete(path, True)
        if name in _own.paths:
            _own.paths.remove(name)


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def keep(df: DataFrame, name: str = "table") -> DataFrame:
    """Write df to the shared folder and read it back, which cuts its lineage and survives lost executors."""
    path = fresh_path(df.sparkSession, name)
    schema = df.schema
    _own.paths.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def text_chunks(column: pa.Array | pa.ChunkedArray, most: int = 1 << 19) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole texts of about `most` bytes: first row, last row + 1, their UTF-8 bytes, and offsets into those.

    Null is an empty text. A text is never cut, so a run may be as long as the longest text.
    """
    for part in column.chunks if isinstance(column, pa.ChunkedArray) else [column]:
        part = part.cast(pa.large_string())
        n = len(part)
        if part.null_count:
            part = part.fill_null("")
        _, ends, data = part.buffers()
        off = np.frombuffer(ends, np.int64, n + 1, part.offset * 8) if n else np.zeros(1, np.int64)
        raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
        i = 0
        while i < n:
            j = max(i + 1, int(np.searchsorted(off, off[i] + most, "right")) - 1)
            yield i, j, raw[off[i] : off[j]], off[i : j + 1] - off[i]
            i = j


def components(edges: DataFrame) -> DataFrame:
    """node, root (both long) for every end of the edges (u, v); nodes of one connected group have one root.

    Each round hooks every node on the neighbour that comes first in a random order, follows one more step, and
    contracts the edges; the order changes each round, so that long chains shrink by a constant factor.
    """
    e = keep(edges.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).where("u <> v").distinct(), "edges")
    tree = e.select(F.explode(F.array("u", "v")).alias("node")).distinct().withColumn("root", F.col("node"))
    turn = 0
    while not e.isEmpty():
        key = lambda c, t=turn: F.struct(F.xxhash64(F.col(c), F.lit(t)).alias("h"), F.col(c).alias("id"))
        both = e.union(e.select("v", "u"))
        hook = keep(both.groupBy("u").agg(F.min(key("v")).alias("m")).select("u", F.least(F.col("m"), key("u"))["id"].alias("p")), "hooks")
        up = hook.select(F.col("u").alias("p"), F.col("p").alias("q"))
        jump = keep(hook.join(up, "p").select("u", F.col("q").alias("p")).join(up, "p").select("u", "q"), "jumps")
        to = lambda c, j=jump: j.select(F.col("u").alias(c), F.col("q").alias(f"new_{c}"))
        tree = tree.join(to("root"), "root", "left").select("node", F.coalesce("new_root", "root").alias("root"))
        e = keep(e.join(to("u"), "u").join(to("v"), "v").select(F.least("new_u", "new_v").alias("u"), F.greatest("new_u", "new_v").alias("v")).where("u <> v").distinct(), "edges")
        turn += 1
    return keep(tree, "tree")


def sized(df: DataFrame, most: int = 200_000) -> DataFrame:
    """A written table, to be broadcast if it has at most `most` rows; a larger one is joined by a shuffle."""
    return F.broadcast(df) if df.count() <= most else df
