"""Best-fit packing: tokenise, cut, and pack pieces into sequences of a fixed length, by patterns.

The histogram of piece lengths (at most `size` rows) is all that the plan needs. Patterns of a few lengths that fill a
sequence are enumerated, their repeat counts fitted to the histogram by non-negative least squares (accelerated
projected gradient), rounded down, and what remains is packed best-fit by decreasing length, many equal pieces at a
time. The plan is a list of intervals: "pieces number i to j of length l go to place p of sequences from s on". Pieces
of a length are numbered by groups of a hash, so that a length that a third of all pieces have is still many tasks.

Defined cases: a null or empty text is the end id alone, a piece of one token; null or repeated ids and repeated rows
are packed row by row; an empty table gives an empty result; other columns are ignored. The longest text sets the
memory of a task.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import keep, text_chunks
from .pretok import Codebook, code_points, cut

SPECIAL = b"<|"
_books: dict[str, tuple] = {}


def _book(path: str) -> tuple:
    """The tokenizer of a file and its codebook, once for each Python worker."""
    if path not in _books:
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(path)
        tok.no_truncation()
        tok.no_padding()
        _books[path] = tok, Codebook(lambda words: [e.ids for e in tok.encode_batch(words, add_special_tokens=False)])
    return _books[path]


def token_runs(column: pa.Array, path: str) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of texts: first row, last row + 1, all ids, and how many each text has.

    Known pre-tokens are looked up; new ones, and texts with rare characters or special tokens, go to the tokenizer.
    """
    tok, book = _book(path)
    for i, j, raw, off in text_chunks(column):
        points, poff = code_points(raw, off)
        at, end, text, h, plain = cut(points, poff, spaces=True)
        body = raw.tobytes()
        if SPECIAL in body:
            for k in range(j - i):
                plain[k] &= SPECIAL not in body[off[k] : off[k + 1]]
            ok = plain[text]
            at, end, text, h = at[ok], end[ok], text[ok], h[ok]
        place, _ = book.look_up(points, at, end, h)
        ids, size = book.expand(place)
        n = np.bincount(text, size, j - i).astype(np.int64)
        if not plain.all():
            rest = np.flatnonzero(~plain)
            coded = tok.encode_batch([body[off[k] : off[k + 1]].decode() for k in rest], add_special_tokens=False)
            parts, ends = [], np.concatenate([[0], np.cumsum(n)])
            of = dict(zip(rest.tolist(), coded, strict=True))
            for k in range(j - i):
                if k in of:
                    parts.append(np.array(of[k].ids, np.uint32))
                    n[k] = len(of[k].ids)
                else:
                    parts.append(ids[ends[k] : ends[k + 1]])
            ids = np.concatenate(parts)
        yield i, j, ids, n


def pieces(docs: DataFrame, path: str, end_id: int, size: int, with_ids: bool = False) -> DataFrame:
    """id, piece, start, length, ids_crc32 (and ids) of the pieces of every whole text."""
    names = ["id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, ids, n in token_runs(batch.column("text"), path):
                ends = np.cumsum(n)
                full = np.insert(ids, ends, end_id).astype("<u4")
                total = n + 1
                begin = np.concatenate([[0], np.cumsum(total)[:-1]])
                count = (total + size - 1) // size
                row = np.repeat(np.arange(j - i), count)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                head = total - (count - 1) * size  # the first piece has what whole pieces leave
                start = np.where(piece == 0, 0, head[row] + (piece - 1) * size)
                length = np.where(piece == 0, head[row], size)
                lo = begin[row] + start
                body = full.tobytes()
                cuts = [body[4 * a : 4 * (a + b)] for a, b in zip(lo.tolist(), length.tolist(), strict=True)]
                crc = [zlib.crc32(c) for c in cuts]
                cols = [batch.column("id").slice(i, j - i).take(pa.array(row)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crc, pa.int64())]
                if with_ids:
                    ends_ = np.concatenate([[0], np.cumsum(length)]).astype(np.int32)
                    cols.append(pa.ListArray.from_arrays(pa.array(ends_), pa.array(full.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(cols, names=names)

    schema = "id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return docs.mapInArrow(split, schema)


def patterns(size: int, most: int = 3) -> np.ndarray:
    """All ways to fill a sequence with up to `most` lengths, falling; 0 fills up."""
    a = np.arange(1, size + 1)
    out = [np.array([[size, 0, 0]])]
    b = a[: size // 2]
    out.append(np.column_stack([size - b, b, np.zeros_like(b)]))
    if most > 2:
        x, y = np.meshgrid(a, a, indexing="ij")
        z = size - x - y
        fit = (x >= y) & (y >= z) & (z >= 1)
        out.append(np.column_stack([x[fit], y[fit], z[fit]]))
    return np.concatenate(out)


def fit_counts(pats: np.ndarray, hist: np.ndarray, rounds: int = 400) -> np.ndarray:
    """Non-negative least squares: repeat counts whose pieces come closest to the histogram, by projected gradients
    with momentum. Lengths are weighted by 1 / sqrt(count), so that rare ones are fitted too."""
    size = len(hist)
    weight = np.where(hist > 0, 1 / np.sqrt(np.maximum(hist, 1)), 1.0)
    weight[0] = 0  # the filler
    usable = (hist[pats] > 0) | (pats == 0)
    pats = np.where(usable.all(1)[:, None], pats, 0)

    def apply(x: np.ndarray) -> np.ndarray:
        return sum(np.bincount(pats[:, k], x, size) for k in range(pats.shape[1])) * weight

    def back(r: np.ndarray) -> np.ndarray:
        r = r * weight
        return sum(r[pats[:, k]] for k in range(pats.shape[1]))

    target = hist * weight
    probe = np.ones(len(pats))
    for _ in range(20):  # the largest eigenvalue, for the step
        probe = back(apply(probe))
        norm = np.linalg.norm(probe)
        probe = probe / max(norm, 1e-300)
    step = 1 / max(norm * 1.05, 1e-9)
    x = y = np.zeros(len(pats))
    t = 1.0
    for _ in range(rounds):
        new = np.maximum(0, y - step * back(apply(y) - target))
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / t2 * (new - x)
        x, t = new, t2
    x[~usable.all(1)] = 0
    return x


def rounded(pats: np.ndarray, x: np.ndarray, hist: np.ndarray) -> np.ndarray:
    """Whole repeat counts that use no length more often than it occurs: round down, then up where pieces are left."""
    n = np.floor(x + 1e-9).astype(np.int64)
    used = sum(np.bincount(pats[:, k], n, len(hist)) for k in range(pats.shape[1]))
    used[0] = 0
    over = used > hist
    if over.any():  # least squares may exceed the histogram
        ratio = np.where(used > 0, np.minimum(1, hist / np.maximum(used, 1)), 1.0)
        ratio[0] = 1
        n = np.floor(n * ratio[pats].min(1)).astype(np.int64)
        used = sum(np.bincount(pats[:, k], n, len(hist)) for k in range(pats.shape[1]))
    left = (hist - used).astype(np.int64)
    left[0] = np.iinfo(np.int64).max
    for i in np.argsort(n - x)[: 4 * len(hist)]:
        lengths, times = np.unique(pats[i][pats[i] > 0], return_counts=True)
        if x[i] > 0 and (left[lengths] >= times).all():
            n[i] += 1
            left[lengths] -= times
    return n


def best_fit(hist: np.ndarray, size: int) -> list[tuple[list[int], int]]:
    """Best-fit packing by decreasing length of what is left: (lengths, how many sequences). Equal pieces go together:
    open sequences of one kind and one free length are one entry."""
    open_: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    for length in range(len(hist) - 1, 0, -1):
        n = int(hist[length])
        free = length
        while n and free <= size:
            if not open_.get(free):
                free += 1
                continue
            kind, times = open_[free].pop()
            take = min(n, times)
            if take < times:
                open_[free].append((kind, times - take))
            open_.setdefault(free - length, []).append(((*kind, length), take))
            n -= take
            free = max(free, length)
        if n:
            per = size // length
            if n // per:
                open_.setdefault(size - per * length, []).append(((length,) * per, n // per))
            if n % per:
                open_.setdefault(size - n % per * length, []).append(((length,) * (n % per), 1))
    return [(list(kind), times) for group in open_.values() for kind, times in group]


def plan(hist: np.ndarray, size: int) -> np.ndarray:
    """Rows (length, first number, past the last, first sequence, offset), sorted, for hist[length] pieces."""
    pats = patterns(size)
    counts = rounded(pats, fit_counts(pats, hist), hist)
    chosen = [([int(v) for v in pats[i] if v], int(counts[i])) for i in np.flatnonzero(counts)]
    used = np.zeros(len(hist), np.int64)
    for lengths, times in chosen:
        np.add.at(used, lengths, times)
    chosen += best_fit(hist - used, size)
    given, sequence, rows = np.zeros(len(hist), np.int64), 0, []
    for lengths, times in chosen:
        offset = 0
        for length in lengths:
            rows.append((length, given[length], given[length] + times, sequence, offset))
            given[length] += times
            offset += length
        sequence += times
    assert (given[1:] == hist[1:]).all()
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, end_id: int = 2, size: int = 1024, with_ids: bool = False) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset (and ids)."""
    spark = docs.sparkSession
    path = tokenizer or public_tokenizers.path("byte_bpe_50k.json")
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    cut_ = keep(pieces(texts, path, end_id, size, with_ids), "pieces")
    groups = max(64, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    cut_ = cut_.withColumn("part", F.pmod(F.xxhash64("id", "piece", "ids_crc32"), F.lit(groups)))
    sizes = keep(cut_.groupBy("length", "part").agg(F.count("*").alias("n")), "sizes")
    hist = np.zeros(size + 1, np.int64)
    for row in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most `size` rows
        hist[row["length"]] = row["n"]
    steps = spark.sparkContext.broadcast(plan(hist, size))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select("length", "part", before.alias("base"))
    own = Window.partitionBy("length", "part").orderBy("id", "piece", "ids_crc32")
    numbered = cut_.withColumn("own", F.row_number().over(own) - 1).join(starts, ["length", "part"]).withColumn("number", F.col("base") + F.col("own"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = steps.value
        key = table[:, 0] * (1 << 50) + table[:, 1]
        for batch in batches:
            length, number = batch.column("length").to_numpy(), batch.column("number").to_numpy()
            row = table[np.searchsorted(key, length * (1 << 50) + number, "right") - 1] if len(length) else table[:0]
            rest = [c for c in batch.schema.names if c != "number"]
            cols = [batch.column(c) for c in rest] + [pa.array(row[:, 3] + number - row[:, 1]), pa.array(row[:, 4])]
            yield pa.RecordBatch.from_arrays(cols, names=[*rest, "sequence_id", "offset"])

    schema = "id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    out = numbered.select("id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids, "number").mapInArrow(place, f"{schema}, sequence_id long, offset long")
    return out.withColumnRenamed("id", id_col)


def query(spark, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
