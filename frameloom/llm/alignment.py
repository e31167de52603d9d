"""Alignment of two tokenizers' tokens over the same bytes, by interval coalescing, and corpus-wide counts of linked pairs.

1. A text with a blank before it is encoded by a byte-level BPE file (A) and, without that blank, by a sentencepiece model that adds one
   (B). Every token is a range of bytes. All tokens of A and B are lexsorted by start; where a start reaches the running maximum of the ends
   (`maximum.accumulate`), both tokenizers end a token, and a new group begins. Overlaps expand within the groups: a token of A links with
   every token of B that begins before its end and ends after its start.
2. A document's links are kept as distinct id pairs with how often each occurs. A pair's count is the number of documents that hold it,
   from one grouped aggregation; an id's best count is the highest one of its pairs.
3. Every document meets the counts of its pairs again. Pairs with 2^-18 of all entries or more are at most 2^18, whatever the
   corpus, and are broadcast; the entries of the others are joined by a shuffle, in which no pair has more than 2^-18 of all.

Words are encoded once per Python worker and looked up by hash: A's pre-tokens, and for B each run of blanks with what follows it, as
no piece of the model has a blank after another character (a model that has one is refused).

Defined cases: null and empty texts, and texts whose joined bytes of either tokenizer differ from blank + text (those with U+2581), have no
tokens: zeros and an empty groups_sha256. Null or repeated ids and repeated rows are documents of their own; an empty table gives an empty
result; other columns are ignored. The longest text sets the memory of a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import byte_characters
from .common import keep, text_chunks
from .pretok import Codebook, code_points, cut
from .textkit import range_hash

#: At most so many pairs are broadcast: those with 1 / HOT of all entries or more.
HOT = 1 << 18
BLANK = "▁"


class Tokenizers:
    """Both encoders: runs of texts to ids, and how many bytes each id has."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        byte_of = set(byte_characters())
        self.a_bytes = np.array([len(s) if set(s) <= byte_of else len(s.encode()) for s in map(self.a.id_to_token, range(self.a.get_vocab_size()))])
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any(BLANK in p.lstrip(BLANK) for p in pieces):
            raise ValueError("a piece has a blank after another character, so that words can't be encoded one by one")
        self.b_text = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(BLANK, " ").encode() for i, p in enumerate(pieces)]
        self.none = len(pieces)  # stands for a word that its pieces don't give back
        self.b_bytes = np.array([*map(len, self.b_text), 0])
        self.lone = self.b.piece_to_id(BLANK)
        self.a_book = Codebook(lambda words: [e.ids for e in self.a.encode_batch(words, add_special_tokens=False)])
        self.b_book = Codebook(self.b_words)

    def b_words(self, words: list[str]) -> list[list[int]]:
        out = []
        for w, ids in zip(words, self.b.encode([w[1:] for w in words], num_threads=1), strict=True):
            ids = ids or [self.lone]
            out.append(ids if b"".join(self.b_text[i] for i in ids) == w.encode() else [self.none])
        return out

    def a_ids(self, points: np.ndarray, poff: np.ndarray, body: bytes, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of A, and how many each text has."""
        at, end, text, h, plain = cut(points, poff, spaces=True)
        place, _ = self.a_book.look_up(points, at, end, h)
        ids, size = self.a_book.expand(place)
        n = np.bincount(text, size, len(off) - 1).astype(np.int64)
        if not plain.all():
            ends, parts = np.concatenate([[0], np.cumsum(n)]), []
            rest = np.flatnonzero(~plain)
            coded = dict(zip(rest.tolist(), self.a.encode_batch([body[off[k] : off[k + 1]].decode() for k in rest], add_special_tokens=False), strict=True))
            for k in range(len(n)):
                parts.append(np.array(coded[k].ids, np.uint32) if k in coded else ids[ends[k] : ends[k + 1]])
                n[k] = len(parts[-1])
            ids = np.concatenate(parts)
        return ids.astype(np.int64), n

    def b_ids(self, points: np.ndarray, poff: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of B, and how many each text has. Every text begins with a blank."""
        blank = points == 0x20
        start = blank.copy()
        start[1:] &= ~blank[:-1]
        start[poff[:-1]] = True
        at = np.flatnonzero(start)
        end = np.append(at[1:], len(points))
        place, _ = self.b_book.look_up(points, at, end, range_hash(points, at, end))
        ids, size = self.b_book.expand(place)
        text = np.searchsorted(poff, at, "right") - 1
        return ids.astype(np.int64), np.bincount(text, size, len(poff) - 1).astype(np.int64)


_loaded: dict[tuple[str, str], Tokenizers] = {}


def loaded(a_path: str, b_path: str) -> Tokenizers:
    if (a_path, b_path) not in _loaded:
        _loaded[a_path, b_path] = Tokenizers(a_path, b_path)
    return _loaded[a_path, b_path]


def coalesce(starts: np.ndarray, ends: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """The group of each range: groups begin where a start, in rising order, reaches the running maximum of the ends."""
    order = np.lexsort((kind, starts))
    reach = np.maximum.accumulate(ends[order])
    new = np.ones(len(order), bool)
    new[1:] = starts[order][1:] >= reach[:-1]
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new) - 1
    return out


def overlaps(a_end: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The index pairs of overlapping tokens of two partitions of the same bytes, given their ends."""
    a_start, b_start = (np.concatenate([[0], e[:-1]]) if len(e) else e for e in (a_end, b_end))
    low = np.searchsorted(b_end, a_start, "right")
    size = np.searchsorted(b_start, a_end, "left") - low
    stop = np.cumsum(size)
    return np.repeat(np.arange(len(a_end)), size), np.repeat(low - stop + size, size) + np.arange(stop[-1] if len(stop) else 0)


def joined_text(ids: np.ndarray, separator: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The ids in decimal, each with its separator after it, and where each one begins."""
    digits = np.ones(len(ids), np.int64)
    for k in range(1, len(str(int(ids.max()))) if len(ids) else 1):
        digits += ids >= 10**k
    stop = np.cumsum(digits + 1)
    out = np.empty(int(stop[-1]) if len(stop) else 0, np.uint8)
    out[stop - 1] = separator
    rest, at = ids.copy(), stop - 2
    left = digits.copy()
    while len(rest):
        out[at] = 48 + rest % 10
        more = left > 1
        rest, at, left = rest[more] // 10, at[more] - 1, left[more] - 1
    return out.tobytes(), stop - digits - 1


def aligned(raw: np.ndarray, off: np.ndarray, both: Tokenizers) -> dict[str, np.ndarray | list]:
    """The columns of a run of texts, each with a blank before it: counts, digest and distinct links of every text."""
    n = len(off) - 1
    points, poff = code_points(raw, off)
    a, n_a = both.a_ids(points, poff, raw.tobytes(), off)
    b, n_b = both.b_ids(points, poff)
    a_doc, b_doc = np.repeat(np.arange(n), n_a), np.repeat(np.arange(n), n_b)
    size = np.diff(off)
    whole = (size > 1) & (np.bincount(a_doc, both.a_bytes[a], n) == size) & (np.bincount(b_doc, both.b_bytes[b], n) == size)
    whole &= np.bincount(b_doc, b == both.none, n) == 0
    a, a_doc, b, b_doc = a[whole[a_doc]], a_doc[whole[a_doc]], b[whole[b_doc]], b_doc[whole[b_doc]]
    n_a, n_b = n_a * whole, n_b * whole
    a_end, b_end = np.cumsum(both.a_bytes[a]), np.cumsum(both.b_bytes[b])
    kind = np.repeat([0, 1], [len(a), len(b)])
    ends = np.concatenate([a_end, b_end])
    group = coalesce(ends - np.concatenate([both.a_bytes[a], both.b_bytes[b]]), ends, kind)
    a_group, b_group = group[: len(a)], group[len(a) :]
    total = int(group.max()) + 1 if len(group) else 0
    a_size, b_size = np.bincount(a_group, minlength=total), np.bincount(b_group, minlength=total)
    a_first, b_first = np.cumsum(a_size) - a_size, np.cumsum(b_size) - b_size
    n_groups = np.bincount(a_doc[a_first], minlength=n) if total else np.zeros(n, np.int64)
    # ids in order: the group's A ids, then its B ids
    ids, mark = np.empty(len(group), np.int64), np.full(len(group), ord(","), np.uint8)
    ids[np.arange(len(a)) + b_first[a_group]] = a
    ids[np.arange(len(b)) + a_first[b_group] + a_size[b_group]] = b
    mark[a_first + b_first + a_size - 1] = ord("|")
    mark[a_first + a_size + b_first + b_size - 1] = ord(";")
    text, begin = joined_text(ids, mark)
    bound = np.append(begin, len(text))[np.concatenate([[0], np.cumsum(n_a + n_b)])].tolist()
    digests = [hashlib.sha256(text[i : j - 1]).hexdigest() if j > i else "" for i, j in zip(bound[:-1], bound[1:], strict=True)]
    i, j = overlaps(a_end, b_end)
    pair = a[i] * len(both.b_text) + b[j]
    doc = a_doc[i]
    span = len(both.a_bytes) * len(both.b_text)
    keys, times = np.unique(doc * span + pair, return_counts=True)
    per_doc = np.bincount(keys // span, minlength=n)
    return {"n_a": n_a, "n_b": n_b, "n_groups": n_groups, "n_links": np.bincount(doc, minlength=n), "groups_sha256": digests, "at": np.concatenate([[0], np.cumsum(per_doc)]), "pairs": keys % span, "times": times}


COUNTS = ("n_a", "n_b", "n_groups", "n_links")


def links(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """id, n_a, n_b, n_groups, n_links, groups_sha256, pairs (a * B's vocabulary size + b) and times of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = loaded(a_path, b_path)
        for batch in batches:
            text = batch.column("text").cast(pa.large_string()).fill_null("")
            led = pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), text, pa.scalar("", pa.large_string()))
            for i, j, raw, off in text_chunks(led):
                got = aligned(raw, off, both)
                at = pa.array(got["at"].astype(np.int32))
                lists = [pa.ListArray.from_arrays(at, pa.array(got[c].astype(t))) for c, t in (("pairs", np.int64), ("times", np.int32))]
                cols = [batch.column("id").slice(i, j - i), *(pa.array(got[c].astype(np.int64)) for c in COUNTS), pa.array(got["groups_sha256"], pa.string()), *lists]
                yield pa.RecordBatch.from_arrays(cols, names=["id", *COUNTS, "groups_sha256", "pairs", "times"])

    return docs.select("id", "text").mapInArrow(run, "id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<int>")


def pair_counts(entries: DataFrame, vocabulary: int) -> DataFrame:
    """pair, count (documents that hold it), best (whether no pair of its A id has more)."""
    counted = keep(entries.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("count")), "pair-counts")
    a = F.floor(F.col("pair") / vocabulary)
    most = counted.groupBy(a.alias("of")).agg(F.max("count").alias("most"))
    return keep(counted.join(most, a == F.col("of")).select("pair", "count", (F.col("count") == F.col("most")).alias("best")), "pairs")


def scored(rows: DataFrame, hot: tuple[np.ndarray, np.ndarray, np.ndarray]) -> DataFrame:
    """row, its sums over hot pairs, and the pairs and times that are left."""
    known = rows.sparkSession.sparkContext.broadcast(hot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, best = known.value
        for whole in batches:
            ends = whole.column("pairs").offsets.to_numpy()
            lo = 0
            while lo < whole.num_rows:  # rows of about a million pairs at a time
                hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + (1 << 20), "right")) - 1)
                batch, lo = whole.slice(lo, hi - lo), hi
                lists = batch.column("pairs")
                pairs, times = lists.flatten().to_numpy(), batch.column("times").flatten().to_numpy().astype(np.int64)
                doc = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
                place = np.minimum(np.searchsorted(keys, pairs), max(len(keys) - 1, 0))
                hit = keys[place] == pairs if len(keys) else np.zeros(len(pairs), bool)
                take, place, there = times[hit], place[hit], doc[hit]
                sums = np.zeros((2, len(lists)), np.int64)
                np.add.at(sums[0], there, take * best[place])
                np.add.at(sums[1], there, take * counts[place])
                at = pa.array(np.concatenate([[0], np.cumsum(np.bincount(doc[~hit], minlength=len(lists)))]).astype(np.int32))
                rest = [pa.ListArray.from_arrays(at, pa.array(x[~hit])) for x in (pairs, times)]
                yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(sums[0]), pa.array(sums[1]), *rest], names=["row", "hot_best", "hot_sum", "pairs", "times"])

    return rows.select("row", "pairs", "times").mapInArrow(run, "row long, hot_best long, hot_sum long, pairs array<long>, times array<long>")


def align(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", a_path: str | None = None, b_path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """One row per document (id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256), and the corpus' id pairs
    (a_id, b_id, count, best)."""
    a_path, b_path = a_path or public_tokenizers.path("byte_bpe_50k.json"), b_path or public_tokenizers.path("piece_bpe_32k.model")
    vocabulary = len(loaded(a_path, b_path).b_text)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = keep(links(texts, a_path, b_path).withColumn("row", F.monotonically_increasing_id()), "links")
    pairs = pair_counts(rows, vocabulary)
    total = pairs.agg(F.sum("count").alias("n")).first()["n"] or 0
    hot = pairs.where(F.col("count") * HOT >= total).orderBy("pair").toArrow()  # at most HOT rows
    known = tuple(hot.column(c).to_numpy() for c in ("pair", "count", "best"))
    met = keep(scored(rows, known), "scored")
    cold = met.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("row", F.col("x.pairs").alias("pair"), F.col("x.times").alias("times"))
    found = cold.join(pairs.where(F.col("count") * HOT < total), "pair")
    sums = found.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("cold_best"), F.sum(F.col("times") * F.col("count")).alias("cold_sum"))
    out = rows.drop("pairs", "times").join(met.select("row", "hot_best", "hot_sum"), "row").join(sums, "row", "left")
    add = lambda c: (F.col(f"hot_{c}") + F.coalesce(f"cold_{c}", F.lit(0))).cast("long")
    per_document = out.select(F.col("id").alias(id_col), *COUNTS, add("best").alias("n_best"), add("sum").alias("count_sum"), "groups_sha256")
    a = F.floor(F.col("pair") / vocabulary)
    return per_document, pairs.select(a.cast("int").alias("a_id"), (F.col("pair") - a * vocabulary).cast("int").alias("b_id"), "count", "best")


def query(spark, sf_dir: str) -> DataFrame:
    return align(spark.read.parquet(f"{sf_dir}/documents.parquet"))[0]
