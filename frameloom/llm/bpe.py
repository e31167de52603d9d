"""Byte-pair encoding of whole texts with a public vocabulary, and decoding.

A pre-token's symbols form a doubly linked list; adjacent pairs that have a merge wait in a priority queue by rank, then
place. Popped entries whose symbols have changed since are stale and skipped. Pre-tokens are cut by numpy for many
texts at once and each different one is merged once per Python worker (a bounded book); texts with characters beyond
the ranges that are cut there are cut by the file's own normaliser and pattern, as the tokenizers library reads them, so that
letters and digits are those of its version of Unicode; their pre-tokens are merged in the same way.
Decoding concatenates the vocabulary's strings, with a blank between them, as the file names no decoder.

Defined cases: null or empty texts have no ids and decode to an empty text; null or repeated ids and repeated rows are
encoded row by row; an empty table gives an empty result; `encode` keeps id and text columns only.
"""

from __future__ import annotations

import heapq
import json
from functools import cached_property
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import text_chunks
from .pretok import LIMIT, Codebook, code_points, cut

LOWER = np.array([ord(chr(c).lower()) if len(chr(c).lower()) == 1 else LIMIT for c in range(LIMIT)] + [LIMIT], np.uint32)
LOWER = np.where(LOWER < LIMIT, LOWER, LIMIT).astype(np.int64)


#: How many pre-tokens with rare characters a worker remembers.
KNOWN = 100_000


def byte_characters() -> list[str]:
    """The character that stands for each byte: printable Latin-1 ones for themselves, the others from 256 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    out, n = [], 0
    for b in range(256):
        out.append(chr(b) if b in own else chr(256 + n))
        n += b not in own
    return out


class Vocabulary:
    def __init__(self, path: str):
        self.path, self.known = path, {}
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        model = file["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.end: str = model.get("end_of_word_suffix") or ""
        self.special = {t["content"]: t["id"] for t in file["added_tokens"]}
        self.strings = [""] * (1 + max([*self.vocab.values(), *self.special.values()]))
        for s, i in [*self.vocab.items(), *self.special.items()]:
            self.strings[i] = s
        self.merges: dict[int, tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.merges[self.vocab[a] << 20 | self.vocab[b]] = (rank, self.vocab[a + b])
        chars = byte_characters()
        self.byte_of = {c: b for b, c in enumerate(chars)}
        self.inner = [self.vocab.get(c) for c in chars]
        self.last = [self.vocab.get(c + self.end) for c in chars]
        self.split = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.book = Codebook(self.encode_words)

    @cached_property
    def cutter(self) -> tuple:
        """The file's normaliser and pre-tokenizer."""
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(self.path)
        return tok.normalizer, tok.pre_tokenizer

    def encode_words(self, words: list[str]) -> list[list[int]]:
        return [self.merge(w.encode("utf-8")) for w in words]

    def merge(self, word: bytes) -> list[int]:
        """The ids of a pre-token."""
        symbols = [self.inner[b] for b in word[:-1]] + [self.last[word[-1]]]
        symbols = [s for s in symbols if s is not None]
        n = len(symbols)
        merges = self.merges
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        queue = []
        for i in range(n - 1):
            m = merges.get(symbols[i] << 20 | symbols[i + 1])
            if m:
                queue.append((m[0], i, symbols[i], symbols[i + 1], m[1]))
        heapq.heapify(queue)
        while queue:
            _, i, a, b, new = heapq.heappop(queue)
            j = after[i]
            if symbols[i] != a or j < 0 or symbols[j] != b:
                continue  # stale
            symbols[i], symbols[j] = new, -1
            k = after[i] = after[j]
            if k >= 0:
                before[k] = i
                m = merges.get(new << 20 | symbols[k])
                if m:
                    heapq.heappush(queue, (m[0], i, new, symbols[k], m[1]))
            k = before[i]
            if k >= 0:
                m = merges.get(symbols[k] << 20 | new)
                if m:
                    heapq.heappush(queue, (m[0], k, symbols[k], new, m[1]))
        return [s for s in symbols if s >= 0]

    def encode(self, text: str) -> list[int]:
        """The ids of any text: special tokens first, then normalised parts."""
        out: list[int] = []
        for part in self.split.split(text) if self.split else [text]:
            if part in self.special:
                out.append(self.special[part])
                continue
            normaliser, pieces = self.cutter
            for word, _ in pieces.pre_tokenize_str(normaliser.normalize_str(part)):
                ids = self.known.get(word)
                if ids is None:
                    if len(self.known) >= KNOWN:
                        self.known.clear()
                    ids = self.known[word] = self.merge(bytes(self.byte_of[c] for c in word))
                out += ids
        return out


_vocabularies: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    if path not in _vocabularies:
        _vocabularies[path] = Vocabulary(path)
    return _vocabularies[path]


def id_runs(column: pa.Array, path: str) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of texts: first row, last row + 1, all ids, and how many each text has."""
    v = vocabulary(path)
    for i, j, raw, off in text_chunks(column):
        points, poff = code_points(raw, off)
        at, end, text, h, plain = cut(points, poff, spaces=False, lower=LOWER)
        body = raw.tobytes()
        if any(s.encode() in body for s in v.special):
            for k in range(j - i):
                plain[k] &= not any(s.encode() in body[off[k] : off[k + 1]] for s in v.special)
            ok = plain[text]
            at, end, text, h = at[ok], end[ok], text[ok], h[ok]
        lowered = LOWER[np.minimum(points, LIMIT)].astype(np.uint32)
        place, _ = v.book.look_up(lowered, at, end, h)
        ids, size = v.book.expand(place)
        n = np.bincount(text, size, j - i).astype(np.int64)
        if not plain.all():
            ends, parts = np.concatenate([[0], np.cumsum(n)]), []
            for k in range(j - i):
                parts.append(ids[ends[k] : ends[k + 1]] if plain[k] else np.array(v.encode(body[off[k] : off[k + 1]].decode()), np.uint32))
                n[k] = len(parts[-1])
            ids = np.concatenate(parts)
        yield i, j, ids, n


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """id, ids (array<int>) of every whole text."""
    path = path or public_tokenizers.path("word_bpe_49k.json")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, ids, n in id_runs(batch.column("text"), path):
                ends = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(i, j - i), lists], names=["id", "ids"])

    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return texts.mapInArrow(run, "id long, ids array<int>").withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, ids_col: str = "ids", text_col: str = "decoded", path: str | None = None) -> DataFrame:
    """Add the decoded text of each row's ids (null: null)."""
    path = path or public_tokenizers.path("word_bpe_49k.json")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        strings = pa.array(vocabulary(path).strings)
        for whole in batches:
            ends = whole.column(ids_col).offsets.to_numpy()
            lo = 0
            while lo < whole.num_rows:  # rows of about a quarter of a million ids at a time
                hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + (1 << 18), "right")) - 1)
                batch = whole.slice(lo, hi - lo)
                lists, lo = batch.column(ids_col), hi
                at = lists.offsets.to_numpy()
                first, last = int(at[0]), int(at[-1])
                text = pc.binary_join(pa.ListArray.from_arrays(pa.array(at - first), strings.take(lists.values.slice(first, last - first))), " ")
                if lists.null_count:
                    text = pc.if_else(lists.is_valid(), text, None)
                yield pa.RecordBatch.from_arrays([*batch.columns, text], names=[*batch.schema.names, text_col])

    rest = encoded.drop(text_col)
    return rest.mapInArrow(run, T.StructType([*rest.schema.fields, T.StructField(text_col, T.StringType())]))


def query(spark, sf_dir: str) -> DataFrame:
    out = decode(encode(spark.read.parquet(f"{sf_dir}/documents.parquet")))
    joined = F.array_join(F.col("ids").cast("array<string>"), " ")
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(joined, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
