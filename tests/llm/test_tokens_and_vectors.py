"""Token counts, alignment and whitening against the libraries and plain Python, with awkward rows."""

import collections
import hashlib
import math
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from frameloom.llm import alignment, token_counts, whitening
from frameloom.llm.bpe import byte_characters
from frameloom.llm.common import fresh_path

A_PATH, B_PATH = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = [None, "", " ", "  ", "\n\n", "one", "a ", " a", "a  b   c ", "it's 'sun we'd've  'll\n's", "a\tb  c\x85d\r\n", "日本語 text é", "<|endoftext|> <s> </s> <unk> <0x41>", "word " * 3000, "x" * 20000, "İ ΑΣ 🙂 1234", "a▁b", "▁", "é ﬁ Å ​ ﻿", "\x00 \x01", "кот и 狗 คน", "12345 67.89%", "नमस्ते दुनिया"]
SCHEMA = "doc_id long, text string, lang string, n_tokens string, pairs string, id string, row string, digest string"


def table(spark, texts):
    return spark.createDataFrame([(i if i % 9 else None, t, None, "clash", "clash", "clash", "clash", "clash") for i, t in enumerate(texts, 1)], SCHEMA)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdeghilmnorstäß") for _ in range(rng.randint(1, 9))) for _ in range(300)]
    base = [rng.choice([" ", "  ", "\n"]).join(rng.choice(words) for _ in range(rng.randint(1, 60))) for _ in range(60)]
    noise = ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(0x80, 0x250), rng.randrange(0x3000, 0x3100), 0x20, 0x0A])) for _ in range(rng.randint(1, 80))) for _ in range(60)]
    return ODD + base + noise + base[:10] * 3


def library_counts(texts):
    tok = Tokenizer.from_file(A_PATH)
    return [len(tok.encode(t or "", add_special_tokens=False).ids) for t in texts]


def test_token_counts(spark, texts):
    cache = fresh_path(spark, "cache")
    docs = table(spark, texts).cache()
    want = collections.Counter((i if i % 9 else None, len((t or "").encode()), n, n > 512) for i, (t, n) in enumerate(zip(texts, library_counts(texts), strict=True), 1))
    folder = f"{cache}/{token_counts.tokenizer_digest(A_PATH)}"
    distinct = len({t or "" for t in texts})
    for run in range(2):  # the second run finds every count
        got = token_counts.token_counts(docs, cache)
        assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
        assert collections.Counter(map(tuple, got.collect())) == want
        assert token_counts.stored(spark, folder).count() == distinct, run
    # only what is new is appended
    more = table(spark, [*texts[:20], "something new", "something new", "and this"])
    token_counts.token_counts(more, cache).collect()
    assert token_counts.stored(spark, folder).count() == distinct + 2


def test_token_counts_come_from_the_cache(spark):
    """A stored count is used as it is; another tokenizer's counts are not."""
    cache = fresh_path(spark, "cache")
    folder = f"{cache}/{token_counts.tokenizer_digest(A_PATH)}"
    digest = hashlib.sha256(b"known text").digest()
    for _ in range(2):  # appended twice, as by two runs at a time
        spark.createDataFrame([(bytearray(digest), 77)], token_counts.STORED).write.mode("append").parquet(folder)
    docs = spark.createDataFrame([(1, "known text"), (2, "known text"), (3, "Known text")], "doc_id long, text string")
    of = lambda **o: {r["doc_id"]: r["n_tokens"] for r in token_counts.token_counts(docs, cache, **o).collect()}
    assert of() == {1: 77, 2: 77, 3: 2}
    sp = sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    assert of(tokenizer=B_PATH) == {1: len(sp.encode("known text")), 2: len(sp.encode("known text")), 3: len(sp.encode("Known text"))}
    assert of(normalise=lambda c: F.lower(token_counts.as_it_is(c))) == {1: 77, 2: 77, 3: 77}


def test_token_counts_empty_and_repeated(spark):
    cache = fresh_path(spark, "cache")
    assert token_counts.token_counts(spark.createDataFrame([], "doc_id long, text string"), cache).count() == 0
    same = spark.createDataFrame([(1, "twice said")] * 50 + [(None, None)] * 3, "doc_id long, text string")
    got = collections.Counter(map(tuple, token_counts.token_counts(same, cache).collect()))
    assert got == {(1, 10, library_counts(["twice said"])[0], False): 50, (None, 0, 0, False): 3}


def plain_alignment(texts):
    """Per text: a tokens and b tokens (id, start, end), groups and links, by loops over bytes."""
    tok = Tokenizer.from_file(A_PATH)
    tok.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    byte_of = {c: b for b, c in enumerate(byte_characters())}
    out = []
    for t in texts:
        led = (" " + (t or "")).encode()
        a = [(i, bytes(byte_of[c] for c in tok.id_to_token(i))) for i in tok.encode(led.decode(), add_special_tokens=False).ids]
        b = [(i, bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode()) for i in sp.encode(t or "")]
        if not t or b"".join(x for _, x in a) != led or b"".join(x for _, x in b) != led:
            out.append(([], [], [], []))
            continue
        spans = []
        for tokens in (a, b):
            at, own = 0, []
            for i, x in tokens:
                own.append((i, at, at + len(x)))
                at += len(x)
            spans.append(own)
        ends = sorted({e for _, _, e in spans[0]} & {e for _, _, e in spans[1]})
        groups = [([i for i, s, e in spans[0] if lo <= s < hi], [i for i, s, e in spans[1] if lo <= s < hi]) for lo, hi in zip([0, *ends], ends)]
        links = [(i, j) for i, s, e in spans[0] for j, u, v in spans[1] if s < v and u < e]
        out.append((spans[0], spans[1], groups, links))
    return out


@pytest.mark.parametrize("hot", [1, 1 << 18])
def test_alignment(spark, texts, hot, monkeypatch):
    monkeypatch.setattr(alignment, "HOT", hot)
    short = [t if t is None or len(t) < 1500 else t[:1500] for t in texts]
    plain = plain_alignment(short)
    count = collections.Counter(p for *_, links in plain for p in set(links))
    most = collections.defaultdict(int)
    for (a, _), n in count.items():
        most[a] = max(most[a], n)
    want = collections.Counter()
    for k, (a, b, groups, links) in enumerate(plain, 1):
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        digest = hashlib.sha256(text.encode()).hexdigest() if text else ""
        want[k if k % 9 else None, len(a), len(b), len(groups), len(links), sum(count[p] == most[p[0]] for p in links), sum(count[p] for p in links), digest] += 1
    rows, pairs = alignment.align(table(spark, short))
    assert rows.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert collections.Counter(map(tuple, rows.collect())) == want
    assert {(r["a_id"], r["b_id"]): (r["count"], r["best"]) for r in pairs.collect()} == {p: (n, n == most[p[0]]) for p, n in count.items()}
    assert sum(n == 0 for (_, n, *_), k in want.items()) and any(k[3] != k[1] for k in want)


def test_alignment_long_and_empty(spark):
    rows, pairs = alignment.align(spark.createDataFrame([], "doc_id long, text string"))
    assert rows.count() == 0 and pairs.count() == 0
    rng = random.Random(2)
    long = " ".join(rng.choice(["some", "words,", "élan", "3.14"]) for _ in range(400_000))
    (row,) = alignment.align(spark.createDataFrame([(7, long)], "doc_id long, text string"))[0].collect()
    tok, sp = Tokenizer.from_file(A_PATH), sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    assert (row["n_a"], row["n_b"]) == (len(tok.encode(" " + long, add_special_tokens=False).ids), len(sp.encode(long)))


def plain_whitening(rows, scale=64, lift=1_000_000, most=16):
    """Kept (id, x), eigenvalues and eigenvectors, by numpy's solver on exactly centred values."""
    kept = [(i, tuple(math.floor(scale * c) + lift for c in map(float, v))) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    fit = np.array(sorted({x for _, x in kept}), dtype=object)
    n, sums = len(fit), fit.sum(0)
    d = (fit * n - sums).astype(float) / n
    return kept, n, sums, *np.linalg.eigh(d.T @ d / n)


def check_whitening(spark, rows, got, rank=None):
    kept, n, sums, e, vectors = plain_whitening(rows)
    e, vectors = e[::-1], vectors[:, ::-1]
    k = min(16, rank or len(e))
    assert sorted({r["component"] for r in got}) == list(range(1, k + 1))
    by = collections.defaultdict(list)
    for r in got:
        by[r["vec_id"], r["component"]].append(r)
    assert collections.Counter(r["vec_id"] for r in got) == {i: m * k for i, m in collections.Counter(i for i, _ in kept).items()}
    sign = {}
    for i, x in kept:
        y = [n * v - int(s) for v, s in zip(x, sums, strict=True)]
        for c in range(1, k + 1):
            want = np.dot(np.array(y, float) / n, vectors[:, c - 1]) / math.sqrt(e[c - 1])
            near = min(by[i, c], key=lambda r: abs(abs(r["whitened"]) - abs(want)))
            if abs(want) > 0.1:
                sign.setdefault(c, np.sign(near["whitened"] * want))
            assert abs(near["whitened"] - sign.get(c, np.sign(near["whitened"] * want) or 1) * want) < 1e-6
            assert near["n"] == n and near["deviation"] == sum(v * v for v in y)
            assert abs(near["explained"] / (e[c - 1] / e.sum()) - 1) < 1e-9 and near["identity_error"] < 1e-8


def test_whitening(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(400, 24)) * np.linspace(3, 0.2, 24) @ np.linalg.qr(rng.normal(size=(24, 24)))[0] + 5
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(base)]
    rows += [(1000 + i, rows[0][1]) for i in range(200)]  # copies weigh once
    rows += [(5000, None), (5001, []), (5002, [None] * 24), (5003, [math.nan] + [1.0] * 23), (5004, [math.inf] + [1.0] * 23)]
    df = spark.createDataFrame([(i, v, "clash", "clash") for i, v in rows], "vec_id long, embedding array<double>, x string, component string")
    got = whitening.whiten(df).collect()
    assert whitening.whiten(df).columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    check_whitening(spark, rows, got)


def test_whitening_of_low_rank(spark):
    """Constant and repeated dimensions have no variance of their own; fewer vectors than dimensions."""
    rng = np.random.default_rng(4)
    base = rng.integers(-200, 200, size=(60, 3)) / 64
    rows = [(i, [v[0], v[1], v[0], 7.0, v[2], v[1]]) for i, v in enumerate(base.tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    check_whitening(spark, rows, whitening.whiten(df).collect(), rank=3)
    few = [(i, rng.normal(size=20).tolist()) for i in range(5)] + [(None, [0.5] * 20)]
    check_whitening(spark, few, whitening.whiten(spark.createDataFrame(few, "vec_id long, embedding array<double>")).collect(), rank=5)


def test_whitening_defined_cases(spark):
    schema = "vec_id long, embedding array<float>"
    assert whitening.whiten(spark.createDataFrame([], schema)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, [0.5, 0.25]), (2, [0.5, 0.25])], schema)).count() == 0
    mixed = spark.createDataFrame([(1, [0.5, 0.25]), (2, [0.75, 0.5]), (3, [1.0]), (4, [9.0, 2.0])], schema)
    assert {r["vec_id"] for r in whitening.whiten(mixed).collect()} == {1, 2, 4}
    # entries so large that 64 bits do not hold the deviation
    large = spark.createDataFrame([(1, [1e9, 0.0]), (2, [-1e9, 1.0]), (3, [0.0, 7.0])], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r["deviation"] for r in whitening.whiten(large).collect()}
    assert got[1] is None and got[3] == (3 * 448 - 512) ** 2


def test_gram_of_badly_scaled_rows(spark):
    """Singular values over nine powers of ten: one Cholesky factor alone loses the small ones."""
    rng = np.random.default_rng(6)
    d = np.round(rng.normal(size=(300, 8)) * np.array([1e9, 1e8, 1e7, 1e6, 1e5, 1e3, 1e2, 10]))
    rows = spark.createDataFrame([([int(c) for c in v],) for v in d], "x array<long>")
    r = whitening.triangular_factor(rows, len(d), d.sum(0).astype(int).astype(object))
    exact = np.linalg.svd(d - d.mean(0), compute_uv=False)
    assert np.allclose(np.linalg.svd(r, compute_uv=False), exact, rtol=1e-9)
