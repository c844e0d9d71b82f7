import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from affinity.llm import importance

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def features_of(text, n):
    w = words_of(text)
    return [" ".join(w[i : i + k]) for k in range(1, n + 1) for i in range(len(w) - k + 1)]


def expected(docs, target, percent, min_words, n=2, buckets=10_000, seed=7):
    def bucket(f):
        return zlib.crc32(f.encode()) % buckets

    s, t = (Counter(bucket(f) for text in texts for f in features_of(text, n)) for texts in ([d[1] for d in docs], target))
    s_all, t_all = sum(s.values()) + buckets, sum(t.values()) + buckets
    out = []
    for doc_id, text in docs:
        gains = [
            math.floor(1000 * math.log((t[b] + 1.0) * s_all / ((s[b] + 1.0) * t_all)))
            for b in map(bucket, features_of(text, n))
        ]
        weight = sum(gains) // len(gains) if gains else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, len(words_of(text)), len(gains), weight, score, None])
    able = sorted((r for r in out if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2], r[3]))
    for k, r in enumerate(able[: percent * len(able) // 100]):
        r[5] = k + 1
    return sorted(map(tuple, out), key=str)


def test_crc_matrices_equal_zlib(monkeypatch):
    rng = np.random.default_rng(0)
    parts = [rng.integers(0, 256, int(n), dtype=np.uint8).tobytes() for n in (0, 1, 1, 2, 255, 256, 257, 1000, *rng.integers(0, 40, 500))]
    data = np.frombuffer(b"".join(parts), np.uint8)
    length = np.array([len(p) for p in parts])
    start = np.cumsum(length) - length
    for matrix_bytes in (1 << 22, 64):
        monkeypatch.setattr(importance, "MATRIX_BYTES", matrix_bytes)
        assert importance.crc32_of(data, start, length).tolist() == [zlib.crc32(p) for p in parts]


@pytest.mark.parametrize("n", [1, 2, 3])
def test_features_and_pieces_equal_brute_force(n):
    rng = np.random.default_rng(n)
    texts = ["", " ", "a", "A b", "é ß　x", "x" * 300 + " y", "a--b  c\n\nd.", *("".join(rng.choice(list("aB1é -\n"), 200)) for _ in range(20))]
    for size in (16, 50, 1 << 20):
        cut = [(i, p, c) for i, t in enumerate(texts) for p, c in importance.pieces(t.encode(), n, size)]
        rows = np.array([i for i, _, _ in cut])
        owner, bucket, words = importance.features_of([p for _, p, _ in cut], [c for _, _, c in cut], n, 10_000)
        assert np.bincount(rows, weights=words, minlength=len(texts)).tolist() == [len(words_of(t)) for t in texts]
        for i, t in enumerate(texts):
            got = Counter(bucket[rows[owner] == i].tolist())
            assert got == Counter(zlib.crc32(f.encode()) % 10_000 for f in features_of(t, n)), (t, size)


def test_long_word_without_spaces_is_one_piece():
    assert [p for p, _ in importance.pieces(b"x" * 1000, 2, 64)] == [b"x" * 1000]
    assert sum(len(p) for p, _ in importance.pieces(b" " * 1000, 2, 64)) == 1000


def fixture(spark):
    rng = np.random.default_rng(4)
    vocabulary = [f"w{i}" for i in range(60)] + ["É", "Zü"]
    docs = [(i, " ".join(rng.choice(vocabulary, int(rng.integers(0, 60))))) for i in range(120)]
    docs += [(200, None), (201, ""), (202, "?! --"), (None, docs[5][1]), (None, docs[5][1]), (7, docs[7][1]), (7, "w1 " * 30), (203, "w2 w3 " * 60_000)]
    target = [" ".join(rng.choice(vocabulary[:12], 40)) for _ in range(10)] + [None, ""]
    frame = spark.createDataFrame([(i, t, "n", 1) for i, t in docs], "doc_id bigint, text string, score string, place int")
    return docs, target, frame, spark.createDataFrame([(t,) for t in target], "text string")


@pytest.mark.parametrize("percent,min_words", [(25, 20), (100, 0), (0, 20), (3, 1)])
def test_resample_equals_brute_force(spark, percent, min_words):
    docs, target, frame, wanted = fixture(spark)
    got = importance.resample(frame.repartition(5), wanted, percent=percent, min_words=min_words)
    assert got.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, got.collect()), key=str) == expected(docs, target, percent, min_words)


def test_three_word_runs_and_small_pieces(spark, monkeypatch):
    docs, target, frame, wanted = fixture(spark)
    got = importance.resample(frame, wanted, ngrams=3, buckets=97, seed=1)
    assert sorted(map(tuple, got.collect()), key=str) == expected(docs, target, 25, 20, 3, 97, 1)


def test_empty_tables_and_bad_utf8(spark):
    docs, target, frame, wanted = fixture(spark)
    assert importance.resample(frame.limit(0), wanted).count() == 0
    got = importance.resample(frame, wanted.limit(0)).collect()
    assert sorted(map(tuple, got), key=str) == expected(docs, [], 25, 20)
    bad = frame.selectExpr("doc_id", "cast(unhex('61FF62') as string) AS text")
    assert {r["n_features"] for r in importance.resample(bad, wanted).collect()} == {1}
    with pytest.raises(ValueError):
        importance.resample(frame, wanted, percent=101)


def test_runs_bound_their_bytes(monkeypatch):
    monkeypatch.setattr(importance, "RUN_BYTES", 100)
    batch = pa.RecordBatch.from_arrays([pa.array([b"ab " * 20] * 10 + [None])], ["text"])
    parts = list(importance.runs(batch, 0, 2))
    assert len(parts) > 4 and sorted({int(i) for rows, _, _ in parts for i in rows}) == list(range(11))
