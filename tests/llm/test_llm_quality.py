import re
import zlib
from collections import Counter

import numpy as np
import pytest

from affinity.llm import quality, queries


def plain_counts(text: bytes) -> dict:
    """The counts of a text written out."""
    kinds = [int(quality.CLASS[b]) for b in text]
    found = Counter(dict.fromkeys(quality.COUNTS, 0))
    found["bytes"], found["lines"] = len(text), text.count(b"\n")
    for name, kind in (("digit", 1), ("upper", 2), ("lower", 3), ("stop", 4), ("mark", 5), ("beyond", 6)):
        found[name] = kinds.count(kind)
    words = re.findall(rb"[^\x00-\x20\x7F]+", text)
    found["words"] = len(words)
    for at in range(0, len(words), quality.BLOCK):
        part = words[at : at + quality.BLOCK]
        found["distinct"] += len(set(part))
        found["top"] += max(Counter(part).values())
        found["repeats"] += sum(a == b for a, b in zip(part, part[1:]))
        found["pairs"] += len(set(zip(part, part[1:])))
    for w in words:
        found["odd"] += quality.CLASS[w[-1]] == 5
        found["bare"] += not any(quality.CLASS[b] in (1, 2, 3, 6) for b in w)
        found["capital"] += quality.CLASS[w[0]] == 2
        found["squares"] += min(len(w), 255) ** 2
    return {k: int(found[k]) for k in quality.COUNTS}


def test_counts_and_pieces_equal_brute_force(monkeypatch):
    rng = np.random.default_rng(0)
    words = [b"a", b"The", b"###", b"x,", b"\xc3\xa9", b"9", b"word", b"!!", b"w" * 300]
    texts = [b"", b" ", b"\n", b"one", b" a  a\n", b"\xff\xfe"]
    texts += [b" ".join(rng.choice(words, int(n))) for n in (1, 5, 60, 1023, 1024, 1025, 5000)]
    got = quality.counts_of(texts)
    assert [dict(zip(quality.COUNTS, row)) for row in got.tolist()] == [plain_counts(t) for t in texts]
    for size in (300, 9000):
        for t in texts:
            parts = list(quality.pieces(t, size))
            assert b"".join(parts) == t
            assert sum(quality.counts_of([p])[0] for p in parts).tolist() == list(plain_counts(t).values())
    assert len(list(quality.pieces(texts[-1], 300))) > 3
    assert np.isfinite(quality.statistics_of(got)).all()


def test_isotonic_is_the_least_squares_rising_curve():
    rng = np.random.default_rng(1)
    x, n = np.arange(60.0), rng.integers(1, 20, 60).astype(float)
    ones = np.minimum(n, rng.poisson(n * np.linspace(0.1, 0.9, 60)))
    at, value = quality.isotonic(x, ones, n)
    assert (np.diff(value) > 0).all() and (np.diff(at) > 0).all() and 0 < value[0] and value[-1] < 1
    # max-min formula of the pooled means
    share = [max(min(ones[a : b + 1].sum() / n[a : b + 1].sum() for b in range(i, 60)) for a in range(i + 1)) for i in range(60)]
    assert sorted(set(np.round(share, 3))) == sorted(set(np.round((value * (len_of(at, x, n) + 0.02) - 0.01) / len_of(at, x, n), 3)))


def len_of(at, x, n):
    """Rows of each pooled block, from the blocks' mean places."""
    sizes, start = [], 0
    for a in at:
        for end in range(start + 1, len(x) + 1):
            if np.isclose((x[start:end] * n[start:end]).sum() / n[start:end].sum(), a):
                sizes.append(n[start:end].sum())
                start = end
                break
    return np.array(sizes)


def test_normal_equations_and_moments_are_exact_sums(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, quality.N_STATS))
    y = (x[:, 0] + x[:, 1] ** 2 > 0.5).astype(int)
    rows = spark.createDataFrame([(i, list(map(float, r)), int(b)) for i, (r, b) in enumerate(zip(x, y))], "id long, x array<double>, y int")
    mean, deviation = quality.moments(rows.repartition(7))
    assert np.allclose(mean, x.mean(axis=0), atol=1e-3) and np.allclose(deviation, x.std(axis=0), atol=1e-2)
    features = quality.Features.drawn(mean, deviation, 20, 3.0, 1)
    z = np.concatenate([features.of(x), y[:, None] * quality.STEPS], axis=1)
    for parts in (1, 9):
        assert (quality.normal_equations(rows.repartition(parts), features) == z.T @ z).all()


def test_random_features_approach_the_gaussian_kernel():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(30, 5))
    features = quality.Features.drawn(np.zeros(5), np.ones(5), 20_000, 2.0, 4)
    z = features.of(x)[:, :-1] / quality.STEPS
    kernel = np.exp(-((x[:, None] - x[None]) ** 2).sum(axis=2) / (2 * 2.0**2))
    assert np.abs(2 * z @ z.T / 20_000 - kernel).max() < 0.05
    assert (features.of(x)[3] == features.of(x[3:4])[0]).all()


def test_held_out_recall_and_precision(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = queries.QUERIES["op11_fourier_quality"](spark, sf).collect()
    assert len(got) == 10_000
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
    known = [(r["predicted"], labels[r["doc_id"]]) for r in got if r["doc_id"] in labels and r["held_out"]]
    low = [p for p, y in known if y == 0]
    assert len(low) > 50 and np.mean([p == 0 for p in low]) > 0.9
    assert np.mean([y == 0 for p, y in known if p == 0]) > 0.9
    assert np.mean([p == 1 for p, y in known if y == 1]) > 0.98


def fixture(spark, n=200):
    rng = np.random.default_rng(5)
    vocabulary = ["".join(rng.choice(list("aeiorstln"), int(rng.integers(2, 9)))) for _ in range(300)]
    rows, labels = [], []
    for i in range(n):
        words = list(rng.choice(vocabulary, int(rng.integers(5, 80))))
        junk = i % 4 == 0
        rows.append((i, " ".join(f"{w}***" if junk else w for w in words), "en", 0.1))
        labels.append((i, 0 if junk else 1))
    rows += [(900, None, "en", 0.1), (901, "", None, None), (902, " \n", "en", 0.1), (None, rows[0][1], "en", 0.1), (0, rows[1][1], "x", 0.1)]
    rows.append((903, "word " * 300_000, "en", 0.1))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, id string, score double")
    labels += [(5, 0), (5, None), (None, 1), (7, 9)]
    return rows, docs, spark.createDataFrame(labels, "doc_id bigint, quality int")


def test_edge_cases_and_partitions(spark):
    rows, docs, labels = fixture(spark)
    got = quality.classify(docs.coalesce(1), labels).collect()
    again = quality.classify(docs.repartition(9), labels.repartition(3)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, again), key=str) and len(got) == len(rows)
    score = {r["doc_id"]: r["score"] for r in got if r["doc_id"] != 0}
    of_zero = {r["score"] for r in got if r["doc_id"] == 0}
    assert score[900] == score[901] == score[902] and score[None] in of_zero and score[1] in of_zero
    assert np.mean([(r["score"] >= 0.3) == (r["doc_id"] % 4 != 0) for r in got if r["doc_id"] is not None and 0 < r["doc_id"] < 200]) > 0.97


def test_without_labels_or_documents(spark):
    rows, docs, labels = fixture(spark, 40)
    assert quality.classify(docs.limit(0), labels).count() == 0
    assert {r["score"] for r in quality.classify(docs, labels.limit(0)).collect()} == {0.5}
    one = quality.classify(docs, labels.where("quality = 1")).collect()
    assert len({r["score"] for r in one}) == 1 and 0.9 < one[0]["score"] < 1
    bad = spark.sql("SELECT 1L AS doc_id, cast(unhex('61FF62') AS string) AS text")
    assert quality.classify(bad, labels).count() == 1


@pytest.mark.parametrize("n", [1, 3])
def test_fewer_rows_than_features(spark, n):
    rows, docs, labels = fixture(spark, 8)
    got = quality.classify(docs, labels, n_features=64).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
