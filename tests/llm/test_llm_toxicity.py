import zlib

import numpy as np
import pytest

from affinity.llm import queries, toxicity


def made_up(rng, n):
    stems = ["zorg", "blix", "quam"]
    letters = np.random.default_rng(99)  # one vocabulary for all texts
    plain = ["".join(letters.choice(list("aeioulmnrst"), 2 + k % 4)) for k in range(400)]
    texts, labels = [], []
    for i in range(n):
        words = list(rng.choice(plain, int(rng.integers(5, 120))))
        toxic = i % 3 == 0
        if toxic:
            for _ in range(3):
                words.insert(int(rng.integers(len(words) + 1)), str(rng.choice(stems)) + "".join(rng.choice(list("aeiou"), 2)))
        texts.append(" ".join(words))
        labels.append(int(toxic))
    return texts, labels


def test_gradients_against_finite_differences():
    rng = np.random.default_rng(0)
    net = toxicity.Network.fresh(np.zeros(0, np.uint64), 5, 3, 2, 2, 1, rng)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    x = rng.normal(size=(5, 4, 5))
    mask = np.ones((5, 4), bool)
    mask[3:, 1] = False
    y = np.array([1.0, 0, 1, 0])

    def loss():
        pre = [x @ net.p[f"in_{s}"] + net.p[f"bias_{s}"] for s in "fb"]
        z, saved = net.forward(*pre, mask=mask, keep=True)
        return float((np.logaddexp(0, z) - y * z).sum()), z, saved

    _, z, saved = loss()
    g, d_x = net.backward(x, saved, toxicity.sigmoid(z) - y)
    for value, grad in [(net.p[k], g[k]) for k in g] + [(x, d_x)]:
        flat, want = value.reshape(-1), np.asarray(grad).reshape(-1)
        for j in rng.permutation(len(flat))[:8]:
            keep = flat[j]
            flat[j] = keep + 1e-4
            up = loss()[0]
            flat[j] = keep - 1e-4
            down = loss()[0]
            flat[j] = keep
            assert want[j] == pytest.approx((up - down) / 2e-4, rel=2e-2, abs=2e-3)


def test_windows_cover_every_word():
    for n in (0, 1, 23, 24, 25, 36, 37, 100, 1000):
        first = toxicity.windows_of(n, 24)
        seen = {i for a in first for i in range(a, min(n, a + 24))}
        assert seen == set(range(n)) and len(set(first.tolist())) == len(first)
        assert n <= 24 or first[-1] == n - 24


def test_learns_words_by_their_characters():
    rng = np.random.default_rng(1)
    net = toxicity.train(*made_up(rng, 400), epochs=4)
    texts, labels = made_up(rng, 120)
    score = []
    for t in texts:
        v = net.logits(toxicity.read_words(t))
        score.append(net.score(v.max(), toxicity.sigmoid(v).sum(), len(v)))
    assert np.mean((np.array(score) >= 0.5) == np.array(labels)) > 0.95


def test_batched_windows_and_slices_equal_one_by_one(monkeypatch):
    rng = np.random.default_rng(2)
    net = toxicity.Network.fresh(np.zeros(0, np.uint64), 24, 4, 3, 3, 2, rng)
    words = [toxicity.read_words(t) for t in (*made_up(rng, 9)[0], "", "one", "x " * 500)]
    for w, v in zip(words, net.window_logits(words)):
        assert np.allclose(v, net.logits(w), atol=1e-5)
    whole = words[-1]
    monkeypatch.setattr(toxicity, "WORDS_AT_ONCE", 96)
    parts = list(toxicity.slices(whole, 24))
    assert len(parts) > 3
    assert max(net.logits(p).max() for p in parts) == pytest.approx(net.logits(whole).max(), abs=1e-5)


def test_held_out_recall_and_precision(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = queries.QUERIES["op4_bigru_toxicity"](spark, sf).collect()
    assert len(got) == 10_000
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
    known = [(r["predicted"], labels[r["doc_id"]]) for r in got if r["doc_id"] in labels and r["held_out"]]
    toxic = [p for p, y in known if y == 1]
    assert len(toxic) > 50 and np.mean(toxic) > 0.8  # recall
    assert np.mean([y for p, y in known if p == 1]) > 0.85  # precision


def test_edge_cases(spark):
    rng = np.random.default_rng(3)
    texts, marks = made_up(rng, 150)
    rows = [(i, t, "en", 0.5) for i, t in enumerate(texts)]
    rows += [(900, None, None, None), (901, "", "en", 1.0), (902, " ## ", "en", 1.0), (None, texts[0], "en", 1.0), (0, texts[0], "en", 1.0)]
    plain = " ".join(t for t, m in zip(texts, marks) if not m)
    rows.append((903, " ".join([plain] * 4 + [texts[0]] * 3 + [plain] * 4), "en", 1.0))
    rows.append((904, " ".join([plain] * 8), "en", 1.0))
    rows.append((905, "lang " * 300_000, "en", 1.0))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, score double")
    labels = spark.createDataFrame([(i, m) for i, m in enumerate(marks)] + [(5, None), (None, 1), (7, 9)], "doc_id bigint, toxic int")
    got = toxicity.classify(docs, labels, epochs=3).collect()
    assert len(got) == len(rows)
    score = {r["doc_id"]: r["score"] for r in got}
    assert score[900] == score[901] == score[902] < 0.5
    assert score[None] == score[0]
    assert score[903] >= 0.5 > score[904] and score[905] < 0.5
    again = toxicity.classify(docs.repartition(7), labels.repartition(2), epochs=3).collect()
    assert sorted(map(tuple, again), key=str) == sorted(map(tuple, got), key=str)
    kept = toxicity.keep_clean(docs, labels)
    assert kept.columns == docs.columns and {900, 901, 902} <= {r["doc_id"] for r in kept.collect()}
    assert toxicity.classify(docs.limit(0), labels, epochs=1).count() == 0
    assert {round(r["score"], 6) for r in toxicity.classify(docs, labels.limit(0)).collect()} == {round(float(toxicity.sigmoid(-5.0)), 6)}
