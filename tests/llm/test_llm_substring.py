import hashlib
import re

import numpy as np
import pytest

from affinity.llm import substring

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(docs, window):
    """{position in docs: (n_words, kept words)} by the rule; docs are (id, text) with ids unique or null."""
    order = lambda i, s: (docs[i][0] is None, docs[i][0] or 0, s)
    words = [WORD.findall(t or "") for _, t in docs]
    first = {}
    for i, w in enumerate(words):
        for s in range(len(w) - window + 1):
            k = tuple(w[s : s + window])
            first[k] = min(first.get(k, order(i, s)), order(i, s))
    out = []
    for i, w in enumerate(words):
        gone = set()
        for s in range(len(w) - window + 1):
            if first[tuple(w[s : s + window])] < order(i, s):
                gone.update(range(s, s + window))
        out.append((docs[i][0], len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)))
    return sorted(out, key=str)


def run(spark, docs, parts=3, **options):
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(parts)
    rows = substring.repeated_windows_removed(df, **options).collect()
    return sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept_text"]) for r in rows), key=str)


@pytest.mark.parametrize("window", [1, 3, 5, 20])
def test_against_brute_force(spark, window):
    rng = np.random.default_rng(window)
    docs = []
    for i in range(60):
        n = int(rng.integers(0, 70))
        docs.append((int(i * 7 % 61), " ".join(f"w{x}" for x in rng.integers(0, 3 if window > 3 else 40, n))))
    passage = " ".join(f"p{x}" for x in range(35))
    docs += [(100 + i, f"a{i} {passage} b{i} c") for i in range(30)] + [(200, passage + " " + passage)]
    # small blocks and shards: every step is dealt over many tasks
    assert run(spark, docs, window=window, block_bytes=900, shard_windows=64) == brute(docs, window)
    assert run(spark, docs, window=window) == brute(docs, window)


def test_edge_cases(spark):
    t = " ".join(f"x{i}" for i in range(25))
    docs = [(3, t), (1, t + " y z"), (None, t), (4, None), (5, ""), (6, " \t\n"), (7, "short text"), (None, "\x0b" + t.replace(" ", "\x0c"))]
    got = run(spark, docs)
    assert got == brute(docs, 20)
    assert [r for r in got if r[0] in (4, 5, 6)] == [(4, 0, 0, ""), (5, 0, 0, ""), (6, 0, 0, "")]
    # equal windows at one start of one id do not remove each other
    assert [r[2] for r in run(spark, [(1, t), (1, t)])] == [0, 0]
    assert run(spark, []) == []
    with pytest.raises(ValueError):
        run(spark, docs, window=0)


def test_very_long_text_and_hot_passage(spark):
    long = " ".join(f"u{i}" for i in range(60_000))
    docs = [(1, long), (2, long)] + [(10 + i, " ".join(["lorem"] * 40)) for i in range(300)]
    got = {r[0]: r for r in run(spark, docs, block_bytes=20_000)}
    assert got[1][2] == 0 and got[2][2] == 60_000
    assert got[10] == (10, 40, 39 - 20 + 20, "lorem") and all(got[10 + i][2] == 40 for i in range(1, 300))


def test_all_columns_pass_through(spark):
    t = " ".join(f"x{i}" for i in range(22))
    df = spark.createDataFrame(
        [(1, t, "a", [1, 2], 5), (2, t + "  end", "b", None, None), (3, "  as  it was ", None, [], 1)],
        "doc_id bigint, text string, n_words string, c0 array<int>, block int",
    )
    out = substring.without_repeats(df)
    assert out.columns == df.columns
    rows = {r["doc_id"]: r for r in out.collect()}
    assert rows[1]["text"] == t and rows[2]["text"] == "end" and rows[3]["text"] == "  as  it was "
    assert rows[1]["c0"] == [1, 2] and rows[2]["n_words"] == "b" and rows[3]["block"] == 1


def test_window_hash_depends_on_every_word_and_its_place():
    rng = np.random.default_rng(1)
    w = rng.integers(0, 2**63, 20).astype(np.uint64)
    base = substring.window_hashes(w, 20)[0]
    for i in range(20):
        x = w.copy()
        x[i] ^= np.uint64(1)
        assert substring.window_hashes(x, 20)[0] != base
        x = w.copy()
        x[[i, (i + 1) % 20]] = x[[(i + 1) % 20, i]]
        assert substring.window_hashes(x, 20)[0] != base
    for n in (1, 2, 3, 5, 7, 20, 31):
        x = rng.integers(0, 2**63, 50).astype(np.uint64)
        got = substring.window_hashes(x, n)
        assert len(got) == 51 - n
        assert [substring.window_hashes(x[i : i + n], n)[0] for i in range(51 - n)] == got.tolist()


def test_query_digest(spark):
    from affinity.llm import queries

    rows = queries.QUERIES["op5_count_min_substring_dedup"](spark, "/root/testdata/sf0.001").collect()
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    want = {d: (n, k, hashlib.sha256(t.encode()).hexdigest()) for d, n, k, t in brute(docs, 20)}
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in rows} == want
