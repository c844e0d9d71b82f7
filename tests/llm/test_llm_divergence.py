import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from affinity.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def expected(docs, min_docs=30, top=50, a=5, scale=1_000_000_000):
    counts, in_docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in docs:
        group = (lang or "", source or "")
        groups.add(group)
        counts[group].update(terms_of(text))
        in_docs[group[0]].update(set(terms_of(text)))
    out = []
    for lang, source in groups:
        kept = sorted((t for t, n in in_docs[lang].items() if n >= min_docs), key=lambda t: t.encode())
        sources = [s for k, s in groups if k == lang]
        whole = Counter()
        for s in sources:
            whole.update(counts[lang, s])

        def p(c, t):
            return 1 + scale * (c[t] + a) // (sum(c[x] for x in kept) + a * len(kept))

        own = {t: p(counts[lang, source], t) for t in kept}
        pairs = [(-sum(abs(own[t] - p(counts[lang, s], t)) for t in kept), s) for s in sources if s != source]
        for rank, (value, s) in enumerate(sorted(pairs, key=lambda r: (r[0], r[1].encode()))):
            out.append((lang, source, "pair", s, -value, rank + 1))
        terms = [(own[t] - p(whole, t), t) for t in kept if counts[lang, source][t] and own[t] > p(whole, t)]
        for rank, (value, t) in enumerate(sorted(terms, key=lambda r: (-r[0], r[1].encode()))[:top]):
            out.append((lang, source, "term", t, value, rank + 1))
    return sorted(out)


def made_up(seed, n):
    rng = np.random.default_rng(seed)
    vocabulary = [f"{a}{b}" for a in "abcdefgh" for b in ("x", "é", "ß", "q", "Z", "\U0001F600", "�", "")]
    docs = []
    for _ in range(n):
        lang = str(rng.choice(["en", "de", "xx", ""]))
        source = str(rng.choice(["s1", "s2", "É", "", "hot", "hot", "hot"]))
        skew = np.arange(1, len(vocabulary) + 1.0) ** -float(rng.choice([0.3, 0.9]))
        words = rng.choice(vocabulary, int(rng.integers(0, 30)), p=skew / skew.sum())
        docs.append((" ".join(words), None if lang == "" else lang, None if source == "" else source))
    return docs


def run(spark, docs, **options):
    frame = spark.createDataFrame([(*d, 1, "x") for d in docs], "text string, lang string, source string, n int, term string")
    got = divergence.audit(frame.repartition(6), **options)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    return sorted(map(tuple, got.collect()))


@pytest.mark.parametrize("options", [{}, {"min_docs": 2, "top_terms": 3}, {"min_docs": 1, "scale": 10}, {"top_terms": 0}])
def test_audit_equals_brute_force(spark, options):
    docs = made_up(1, 500) + [(None, "en", "s1"), ("", "zz", "only"), ("1 2 --", "zz", "other"), (None, None, None)]
    names = {"min_docs": "min_docs", "top_terms": "top", "scale": "scale"}
    assert run(spark, docs, **options) == expected(docs, **{names[k]: v for k, v in options.items()})


def test_ties_span_cells_and_the_last_rank(spark):
    # many terms of equal counts: one cell holds more terms than the ranks asked for
    words = [f"t{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(200)]
    docs = [(" ".join(words[:150]), "en", "a")] * 3 + [(" ".join(words[100:]), "en", "b")] * 3
    assert run(spark, docs, min_docs=1) == expected(docs, min_docs=1)
    assert len([r for r in run(spark, docs, min_docs=1) if r[2] == "term" and r[1] == "a"]) == 50


def test_a_language_without_kept_terms_has_distance_zero(spark):
    docs = [("one two", "en", "b"), ("three", "en", "a"), (None, "en", "c")]
    got = run(spark, docs)
    assert got == expected(docs) and {r[4] for r in got} == {0} and len(got) == 6


def test_empty_table_very_long_text_and_bad_utf8(spark, monkeypatch):
    frame = spark.createDataFrame([], "text string, lang string, source string")
    assert divergence.audit(frame).count() == 0
    docs = [("word " * 400_000 + "x" * 5_000_000, "en", "a"), ("word other", "en", "b"), ("word", "en", "b")]
    assert run(spark, docs, min_docs=1) == expected(docs, min_docs=1)
    bad = spark.range(40).selectExpr("cast(unhex('61FF62') as string) AS text", "'en' AS lang", "concat('s', id % 2) AS source")
    assert divergence.audit(bad).count() == 2


def test_counts_passed_on_early_add_up(spark, monkeypatch):
    docs = made_up(2, 200)
    for rows, run_bytes, piece in ((5, 50, 7), (60, 40, 3), (10_000, 1, 1)):
        for name, value in (("HELD_ROWS", rows), ("RUN_BYTES", run_bytes), ("PIECE_BYTES", piece)):
            monkeypatch.setattr(divergence, name, value)
        assert run(spark, docs, min_docs=3) == expected(docs, min_docs=3)
