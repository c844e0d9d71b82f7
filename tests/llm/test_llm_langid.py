import zlib

import numpy as np

from affinity.llm import langid, queries


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = queries.QUERIES["op7_bitmask_language_id"](spark, sf).collect()
    assert len(got) == len(docs)
    held = [r for r in got if r["held_out"]]
    assert {r["doc_id"] for r in held} == {d for d in docs if zlib.crc32(str(d).encode()) % 4 == 2}
    assert np.mean([r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in held]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got)


def test_filter_returns_all_languages_of_an_ngram_and_corrects_false_hits():
    table = np.zeros(1 << 10, np.uint8)
    h = langid.gram_hashes(langid.letter_codes("alpha beta gamma"), 3)
    for c in langid.cells_of(h, 10):
        table[c] |= 0b01
    for c in langid.cells_of(h[: len(h) // 2], 10):
        table[c] |= 0b10
    f = langid.Filters(["xx", "yy"], table, (3,), 10)
    n = f.counts(h)
    assert n[0] == len(h) and len(h) // 2 <= n[1] < len(h)
    assert 0 < f.false_rate[1] < f.false_rate[0] < 0.05
    assert f.predict("alpha beta gamma")[0] == "xx"
    # a filter filled with noise matches anything, and the correction takes that off
    noisy = table.copy()
    noisy[::2] |= 0b10
    noisy[1::4] |= 0b10
    g = langid.Filters(["xx", "yy"], noisy, (3,), 10)
    assert g.counts(h)[1] > len(h) // 2 and g.predict("alpha beta gamma")[0] == "xx"


def test_many_languages_and_edge_cases(spark):
    rows, i = [], 0
    rng = np.random.default_rng(0)
    stems = {f"l{k:02d}": ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 3)) for _ in range(6)] for k in range(70)}
    for lang, parts in stems.items():
        for _ in range(12):
            rows.append((i, " ".join(rng.choice(parts) + rng.choice(parts) for _ in range(40)), lang, 0.5, "s"))
            i += 1
    extra = [(9001, None, "l01", 0.1, ""), (9002, "", None, None, ""), (9003, "123 -- !", "l02", 0.0, ""), (None, rows[0][1], None, 1.0, "x"), (0, rows[0][1], "l00", 1.0, "")]
    docs = spark.createDataFrame(rows + extra, "doc_id bigint, text string, lang string, score double, lang_pred string")
    got = langid.identify(docs).collect()
    assert len(got) == len(rows) + len(extra)
    by = {r["doc_id"]: r for r in got}
    assert [by[d]["lang_pred"] for d in (9001, 9002, 9003)] == ["und"] * 3 and by[9001]["score"] == 0
    truth = {r[0]: r[2] for r in rows}
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in got if r["doc_id"] in truth and r["held_out"]]) > 0.9
    assert by[None]["lang_pred"] == "l00"
    assert langid.identify(docs.limit(0)).count() == 0
    unlabelled = spark.createDataFrame([(1, "some text", None)], "doc_id bigint, text string, lang string")
    assert [tuple(r)[2:] for r in langid.identify(unlabelled).collect()] == [("und", 0.0)]


def test_long_text_in_pieces():
    codes = langid.letter_codes("abc de " * 60_000)
    assert len(codes) > langid.PIECE
    for n in (2, 4):
        whole = langid.gram_hashes(codes, n)
        parts = [langid.gram_hashes(p, n) for p in langid.pieces(codes, 4)]
        assert abs(sum(map(len, parts)) - len(whole)) <= 3 * len(parts)


def test_learning_reads_no_held_out_row(spark):
    rows = [(i, "bo ba bi " * 20, "aa") for i in range(40)]
    held = [i for i in range(40) if zlib.crc32(str(i).encode()) % 4 == 2]
    rows = [(i, t, "zz" if i in held else lang) for i, t, lang in rows]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    assert {r["lang_pred"] for r in langid.identify(docs).collect()} == {"aa"}


def test_numbers_are_no_letters(spark):
    rng = np.random.default_rng(0)
    words = {"en": ["the", "house", "and"], "de": ["das", "haus", "und"]}
    rows = [(i, " ".join(rng.choice(words["en" if i % 2 else "de"], 20)), "en" if i % 2 else "de") for i in range(80)]
    rows += [(100 + i, t, None) for i, t in enumerate(["½ ² ①", "〇", "Ⅷ ⅷ", "³the²", "९"])]
    got = {r["doc_id"]: r["lang_pred"] for r in langid.identify(spark.createDataFrame(rows, "doc_id bigint, text string, lang string")).collect()}
    assert [got[100 + i] for i in range(5)] == ["und", "und", "und", "en", "und"]
    assert langid.letter_runs("a²b ½c") == ["a", "b", "c"]
