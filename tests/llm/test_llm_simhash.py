import re

import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from affinity.llm import components, queries, simhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def slow_fingerprint(text, k=3):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(values, linked):
    """Smallest label of each item's class, by brute force over all pairs."""
    root = dict.fromkeys(values)
    for v in root:
        root[v] = v

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    items = sorted(root)
    for i, a in enumerate(items):
        for b in items[i + 1 :]:
            if linked(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {v: find(v) for v in items}


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="aB c\t\né ſK", max_size=60))
def test_fingerprint_matches_the_rule(text):
    assert simhash.fingerprint(text) == slow_fingerprint(text)


def test_long_text_in_slices():
    text = " ".join(f"w{i * i % 977}" for i in range(simhash._BITS_AT_ONCE + 500))
    assert simhash.fingerprint(text) == slow_fingerprint(text)


def links_by(spark, values, max_bits, dense_list):
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    prints = spark.createDataFrame([(v,) for v in signed], "fp bigint")
    edges = simhash.fingerprint_links(prints, max_bits, dense_list)
    got = {r["node"] & (2**64 - 1): r["root"] & (2**64 - 1) for r in components.components(edges).collect()}
    groups = {}
    for v in values:
        groups.setdefault(got.get(v, v), set()).add(v)
    return sorted(map(sorted, groups.values()))


def expected(values, max_bits):
    root = classes(values, lambda a, b: (a ^ b).bit_count() <= max_bits)
    groups = {}
    for v, r in root.items():
        groups.setdefault(r, set()).add(v)
    return sorted(map(sorted, groups.values()))


def test_links_are_those_of_all_pairs_short_and_dense_lists(spark):
    rng = np.random.default_rng(3)
    values = set()
    for _ in range(25):
        center = int(rng.integers(0, 2**63)) * 2 + 1
        values.add(center)
        for _ in range(6):  # families whose members differ by 1 to 4 bits, chains included
            v = center
            for b in rng.integers(0, 64, size=int(rng.integers(1, 5))):
                v ^= 1 << int(b)
            values.add(v)
    values = sorted(values | {0, 1, 3, 7, 2**64 - 1})
    for bits in (0, 1, 2, 3):
        want = expected(values, bits)
        assert links_by(spark, values, bits, 1000) == want
        assert links_by(spark, values, bits, 2) == want  # every list over 2 goes the dense way


def test_edge_cases(spark):
    rows = [
        (5, "a b c d", 1), (2, "A B C D", 2), (7, None, 3), (3, "", 4), (9, " \t\n", 5),
        (None, "a b c d", 6), (5, "a b c d", 7), (11, "solo", 8), (12, "zwei worte", 9),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, component_id int").withColumn("fp", F.lit("x"))
    got = {(r["doc_id"], r["component_id"]) for r in simhash.simhash_components(docs).collect()}
    assert got == {(5, 2), (2, 2), (None, 2), (7, 3), (3, 3), (9, 3), (11, 11), (12, 12)}
    assert simhash.simhash_components(docs).count() == len(rows)
    assert sorted(r["doc_id"] or -1 for r in simhash.keep_first(docs).collect()) == [-1, 2, 3, 11, 12]
    assert simhash.keep_first(docs).columns == docs.columns
    assert simhash.simhash_components(docs.limit(0)).count() == 0


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = {r["doc_id"]: slow_fingerprint(r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    root = classes(set(docs.values()), lambda a, b: (a ^ b).bit_count() <= 2)
    least = {}
    for d, f in sorted(docs.items()):
        least.setdefault(root[f], d)
    got = queries.QUERIES["op1_simhash_near_dedup"](spark, sf).collect()
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in got} == {
        d: (f"{f:016x}", least[root[f]]) for d, f in docs.items()
    }
