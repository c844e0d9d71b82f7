import html
import re
import time
from collections import Counter

import numpy as np
import pytest

from affinity.llm import html_extract as H
from affinity.llm import queries
from html_pages import PAGES


@pytest.fixture(scope="module")
def trees():
    return H.train()


def one(source, trees):
    return H.main_texts([source], trees)[0]


PROSE = "The river rose over night, and by morning the lower road was gone. People came to look at the water."


def test_blocks_references_and_white_space(trees):
    source = f"""<html><head><title>no</title><style>p{{}}</style></head><body><nav><ul><li><a href=/>Home</a><li><a href=/a>About</a></ul></nav>
    <article><h1>A &amp; B &lt;c&gt;</h1><p>{PROSE}\n\n  And&nbsp;a <b>bold\tone</b>, a<i>b</i>c&#33; x<br>y &hellip; &zzref; 3 < 4</p>
    <!-- <p>comment</p> --><script>document.write("<p>no</p>")</script><p>{PROSE}<p>{PROSE}<ul><li>first thing here<li>second thing here</ul></article>
    <footer>&copy; Someone</footer></body></html>"""
    assert one(source, trees).split("\n\n") == [
        "A & B <c>",
        f"{PROSE} And a bold one, abc! x y … &zzref; 3 < 4",
        PROSE,
        PROSE,
        "first thing here",
        "second thing here",
    ]


def test_boilerplate_of_many_kinds_goes(trees):
    rest = "Sign up for our letters, offers and more from our partners today."
    good = "".join(f"<p>{PROSE}</p>" for _ in range(5))
    parts = [
        f'<div class="cookie-notice"><p>{rest}</p></div>', f"<header><p>{rest}</p></header>", f'<div class="ad">{rest}</div>',
        f"<aside><h3>Related</h3><ul><li><a href=/x>{rest}</a></li></ul></aside>", f'<form class="newsletter"><p>{rest}</p><input></form>',
        f'<section id="comments"><h3>3 comments</h3><div class="comment"><p>{rest}</p></div><div class="comment"><p>{rest} {PROSE[:40]}</p></div></section>',
        f'<div class="sidebar"><p>{rest}</p></div>', f"<footer><p>{rest}</p></footer>", f'<div class="share"><a href=/>Share</a></div>',
    ]
    for before in (parts[:4], []):
        for wrap in ("<article>{}</article>", "<main>{}</main>", '<div class="content">{}</div>'):
            source = f"<body>{''.join(before)}{wrap.format(good)}{''.join(parts[4:])}</body>"
            assert one(source, trees) == "\n\n".join([PROSE] * 5)


def test_decoding_is_consistent():
    rng = np.random.default_rng(0)
    for _ in range(50):
        n = int(rng.integers(1, 40))
        parent = np.array([-1] + [int(rng.integers(0, i)) for i in range(1, n)])
        depth = np.zeros(n, np.int64)
        for i in range(1, n):
            depth[i] = depth[parent[i]] + 1
        logit, text = rng.normal(size=n) * 3, rng.integers(0, 500, n).astype(float)
        kept = H.decode(logit, parent, depth, text)
        weight = 1 + np.log1p(text)
        kids = [[c for c in range(n) if parent[c] == i] for i in range(n)]

        def whole(i, sign):
            return weight[i] * np.logaddexp(0, -sign * logit[i]) + sum(whole(c, sign) for c in kids[i])

        def best(i):
            own = weight[i] * min(np.logaddexp(0, -logit[i]), np.logaddexp(0, logit[i]))
            return min(whole(i, 1), whole(i, -1), own + H.SPLIT_COST + sum(best(c) for c in kids[i]))

        def cost(i):  # of the decoding, from the labels alone
            below = [i]
            for x in below:
                below += kids[x]
            if kept[below].all() and whole(i, 1) <= whole(i, -1) and abs(whole(i, 1) - best(i)) < 1e-9:
                return whole(i, 1)
            if not kept[below].any() and abs(whole(i, -1) - best(i)) < 1e-9:
                return whole(i, -1)
            return weight[i] * np.logaddexp(0, -logit[i] if kept[i] else logit[i]) + H.SPLIT_COST + sum(cost(c) for c in kids[i])

        assert cost(0) == pytest.approx(best(0))


@pytest.mark.parametrize(
    "source",
    [None, "", " ", "<", "<a", "<!--", "<p", "</", "</p>", "<script>", "&", "<<<>>>", "<p a='>", "<div " * 50, "<table><tr><td><p>",
     "<b>" * 3000 + "x", "text only", "\x00<p>\x00", "<title>t", "<!doctype", "<a href=\"x>y</a>"],
)
def test_broken_markup_gives_a_result(source, trees):
    assert isinstance(one(source, trees), str)


def test_raw_text_and_implied_ends():
    page = H.parse("<head><title>a<p></title><body><script>if (a</b>) '</p>'</script><style><p></style><p>x<p>y<li>z<textarea><p>q</textarea>")
    assert [t for _, _, t in page.runs] == ["x", "y", "z"]
    assert len({b for _, b, _ in page.runs}) == 3


def test_held_out_layouts(trees):
    """Pages of layouts drawn anew: word recall and precision of the main text."""
    hit = total = found = 0
    for source in H.training_pages(150, seed=99):
        page = H.parse(source)
        main = " ".join(t.strip()[1:] for _, _, t in page.runs if t.strip().startswith(H.MAIN)).split()
        text = one(source.replace(H.MAIN, "").replace(H.REST, ""), trees).split()
        a, b = set(main), set(text)
        hit, total, found = hit + len(a & b), total + len(a), found + len(b)
    assert hit / total > 0.95 and hit / found > 0.95


def block_score(pages, trees):
    """Recall and precision of whole blocks over pages."""
    hit = total = found = 0
    for _, source, blocks in pages:
        got = one(source, trees).split("\n\n")
        same = sum((Counter(got) & Counter(blocks)).values())
        hit, total, found = hit + same, total + len(blocks), found + len([b for b in got if b])
    return hit / total, hit / found


def test_hand_written_pages(trees):
    assert len(PAGES) >= 20
    recall, precision = block_score(PAGES, trees)
    assert recall >= 0.95 and precision >= 0.95


@pytest.mark.parametrize("n", [3, 6, 12, 24])
def test_div_paragraphs_are_kept(n, trees):
    body = "".join(f"<div>{PROSE}</div>" for _ in range(n))
    for wrap in ("<article>{}</article>", "<div class=content>{}</div>", "<div>{}</div>", "<main><section><div>{}</div></section></main>"):
        assert one(f"<body><h1>A day at the river</h1>{wrap.format(body)}</body>", trees).count(PROSE) == n


def test_deep_markup_takes_linear_time(trees):
    took = []
    for n in (5_000, 20_000):
        source = "<body>" + "<font>x</b>" * n
        start = time.perf_counter()
        one(source, trees)
        took.append(time.perf_counter() - start)
    assert took[1] < 10 * took[0] + 1 and took[1] < 30
    for source in ("<b><td>" + "<font></b>" * 20_000, "<p>" * 20_000, "<li><div>" * 20_000, "<table><td>" * 20_000):
        start = time.perf_counter()
        H.parse(source)
        assert time.perf_counter() - start < 5


def test_query_on_its_template(spark):
    sf = "/root/testdata/sf0.001"
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    got = queries.QUERIES["op9_boosted_html_extraction"](spark, sf).collect()
    right = 0
    for r in got:
        body = pages[r["page_id"]].partition("<article>")[2].partition("</article>")[0].replace("<br>", " ")
        blocks = re.split(r"</?(?:p|h1)>", body)
        want = "\n\n".join(t for t in (" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in blocks) if t)
        right += r["text"] == want and r["n_chars"] == len(want)
    assert right >= 0.95 * len(got)


def test_columns(spark):
    rows = [(1, "u", None, "old", 3, "k"), (None, None, f"<article><h1>T t</h1><p>{PROSE}</p><p>{PROSE}</p></article>", None, None, "l")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string, c0 int, n_chars string")
    out = H.extract(pages)
    assert out.columns == ["page_id", "url", "html", "c0", "text", "n_chars"]
    by = {r["page_id"]: r for r in out.collect()}
    assert by[1]["text"] == "" and by[1]["n_chars"] == 0 and by[1]["c0"] == 3
    assert by[None]["text"].endswith(PROSE)
    assert H.extract(pages.limit(0)).count() == 0
