"""Main text of web pages: gradient-boosted trees over DOM nodes with hierarchical decoding.

A tolerant parser turns a page into a flat tree; features of every element (subtree text and link
density, tag and attribute tokens, depth, sibling statistics) go to boosted trees that estimate whether
the element's text is main text. Decoding picks, bottom up, the likeliest consistent labelling: an element
is kept whole, dropped whole, or left to its children, so nothing inside a dropped element is ever kept.

The trees are trained here, in numpy, on pages made by ``training_pages``: layouts drawn at random from
the kinds of containers, notices, menus, adverts, forms and comment sections in use on the web, whose
main text is known. Nothing is learnt from the pages that are extracted.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_right
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.llm.shared import received, sent, slices_of

# fixed values: element names of HTML with a special role for parsing
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = RAW | frozenset("head noscript template svg math canvas object select button audio video map datalist".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary "
    "table tbody td tfoot th thead tr ul".split()
)
CLOSES = {  # an opening tag ends these, if open, up to one of the bounds
    "li": (("li",), ("ul", "ol", "menu", "dir")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "tbody": (("thead", "tbody", "tr", "td", "th"), ("table",)),
    "tfoot": (("thead", "tbody", "tr", "td", "th"), ("table",)),
    "option": (("option",), ("select", "datalist")),
}
SCOPE = frozenset("table td th caption button object body html".split())

KINDS = [  # element names that share a feature
    ("article", "main"), ("nav", "menu"), ("aside",), ("header",), ("footer",), ("form", "fieldset", "label", "legend"),
    ("section",), ("div",), ("p", "blockquote", "pre"), ("h1",), ("h2", "h3", "h4", "h5", "h6"), ("ul", "ol", "dl"),
    ("li", "dd", "dt"), ("table", "tbody", "thead", "tr"), ("td", "th"), ("a",), ("span", "b", "i", "em", "strong", "font"),
    ("figure", "figcaption"), ("body",),
]
TOKENS = [  # words in class, id and role that share a feature
    ("content", "contents", "article", "main", "post", "entry", "story", "body", "text", "page", "articlebody", "prose"),
    ("nav", "navbar", "navigation", "menu", "menubar", "breadcrumb", "breadcrumbs", "crumbs", "topbar", "toc", "pagination", "pager", "tabs"),
    ("ad", "ads", "advert", "adverts", "advertisement", "adbox", "banner", "sponsor", "sponsored", "promo", "promotion", "dfp"),
    ("sidebar", "side", "aside", "rail", "widget", "widgets", "related", "recommended", "trending", "popular", "more", "complementary"),
    ("footer", "foot", "bottom", "copyright", "legal", "contentinfo", "colophon"),
    ("header", "head", "masthead", "branding", "logo", "site", "top", "skip"),
    ("comment", "comments", "reply", "replies", "respond", "disqus", "discussion", "thread", "feedback", "reader", "readers"),
    ("cookie", "cookies", "consent", "gdpr", "notice", "notification", "alert", "popup", "modal", "overlay", "dialog", "privacy", "message"),
    ("share", "sharing", "social", "follow", "tools", "toolbar", "actions", "buttons", "print"),
    ("form", "subscribe", "subscription", "newsletter", "signup", "login", "search", "register", "paywall"),
    ("meta", "byline", "tags", "tag", "category", "date"),
    ("hidden", "none", "print", "sr", "visuallyhidden"),
]
KIND_OF = {t: i for i, group in enumerate(KINDS) for t in group}
TOKEN_OF: dict[str, int] = {}
for _i, _group in enumerate(TOKENS):
    for _t in _group:
        TOKEN_OF.setdefault(_t, _i)

TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>\x00]*)")
ATTRIBUTE = re.compile(r"""[\s/]*([^\s=>/"'][^\s=>/]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]*)))?""")
TAIL = re.compile(r"""(?:[^>"']|"[^"]*"|'[^']*')*>""")
PART = re.compile(r"[A-Za-z]+")


class Page:
    """A parsed page: parallel lists per element, and text runs ``(element, block, text)`` in page order."""

    __slots__ = ("tags", "parent", "depth", "groups", "runs")

    def __init__(self):
        self.tags, self.parent, self.depth, self.groups, self.runs = ["#root"], [-1], [0], [0], []


def _attribute_groups(source: str) -> int:
    """Bits of the token groups in class, id and role; the last bit for hidden elements."""
    bits = 0
    for name, a, b, c in ATTRIBUTE.findall(source):
        name = name.lower()
        if name in ("class", "id", "role", "aria-label"):
            for word in PART.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", html.unescape(a or b or c))):
                if (g := TOKEN_OF.get(word.lower())) is not None:
                    bits |= 1 << g
        elif name == "hidden" or (name == "style" and "display:none" in (a or b or c).replace(" ", "").lower()):
            bits |= 1 << len(TOKENS)
    return bits


def parse(source: str | None) -> Page:
    """Tolerant parse: implied end tags, unclosed and stray tags, comments, raw text and cut-off markup."""
    page, source = Page(), source or ""
    tags, parent, depth, groups, runs = page.tags, page.parent, page.depth, page.groups, page.runs
    stack, unseen, block, at, n = [0], 0, 0, 0, len(source)
    # places in the stack of the open elements of each name, and of those that limit a scope: no tag scans the stack
    places: dict[str, list[int]] = defaultdict(list)
    scopes, has_body = [0], False

    def pop_to(k):
        nonlocal unseen, block
        while len(stack) > k:
            t = tags[stack.pop()]
            places[t].pop()
            if t in SCOPE:
                scopes.pop()
            unseen -= t in UNSEEN
            block += t in BLOCK

    while at < n:
        to = source.find("<", at)
        if to < 0:
            to = n
        if to > at and not unseen:
            runs.append((stack[-1], block, html.unescape(source[at:to])))
        if to >= n:
            break
        if source.startswith("<!--", to):
            end = source.find("-->", to + 4)
            at = n if end < 0 else end + 3
            continue
        if source.startswith(("<!", "<?"), to):
            end = source.find(">", to)
            at = n if end < 0 else end + 1
            continue
        m = TAG.match(source, to)
        if not m:
            if source.startswith("</", to):
                end = source.find(">", to)
                at = n if end < 0 else end + 1
            else:
                if not unseen:
                    runs.append((stack[-1], block, "<"))
                at = to + 1
            continue
        name = m[2].lower()
        end = source.find(">", m.end())
        quoted = end > 0 and ('"' in source[m.end() : end] or "'" in source[m.end() : end])
        if quoted:
            tail = TAIL.match(source, m.end())
            end = tail.end() - 1 if tail else end
        if end < 0:
            break  # a tag that is cut off
        attributes, at = source[m.end() : end], end + 1
        if m[1]:
            if not places[name]:
                block += name in BLOCK
            elif name in BLOCK or scopes[-1] <= places[name][-1]:
                pop_to(places[name][-1])
            continue
        if name == "br":
            if not unseen:
                runs.append((stack[-1], block, " "))
            continue
        if name in BLOCK:
            block += 1
            if places["p"] and places["p"][-1] > scopes[-1]:  # an open paragraph ends where a block begins
                pop_to(places["p"][-1])
        if name in CLOSES:
            ends, bounds = CLOSES[name]
            bound = max((places[t][-1] for t in bounds if places[t]), default=0)
            open_ends = [(places[t], bisect_right(places[t], bound)) for t in ends]
            cut = min((at_[i] for at_, i in open_ends if i < len(at_)), default=None)
            if cut is not None:
                pop_to(cut)
        if name == "body":
            if not has_body and places["head"]:
                pop_to(places["head"][0])
            has_body = True
        if name in VOID:
            continue
        node = len(tags)
        tags.append(name)
        parent.append(stack[-1])
        depth.append(len(stack))
        groups.append(_attribute_groups(attributes) if attributes and attributes != "/" else 0)
        if attributes.endswith("/") and name in ("svg", "path", "use"):
            continue
        if name in RAW:
            close = re.compile(rf"</{name}(?=[\s/>]|$)", re.I).search(source, at)
            at = n if not close else close.start()
        places[name].append(len(stack))
        if name in SCOPE:
            scopes.append(len(stack))
        stack.append(node)
        unseen += name in UNSEEN
    return page


def by_depth(depth: np.ndarray) -> list[np.ndarray]:
    """The nodes of each depth, from one sort."""
    return np.split(np.argsort(depth, kind="stable"), np.cumsum(np.bincount(depth))[:-1])


# ---- features ------------------------------------------------------------------------------------


def features(pages: list[Page]):
    """``(matrix, parent, depth, start of each page)`` over all elements of the pages, vectorised by depth."""
    sizes = np.array([len(p.tags) for p in pages])
    base = np.concatenate(([0], np.cumsum(sizes)[:-1])).astype(np.int64)
    total = int(sizes.sum())
    parent = np.concatenate([np.array(p.parent) + b for p, b in zip(pages, base)]).astype(np.int64)
    parent[base] = -1
    depth = np.concatenate([np.array(p.depth) for p in pages]).astype(np.int64)
    tags = [t for p in pages for t in p.tags]
    kind = np.array([KIND_OF.get(t, len(KINDS)) for t in tags])
    groups = np.concatenate([np.array(p.groups, np.int64) for p in pages])
    own = np.zeros((total, 4))  # characters, words, sentence ends and commas, runs
    for p, b in zip(pages, base):
        for node, _, text in p.runs:
            words = len(text.split())
            if words:
                marks = text.count(".") + text.count(",") + text.count("?") + text.count("!")
                own[b + node] += (len(text), words, marks, 1)
    inside = np.zeros((total, 9))
    inside[:, :4] = own
    link = kind == KIND_OF["a"]
    inside[:, 4] = 1  # elements
    for column, k in ((5, "p"), (6, "li"), (7, "h1")):
        inside[:, column] = kind == KIND_OF[k]
    levels = by_depth(depth)
    for nodes in reversed(levels[1:]):
        linked = nodes[link[nodes]]
        inside[linked, 8] = inside[linked, 0]
        np.add.at(inside, parent[nodes], inside[nodes])
    up, text = np.maximum(parent, 0), inside[:, 0]
    has_up = parent >= 0
    children = np.bincount(up[has_up], minlength=total)
    order = np.zeros(total)  # place among the siblings
    seen = np.zeros(total, np.int64)
    by_parent = np.argsort(up + np.where(has_up, 0, total), kind="stable")
    starts = np.concatenate(([0], np.cumsum(np.bincount(up[by_parent], minlength=total))[:-1]))
    seen[by_parent] = np.arange(total)
    order[has_up] = (seen - starts[up])[has_up]
    whole = np.repeat(text[base], sizes)
    same_kind = np.zeros(total)
    pair = up * 64 + kind
    values, back, count = np.unique(pair[has_up], return_inverse=True, return_counts=True)
    same_kind[has_up] = count[back]
    above_groups, above_kind = np.zeros(total, np.int64), np.zeros((total, 6), bool)
    special = [KIND_OF[k] for k in ("article", "nav", "aside", "header", "footer", "form")]
    for nodes in levels[1:]:
        u = parent[nodes]
        above_groups[nodes] = above_groups[u] | groups[u]
        above_kind[nodes] = above_kind[u]
        for j, k in enumerate(special):
            above_kind[nodes, j] |= kind[u] == k
    columns = [
        np.log1p(text),
        inside[:, 8] / np.maximum(text, 1),
        np.log1p(text / inside[:, 4]),
        inside[:, 2] / np.maximum(inside[:, 1], 1),
        inside[:, 1] / np.maximum(inside[:, 3], 1),
        own[:, 0] / np.maximum(text, 1),
        text / np.maximum(whole, 1),
        text / np.maximum(text[up], 1),
        np.log1p(inside[:, 5]),
        np.log1p(inside[:, 6]),
        np.minimum(inside[:, 7], 3),
        depth.astype(float),
        order,
        order / np.maximum(children[up], 1),
        children[up].astype(float),
        children.astype(float),
        same_kind,
        inside[up, 5],
    ]
    one_hot = [kind == i for i in range(len(KINDS))]
    tokens = [(groups >> i) & 1 for i in range(len(TOKENS) + 1)]
    above = [(above_groups >> i) & 1 for i in range(len(TOKENS))] + list(above_kind.T)
    matrix = np.stack([np.asarray(c, np.float32) for c in [*columns, *one_hot, *tokens, *above]], axis=1)
    return matrix, parent, depth, base, text


# ---- boosted trees ---------------------------------------------------------------------------------


class Boosted:
    """Logistic gradient boosting over binned features; trees of a fixed depth as arrays."""

    def __init__(self, rounds: int = 60, depth: int = 4, rate: float = 0.2, bins: int = 32, penalty: float = 1.0):
        self.rounds, self.depth, self.rate, self.bins, self.penalty = rounds, depth, rate, bins, penalty
        self.trees, self.base = [], 0.0

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> "Boosted":
        edges = [np.unique(np.quantile(c, np.linspace(0, 1, self.bins + 1)[1:-1])) for c in x.T]
        codes = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T)], axis=1)
        share = float(np.clip((weight * y).sum() / weight.sum(), 1e-3, 1 - 1e-3))
        self.base = np.log(share / (1 - share))
        f = np.full(len(y), self.base)
        for _ in range(self.rounds):
            p = 0.5 * np.tanh(0.5 * f) + 0.5
            g, h = weight * (p - y), weight * np.maximum(p * (1 - p), 1e-6)
            feature, cut = np.zeros((1 << self.depth) - 1, np.int64), np.full((1 << self.depth) - 1, np.inf)
            node = np.zeros(len(y), np.int64)
            for level in range(self.depth):
                first, width = (1 << level) - 1, 1 << level
                local = node - first
                best = np.full(width, 1e-6)
                for j, e in enumerate(edges):
                    if not len(e):
                        continue
                    key = local * (len(e) + 1) + codes[:, j]
                    sums = [np.bincount(key, v, width * (len(e) + 1)).reshape(width, -1) for v in (g, h)]
                    left = [np.cumsum(s, axis=1)[:, :-1] for s in sums]
                    full = [s.sum(axis=1, keepdims=True) for s in sums]
                    gain = sum(a**2 / (b + self.penalty) for a, b in (left, (full[0] - left[0], full[1] - left[1])))
                    gain = gain - full[0] ** 2 / (full[1] + self.penalty)
                    at = gain.argmax(axis=1)
                    value = gain[np.arange(width), at]
                    for k in np.nonzero(value > best)[0]:
                        best[k], feature[first + k], cut[first + k] = value[k], j, e[at[k]]
                node = 2 * node + 1 + (x[np.arange(len(y)), feature[node]] > cut[node])
            leaf = node - ((1 << self.depth) - 1)
            value = -self.rate * np.bincount(leaf, g, 1 << self.depth) / (np.bincount(leaf, h, 1 << self.depth) + self.penalty)
            self.trees.append((feature, cut.astype(np.float32), value))
            f += value[leaf]
        return self

    def logit(self, x: np.ndarray) -> np.ndarray:
        f, row = np.full(len(x), self.base), np.arange(len(x))
        for feature, cut, value in self.trees:
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[row, feature[node]] > cut[node])
            f += value[node - len(feature)]
        return f


SPLIT_COST = 4.0


def decode(logit: np.ndarray, parent: np.ndarray, depth: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Kept elements of the likeliest labelling in which every element is kept whole, dropped whole, or left
    to its children (its own direct text then goes by its own estimate), which costs ``SPLIT_COST``."""
    weight = 1 + np.log1p(text)
    keep, drop = weight * np.logaddexp(0, -logit), weight * np.logaddexp(0, logit)
    own = np.minimum(keep, drop)
    mixed = own + SPLIT_COST
    levels = by_depth(depth)
    for nodes in reversed(levels[1:]):
        best = np.minimum(np.minimum(keep[nodes], drop[nodes]), mixed[nodes])
        np.add.at(keep, parent[nodes], keep[nodes])
        np.add.at(drop, parent[nodes], drop[nodes])
        np.add.at(mixed, parent[nodes], best)
    state = np.zeros(len(logit), np.int8)  # 1 kept whole, -1 dropped whole, 0 left to the children
    kept = np.zeros(len(logit), bool)
    for d, nodes in enumerate(levels):
        choice = np.where(keep[nodes] <= np.minimum(drop[nodes], mixed[nodes]), 1, np.where(drop[nodes] <= mixed[nodes], -1, 0))
        if d:
            above = state[parent[nodes]]
            choice = np.where(above != 0, above, choice)
        state[nodes] = choice
        kept[nodes] = (choice == 1) | ((choice == 0) & (logit[nodes] > 0))
    return kept


# ---- training pages ------------------------------------------------------------------------------

MAIN, REST = "\ue000", "\ue001"  # marks at the start of a training page's text runs


def training_pages(count: int, seed: int = 5) -> list[str]:
    """Pages of random layouts; a mark before each text run tells main text from the rest."""
    rng = np.random.default_rng(seed)
    pick = lambda *xs: xs[int(rng.integers(len(xs)))]
    chance = lambda p: rng.random() < p
    syllables = [a + b for a in "bcdfglmnprstv" for b in "aeiou"]

    def words(n):
        return " ".join("".join(syllables[k] for k in rng.integers(len(syllables), size=rng.integers(1, 5))) for _ in range(n))

    def sentences(n):
        left, out = n, []
        while left > 0:
            k = int(min(left, rng.integers(3, 18)))
            s = words(k)
            out.append((s[0].upper() + s[1:]).replace(" ", ", ", int(chance(0.4))) + pick(".", ".", ".", "?", " &amp; co."))
            left -= k
        return " ".join(out)

    def element(tag, names, body):
        label = pick("class", "class", "id")
        head = f' {label}="{pick(*names)}"' if names else ""
        return f"<{tag}{head}>{body}</{tag}>"

    def links(n, tag=None):
        tag = tag or pick("ul", "ul", "div", "p")
        label = lambda: pick(words(int(rng.integers(1, 4))), words(1) + pick(".", ",", " |", "!", "?"), words(1).capitalize() + pick("", "."))
        items = [f'<a href="/{words(1)}">{REST}{label()}</a>' for _ in range(n)]
        return element(tag, [], "".join(f"<li>{x}</li>" for x in items) if tag == "ul" else " | ".join(items))

    def prose(lo, hi, mark=REST):
        return mark + sentences(int(rng.integers(lo, hi)))

    def rest_block():
        group = int(rng.integers(9))
        n = int(rng.integers(2, 9))
        return [
            lambda: element(pick("nav", "nav", "div"), ["nav", "menu", "navbar", "main-menu", "breadcrumbs"], links(n)),
            lambda: f"<nav>{links(n)}</nav>",
            lambda: element("div", ["ad", "ads", "advert", "banner", "sponsored", "promo-box", "ad-slot"], pick(prose(2, 40), f"<p>{prose(2, 40)}</p>")),
            lambda: element("aside", pick([], ["sidebar", "related", "widget"]), pick(links(n), f"<h3>{REST}{words(2)}</h3>" + links(n), f"<p>{prose(4, 50)}</p>")),
            lambda: element("div", ["sidebar", "side", "related-posts", "widget", "trending"], f"<h4>{REST}{words(2)}</h4>" + pick(links(n), f"<p>{prose(4, 40)}</p>")),
            lambda: element(pick("div", "section"), ["cookie-notice", "cookies", "consent", "notice", "alert", "gdpr-banner", "modal"], f"<p>{prose(5, 40)}</p>" + pick("", f"<a href='#'>{REST}{words(1)}</a>")),
            lambda: element("form", pick([], ["newsletter", "subscribe", "search", "login"]), f"<label>{REST}{words(2)}</label><input name=q>" + pick("", f"<p>{prose(4, 25)}</p>")),
            lambda: element("div", ["share", "social", "toolbar", "follow-us"], links(int(rng.integers(2, 5)), "div")),
            lambda: element("div", ["newsletter", "signup", "subscribe-box"], f"<p>{prose(4, 25)}</p><form><input></form>"),
        ][group]()

    def comments():
        box = "".join(
            element(pick("div", "li", "article"), pick(["comment"], ["comment-body"], ["reply"]), f"<b>{REST}{words(1)}</b><p>{prose(3, 80)}</p>")
            for _ in range(int(rng.integers(1, 8)))
        )
        return element(pick("section", "div", "ol"), ["comments", "comment-list", "disqus", "discussion", "reader-comments"], f"<h3>{REST}{words(2)}</h3>{box}")

    def named(tag, body, names=()):
        """An element without attributes, with a class of the page's own or one of ``names``."""
        label = pick("", "", words(1), words(1) + "-" + words(1), f"css-{words(1)}", *names)
        return f"<{tag} class={label}>{body}</{tag}>" if label else f"<{tag}>{body}</{tag}>"

    def styled(text, style):
        """A paragraph in the page's own way of writing one."""
        if style == "any":
            style = pick("p", "div", "nested", "span")
        if style == "div":
            return named("div", text, ["paragraph", "text", "para"])
        if style == "nested":
            return named(pick("div", "section"), named("div", text))
        if style == "span":
            return named(pick("div", "p"), named("span", text))
        if style == "bare":
            return text + pick("<br><br>", "<br>\n<br>", "<br><p>")
        if style == "cell":
            return f"<table><tr><td>{text}</td></tr></table>"
        return f"<p>{text}</p>" if chance(0.8) else named("p", text)

    def paragraph(style):
        n = int(pick(1, 2, 4, 8, 20, 50, 90, 140))
        text = MAIN + sentences(max(1, int(rng.integers(n, 2 * n + 1))))
        if chance(0.2):
            cut = text.rfind(" ", 0, len(text) // 2)
            text = f"{text[: max(cut, 1)]} {pick('<b>', '<em>', '<a href=/x>')}{MAIN}{words(2)}{pick('</b>', '</em>', '</a>')}{MAIN}{text[max(cut, 1):].replace(MAIN, '')}"
        form = int(rng.integers(12))
        if form == 0 and style == "p":
            return f"<p><b>{text}<br>"
        if form == 1:
            return element(pick("ul", "ol"), [], "".join(f"<li>{MAIN}{words(int(rng.integers(1, 14)))}</li>" for _ in range(int(rng.integers(2, 6)))))
        if form == 2:
            return f"<h2>{MAIN}{words(int(rng.integers(1, 7)))}</h2>" + styled(text, style)
        if form == 3:
            return f"<blockquote>{styled(text, pick('bare', style)).replace('<br>', '')}</blockquote>"
        if form == 4 and style == "p":
            return f"<p>{text}"
        if form == 5 and chance(0.4):
            return f"<pre>{text}</pre>"
        if form == 6 and chance(0.4):
            return "<table>" + "".join(f"<tr><td>{MAIN}{words(2)}<td>{MAIN}{words(3)}" for _ in range(3)) + "</table>"
        return styled(text, style)

    def small_print():
        text = pick(f"&copy; {words(2)} &middot; {sentences(int(rng.integers(1, 16)))}", f"Copyright {words(2)}. {sentences(int(rng.integers(1, 9)))}", f"&copy; 20{words(1)} {words(2)}")
        return REST + text

    def article_frame(title, body):
        """Title and text of an article, at times with a header and a footer of its own."""
        byline = pick("", "", f'<div class="{pick("byline", "meta", "post-meta", "date")}">{REST}{words(3)}</div>', f"<p class=byline>{REST}{words(3)}</p>")
        if chance(0.25):
            title, byline = f"<header>{title}{byline}</header>", ""
        last = pick("", "", "", f"<footer>{REST}{words(2)}: {links(int(rng.integers(1, 4)), 'div')}</footer>", f"<footer><p>{REST}{words(3)} <a href=/t>{REST}{words(1)}</a></p></footer>",
                    element("div", ["tags", "post-tags", "categories"], f"{REST}{words(2)}: {links(2, 'div')}"))
        return f"{title}{byline}{body}{last}"

    #: names on main text that share a word with other parts of a page
    misleading = ["post-header-image", "with-sidebar", "has-sidebar", "no-ads", "page-top", "header-content", "main-column", "site-content", "side-by-side", "content-footer-gap", "more-text"]

    pages = []
    for _ in range(count):
        style = pick("p", "p", "p", "p", "p", "div", "div", "nested", "span", "bare", "cell", "any")
        body = [paragraph(style) for _ in range(int(pick(1, 2, 3, 4, 6, 9, 14, 24)))]
        for _ in range(int(pick(0, 0, 0, 1, 2))):
            body.insert(int(rng.integers(len(body) + 1)), rest_block())
        title = f"<h1>{MAIN}{words(int(rng.integers(1, 12)))}</h1>" if chance(0.85) else ""
        inner = article_frame(title, "".join(body))
        for _ in range(int(pick(0, 0, 0, 1, 1, 2))):
            inner = named(pick("div", "div", "section"), inner, ["inner", "row", "col", *([pick(*misleading)] if chance(0.5) else [])])
        wrap = int(rng.integers(10))
        if wrap < 3:
            inner = f"<article>{inner}</article>"
        elif wrap == 3:
            inner = f"<main>{pick(inner, f'<article>{inner}</article>')}</main>"
        elif wrap == 4:
            inner = element("div", ["content", "main-content", "post", "article-body", "entry-content", "story"], inner)
        elif wrap == 5:
            inner = element("section", pick([], ["content", "article"]), inner)
        elif wrap == 6:
            inner = element("div", [], inner)
        elif wrap == 7:
            inner = named("div", inner, misleading)
        elif wrap == 8 and style != "bare":
            inner = f"<main>{named('section', named('div', inner))}</main>"
        before = [rest_block() for _ in range(int(rng.integers(0, 4)))]
        after = [rest_block() for _ in range(int(rng.integers(0, 3)))]
        if chance(0.5):
            banner = f"{pick('', f'<h2>{REST}{words(2)}</h2>')}{links(4)}{pick('', f'<p>{prose(2, 9)}</p>')}"
            slogan = f"{pick('', f'<a href=/>{REST}{words(2)}</a>')}<p>{prose(2, 25)}</p>"
            place = pick("header", "header", "div")
            names = ["header", "masthead", "site-header"] if place == "div" or chance(0.6) else []
            before.insert(0, element(place, names, banner if chance(0.65) else slogan))
        if chance(0.3):
            after.append(comments())
        if chance(0.8):
            small = small_print()
            after.append(pick(f"<footer>{small}</footer>", f"<footer><p>{small}</p>{links(3)}</footer>", element("div", ["footer", "bottom", "copyright"], small), named("div", small)))
        if chance(0.08):  # a page laid out as a table
            side = "".join(before) or links(4, "div")
            row = pick(f"<tr><td>{side}</td><td>{inner}</td></tr>", f"<tr><td>{inner}</td><td>{side}</td></tr>", f"<tr><td>{side}</td></tr><tr><td>{inner}</td></tr>")
            inner, before, after = f"<table>{row}<tr><td>{small_print()}</td></tr></table>", [], after[:-1]
        middle = "".join(before) + inner + "".join(after)
        if chance(0.25):
            middle = element("div", pick([], ["wrapper", "container", "page"]), middle)
        head = f"<head><title>{words(4)}</title><style>p{{margin:0}}</style><script>var a='<p>';</script></head>"
        pages.append(f"<!DOCTYPE html><html>{head}<body>{middle}{pick('', '</body></html>')}")
    return pages


def train(pages: int = 600, seed: int = 5) -> Boosted:
    """Trees fitted to the elements of the training pages that hold text; an element is main if most of its
    text is."""
    parsed, main = [], []
    for source in training_pages(pages, seed):
        page = parse(source)
        good = np.zeros((len(page.tags), 2))
        clean = []
        for node, block, text in page.runs:
            n = len(text.split())
            is_main = text.lstrip().startswith(MAIN)
            good[node] += (n if is_main else 0, n)
            clean.append((node, block, text.replace(MAIN, "").replace(REST, "")))
        page.runs = clean
        for node in range(len(page.tags) - 1, 0, -1):
            good[page.parent[node]] += good[node]
        parsed.append(page)
        main.append(good)
    x, _, _, _, _ = features(parsed)
    good = np.concatenate(main)
    share = good[:, 0] / np.maximum(good[:, 1], 1)
    use = good[:, 1] > 0
    clear = np.abs(share - 0.5) * 2
    return Boosted().fit(x[use], (share[use] > 0.5).astype(float), (0.1 + clear[use]))


# ---- extraction ------------------------------------------------------------------------------------


def main_texts(sources: list[str | None], trees: Boosted) -> list[str]:
    """Main text of each page: blocks in page order, white space folded, joined by an empty line."""
    pages = [parse(s) for s in sources]
    if not pages:
        return []
    x, parent, depth, base, text = features(pages)
    kept = decode(trees.logit(x), parent, depth, text)
    result = []
    for page, b in zip(pages, base):
        blocks: dict[int, list[str]] = {}
        for node, block, run in page.runs:
            if kept[b + node]:
                blocks.setdefault(block, []).append(run)
        folded = (" ".join("".join(runs).split()) for runs in blocks.values())
        result.append("\n\n".join(t for t in folded if t))
    return result


def extract(
    pages: DataFrame, id_col: str = "page_id", html_col: str = "html", train_pages: int = 600, batch_chars: int = 2_000_000
) -> DataFrame:
    """All columns of ``pages`` and ``text``, ``n_chars`` (code points), in place of columns of these names.

    A null or empty page, and one whose text is all menus and the like, has an empty text. Null and repeated
    ids are carried along like other columns; an empty table gives an empty result. Memory is bounded by
    ``batch_chars`` of markup and the longest page.
    """
    trees = sent(pages.sparkSession, train(train_pages))
    names = [c for c in pages.columns if c not in ("text", "n_chars") or c in (id_col,)]
    rows = pages.select(
        *[F.col(c).alias(f"c{i}") for i, c in enumerate(names)], F.col(html_col).cast("string").alias("__html")
    )
    carried = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.drop("__html").schema)

    def run(batches):
        model = received(trees)
        for batch in batches:
            texts, held, size = [], [], 0
            for s in (s for part in slices_of(batch, batch.num_columns - 1) for s in part):
                held.append(s)
                size += len(s or "")
                if size >= batch_chars:
                    texts += main_texts(held, model)
                    held, size = [], 0
            texts += main_texts(held, model)
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            columns += [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:-1], "text", "n_chars"])

    found = rows.mapInArrow(run, f"{carried}, text string, n_chars bigint")
    return found.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)], "text", "n_chars")
