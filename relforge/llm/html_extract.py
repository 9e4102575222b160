"""Main text of web pages by a tree-structured graphical model over the DOM (operator 7).

Every element and text of a page is a binary variable: content or not. A node has a potential from its
features (tag, words of class, id and role, share of link text, length, punctuation, hidden), and each
parent-child edge a 2 x 2 potential by the kind of child (section, block, inline, text). The graph is the
tree itself, so sum-product message passing once upward and once downward gives exact marginals. Texts
whose content marginal is at least one half make the main text.

Training. Pages that mark their article or main part label themselves: text in it, outside of parts that
are named as something else, is content. ``fit`` maximises the likelihood of at most ``MAX_PAGES`` such
pages (the smallest hashes of their id, up to ``MAX_CHARS`` characters each) by gradient steps on the
model's own marginals. On every second page the sectioning tags are hidden from the features, so that
the model also learns to read pages without them. The weights start from fixed expectations about tags
and names, and are pulled towards them, so a name that no training page has keeps its expectation. A name
on a container decides (a menu, a notice, comments), and so what stands within it; on a paragraph, caption or address
only names of adverts, sharing, comments and the like do, others are weighed against the length and the marks of its words. The
bounds are parameters; extraction covers all pages, whole.

The text: character references decoded, white space inside a block one space, blocks joined in page order
by one space; a line break counts as white space. Scripts, styles, form controls and the like are never
text. Defined results: null or empty html gives an empty text; markup that never ends is read to the
end; rows repeat as given; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import col, slices
from .dom import INLINE, MUTE, SECTIONS, Page, attributes, parse, tokens

MAX_PAGES, MAX_CHARS = 300, 100_000
EPOCHS, RATE, PULL, EDGE_PULL = 12, 0.25, 0.01, 0.1

# Expectations about tags and about words of class, id and role (fixed values).
NOT_CONTENT_WORDS = """ad ads advert adverts advertisement banner promo promotion sponsor sponsored sidebar menu nav navbar navigation
breadcrumb breadcrumbs footer header masthead topbar cookie cookies consent gdpr notice alert popup modal newsletter subscribe
subscription share sharing social related recommended recommendations trending comment comments reply replies discussion disqus
respond pagination pager outbrain taboola copyright contentinfo complementary""".split()
DOUBTFUL_WORDS = "side popular overlay signup login register search widget widgets toolbar legal tags tagcloud hidden skip teaser dialog form meta".split()
CONTENT_WORDS = "article content main post entry story body text page prose".split()
#: Of the first, names that decide on a paragraph too; the others may name one that is about an alert, a board or a footer.
DECIDING_WORDS = frozenset("""ad ads advert adverts advertisement promo promotion sponsor sponsored cookie cookies consent gdpr newsletter subscribe
share social breadcrumb breadcrumbs comment comments disqus pagination pager outbrain taboola copyright contentinfo""".split())
NOT_CONTENT_TAGS = "nav footer header aside form menu dialog label fieldset legend input".split()
#: Parts of running text; a name on one of them weighs against its words, a name on any other part decides.
PROSE_TAGS = frozenset("p blockquote pre li dd dt td th h1 h2 h3 h4 h5 h6 figcaption address".split())
CONTENT_TAGS = "article main h1 h2 h3 p blockquote pre".split()
_WORD_PRIOR = {**{w: -14.0 for w in NOT_CONTENT_WORDS}, **{w: -4.0 for w in DOUBTFUL_WORDS}, **{w: 1.0 for w in CONTENT_WORDS}}
_TAG_PRIOR = {**{t: -12.0 for t in NOT_CONTENT_TAGS}, **{t: 0.7 for t in CONTENT_TAGS}, "article": 5.0, "main": 4.0, "body": 1.0, "#root": 3.0}
KINDS = ("section", "block", "inline", "text")
#: Edge expectations, rows: parent not content / content, columns: child. A part that is no content says
#: little about the block it stands in, content says much.
_EDGE = {"section": ((0.5, -1.5), (0.5, 0.5)), "block": ((1.0, -2.0), (0.0, 2.0)), "inline": ((2.5, -2.5), (-2.5, 2.5)), "text": ((3.5, -3.5), (-3.5, 3.5))}
_LIMIT = 30.0


def prior(feature: str) -> float:
    kind, _, name = feature.partition(":")
    if kind == "tag":
        return _TAG_PRIOR.get(name, 0.0)
    if kind == "word":
        return _WORD_PRIOR.get(name, 0.0)
    if kind == "named":  # a name on a part of running text
        return -14.0 if name in DECIDING_WORDS else max(-6.5, _WORD_PRIOR.get(name, 0.0) / 2)
    return {"hidden": -14.0, "copyright": -6.0, "prose": 4.5, "within": -5.0}.get(kind, 0.0)


def _is_prose(length: int, marks: int) -> bool:
    """Whether a named paragraph is long enough, and punctuated, to be one of the text."""
    return length >= 60 and marks >= 2


def kind_of(tag: str) -> str:
    return "text" if tag == "#" else "section" if tag in SECTIONS else "inline" if tag in INLINE else "block"


class Weights:
    """Feature weights (their expectation unless learned) and edge potentials by kind of child."""

    def __init__(self) -> None:
        self.node: dict[str, float] = {}
        self.edge = {k: [list(row) for row in e] for k, e in _EDGE.items()}

    def of(self, feature: str) -> float:
        value = self.node.get(feature)
        if value is None:
            value = self.node[feature] = prior(feature)
        return value

    def tables(self) -> dict[str, tuple]:
        return {k: tuple(math.exp(x) for row in e for x in row) for k, e in self.edge.items()}


def _level(n: int) -> int:
    return min(n.bit_length(), 10)


def features(page: Page, hide_sections: bool = False) -> tuple[list[list[str]], list[bool]]:
    """Features of each node, and whether it is mute (no text of the page, whatever the model says)."""
    size = len(page.tag)
    length, linked, marks, parts = [0] * size, [0] * size, [0] * size, [0] * size
    for i in range(size - 1, 0, -1):
        p = page.parent[i]
        parts[p] += page.tag[i] != "#" or not page.text[i].isspace()
        if page.tag[i] == "#":
            text = page.text[i].strip()
            length[i] = len(text)
            marks[i] = sum(map(text.count, ".,;!?"))
        elif page.tag[i] == "a":
            linked[i] = length[i]
        if page.tag[i] not in MUTE:
            length[p] += length[i]
            linked[p] += linked[i]
            marks[p] += marks[i]
    names = [tokens(attributes(page.attrs[i])) if page.tag[i] != "#" and page.attrs[i].strip() else [] for i in range(size)]
    heads = [tag == "h1" or (tag in ("article", "main") and not hide_sections) for tag in page.tag]
    for i in range(size - 1, 0, -1):
        heads[page.parent[i]] = heads[page.parent[i]] or heads[i]
    # inside a part that is named as something else, unless the article's own head is in it too
    within = [False] * size
    found, mute = [], [False] * size
    for i, tag in enumerate(page.tag):
        p = page.parent[i]
        mute[i] = tag in MUTE or (p >= 0 and mute[p])
        if p >= 0:
            within[i] = within[p] or (not heads[p] and page.tag[p] not in PROSE_TAGS and any(_WORD_PRIOR.get(w, 0.0) <= -14.0 for w in names[p]))
        if tag == "#":
            own = [f"words:{_level(page.text[i].count(' '))}", f"ends:{page.text[i].rstrip()[-1:] in '.!?:;'}"]
            found.append([*own, "copyright:"] if "©" in page.text[i] or "&copy;" in page.text[i] else own)
            continue
        shown = "div" if hide_sections and tag in SECTIONS else tag
        # a mere wrapper of one part has nothing to say of its own, however many are nested
        own = [] if parts[i] == 1 and shown == "div" else [f"tag:{shown}", f"length:{_level(length[i] // 16)}", f"links:{4 * linked[i] // max(1, length[i])}", f"marks:{min(3, 40 * marks[i] // max(1, length[i]))}"]
        if page.attrs[i].strip():
            attrs = attributes(page.attrs[i])
            own += [f"{'named' if tag in PROSE_TAGS else 'word'}:{w}" for w in dict.fromkeys(names[i])]
            if tag in PROSE_TAGS and any(_WORD_PRIOR.get(w, 0.0) <= -14.0 for w in names[i]) and _is_prose(length[i], marks[i]):
                own.append("prose:")
            style = attrs.get("style", "").replace(" ", "").lower()
            if "hidden" in attrs or attrs.get("aria-hidden") == "true" or "display:none" in style or "visibility:hidden" in style:
                own.append("hidden:")
        if within[i]:
            own.append("within:")
        found.append(own)
    return found, mute


def sum_product(page: Page, unary: list[float], tables: dict[str, tuple]) -> tuple[list[float], list[float], list[float]]:
    """Log odds of content of each node, and for its edge the odds below (without the parent) and above.

    Messages go up in reverse document order and down in document order; no recursion, any depth.
    """
    exp, log = math.exp, math.log
    size, parent, tag = len(page.tag), page.parent, page.tag
    table = [tables[kind_of(t)] for t in tag]
    below, message = unary[:], [0.0] * size
    for i in range(size - 1, 0, -1):
        a00, a01, a10, a11 = table[i]
        u = below[i] = max(-_LIMIT, min(_LIMIT, below[i]))
        e = exp(u)
        message[i] = m = log((a10 + a11 * e) / (a00 + a01 * e))
        below[parent[i]] += m
    odds, above = below[:], [0.0] * size
    for i in range(1, size):
        a00, a01, a10, a11 = table[i]
        d = above[i] = max(-_LIMIT, min(_LIMIT, odds[parent[i]] - message[i]))
        e = exp(d)
        odds[i] = below[i] + log((a01 + a11 * e) / (a00 + a10 * e))
    return odds, below, above


def _unary(found: list[list[str]], mute: list[bool], weights: Weights) -> list[float]:
    known, of = weights.node, weights.of
    return [-_LIMIT if m else sum([known[f] if f in known else of(f) for f in own]) for own, m in zip(found, mute, strict=True)]


_BREAKS = frozenset(["br", "hr"])


def content(page: Page, odds: list[float], mute: list[bool]) -> str:
    out: list[str] = []
    closing: list[int] = []  # ends of open blocks
    for i, tag in enumerate(page.tag):
        while closing and closing[-1] < i:
            closing.pop()
            out.append("\n")
        if tag == "#":
            if not mute[i] and odds[i] >= 0:
                out.append(page.text[i])
        elif tag in _BREAKS:
            out.append("\n")
        elif tag not in INLINE:
            out.append("\n")
            closing.append(page.end[i])
    return " ".join("".join(out).split())


def extract(html: str | None, weights: Weights, tables: dict[str, tuple] | None = None) -> str:
    if not html:
        return ""
    page = parse(html)
    found, mute = features(page)
    odds, _, _ = sum_product(page, _unary(found, mute, weights), tables or weights.tables())
    return content(page, odds, mute)


def labels(page: Page) -> list[int] | None:
    """Content labels of a page that marks its article or main part; None where it doesn't."""
    size = len(page.tag)
    inside, label = [0] * size, [0] * size
    marked = False
    share = [0] * size
    length, marks = [0] * size, [0] * size
    for i in range(size - 1, 0, -1):
        if page.tag[i] == "#":
            length[i], marks[i] = len(page.text[i].strip()), sum(map(page.text[i].count, ".,;!?"))
        length[page.parent[i]] += length[i]
        marks[page.parent[i]] += marks[i]
    for i in range(1, size):
        tag, p = page.tag[i], page.parent[i]
        inside[i] = inside[p]
        if tag in ("article", "main"):
            inside[i], marked = 1, True
        elif tag != "#" and inside[i]:
            names = tokens(attributes(page.attrs[i])) if page.attrs[i].strip() else []
            doubt = {w for w in names if _WORD_PRIOR.get(w, 0) < 0}
            if tag in PROSE_TAGS and not doubt & DECIDING_WORDS and _is_prose(length[i], marks[i]):
                doubt = set()
            if tag in MUTE or tag in ("nav", "aside", "form", "footer") or doubt:
                inside[i] = 0
    if not marked:
        return None
    for i in range(size - 1, 0, -1):
        if page.tag[i] == "#":
            label[i] = inside[i]
            n = len(page.text[i].strip())
            share[i] = n if inside[i] else -n
        else:
            label[i] = int(share[i] > 0 or (share[i] == 0 and inside[i]))
        share[page.parent[i]] += share[i]
    label[0] = int(share[0] > 0)
    return label


def fit_pages(pages: list[str]) -> Weights:
    """Maximum likelihood on self-labelled pages, by gradient steps on tree marginals."""
    weights = Weights()
    data = []
    for k, html in enumerate(pages):
        page = parse(html)
        gold = labels(page)
        if gold:
            data.append((page, gold, *features(page, hide_sections=k % 2 == 1)))
    total: dict = defaultdict(lambda: 1.0)
    order = np.random.default_rng(7)
    for epoch in range(EPOCHS if data else 0):
        rate = RATE / (1 + 0.3 * epoch)
        for k in order.permutation(len(data)):
            page, gold, found, mute = data[k]
            tables = weights.tables()
            odds, below, above = sum_product(page, _unary(found, mute, weights), tables)
            step: dict = defaultdict(float)
            for i in range(len(page.tag)):
                if mute[i]:
                    continue
                miss = gold[i] - 1 / (1 + math.exp(-max(-_LIMIT, min(_LIMIT, odds[i]))))
                for f in found[i]:
                    step[f] += miss
                if i:
                    kind = kind_of(page.tag[i])
                    a, u, d = tables[kind], math.exp(below[i]), math.exp(above[i])
                    pair = (a[0], a[1] * u, a[2] * d, a[3] * d * u)
                    z = sum(pair)
                    for cell in range(4):
                        step[kind, cell] += (2 * gold[page.parent[i]] + gold[i] == cell) - pair[cell] / z
            for f, g in step.items():
                if isinstance(f, tuple):
                    kind, cell = f
                    g -= EDGE_PULL * (weights.edge[kind][cell // 2][cell % 2] - _EDGE[kind][cell // 2][cell % 2])
                    total[f] += g * g
                    weights.edge[kind][cell // 2][cell % 2] += rate * g / math.sqrt(total[f])
                else:
                    g -= PULL * (weights.of(f) - prior(f))
                    total[f] += g * g
                    weights.node[f] += rate * g / math.sqrt(total[f])
    return weights


def fit(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", max_pages: int = MAX_PAGES, max_chars: int = MAX_CHARS) -> Weights:
    """The model of a bounded sample of the pages that mark their article or main part."""
    html = col(html_col).cast("string")
    marked = pages.select(col(id_col).cast("string").alias("id"), html.alias("html")).where(
        (F.length("html") <= max_chars) & F.col("html").rlike(r"(?i)<(?:article|main)[\s>]"))
    # ids first, so that the sort moves no pages; max_pages rows at most are read to the driver
    ids = marked.select("id", F.xxhash64("html").alias("h")).orderBy("h", "id").limit(max_pages)
    sample = marked.withColumn("h", F.xxhash64("html")).join(F.broadcast(ids), ["id", "h"])
    rows = sorted({r.html for r in sample.select("html").collect()})
    return fit_pages(rows)


def extract_pages(pages: DataFrame, weights: Weights, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per row: page_id, url, text, n_chars."""
    given = pages.select(col(id_col).alias("page_id"), col(url_col).cast("string").alias("url"), col(html_col).cast("string").alias("html"))
    id_type = given.schema["page_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = weights.tables()
        for batch in slices(batches):
            texts = [extract(h, weights, tables) for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    return given.mapInArrow(run, f"page_id {id_type}, url string, text string, n_chars long")
