"""Main text of web pages from flat text blocks and a decision tree.

A page is cut at every tag that is not inline into a flat list of text
blocks. A block's features are its word count and link density, those of
the block before and after it, whether it lies in an article, in a
boilerplate element (menu, footer, form ...) or in an element whose class or
id names one (advert, comments, cookie notice ...; its own element counts, an
inline one if it holds all words of the block), whether it is a heading, and,
outside articles, what share of the page's words its articles hold. A decision
tree trained by Spark on the small table LABELLED says which blocks are the
article: inside article elements it keeps all that is not named otherwise,
linked paragraphs too; on pages of plain elements it goes by word counts and
link densities of a block and its neighbours. The tree has a few nodes and goes to the tasks
as a nested tuple; pages are then read one by one, whole.

Defined results: a null or empty page has the text ``""``; unclosed and
truncated markup is read to its end; comments, scripts, styles and titles are
no blocks; repeated rows are read one by one; an empty table gives an empty
result; further columns are carried along, those named like a result column
are replaced.
"""
from __future__ import annotations

import html
import re
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterable

import pandas as pd
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finlake.llm.common import fresh_names

INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code del dfn em font i img ins kbd mark q s samp small span strike strong "
    "sub sup time tt u var wbr".split())
SKIPPED = frozenset("script style noscript template title svg math iframe object textarea select head-title".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BOILER = frozenset("nav footer aside form menu dialog button fieldset".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements whose end tag may be missing: what starts of them end, up to the nearest of the others.
ENDS = {"li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th", "table"),
        "td": ("td th", "tr table"), "th": ("td th", "tr table"), "option": ("option", "select datalist optgroup")}
ENDS = {tag: (frozenset(ended.split()), frozenset(within.split())) for tag, (ended, within) in ENDS.items()}
ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl dt dd fieldset figcaption figure footer form h1 h2 h3 h4 h5 "
    "h6 header hgroup hr li main menu nav ol p pre search section table ul".split())
P_WITHIN = frozenset("td th caption button table".split())
HINT = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisement|banner|breadcrumbs?|comments?|consent|cookies?|disqus|footer|header|menu|"
    r"modal|nav|navbar|navigation|newsletter|notice|popup|promo|related|replies|respond|share|sharing|sidebar|social|"
    r"sponsor(?:ed)?|subscribe|toolbar|widget)(?:$|[\s_-])", re.I)
_token = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:"[^"]*"|'[^']*'|[^'">])*)(?:>|\Z)""", re.S)
_named = re.compile(r"""\b(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)

FEATURES = ["words", "density", "words_before", "density_before", "words_after", "density_after", "article", "marked", "heading", "elsewhere"]
#: A hand-labelled page per list; rows: words, link density, in an article, in
#: a boilerplate element, named as one, heading, is main text.
LABELLED = [
    [(1, 1, 0, 1, 0, 0, 0), (1, 1, 0, 1, 0, 0, 0), (2, 1, 0, 1, 0, 0, 0), (8, 0, 0, 0, 1, 0, 0), (9, 0, 1, 0, 0, 1, 1),
     (60, 0, 1, 0, 0, 0, 1), (2, 0, 1, 0, 0, 0, 1), (120, 0.05, 1, 0, 0, 0, 1), (30, 0, 1, 0, 0, 0, 1), (12, 0.1, 0, 1, 0, 0, 0)],
    [(40, 0, 0, 0, 1, 0, 0), (6, 0, 1, 0, 0, 1, 1), (3, 0, 1, 0, 0, 0, 1), (1, 0, 1, 0, 0, 0, 1), (200, 0, 1, 0, 0, 0, 1),
     (25, 0, 0, 0, 1, 0, 0), (70, 0, 0, 0, 1, 0, 0), (5, 0, 0, 1, 0, 0, 0)],
    [(3, 1, 0, 0, 0, 0, 0), (2, 1, 0, 0, 0, 0, 0), (2, 1, 0, 0, 0, 0, 0), (7, 0, 0, 0, 0, 1, 1), (55, 0.02, 0, 0, 0, 0, 1),
     (4, 0, 0, 0, 0, 0, 1), (80, 0, 0, 0, 0, 0, 1), (35, 0.1, 0, 0, 0, 0, 1), (6, 0.5, 0, 0, 0, 0, 0), (3, 1, 0, 0, 0, 0, 0)],
    [(4, 0, 0, 1, 0, 0, 0), (10, 0.9, 0, 1, 0, 0, 0), (8, 0, 1, 0, 0, 1, 1), (14, 0.6, 1, 0, 0, 0, 1), (22, 0, 1, 1, 0, 0, 0),
     (18, 0, 1, 0, 1, 0, 0), (45, 0, 1, 0, 0, 0, 1), (5, 1, 1, 0, 1, 0, 0), (3, 1, 1, 1, 0, 0, 0), (20, 0, 0, 1, 0, 0, 0)],
    [(5, 0.8, 0, 0, 0, 0, 0), (4, 1, 0, 0, 0, 0, 0), (30, 0, 0, 0, 0, 0, 1), (28, 0, 0, 0, 0, 0, 1), (9, 0, 0, 0, 0, 1, 1),
     (64, 0.05, 0, 0, 0, 0, 1), (12, 0.9, 0, 0, 0, 0, 0), (10, 0.8, 0, 0, 0, 0, 0), (60, 0, 0, 0, 1, 0, 0), (50, 0, 0, 1, 0, 0, 0)],
    [(2, 0, 0, 0, 1, 0, 0), (90, 0, 0, 1, 0, 0, 0), (2, 0, 1, 0, 0, 1, 1), (1, 1, 1, 0, 0, 0, 1), (4, 0.5, 1, 0, 0, 0, 1),
     (150, 0, 1, 0, 0, 0, 1), (90, 0.02, 1, 0, 1, 0, 0), (40, 0, 1, 1, 0, 0, 0), (6, 0, 0, 1, 1, 0, 0)],
    [(7, 0, 1, 0, 0, 1, 1), (52, 0, 1, 0, 0, 0, 1), (34, 0, 1, 0, 1, 0, 0), (48, 0, 1, 0, 0, 0, 1), (3, 0, 1, 0, 1, 1, 0)],
    # plain elements without a name: menu, notice, the article, reader comments, copyright
    [(6, 1, 0, 0, 0, 0, 0), (11, 0, 0, 0, 0, 0, 0), (7, 0, 0, 0, 0, 1, 1), (62, 0, 0, 0, 0, 0, 1), (5, 0, 0, 0, 0, 0, 1),
     (80, 0.05, 0, 0, 0, 0, 1), (33, 0.4, 0, 0, 0, 0, 1), (48, 0, 0, 0, 0, 0, 1), (14, 0, 0, 0, 0, 0, 0), (9, 0, 0, 0, 0, 0, 0), (6, 0, 0, 0, 0, 0, 0)],
    [(5, 1, 0, 0, 0, 0, 0), (5, 0.8, 0, 0, 0, 0, 0), (14, 0.1, 0, 0, 0, 0, 0), (9, 0, 0, 0, 0, 1, 1), (41, 0, 0, 0, 0, 0, 1), (4, 0, 0, 0, 0, 1, 1),
     (90, 0, 0, 0, 0, 0, 1), (22, 0.3, 0, 0, 0, 0, 1), (36, 0, 0, 0, 0, 0, 1), (3, 0, 0, 0, 0, 0, 0), (13, 0, 0, 0, 0, 0, 0), (2, 0, 0, 0, 0, 0, 0),
     (12, 0, 0, 0, 0, 0, 0), (8, 0.2, 0, 0, 0, 0, 0)],
    [(4, 0, 0, 0, 0, 0, 0), (3, 1, 0, 0, 0, 0, 0), (70, 0, 0, 0, 0, 0, 1), (6, 0, 0, 0, 0, 0, 1), (55, 0, 0, 0, 0, 0, 1), (4, 1, 0, 0, 0, 0, 0), (5, 0, 0, 0, 0, 0, 0)],
    # a page that is one block
    [(4, 0, 0, 0, 0, 0, 1)], [(15, 0, 0, 0, 0, 0, 1)], [(9, 0, 0, 0, 0, 1, 1)], [(300, 0, 0, 0, 0, 0, 1)], [(3, 1, 0, 0, 0, 0, 0)],
    # an article with linked paragraphs, unnamed lines around it
    [(6, 0.5, 0, 0, 0, 0, 0), (12, 0, 0, 0, 0, 0, 0), (8, 0, 1, 0, 0, 1, 1), (4, 0.75, 1, 0, 0, 0, 1), (6, 1, 1, 0, 0, 0, 1), (58, 0.1, 1, 0, 0, 0, 1),
     (2, 1, 1, 0, 0, 0, 1), (3, 0, 1, 0, 0, 0, 1), (30, 0, 0, 0, 0, 0, 0), (21, 0, 0, 0, 0, 0, 0), (9, 0, 0, 0, 0, 0, 0)],
    [(26, 0, 0, 0, 0, 0, 0), (45, 0, 1, 0, 0, 0, 1), (20, 0.9, 1, 0, 0, 0, 1), (5, 0, 1, 0, 0, 0, 1), (38, 0, 0, 0, 0, 0, 0), (7, 0, 0, 0, 0, 1, 0), (24, 0.1, 0, 0, 0, 0, 0)],
    # asides, forms, adverts and comments between the paragraphs of an article, linked lists in it
    [(30, 0.9, 0, 1, 0, 0, 0), (52, 0, 0, 0, 1, 0, 0), (9, 0, 1, 0, 0, 1, 1), (70, 0, 1, 0, 0, 0, 1), (26, 0, 1, 1, 0, 0, 0), (64, 0, 1, 0, 0, 0, 1),
     (40, 0, 1, 0, 1, 0, 0), (81, 0, 1, 0, 0, 0, 1), (4, 1, 1, 1, 0, 0, 0), (55, 0, 1, 0, 0, 0, 1), (3, 1, 1, 0, 0, 0, 1), (2, 1, 1, 0, 0, 0, 1), (5, 1, 1, 0, 0, 0, 1),
     (35, 0.8, 1, 0, 0, 0, 1), (4, 0, 1, 0, 1, 1, 0), (62, 0, 1, 0, 1, 0, 0), (30, 0, 0, 1, 0, 0, 0)],
    # the same marks on pages of plain elements
    [(21, 0, 0, 1, 0, 0, 0), (7, 0, 0, 0, 0, 1, 1), (60, 0, 0, 0, 0, 0, 1), (33, 0, 0, 0, 1, 0, 0), (75, 0, 0, 0, 0, 0, 1), (28, 0, 0, 1, 0, 0, 0),
     (58, 0, 0, 0, 0, 0, 1), (4, 0, 0, 0, 1, 1, 0), (66, 0, 0, 0, 1, 0, 0), (47, 0, 0, 0, 1, 0, 0), (31, 0, 0, 1, 0, 0, 0)],
    # a short article, much around it
    [(40, 0.9, 0, 0, 0, 0, 0), (5, 0, 0, 0, 0, 1, 0), (34, 0, 0, 0, 0, 0, 0), (25, 0, 1, 0, 0, 0, 1), (16, 0, 1, 0, 0, 0, 1), (29, 0, 0, 0, 0, 0, 0), (26, 0, 0, 0, 0, 0, 0)],
    # long lists of links and long unnamed blocks that are no article
    [(60, 1, 0, 0, 0, 0, 0), (9, 0, 0, 0, 0, 1, 1), (65, 0, 0, 0, 0, 0, 1), (50, 0.1, 0, 0, 0, 0, 1), (72, 0, 0, 0, 0, 0, 1), (80, 0.95, 0, 0, 0, 0, 0), (45, 0.9, 0, 0, 0, 0, 0),
     (120, 0.8, 0, 0, 0, 0, 0), (46, 1, 0, 0, 0, 0, 0)],
    [(60, 0, 0, 0, 0, 0, 0), (7, 0, 0, 0, 0, 1, 0), (9, 0, 1, 0, 0, 1, 1), (150, 0, 1, 0, 0, 0, 1), (130, 0, 1, 0, 0, 0, 1), (50, 0, 0, 0, 0, 0, 0), (90, 0.1, 0, 0, 0, 0, 0),
     (45, 0, 0, 0, 0, 0, 0), (70, 1, 0, 0, 0, 0, 0)],
    [(43, 0, 0, 0, 0, 0, 0), (4, 0, 0, 0, 0, 1, 0), (110, 0, 1, 0, 0, 0, 1), (6, 0, 1, 0, 0, 0, 1), (58, 0, 0, 0, 0, 0, 0), (4, 0, 0, 0, 0, 0, 0), (42, 0.2, 0, 0, 0, 0, 0)],
    # short paragraphs between short ones
    [(3, 1, 0, 0, 0, 0, 0), (6, 0, 0, 0, 0, 1, 1), (20, 0, 0, 0, 0, 0, 1), (4, 0, 0, 0, 0, 0, 1), (18, 0, 0, 0, 0, 0, 1), (6, 0, 0, 0, 0, 0, 1), (25, 0, 0, 0, 0, 0, 1), (5, 0, 0, 0, 0, 1, 1),
     (29, 0, 0, 0, 0, 0, 1), (2, 0, 0, 0, 0, 0, 1), (33, 0.2, 0, 0, 0, 0, 1), (12, 0, 0, 0, 0, 0, 0), (8, 0, 0, 0, 0, 0, 0), (5, 0, 0, 0, 0, 0, 0)],
    [(2, 1, 0, 0, 0, 0, 0), (10, 0, 0, 0, 0, 0, 0), (8, 0, 0, 0, 0, 1, 1), (31, 0, 0, 0, 0, 0, 1), (3, 0, 0, 0, 0, 0, 1), (24, 0.1, 0, 0, 0, 0, 1), (7, 0, 0, 0, 0, 1, 1), (21, 0, 0, 0, 0, 0, 1), (9, 0, 0, 0, 0, 0, 0)],
    # teasers are articles, the text is not in one
    [(8, 0, 0, 0, 0, 1, 1), (75, 0, 0, 0, 0, 0, 1), (66, 0.02, 0, 0, 0, 0, 1), (42, 0, 0, 0, 0, 0, 1), (9, 0, 1, 0, 1, 0, 0), (20, 0.1, 1, 0, 0, 0, 1)],
]


def blocks(page: str | None) -> list[tuple]:
    """(text, words, link density, article, boiler, hint, heading) of each
    block of the page."""
    page = page or ""
    out: list[tuple] = []
    open_: list[tuple[str, int, int, int]] = []  # tag, in article, boiler, hint: with those of its parents
    places: defaultdict[str, list[int]] = defaultdict(list)  # where each tag is open, so that an end tag searches nothing
    solid: list[int] = []  # where elements other than inline ones are open
    parts: list[tuple[str, bool, int]] = []  # text, in a link, hint
    link = False
    heading = 0

    def close() -> None:
        if not parts:
            return
        text = " ".join(html.unescape("".join(p for p, *_ in parts)).split())
        if text:
            n = len(text.split(" "))
            linked = sum(len(html.unescape(p).split()) for p, inside, _ in parts if inside)
            art, boil = open_[-1][1:3] if open_ else (0, 0)
            hint = int(all(named for p, _, named in parts if html.unescape(p).strip()))
            out.append((text, n, min(1.0, linked / n), art, boil, hint, heading))
        parts.clear()

    def push(tag: str, *state: int) -> None:
        places[tag].append(len(open_))
        if tag not in INLINE:
            solid.append(len(open_))
        open_.append((tag, *state))

    def cut(upto: int) -> None:
        while len(open_) > upto:
            tag = open_.pop()[0]
            places[tag].pop()
            if tag not in INLINE:
                solid.pop()

    def nearest(tags: Iterable[str]) -> int:
        return max((places[t][-1] for t in tags if places[t]), default=-1)

    def end_of(ended: frozenset[str], within: frozenset[str]) -> None:
        """Ends the open elements of these names, up to the nearest one of
        ``within``, with all in them."""
        wall = nearest(within - ended)
        first = [places[t][k] for t in ended if (k := bisect_right(places[t], wall)) < len(places[t])]
        cut(min(first, default=len(open_)))

    def named(tag: str, attributes: str, hint: int) -> int:
        if hint or not attributes or tag in ("html", "body", "article", "main"):
            return hint
        names = " ".join(x.strip("\"'") for x in _named.findall(attributes))
        if tag in HEADINGS:  # a heading may be called the header of its text
            names = re.sub("header", "", names, flags=re.I)
        return int(bool(HINT.search(names)))

    at = 0
    while at < len(page):
        m = _token.search(page, at)
        end = m.start() if m else len(page)
        if end > at:
            parts.append((page[at:end], link, open_[-1][3] if open_ else 0))
        if not m:
            break
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:  # comment, doctype
            continue
        if tag in INLINE:
            if tag == "a":
                link = not m[1]
            elif tag == "br":
                parts.append((" ", False, 0))
            if m[1]:
                if nearest([tag]) > (solid[-1] if solid else -1):  # an inline end tag ends no block
                    cut(places[tag][-1])
            elif tag not in VOID and not m[3].endswith("/"):
                art, boil, hint = open_[-1][1:] if open_ else (0, 0, 0)
                push(tag, art, boil, named(tag, m[3], hint))
            continue
        close()
        if m[1]:
            if tag in HEADINGS:
                heading = 0
            within = ENDS[tag][1] if tag in ENDS else P_WITHIN if tag == "p" else frozenset()
            if nearest([tag]) > nearest(within - {tag}):
                cut(places[tag][-1])
        elif tag in SKIPPED:
            over = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            at = over.end() if over else len(page)
        else:
            link = False
            heading = int(tag in HEADINGS)
            if tag in ENDS_P:
                end_of(frozenset("p"), P_WITHIN)
            if tag in ENDS:
                end_of(*ENDS[tag])
            if tag in HEADINGS and open_ and open_[-1][0] in HEADINGS:
                cut(len(open_) - 1)
            if tag not in VOID and not m[3].endswith("/"):
                art, boil, hint = open_[-1][1:] if open_ else (0, 0, 0)
                own = tag in BOILER or (tag == "header" and not art)
                push(tag, int(art or tag in ("article", "main")), int(boil or own), named(tag, m[3], hint))
    close()
    return out


def _features(rows: list[tuple]) -> list[tuple]:
    """The features of each block from (words, density, article, boiler,
    hint, heading) of all."""
    edge = (0, 0.0)
    share = sum(r[0] for r in rows if r[2] and not r[3] and not r[4]) / max(1, sum(r[0] for r in rows))
    out = []
    for k, r in enumerate(rows):
        before = rows[k - 1][:2] if k else edge
        after = rows[k + 1][:2] if k + 1 < len(rows) else edge
        out.append((r[0], r[1], *before, *after, r[2], int(r[3] or r[4]), r[5], 0.0 if r[2] else share))
    return out


def train(spark: SparkSession, depth: int = 8) -> tuple | float:
    """The tree as (feature, threshold, left, right), leaves as 0.0 or 1.0."""
    rows = [(*map(float, x), float(r[-1])) for page in LABELLED for x, r in zip(_features([r[:-1] for r in page]), page)]
    table = spark.createDataFrame(rows, [*FEATURES, "label"])
    data = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(table.coalesce(1))
    model = DecisionTreeClassifier(maxDepth=depth, maxBins=256, minInstancesPerNode=1, seed=7).fit(data)

    def walk(node) -> tuple | float:
        if node.subtreeDepth() == 0:
            return float(node.prediction())
        split = node.split()
        return (split.featureIndex(), split.threshold(), walk(node.leftChild()), walk(node.rightChild()))

    return walk(model._call_java("rootNode"))


def main_text(page: str | None, tree: tuple | float) -> str:
    found = blocks(page)
    kept = []
    for block, x in zip(found, _features([b[1:] for b in found])):
        node = tree
        while isinstance(node, tuple):
            node = node[2] if x[node[0]] <= node[1] else node[3]
        if node:
            kept.append(block[0])
    return "\n".join(kept)


def extract(pages: DataFrame, column: str = "html", tree: tuple | float | None = None) -> DataFrame:
    """The pages with ``text`` and ``n_chars`` (code points)."""
    tree = train(pages.sparkSession) if tree is None else tree

    @F.pandas_udf("string")
    def read(values: pd.Series) -> pd.Series:
        return pd.Series([main_text(v, tree) for v in values], dtype=object)

    (raw,) = fresh_names(pages, "_raw")
    df = pages.withColumn(raw, F.col(column)).drop(*[c for c in ("text", "n_chars") if c != column])
    df = df.withColumn("text", read(F.col(raw)))
    others = [c for c in pages.columns if c not in ("text", "n_chars")]
    return df.withColumn("n_chars", F.char_length("text").cast("long")).select(*others, "text", "n_chars")
