"""Main text of web pages by a tree-structured graphical model.

Block elements of a page, and inline ones with a telling name, are the nodes of a tree. Each is
main text or not. Potentials between a node and its parent depend on the element, and the node's
tag, names, text length and share of link text speak for one or the other. Sum-product messages go
up from the leaves and down from the root; a node's text is kept if its marginal says main text.

The potentials are smoothed counts over labelled pages, added up across tasks. Those in
``html_examples`` are the default.
"""

import math
import re
from dataclasses import dataclass
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import functions as F

from agoralens.llm.common import slices, wider
from agoralens.llm.html_examples import labelled_pages

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is never page text.
SILENT = set("head title script style noscript template svg math iframe object canvas audio video map "
             "select button textarea datalist".split())
FOREIGN = {"svg", "math"}
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
LISTS, CELLS = set("ul ol dl menu".split()), set("table thead tbody tfoot tr caption".split())
ITEMS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
SCOPES = LISTS | {"table", "html", "body"}
BLOCKS = (
    set("html body address article aside blockquote center details dialog dir div fieldset figcaption figure footer form "
        "header hgroup hr legend li dt dd main nav p pre search section summary td th".split()) | HEADINGS | LISTS | CELLS
)
ENDS_PARAGRAPH = BLOCKS - {"html", "body", "td", "th", "li", "dt", "dd"} - CELLS | {"table"}
GROUPS = {t: "heading" for t in HEADINGS} | {t: "list" for t in LISTS} | {t: "table" for t in CELLS}
GROUPS |= {t: t for t in "html body nav header footer aside article main section div p form li".split()}
GROUPS |= {t: "cell" for t in ("td", "th", "dt", "dd")} | {t: "quote" for t in ("blockquote", "pre", "figure", "figcaption")}
#: Words in class, id and role, each with what it tells.
NAMES = {
    "content": "article articlebody content post entry story main text maincontent",
    "menu": "nav navigation navbar menu breadcrumb breadcrumbs pagination pager toc tabs skip",
    "advert": "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion promoted adsense",
    "notice": "cookie cookies consent gdpr notice notices alert alerts warning popup modal overlay dialog message disclaimer toast",
    "comment": "comment comments commentlist reply replies disqus discussion respond reader readers responses thread feedback",
    "side": "sidebar side aside widget widgets related recommended recommendations trending popular more rail",
    "edge": "header footer foot head masthead topbar bottom copyright colophon legal contentinfo",
    "form": "form login signup signin subscribe subscription newsletter search register input",
    "share": "share sharing social tags tag meta byline toolbar buttons actions",
}
#: Boxes of the layout say nothing, whatever else their names hold.
LAYOUT = "wrap wrapper container layout page site row col column grid"
TOLD = {word: "layout" for word in LAYOUT.split()} | {word: kind for kind, words in NAMES.items() for word in words.split()}
ORDER = ["comment", "advert", "notice", "side", "form", "share", "menu", "edge", "content"]
WORD = re.compile(r"[a-z]+|[A-Z][a-z]*")
BODY = re.compile(r"<body[\s>/]", re.I)
LENGTHS = (0, 25, 80, 200)
SMOOTH = 0.1
#: Elements that say themselves what they are; text speaks differently about them.
FRAMES = set("nav footer aside form".split())
BATCH_CHARS = 4_000_000


#: Names of a state: they tell what an element has or does, not what it is.
STATE = re.compile(r"^(has|is|no|not|with|without)[-_]|[-_](open|opened|closed|enabled|disabled|on|off|allowed|count|\d+)$", re.I)
#: Elements of running text; names of places in a layout tell nothing about them.
RUNNING = HEADINGS | {"p"}
PLACES = {"side", "edge", "menu"}


def named(tag, attributes):
    """What class, id and role say about an element, or None. The first kind of ``ORDER`` holds."""
    found = set()
    for name, value in attributes:
        if name in ("class", "id", "role") and value:
            for part in value.split():
                if not STATE.search(part):
                    found.update(TOLD.get(w.lower()) for w in WORD.findall(part))
    if tag in RUNNING:
        found -= PLACES
    elif tag == "article" and "content" in found:
        found -= PLACES  # a post is not its place, whatever topic it is related to
    return None if "layout" in found else next((kind for kind in ORDER if kind in found), None)


class Page(HTMLParser):
    """The tree of a page and its text in page order."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parent, self.group, self.kind = [-1], ["root"], [None]
        self.length, self.linked, self.stops, self.label, self.inside = [0], [0], [0], [None], [False]
        self.open = [("#root", 0)]  # element and its node
        self.silent, self.links, self.block = 0, 0, 0
        self.segments = []  # node, block, text

    def handle_starttag(self, tag, attrs):
        if self.silent:
            if tag == "body":
                self._leave("head")
                if not self.silent:
                    self.handle_starttag(tag, attrs)
            elif tag not in VOID:
                self._push(tag, self.open[-1][1])  # its end must not close what is open outside
            return
        if tag == "br" or tag == "wbr":
            self.segments.append((self.open[-1][1], self.block, " " if tag == "br" else ""))
        if tag in ENDS_PARAGRAPH:
            self._close_above("p", SCOPES)
        for other in ITEMS.get(tag, ()):
            self._close_above(other, SCOPES)
        block, kind = tag in BLOCKS, None if tag in ("html", "body", "main") else named(tag, attrs)
        self.block += block
        if tag in VOID:
            return
        node = self.open[-1][1]
        if block or kind not in (None, "content"):
            marks = [v for k, v in attrs if k == "data-y"]
            self.parent.append(node)
            self.group.append(GROUPS.get(tag, "other" if block else "inline"))
            self.kind.append(kind)
            self.label.append(int(marks[0]) if marks else self.label[node])
            self.inside.append(self.inside[node] or self.group[-1] in FRAMES or kind not in (None, "content"))
            for counts in (self.length, self.linked, self.stops):
                counts.append(0)
            node = len(self.parent) - 1
        self._push(tag, node)

    def _push(self, tag, node):
        self.open.append((tag, node))
        self.silent += tag in SILENT
        self.links += tag == "a"

    def _pop(self):
        tag, _ = self.open.pop()
        self.silent -= tag in SILENT
        self.links -= tag == "a"
        self.block += tag in BLOCKS

    def _close_above(self, tag, scope):
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i][0] == tag:
                while len(self.open) > i:
                    self._pop()
                return
            if self.open[i][0] in scope:
                return

    def _leave(self, tag):
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i][0] == tag:
                if tag in BLOCKS or tag in SILENT:
                    while len(self.open) > i:
                        self._pop()
                else:
                    # An inline end does not close the blocks that were opened since.
                    held = []
                    while len(self.open) > i + 1:
                        held.append(self.open[-1])
                        self._unstack()
                    self._unstack()
                    for other in reversed(held):
                        self._push(*other)
                return

    def _unstack(self):
        tag, _ = self.open.pop()
        self.silent -= tag in SILENT
        self.links -= tag == "a"

    def handle_endtag(self, tag):
        if tag not in VOID:
            self._leave(tag)

    def handle_startendtag(self, tag, attrs):
        # The slash ends foreign elements; elsewhere it means nothing.
        if tag not in FOREIGN and not any(name in FOREIGN for name, _ in self.open):
            self.handle_starttag(tag, attrs)

    def handle_data(self, data):
        if self.silent or not data:
            return
        node = self.open[-1][1]
        self.segments.append((node, self.block, data))
        n = len(data.strip())
        self.length[node] += n
        self.linked[node] += n * (self.links > 0)
        self.stops[node] += sum(map(data.count, ".!?"))

    def evidence(self, node):
        """What speaks about a node, apart from its parent."""
        n = self.length[node]
        share = self.linked[node] / n if n else 0
        frame = "frame" if self.group[node] in FRAMES else "box"
        return (
            f"name {self.kind[node]}",
            f"{frame} length {sum(n > x for x in LENGTHS)}",
            f"{frame} links {'no text' if not n else 'none' if not share else 'some' if share < 0.5 else 'most'}",
            f"{frame} stops {bool(self.stops[node])} {n > 0}",
        )

    def place(self, node):
        """What decides how a node follows its parent: the kind of element, and whether it stands
        inside of one that says it is not main text."""
        plain = self.group[node] in FRAMES or self.kind[node] in (None, "content")
        return (self.group[node] if plain else "named") + (" inside" if self.inside[self.parent[node]] else "")


def read_page(html):
    page = Page()
    if not BODY.search(html):
        page.feed("<body>")  # a page without one has it all the same
    page.feed(html)
    page.close()
    return page


def _events(page):
    """The counted events of a labelled page: (what, given, label)."""
    label = [y or 0 for y in page.label]
    for node in range(1, len(label)):
        y, above = label[node], label[page.parent[node]]
        yield f"step {page.place(node)} {above}", y
        for fact in page.evidence(node):
            yield fact, y


def _chance(odds):
    return 1 / (1 + math.exp(-odds)) if odds > -700 else 0.0


def _log_mix(chance, odds):
    """The log of ``1 - chance + chance * exp(odds)``."""
    return math.log(1 - chance + chance * math.exp(odds)) if odds < 0 else odds + math.log((1 - chance) * math.exp(-odds) + chance)


@dataclass
class TreeModel:
    """For each element and parent label the chance of main text; for each fact its log ratio."""

    steps: dict
    facts: dict

    def marginals(self, page):
        """The chance of main text of each node, by messages up and down the tree.

        All messages are log odds of main text, so they do not vanish on wide or deep pages.
        """
        n = len(page.parent)
        up, sent, down, out = [0.0] * n, [0.0] * n, [-math.inf] * n, [0.0] * n
        for i in range(n - 1, 0, -1):
            up[i] += sum(self.facts.get(fact, 0.0) for fact in page.evidence(i))
            apart, within = self.step(page.place(i))
            sent[i] = _log_mix(within, up[i]) - _log_mix(apart, up[i])
            up[page.parent[i]] += sent[i]
        for i in range(1, n):
            p = page.parent[i]
            above = _chance(down[p] + up[p] - sent[i])
            apart, within = self.step(page.place(i))
            prior = (1 - above) * apart + above * within
            down[i] = math.log(prior) - math.log1p(-prior)
            out[i] = _chance(down[i] + up[i])
        return out

    def step(self, group):
        return self.steps.get(group) or self.steps["other inside" if group.endswith(" inside") else "other"]

    def text(self, html):
        """The main text of a page: its blocks in page order, one line each."""
        if not html:
            return ""
        page = read_page(html)
        share = self.marginals(page)
        lines, last, parts = [], None, []
        for node, block, text in page.segments:
            if share[node] < 0.5:
                continue
            if block != last:
                lines.append(" ".join("".join(parts).split()))
                last, parts = block, []
            parts.append(text)
        lines.append(" ".join("".join(parts).split()))
        return "\n".join(line for line in lines if line)


def _count(batches):
    for batch in batches:
        found = [e for html in batch.column("html").to_pylist() if html for e in _events(read_page(html))]
        yield pa.RecordBatch.from_arrays(
            [pa.array([what for what, _ in found], pa.string()), pa.array([y for _, y in found], pa.int32())],
            names=["what", "y"],
        )


def train(labelled) -> TreeModel:
    """Potentials from a frame with a column ``html`` whose main text is marked by ``data-y``."""
    counted = labelled.select("html").mapInArrow(_count, "what string, y int").groupBy("what")
    rows = counted.agg(F.sum(1 - F.col("y")).alias("no"), F.sum("y").alias("yes")).collect()  # a few for each element
    steps, facts = {}, {}
    no = sum(r["no"] for r in rows if r["what"].startswith("step"))
    yes = sum(r["yes"] for r in rows if r["what"].startswith("step"))
    for row in rows:
        if row["what"].startswith("step"):
            group, above = row["what"].removeprefix("step ").rsplit(" ", 1)
            chance = (row["yes"] + SMOOTH) / (row["no"] + row["yes"] + 2 * SMOOTH)
            steps.setdefault(group, [0.1, 0.9])[int(above)] = chance
        else:
            facts[row["what"]] = math.log((row["yes"] + SMOOTH) / (yes + 1)) - math.log((row["no"] + SMOOTH) / (no + 1))
    steps.setdefault("other", [0.1, 0.9])
    steps.setdefault("other inside", [0.01, 0.9])
    return TreeModel(steps, facts)


def default_model(spark) -> TreeModel:
    return train(spark.createDataFrame([(page,) for page in labelled_pages(NAMES)], "html string").coalesce(1))


def with_main_text(pages, model=None, html_col="html", text_name="text", size_name="n_chars"):
    """``pages`` with the main text and its number of code points; columns of these names go.

    Null and empty pages, and pages without main text, have the empty text. Every row stays.
    """
    model = model or default_model(pages.sparkSession)
    kept = [c for c in pages.columns if c not in (text_name, size_name)]
    rows = pages.select(*[pages[c] for c in kept])

    def run(batches):
        for batch in batches:
            values = batch.column(kept.index(html_col)).to_pylist()
            for a, b in slices([len(v or "") for v in values], BATCH_CHARS):
                texts = [model.text(v) for v in values[a:b]]
                yield pa.RecordBatch.from_arrays(
                    [*batch.slice(a, b - a).columns, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    names=[*kept, text_name, size_name],
                )

    return rows.mapInArrow(run, wider(rows.schema, **{text_name: "string", size_name: "bigint"}))
