"""HTML extraction by the maximum-scoring subsequence of words and tags.

A page is read as a sequence of tokens.  Words score positive and tags negative; words and tags inside boilerplate (menus, headers,
footers, sidebars, notices, adverts, forms, comments) score negative.  The weights come from labelled pages, those whose author
marked the content with <article> or <main>: log odds of each kind of token inside against outside.  One linear scan finds the
contiguous run of tokens with the highest sum; it is the content region.  What scores negative inside it, is left out; the
rest is decoded, with white space inside a block as one blank and blocks joined by line feeds.

How a token stands is a sum of weights of the elements around it:

  boilerplate names   each word of a class, role or (of a container) id has a weight, negative for boilerplate, positive for
                      content (NAMES); a word beside "with", "no", "has" and the like says what a layout has, not what it is,
                      and weighs nothing.  The weights of an element's names add up, and an element is boilerplate where the
                      sum is negative or one around it is boilerplate.  An element that holds the page's <main> (without
                      one, its first heading h1, or an <article> before that) is its frame, whatever it is called: its
                      negative names weigh nothing.
  HTML's own names    nav, footer, aside, form, dialog, menu and header weigh as such names do; a header inside the marked content
                      that holds a heading is the content's own title and weighs nothing.
  marked content      tokens inside <article> or <main> score higher, boilerplate inside it nearly nothing, so an advert between
                      two paragraphs doesn't part them.

A run may begin or end inside an element, as a short last paragraph can weigh less than the tags before it; so the run
is extended to the smallest container (div, section, article ... body) that holds it.

Defined results: a null or empty page, or one without words outside boilerplate, has an empty text; unclosed and stray tags
are closed as HTML's nesting implies; attributes are read as HTML reads them: a quote only counts after an equals sign; very
long pages are read whole.  Extra columns come back in `doc`.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textcore as tc
from .samples import bounded_rows

# HTML's element names by what they mean here.
BLOCKS = set("address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
SILENT = set("head script style noscript template iframe object select textarea button canvas audio video title annotation annotation-xml metadata desc".split())
CONTENT = ("article", "main")
#: Elements that can be the region.
HOLDERS = set("article aside blockquote body center details div dl fieldset figure form html main ol section table tbody td ul".split()) | {""}
#: Elements whose ids say what they are; ids of headings and sections name their subject.
CONTAINERS = set("div ul ol dl table details fieldset center aside header footer nav form".split())
# Weights of words in class, role and id, and of elements.  Words of the first list say what an element is wherever they
# stand; those of the second may name a subject as well (related-work), so they count as the whole name, as its last word, or beside words of layout.
_ANYWHERE = "ads advert adverts advertisement advertising sponsored nav navbar menubar breadcrumb breadcrumbs masthead sidebar gdpr newsletter commentlist disqus pagination pager".split()
_ALONE = "ad adv banner sponsor promo navigation menu header footer aside widget cookie cookies consent popup modal subscribe signup login share sharing social comment comments respond replies related toolbar complementary contentinfo search".split()
_LAYOUT = set("wrapper container section area box block inner outer top bottom left right list links item items bar panel row col column holder group unit slot".split())
NAMES = dict.fromkeys([*_ANYWHERE, *_ALONE], -4.0) | dict.fromkeys("article content story entry post prose text body main".split(), 2.0)
TAG_NAMES = dict.fromkeys("nav header footer aside form menu dialog".split(), -4.0)
#: Elements that are boilerplate even if they hold a heading; a form can hold a whole page.
_FIRM = {*TAG_NAMES} - {"form"}
#: Beside these a word names something that an element has or lacks.
MODIFIERS = set("with without no not has have hide show is in on off open enabled disabled toggle count link icon".split())
_CLOSES = {"p": BLOCKS - {"br"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody", "tfoot"}, "td": {"td", "th", "tr", "tbody", "tfoot"}, "th": {"td", "th", "tr", "tbody", "tfoot"}, "option": {"option"}}

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|=)*+)>", re.S)
_ATTRIBUTE = re.compile(r"([^\s=>/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_NO_DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*none\b", re.I)
_RAW = {name: re.compile(rf"</{name}\s*>", re.I) for name in ("script", "style", "textarea", "title", "noscript", "template", "iframe")}
_PARTS = re.compile(r"[a-z]+")


class Node:
    """An element: its tokens are first to last; own is the weight of its names, silent that its text is never shown."""

    __slots__ = ("first", "last", "marked", "name", "own", "parent", "silent", "stand")

    def __init__(self, name: str, parent: Node | None, first: int, own: float, silent: bool):
        self.name, self.parent, self.first, self.last, self.own, self.silent = name, parent, first, -1, own, silent
        self.marked, self.stand = False, 0.0


def name_weight(value: str) -> float:
    """The sum of the weights of the names in a class or id; the lowest word of a name is the name's weight."""
    total = 0.0
    for name in re.sub(r"([a-z])([A-Z])", r"\1-\2", value).lower().split():
        parts = _PARTS.findall(name)
        if not MODIFIERS.isdisjoint(parts):
            continue
        plain = all(p in NAMES or p in _LAYOUT for p in parts)
        known = [NAMES[p] for k, p in enumerate(parts) if p in NAMES and (plain or p in _ANYWHERE or k == len(parts) - 1)]
        total += min(known, default=0.0)
    return total


def own_weight(name: str, attributes: str) -> tuple[float, bool]:
    """The weight of an element's names, and whether it is hidden."""
    total = TAG_NAMES.get(name, 0.0)
    if not attributes or name in ("html", "body"):
        return total, False
    for key, a, b, c in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), (a or b or c).strip()
        if key == "hidden" and not value.lower().startswith("until") or key == "aria-hidden" and value.lower() == "true" or key == "style" and _NO_DISPLAY.search(value):
            return total, True
        # Names of headings, paragraphs and inline elements say what they are about.
        if key in ("class", "role") and (name in HOLDERS or name in CONTAINERS) or key == "id" and name in CONTAINERS:
            total += name_weight(value)
    return total, False


def parse(page: str) -> tuple[list[tuple], list[Node]]:
    """Tokens (kind, value, node): "text" with its raw characters, "tag" with its name ("/name" at an end); and all elements."""
    tokens: list[tuple] = []
    top = Node("", None, 0, 0.0, False)
    nodes, stack, at = [top], [top], 0

    def close(to: int) -> None:
        while len(stack) > to:
            node = stack.pop()
            tokens.append(("tag", "/" + node.name, node))
            node.last = len(tokens)

    def text(to: int) -> None:
        if to > at and not stack[-1].silent:
            tokens.append(("text", page[at:to], stack[-1]))

    while m := _TOKEN.search(page, at):
        text(m.start())
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        if m[1]:
            depth = next((k for k in range(len(stack) - 1, 0, -1) if stack[k].name == name), 0)
            # An inline end tag doesn't close blocks.
            if depth and (name in BLOCKS or not any(n.name in BLOCKS for n in stack[depth + 1 :])):
                close(depth)
            elif name in ("p", "br"):
                tokens.append(("tag", "br", stack[-1]))
            continue
        if name in BLOCKS:
            for k in range(len(stack) - 1, 0, -1):
                if name in _CLOSES.get(stack[k].name, ()):
                    close(k)
                    break
                if stack[k].name in BLOCKS and stack[k].name not in _CLOSES:
                    break
        above = stack[-1]
        if name in VOID or m[3].endswith("/"):
            tokens.append(("tag", name, above))
            continue
        own, hidden = own_weight(name, m[3])
        node = Node(name, above, len(tokens), own, above.silent or hidden or name in SILENT)
        nodes.append(node)
        stack.append(node)
        tokens.append(("tag", name, node))
        if name in _RAW:
            end = _RAW[name].search(page, at)
            at = end.start() if end else len(page)
    text(len(page))
    close(1)
    top.last = len(tokens)
    _stand(nodes)
    return tokens, nodes


def _stand(nodes: list[Node]) -> None:
    """Whether each element lies in marked content, and how it stands: below zero it is boilerplate."""
    frames, titled = set(), set()

    def upwards(node: Node | None, into: set) -> None:
        while node is not None and id(node) not in into:
            into.add(id(node))
            node = node.parent

    main, title, article = (next((n for n in nodes if n.name == x and not n.silent), None) for x in ("main", "h1", "article"))
    if main is not None:
        upwards(main, frames)
    else:
        upwards(title.parent if title is not None else None, frames)
        if article is not None and (title is None or article.first < title.first):
            upwards(article, frames)
    for n in nodes:
        if n.name in ("h1", "h2") and not n.silent:
            upwards(n.parent, titled)
    for n in nodes[1:]:  # parents come before their elements
        up = n.parent
        n.marked = up.marked or n.name in CONTENT and up.stand >= 0
        own = n.own
        if own < 0 and (n.name == "header" and up.marked and id(n) in titled or n.name not in _FIRM and id(n) in frames):
            own = 0.0
        # Boilerplate isn't redeemed by what it holds.
        n.stand = up.stand if up.stand < 0 else own


def kind_of(token: tuple) -> str:
    kind, value, node = token
    return ("word" if kind == "text" else value) + ("/boiler" if node.stand < 0 else "")


def _words(raw: str) -> list[str]:
    return (html.unescape(raw) if "&" in raw else raw).split()


#: Weights without labelled pages (fixed values).
DEFAULTS = {"word": 1.0, "word/boiler": -3.0, "tag": -0.4, "boiler": -4.0}
#: What marked content adds to a word or tag, and what its boilerplate weighs there (fixed values).
MARKED, MARKED_BOILER = 1.0, -0.01


class Weights:
    """Log odds of tokens inside against outside of labelled content."""

    def __init__(self, pages: list[str]):
        inside, outside = Counter(), Counter()
        for page in pages:
            tokens, nodes = parse(page)
            if not any(n.marked for n in nodes):
                continue
            for token in tokens:
                count = len(_words(token[1])) if token[0] == "text" else 1
                (inside if token[2].marked and token[2].stand >= 0 else outside)[kind_of(token)] += count
        self.weights = {}
        a, b = sum(inside.values()), sum(outside.values())
        if a and b:
            for kind in {*inside, *outside}:
                odds = math.log((inside[kind] + 1) / (a + 1)) - math.log((outside[kind] + 1) / (b + 1))
                # Words score positive and tags negative, whatever the sample says.
                self.weights[kind] = max(0.2, min(1.0, odds)) if kind == "word" else max(-8.0, min(-0.05, odds))

    def of(self, kind: str) -> float:
        if kind in self.weights:
            return self.weights[kind]
        return DEFAULTS.get(kind, DEFAULTS["boiler" if kind.endswith("/boiler") else "tag"])

    def score(self, token: tuple) -> float:
        """The score of a token; a text counts all its words."""
        n = len(_words(token[1])) if token[0] == "text" else 1
        if token[2].marked:
            return n * (MARKED_BOILER if token[2].stand < 0 else self.of(kind_of(token)) + (MARKED if token[0] == "text" else 0.0))
        return n * self.of(kind_of(token))


def best_run(scores: list[float]) -> tuple[int, int]:
    """[first, last) of the contiguous run with the highest sum; (0, 0) if none is positive.  Of equal sums the first, shortest one."""
    best, found, total, start = 0.0, (0, 0), 0.0, 0
    for i, s in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += s
        if total > best:
            best, found = total, (start, i + 1)
    return found


def region_of(tokens: list[tuple], lo: int, hi: int) -> tuple[int, int]:
    """The run, extended to the smallest container that holds its words."""
    inner = [i for i in range(lo, hi) if tokens[i][0] == "text" and tokens[i][2].stand >= 0 and tokens[i][1].strip()]
    if not inner:
        return 0, 0
    node = tokens[inner[0]][2]
    while node.name not in HOLDERS or node.last < inner[-1] + 1:
        node = node.parent
    return node.first, node.last


def extract(page: str | None, weights: Weights) -> str:
    if not page:
        return ""
    tokens, _ = parse(page)
    first, last = region_of(tokens, *best_run([weights.score(t) for t in tokens]))
    blocks, block = [], []
    for token in tokens[first:last]:
        if token[0] == "text":
            if token[2].stand >= 0:
                block.append(token[1])
        elif token[1].lstrip("/") in BLOCKS and block:
            blocks.append("".join(block))
            block = []
    blocks.append("".join(block))
    return "\n".join(x for b in blocks if (x := " ".join(_words(b))))


def train(pages: DataFrame, html_col: str = "html", id_col: str = "page_id", rows: int = 400) -> Weights:
    """Weights from those of `rows` pages, chosen by a hash of id and page, that mark their content."""
    page = F.col(f"`{html_col}`").cast("string")
    chosen = bounded_rows(pages.select(F.col(f"`{id_col}`").alias("id"), page.alias("page")).where("page is not null"), ["id", "page"], rows)
    return Weights([r["page"] for r in chosen.where(F.col("page").rlike("(?i)<(article|main)[\\s>]")).select("page").orderBy("page").collect()])


def main_text(pages: DataFrame, weights: Weights, html_col: str = "html") -> DataFrame:
    """doc (the row) and text of every page."""
    rows = pages.select(F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("doc"))
    sent = pages.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column("doc").field(html_col).cast(pa.string())
            for at in range(0, batch.num_rows, 256):
                yield pa.RecordBatch.from_arrays([batch.column("doc").slice(at, 256), pa.array([extract(x, sent.value) for x in raw.slice(at, 256).to_pylist()], pa.string())], ["doc", "text"])

    return rows.mapInArrow(tc.tidy(run), T.StructType([rows.schema["doc"], T.StructField("text", T.StringType())]))
