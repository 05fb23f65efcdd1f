"""Main text of web pages by wrapper induction.

Pages of one host are aligned with a reference page of that host by simple tree
matching: the largest order-preserving map between two DOM trees that keeps tags,
found by dynamic programming over children. Text nodes of the reference whose text is
the same on ``share`` of the host's distinct pages, at least ``least_pages`` of them,
are template; the other slots vary and may be content. Of those slots, what stands in
page furniture goes: navigation, headers, footers, sidebars, notices, adverts, forms,
reader comments, by element and by words in class, id or role. Where a page has an
article or main element, content lies there.

Blocks are joined by one space, white space is one space, character references are
decoded, inline elements join their neighbours.

Defined results: null and empty pages have no text; a page whose address has no host,
or whose host has fewer distinct pages, has no template and is read by structure
alone; exact copies of a page count once in the host's statistics; broken markup is
closed as browsers do, and what is cut off counts as far as it goes; repeated rows
each give a row; an empty table gives no rows. Other columns stay, but for those of a
result's name, whose place the result takes.
"""

from __future__ import annotations

import html as markup
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.llm.common import others, small_batches, staged, table

#: Elements nested deeper get no node of their own; what they hold belongs to the deepest.
_DEEPEST = 200
#: Lists of children are matched in one table up to this product of their lengths.
_LARGE_TABLE = 40_000
#: Reference pages up to this many characters in all are broadcast.
BROADCAST_CHARACTERS = 16_000_000
# Element names of HTML.
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_BLOCKS = set(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody td "
    "tfoot th thead tr ul".split()
)
_CLOSES_P = _BLOCKS - {"br", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "body", "html"}
_CLOSED_BY = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
# Elements and words of class, id or role that mark page furniture.
_FURNITURE = set(
    "head title nav header footer aside form script style noscript template iframe object svg canvas button select "
    "textarea input dialog menu".split()
)
_FURNITURE_WORDS = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation "
    "menu breadcrumb breadcrumbs pagination sidebar aside footer header masthead cookie cookies consent notice "
    "notices alert popup modal overlay comment comments disqus respond replies share sharing social related "
    "recommended newsletter subscribe subscription signup login search widget toolbar complementary contentinfo".split()
)
# Words that say where an element stands and not what it holds.
_LAYOUT_WORDS = set(
    "site page global main top bottom left right upper lower center middle inner outer first last primary secondary "
    "mobile desktop sticky fixed floating box wrap wrapper container holder inside area block section panel row col "
    "column grid bar list links link items item group button buttons icons icon text title label form area zone unit "
    "slot placeholder content js css web html wp post article blog".split()
)
_TOKENS = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<raw>script|style|textarea|title|noscript|iframe)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<[!?][^>]*>|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attributes>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<[/a-zA-Z][^>]*\Z",
    re.DOTALL | re.IGNORECASE,
)
_MARKS = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
_PARTS = re.compile(r"[^a-z0-9]+")

_TELLS_OF_PAGE = ("has-", "no-", "with-", "without-")


class Node:
    """An element, or a text when ``tag`` is ``#text``."""

    __slots__ = ("children", "furniture", "key", "number", "shape", "size", "tag", "text")

    def __init__(self, tag: str, furniture: bool = False, text: str = "") -> None:
        self.tag, self.furniture, self.text = tag, furniture, text
        self.children: list[Node] = []
        self.key = self.number = self.shape = self.size = 0


def _marks_furniture(name: str) -> bool:
    """Whether a class, id or role says furniture and nothing else: "site-footer" does,
    "share-price" and "search-results" name a content."""
    parts = [part for part in (part.rstrip("0123456789") for part in _PARTS.split(name)) if len(part) > 1]
    return not _FURNITURE_WORDS.isdisjoint(parts) and all(
        part in _FURNITURE_WORDS or part in _LAYOUT_WORDS for part in parts
    )


def _is_furniture(tag: str, attributes: str, inside_article: bool) -> bool:
    if tag in _FURNITURE and not (tag == "header" and inside_article):
        return True
    if "=" not in attributes or tag in ("html", "body", "article", "main"):
        return False
    for match in _MARKS.finditer(attributes):
        value = next((group for group in match.groups() if group is not None), "")
        # "has-sidebar" tells of the page, not of the element.
        if any(_marks_furniture(name) for name in value.lower().split() if not name.startswith(_TELLS_OF_PAGE)):
            return True
    return False


def parse(page: str) -> Node:
    """The DOM tree below one root; scripts, styles and comments leave no nodes."""
    root = Node("#root")
    stack, tags = [root], ["#root"]  # of the open elements, those beyond _DEEPEST have a tag only
    opened: Counter[str] = Counter()
    at = 0

    def add_text(text: str) -> None:
        if text.strip():
            stack[-1].children.append(Node("#text", text=markup.unescape(text)))
        elif text:
            stack[-1].children.append(Node("#space"))

    def close_from(k: int) -> None:
        opened.subtract(tags[k:])
        del stack[k:], tags[k:]

    def close(closed: set[str], limits: set[str]) -> None:
        """Ends the innermost open element of ``closed``, unless a limit lies within."""
        if not any(opened[tag] for tag in closed):
            return
        for k in range(len(tags) - 1, 0, -1):
            if tags[k] in closed:
                close_from(k)
                return
            if tags[k] in limits:
                return

    for token in _TOKENS.finditer(page):
        if token.start() > at:
            add_text(page[at : token.start()])
        at = token.end()
        tag = token["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if token["end"]:
            if opened[tag]:
                k = len(tags) - 1
                while tags[k] != tag:
                    k -= 1
                close_from(k)
            continue
        if tag in _CLOSES_P and opened["p"]:
            close({"p"}, {"article", "main", "section", "div", "td", "li", "body"})
        if tag in _CLOSED_BY:
            close(*_CLOSED_BY[tag])
        inside = opened["article"] or opened["main"]
        node = Node(tag, _is_furniture(tag, token["attributes"], bool(inside)))
        stack[-1].children.append(node)
        if tag not in _VOID and not token["attributes"].endswith("/"):
            tags.append(tag)
            opened[tag] += 1
            if len(tags) <= _DEEPEST:
                stack.append(node)
    if at < len(page):
        add_text(page[at:])
    return root


def _words(text: str) -> str:
    return " ".join(text.split())


class TreeMatcher:
    """Simple tree matching. Scores depend on shapes alone and are kept by shape."""

    def __init__(self) -> None:
        self._shapes: dict[tuple, int] = {}
        self._scores: dict[tuple[int, int], float] = {}

    def prepare(self, root: Node) -> Node:
        """Numbers the text nodes of a tree and gives each node its shape and size."""
        order: list[Node] = []
        todo = [root]
        while todo:
            node = todo.pop()
            node.children = [c for c in node.children if c.tag != "#space"]
            order.append(node)
            todo.extend(reversed(node.children))
        texts = 0
        for node in order:
            if node.tag == "#text":
                node.number, texts = texts, texts + 1
                node.key = xxhash.xxh64_intdigest(_words(node.text))
        if len(self._scores) > 500_000:
            self._shapes.clear()
            self._scores.clear()
        for node in reversed(order):
            shape = (node.tag, *(c.shape for c in node.children))
            node.shape = self._shapes.setdefault(shape, len(self._shapes) + 1)
            node.size = 1 + sum(c.size for c in node.children)
        return root

    def score(self, a: Node, b: Node) -> float:
        if a.tag != b.tag:
            return 0
        if a.shape == b.shape:
            return a.size
        known = self._scores.get((a.shape, b.shape))
        if known is None:
            known = self._scores[a.shape, b.shape] = 1 + self._best(a.children, b.children)
        return known

    def _best(self, left: list[Node], right: list[Node]) -> float:
        """The score of the best match of two lists of children."""
        if len(left) * len(right) > _LARGE_TABLE:
            return float(self._last_row(left, right, False)[-1])
        return self._table(left, right, False)[-1][-1]

    def _table(self, left: list[Node], right: list[Node], by_text: bool) -> list[list[float]]:
        above = [0.0] * (len(right) + 1)
        rows = [above]
        for a in left:
            row = [0.0]
            best = 0.0
            for k, b in enumerate(right):
                if a.tag == b.tag:
                    both = above[k] + (a.size if a.shape == b.shape else self.score(a, b))
                    if by_text and a.key == b.key:
                        both += 0.5
                    if both > best:
                        best = both
                if above[k + 1] > best:
                    best = above[k + 1]
                row.append(best)
            rows.append(row)
            above = row
        return rows

    def _last_row(self, left: list[Node], right: list[Node], by_text: bool) -> np.ndarray:
        """The last row of ``_table``, in memory for one row."""
        kinds: dict[int, int] = {}
        kind = np.array([kinds.setdefault(b.shape, len(kinds)) for b in right])
        examples = {b.shape: b for b in right}
        keys = np.array([b.key for b in right], dtype=np.uint64)
        worths: dict[int, np.ndarray] = {}
        row = np.zeros(len(right) + 1)
        for a in left:
            if a.shape not in worths:
                worths[a.shape] = np.array([self.score(a, examples[shape]) for shape in kinds], dtype=float)[kind]
            worth = worths[a.shape]
            if by_text:
                worth = worth + 0.5 * ((keys == np.uint64(a.key)) & (worth > 0))
            both = np.where(worth > 0, row[:-1] + worth, 0)
            row[1:] = np.maximum.accumulate(np.maximum(row[1:], both))
        return row

    def _matched(self, left: list[Node], right: list[Node]) -> Iterator[tuple[Node, Node]]:
        """Children that the best match joins. Large tables are halved (each half's part
        of the other list is where the two best scores add up to most), so that memory
        grows with the lists and not with their product."""
        todo = [(left, right)]
        while todo:
            left, right = todo.pop()
            # Equal beginnings and ends: no other match of these is better.
            first, last = 0, 0
            shorter = min(len(left), len(right))
            while first < shorter and _alike(left[first], right[first]):
                yield left[first], right[first]
                first += 1
            while last < shorter - first and _alike(left[-1 - last], right[-1 - last]):
                yield left[-1 - last], right[-1 - last]
                last += 1
            left, right = left[first : len(left) - last], right[first : len(right) - last]
            if not left or not right:
                continue
            if len(left) * len(right) > _LARGE_TABLE and len(left) > 1:
                middle = len(left) // 2
                before = self._last_row(left[:middle], right, True)
                after = self._last_row(left[:middle - 1 : -1], right[::-1], True)[::-1]
                cut = int((before + after).argmax())
                todo += [(left[:middle], right[:cut]), (left[middle:], right[cut:])]
                continue
            rows = self._table(left, right, True)
            i, j = len(left), len(right)
            while i and j:
                if rows[i][j] == rows[i - 1][j]:
                    i -= 1
                elif rows[i][j] == rows[i][j - 1]:
                    j -= 1
                else:
                    i, j = i - 1, j - 1
                    yield left[i], right[j]

    def aligned(self, a: Node, b: Node) -> Iterator[tuple[Node, Node]]:
        """Pairs of text nodes that the best match of the two trees joins. Texts that
        are equal are preferred among matches of equal size."""
        todo = [(a, b)] if a.tag == b.tag else []
        while todo:
            a, b = todo.pop()
            if a.tag == "#text":
                yield a, b
                continue
            todo.extend(self._matched(a.children, b.children))


def _alike(a: Node, b: Node) -> bool:
    return a.shape == b.shape and a.key == b.key


def _release_wrappers(root: Node) -> None:
    """Forms and elements marked by a word only are no furniture if they wrap the page:
    if they hold its main element or most of its text outside furniture elements."""
    order, todo = [], [root]
    while todo:
        node = todo.pop()
        order.append(node)
        if node.tag not in _FURNITURE or node.tag == "form":
            todo.extend(node.children)
    if not any(node.furniture for node in order):
        return
    texts: dict[int, int] = {}
    mains = set()
    for node in reversed(order):
        known = [child for child in node.children if id(child) in texts]
        texts[id(node)] = len(node.text.strip()) + sum(texts[id(child)] for child in known)
        if node.tag == "main" or any(id(child) in mains for child in known):
            mains.add(id(node))
    for node in order:
        if node.furniture and (node.tag not in _FURNITURE or node.tag == "form"):
            node.furniture = id(node) not in mains and 2 * texts[id(node)] <= texts[id(root)]


def content(root: Node, template: set[int]) -> str:
    """The text of a tree without furniture and without the numbered template nodes."""
    _release_wrappers(root)
    regions: list[Node] = []
    todo = [root]
    while todo:
        node = todo.pop()
        if node.tag in ("article", "main"):
            regions.append(node)
        elif not node.furniture:
            todo.extend(reversed(node.children))
    found: list[str] = []
    for region in regions or [root]:
        todo = [region]
        while todo:
            node = todo.pop()
            if isinstance(node, str):
                found.append(node)
            elif node.tag == "#text":
                if node.number not in template:
                    found.append(node.text)
            elif node.tag == "#space":
                found.append(" ")
            elif not node.furniture:
                around = " " if node.tag in _BLOCKS else ""
                if around:
                    found.append(around)
                    todo.append(around)
                todo.extend(reversed(node.children))
        found.append(" ")
    return _words("".join(found))


def _number_texts(root: Node) -> None:
    """The numbers that ``TreeMatcher.prepare`` gives, on a tree that keeps its spaces."""
    todo, number = [root], 0
    while todo:
        node = todo.pop()
        if node.tag == "#text":
            node.number, number = number, number + 1
        todo.extend(reversed(node.children))


def _references(pages: DataFrame) -> DataFrame:
    """One page of each host, picked by hash among those that are whole."""
    whole = F.rtrim(F.lower(F.right("_llm_html", F.lit(16)))).endswith("</html>")
    rank = F.struct((~whole).alias("cut"), F.xxhash64("_llm_html").alias("hash"))
    picked = pages.filter("_llm_host is not null").groupBy("_llm_host").agg(F.min_by("_llm_html", rank).alias("_llm_reference"))
    return staged(picked, "reference-pages")


def _with_host(pages: DataFrame, facts: DataFrame, small: bool) -> DataFrame:
    """Adds what is known of each page's host. Hosts may be hot: both sides come from
    tables, so that a host's pages can be split over tasks."""
    return pages.join(F.broadcast(facts) if small else facts.hint("merge"), "_llm_host", "left")


def extracted(
    pages: DataFrame,
    *,
    url: str = "url",
    html: str = "html",
    share: float = 0.9,
    least_pages: int = 8,
) -> DataFrame:
    """``pages`` with ``text``, the main text, and ``n_template``, the number of text
    nodes that the host's template holds on this page."""
    host = F.lower(F.regexp_extract(F.col(url), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    read = small_batches(pages).withColumns(
        {"_llm_host": F.when(host != "", host), "_llm_html": F.coalesce(F.col(html), F.lit(""))}
    )
    references = _references(read.select("_llm_host", "_llm_html"))
    size = references.agg(F.sum(F.char_length("_llm_reference"))).first()[0] or 0
    small = size <= BROADCAST_CHARACTERS

    def compared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        matcher = TreeMatcher()
        trees: dict[str, Node] = {}
        for batch in batches:
            rows = []
            for host, page, reference in batch.itertuples(index=False):
                if len(trees) > 200 and host not in trees:
                    trees.clear()
                if host not in trees:
                    trees[host] = matcher.prepare(parse(reference))
                pairs = list(matcher.aligned(matcher.prepare(parse(page)), trees[host]))
                slots = np.array([b.number for _, b in pairs], dtype=np.int32)
                keys = np.array([a.key for a, _ in pairs], dtype=np.uint64).view(np.int64)
                rows.append((host, xxhash.xxh64_intdigest(page) >> 1, slots, keys))
            yield pd.DataFrame(rows, columns=["host", "page", "slots", "keys"])

    aligned = _with_host(read.select("_llm_host", "_llm_html").filter("_llm_host is not null"), references, small)
    aligned = aligned.select("_llm_host", "_llm_html", "_llm_reference").mapInPandas(
        compared, "host string, page long, slots array<int>, keys array<long>"
    )
    aligned = staged(aligned.groupBy("host", "page").agg(F.first("slots").alias("slots"), F.first("keys").alias("keys")), "aligned-pages")
    seen = aligned.groupBy("host").agg(F.count("*").alias("pages")).filter(F.col("pages") >= least_pages)
    nodes = aligned.select("host", F.explode(F.arrays_zip("slots", "keys")).alias("node"))
    nodes = nodes.groupBy("host", "node.slots", "node.keys").agg(F.count("*").alias("n"))
    constant = nodes.join(seen, "host").filter(F.col("n") >= share * F.col("pages"))
    templates = constant.groupBy("host").agg(F.map_from_entries(F.collect_list(F.struct("slots", "keys"))).alias("_llm_template"))
    templates = templates.select(F.col("host").alias("_llm_host"), "_llm_template")
    facts = staged(references.join(templates, "_llm_host"), "templates")

    @F.pandas_udf("text string, n_template int")
    def read_content(hosts: pd.Series, bodies: pd.Series, known: pd.Series, templates: pd.Series) -> pd.DataFrame:
        matcher = TreeMatcher()
        trees: dict[str, Node] = {}
        rows = []
        for host, page, reference, template in zip(hosts, bodies, known, templates, strict=True):
            root = parse(page)
            _number_texts(root)
            dropped: set[int] = set()
            if reference is not None:
                constant = dict(template)
                if host not in trees:
                    trees[host] = matcher.prepare(parse(reference))
                for a, b in matcher.aligned(matcher.prepare(parse(page)), trees[host]):
                    if b.number in constant and constant[b.number] == np.uint64(a.key).astype(np.int64):
                        dropped.add(a.number)
            rows.append((content(root, dropped), len(dropped)))
        return pd.DataFrame(rows, columns=["text", "n_template"])

    names = others(pages, "text", "n_template")
    joined = _with_host(read, facts, small)
    found = joined.withColumn(
        "_llm_found", read_content("_llm_host", "_llm_html", "_llm_reference", "_llm_template")
    )
    return found.select(*names, "_llm_found.text", "_llm_found.n_template")


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    found = extracted(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"), "n_template")
