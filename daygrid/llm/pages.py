"""HTML extraction: the main text of a page without what its site repeats on every page.

Pages become trees of elements. The subtrees of a page are hashed, Spark counts on how many pages of a host each hash occurs, and
subtrees that occur on a large share of at least ``LEAST_PAGES`` of them are the site's template and are
deleted. What belongs to no article by its element or role (menus, headers, footers, asides, forms,
scripts, adverts, comments and the like) is deleted by name, and of the rest the article is kept: the elements named as the
main content, or without any the whole body.

Only subtrees with text are counted, on different pages: rows of a host whose main text is the same are one page, however
often and under however many URLs it occurs. Hashes and hosts, not text, are shuffled.

Text: character references are decoded, white space in a block becomes one space, blocks are joined by one space in
page order. Defined cases: NULL html is empty; markup that never ends is closed at the end of the page; a NULL
URL or one without a host belongs to the empty host; repeated rows get one row each; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrid.llm.urls import host_and_path
from daygrid.sizing import broadcast_within, stored

# A subtree on this share of a host's pages is its template, if the host has so many pages.
SHARE = 0.5
LEAST_PAGES = 5
# So is one on the square root of them, if that is at least LEAST_PAGES and this share, which bounds a host's list of templates.
LEAST_SHARE = 0.01
# Text blocks and inline elements with fewer words may be anybody's: they need SHARE.
FEW_WORDS = 8
# A page keeps what is on less than SHARE of the pages if that has more than so many times the words of the rest.
MOST_TIMES = 9

# Elements of HTML by what they are for.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = {"script", "style"}
BLOCKS = set(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split()
)
NO_TEXT = set(
    "head title script style noscript template nav header footer aside form button select option input textarea iframe object embed svg canvas "
    "audio video dialog menu map".split()
)
TEXT_BLOCKS = set("h1 h2 h3 h4 h5 h6 p pre blockquote li dt dd td th caption figcaption legend summary".split())
# A start tag that ends an open element of these, as long as no element of the second set lies between.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}), "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}), "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
}
# Elements that an open paragraph does not go around.
_ENDS_P = BLOCKS - {"br", "caption", "dd", "dt", "li", "option", "td", "th", "tr", "tbody", "thead", "tfoot", "title", "body", "html", "legend", "summary", "figcaption"} | {"li", "dd", "dt"}
_SCOPE = {"article", "aside", "body", "button", "div", "footer", "form", "header", "html", "li", "main", "nav", "section", "table", "td", "th", "dd", "blockquote"}
# Words in class or id that name what is no article, and roles.
_NOISE = re.compile(
    r"(^|[\s_-])(ad|ads|adv|advert|adverts|advertisement|advertising|sponsor|sponsored|promo|promotion|nav|navbar|navigation|menu|breadcrumb|breadcrumbs|"
    r"sidebar|side-bar|widget|footer|site-header|masthead|topbar|toolbar|cookie|cookies|consent|gdpr|popup|pop-up|newsletter|"
    r"comment|comments|disqus|respond|related|recommended|recommendations|complementary|contentinfo|pagination|pager|skip-link)($|[\s_-])"
)
# Words that may as well be of the article's own matter: around an article they name noise, inside it only what is mostly links, or a few words outside paragraphs.
_MAYBE = re.compile(
    r"(^|[\s_-])(banner|notice|notices|modal|overlay|subscribe|subscription|signup|share|sharing|social|reply|replies|search|login|copyright|legal)($|[\s_-])"
)
_ROLES = {"banner", "navigation", "complementary", "contentinfo", "search", "dialog", "alertdialog", "menu", "menubar", "toolbar", "form"}
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
_MAIN = {"article", "main"}
_UNFINISHED = re.compile(r"<[A-Za-z/!?]")
_SPACES = re.compile(r"\s+")


class Node:
    __slots__ = ("attributes", "children", "name")

    def __init__(self, name: str, attributes: dict[str, str]):
        self.name, self.attributes, self.children = name, attributes, []


class _Tree(HTMLParser):
    """Builds the tree of a page; what is left open is closed by what encloses it."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("", {})
        self.open = [self.root]

    def handle_starttag(self, tag, attrs):
        if tag in _ENDS_P:
            self._close({"p"}, _SCOPE - {"p"})
        if tag in CLOSES:
            self._close(*CLOSES[tag])
        node = Node(tag, {k: v or "" for k, v in attrs})
        self.open[-1].children.append(node)
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.open[-1].children.append(Node(tag, {k: v or "" for k, v in attrs}))

    def _close(self, names, limits):
        """Close the innermost of ``names`` unless one of ``limits`` lies inside it."""
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].name in names:
                del self.open[i:]
                return
            if self.open[i].name in limits:
                return

    def handle_endtag(self, tag):
        if tag not in VOID:
            for i in range(len(self.open) - 1, 0, -1):
                if self.open[i].name == tag:
                    del self.open[i:]
                    return

    def handle_data(self, data):
        self.open[-1].children.append(data)


def parsed(html: str) -> Node:
    tree = _Tree()
    tree.feed(html)
    if _UNFINISHED.match(tree.rawdata):  # a tag or comment that the page ends in is no text
        tree.rawdata = ""
    tree.close()
    return tree.root


def _noise(node: Node, inside: bool = False) -> bool:
    """Whether an element is no part of an article, by its name or by what it is called; ``inside``: it lies in one."""
    own = node.attributes
    if node.name in NO_TEXT or "hidden" in own or own.get("aria-hidden") == "true" or "display:none" in own.get("style", "").replace(" ", "").lower():
        return True
    if node.name in ("html", "body", "main"):
        return False
    if own.get("role", "").lower() in _ROLES:
        return True
    named = f"{own.get('class', '')} {own.get('id', '')}".lower()
    if named == " ":
        return False
    return bool(_NOISE.search(named)) or (bool(_MAYBE.search(named)) and (not inside or _is_aside(node)))


def _is_aside(node: Node) -> bool:
    """Whether an element is mostly links, or a few words without a paragraph."""
    words = linked = link = paragraphs = 0
    for part, ended in _walk(node):
        if isinstance(part, str):
            n = len(part.split())
            words += n
            linked += n if link else 0
        elif part.name == "a":
            link += -1 if ended else 1
        elif part.name == "p":
            paragraphs += 1
    return 2 * linked >= words or (words < FEW_WORDS and not paragraphs)


def _n_words(node: Node) -> int:
    """Words of an element without its noise."""
    words = dropped = 0
    for part, ended in _walk(node):
        if isinstance(part, str):
            words += 0 if dropped else len(part.split())
        elif part is not node and _noise(part, True):
            dropped += -1 if ended else 1
    return words


def _walk(root: Node) -> Iterator[tuple[Node | str, bool]]:
    """Nodes and texts in page order; each element comes twice, the second time when it ends."""
    stack: list[tuple[Node | str, bool]] = [(root, False)]
    while stack:
        node, ended = stack.pop()
        yield node, ended
        if isinstance(node, Node) and not ended:
            stack.append((node, True))
            stack.extend((child, False) for child in reversed(node.children))


def hashes(root: Node) -> dict[int, int]:
    """For each element with text (by ``id``) a hash of its subtree: names, classes and words; odd if it is a text of few words."""
    inner: list[list[bytes]] = [[]]
    counts = [0]  # words in each open element
    found: dict[int, int] = {}
    for node, ended in _walk(root):
        if isinstance(node, str):
            if words := node.split():
                inner[-1].append(" ".join(words).encode("utf-8", "surrogatepass"))
                counts[-1] += len(words)
        elif not ended:
            inner.append([])
            counts.append(0)
        else:
            parts = inner.pop()
            n_words = counts.pop()
            counts[-1] += n_words
            if parts:
                digest = hashlib.blake2b(b"\0".join([node.name.encode("utf-8", "surrogatepass"), node.attributes.get("class", "").encode("utf-8", "surrogatepass"), *parts]), digest_size=8).digest()
                few = n_words < FEW_WORDS and (node.name in TEXT_BLOCKS or node.name not in BLOCKS)
                found[id(node)] = int.from_bytes(digest, "big", signed=True) & ~1 | few
                inner[-1].append(digest)
    return found


def main_text(root: Node, template: set[int], digests: dict[int, int]) -> str:
    """The text of the article: without named noise and without subtrees whose hash is in ``template``.

    Of several articles those count that have half as many words as the longest, or more. Headings and texts of few words in
    an article are its own, however many pages of the host have them.
    """
    tops = [root]
    chosen: list[Node] = []
    while tops:  # outermost elements of main content that lie in no noise
        node = tops.pop()
        if _noise(node):
            continue
        if node.name in _MAIN or node.attributes.get("role") in _MAIN:
            chosen.append(node)
        else:
            tops.extend(child for child in reversed(node.children) if isinstance(child, Node))
    if len(chosen) > 1:
        sizes = list(map(_n_words, chosen))
        chosen = [node for node, n in zip(chosen, sizes, strict=True) if 2 * n >= max(sizes)]
    pieces: list[str] = []
    for top in chosen or [root]:
        inside = bool(chosen)
        dropped: Node | None = None
        for node, ended in _walk(top):
            if isinstance(node, str):
                if dropped is None:
                    pieces.append(node)
                continue
            if dropped is not None:
                if node is dropped:
                    dropped = None
            elif node is not top and not ended:
                digest = digests.get(id(node))
                own = inside and (node.name in _HEADINGS or (digest is not None and digest & 1))
                if _noise(node, inside) or (digest in template and not own):
                    dropped = node
            if node.name in BLOCKS and dropped is None:
                pieces.append(" ")
        pieces.append(" ")
    return _SPACES.sub(" ", "".join(pieces)).strip()


def templates(pages: DataFrame, share: float = SHARE, least: int = LEAST_PAGES) -> DataFrame:
    """``host, digest, most`` of the subtrees on many of a host's pages (``host, html``), and whether these are ``share`` of them."""

    def subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mains, own = [], []
            for html in map(pa.StringScalar.as_py, batch.column(1)):
                root = parsed(html)
                mains.append(hashlib.blake2b(main_text(root, set(), {}).encode("utf-8", "surrogatepass"), digest_size=16).digest())
                own.append(sorted(set(hashes(root).values())))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(mains, pa.binary()), pa.array(own, pa.list_(pa.int64()))], names=["host", "main", "digests"])

    # What lies around equal main texts may differ; one of them stands for all.
    different = stored(pages.select("host", "html").mapInArrow(subtrees, "host string, main binary, digests array<bigint>").groupBy("host", "main").agg(F.min("digests").alias("digests")), small=True)
    totals = different.groupBy("host").agg(F.count("*").alias("pages")).where(F.col("pages") >= least)
    counts = different.select("host", F.explode("digests").alias("digest")).groupBy("host", "digest").agg(F.count("*").alias("n"))
    most = F.col("n") >= share * F.col("pages")
    many = F.col("n") >= F.greatest(F.lit(least), F.sqrt("pages"), LEAST_SHARE * F.col("pages"))
    found = counts.where("n > 1").join(totals, "host").where(most | many & (F.col("digest").bitwiseAND(F.lit(1)) == 0))
    return found.select("host", "digest", most.alias("most"))


def extracted(pages: DataFrame, share: float = SHARE, least: int = LEAST_PAGES) -> DataFrame:
    """``page_id, url, text`` of every row of ``pages`` (``page_id, url, html``)."""
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), host_and_path(F.col("url"))[0].alias("host"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    # At most 1 / LEAST_SHARE subtrees side by side can be on that share of the pages, each with those inside it.
    lists = [F.sort_array(F.collect_list(F.when(own, F.col("digest")))).alias(name) for name, own in (("most", F.col("most")), ("some", ~F.col("most")))]
    known = stored(templates(rows, share, least).groupBy("host").agg(*lists), small=True)
    entries = known.agg(F.sum(F.size("most") + F.size("some") + 1)).first()[0] or 0
    joined = rows.join(broadcast_within(known, entries), "host", "left").select("page_id", "url", "html", "most", "some")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for html, most, some in zip(map(pa.StringScalar.as_py, batch.column(2)), batch.column(3), batch.column(4), strict=True):
                root = parsed(html)
                digests = hashes(root) if most.is_valid else {}
                template, weak = set(most.as_py() or ()), set(some.as_py() or ()).intersection(digests.values())
                text = main_text(root, template, digests)
                if weak:
                    own = main_text(root, template | weak, digests)
                    n_own = len(own.split())
                    if len(text.split()) - n_own <= MOST_TIMES * n_own:
                        text = own
                texts.append(text)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return joined.mapInArrow(extract, f"page_id {kind}, url string, text string")
