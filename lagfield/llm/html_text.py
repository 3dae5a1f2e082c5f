"""Main text of web pages by composite text density.

Every element of the document tree gets a density: its characters per tag, scaled down by the part that links hold.
The element whose children have the largest sum of densities holds the article; the least density on the way from it
to the body is the threshold. What lies around that element stays if it reaches the threshold or lies in an element
that does, and is no block of links. If the page itself names an article or main on the way, the innermost one is
kept whole and only the widest one is searched for more. Elements that are no article whatever they hold (menus, headers and footers of the page,
asides, forms, scripts, reader comments) are left out of the tree, and those named as such (sidebars, notices, adverts)
if they hold a minor part of the text.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lagfield.llm.common import clean_columns

# fixed values: element names of the HTML standard
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe noembed noframes xmp svg annotation annotation-xml".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section select summary "
    "table tbody td tfoot th thead tr ul".split()
)
# an opening tag of the key ends an open element of the values, up to the nearest of the limits
ENDS = {
    **{b: ("p",) for b in BLOCKS - {"body", "html", "caption", "legend", "option", "optgroup", "td", "th", "tr", "tbody", "thead", "tfoot", "summary"}},
    "li": ("li", "p"), "dt": ("dt", "dd", "p"), "dd": ("dt", "dd", "p"), "tr": ("tr", "td", "th", "p"),
    "td": ("td", "th", "p"), "th": ("td", "th", "p"), "tbody": ("thead", "tbody", "tr", "td", "th", "p"),
    "tfoot": ("thead", "tbody", "tr", "td", "th", "p"), "thead": ("tbody", "tr", "td", "th", "p"),
    "option": ("option",), "optgroup": ("option", "optgroup"),
    **{f"h{i}": ("p", "h1", "h2", "h3", "h4", "h5", "h6") for i in range(1, 7)},
}
LIMITS = {
    "li": frozenset(("ul", "ol", "menu")), "dt": frozenset(("dl",)), "dd": frozenset(("dl",)),
    **{t: frozenset(("table",)) for t in ("tr", "td", "th", "tbody", "thead", "tfoot")},
}
SCOPES = frozenset(("table", "td", "th", "caption", "button", "object", "html", "body", "article", "section", "div", "main"))
# no article whatever they hold; names in MARKED only count for a minor part of the text
DROPPED = frozenset("nav aside form footer button select input dialog menu object embed canvas audio video".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
MARKED = re.compile(
    r"(?:^|\s|(?<!has)(?<!with)(?<!without)(?<!no)[_-])(?:ads?|adverts?|advertisement|advertising|banner|sponsor(?:ed)?|promo(?:tion)?|cookies?|consent|gdpr|"
    r"notices?|popup|modal|overlay|newsletter|subscribe|signup|nav|navbar|navigation|menu|breadcrumbs?|sidebar|side-bar|"
    r"widget|related|recommended|share|sharing|social|comments?|commentlist|respond|disqus|footer|masthead|"
    r"site-header|page-header|pagination|pager|skip-link)(?:$|[\s_-])",
    re.I,
)
# a list of reader comments, one of them, or what belongs to it: the whole of one class or id
COMMENTS = re.compile(
    r"(?:(?:post|reader|readers|user|article|page|blog|entry|the|all|wp|fb|facebook|disqus|div)[_-])?comments?"
    r"(?:[_-](?:area|section|list|thread|threads|container|wrapper|wrap|box|block|body|content|item|form|respond|feed|stream|"
    r"text|inner|template|\d+))*|commentlist|commentarea|respond|disqus(?:[_-]thread)?",
    re.I,
)
# names that say little of an element with paragraphs
WEAK = frozenset(("share", "sharing", "social"))
KEPT = frozenset(("html", "body", "article", "main"))
TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
LINK_BLOCKS = frozenset("ul ol div section dl table".split())
# fixed values: white space in HTML
WHITE = re.compile("[ \t\n\f\r]+")


class Node:
    """An element with its parts (texts and elements) and the counts the density needs."""

    __slots__ = ("name", "parts", "parent", "dropped", "late", "comment", "marks", "chars", "tags", "link_chars", "link_tags", "density", "total")

    def __init__(self, name: str, parent: Node | None, dropped: bool = False, marks: frozenset = frozenset()) -> None:
        self.name, self.parent, self.dropped, self.marks = name, parent, dropped, marks
        # left out only for lack of text beside it; part of the reader comments by its name
        self.late = self.comment = False
        self.parts: list[str | Node] = []
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0


def _is_dropped(name: str, found: dict[str, str], parent: Node) -> bool:
    if name in DROPPED:
        return True
    if name == "header":
        # the header of an article belongs to it
        node: Node | None = parent
        while node is not None and node.name not in ("article", "main"):
            node = node.parent
        return node is None
    if not found or name in KEPT:
        return False
    if "hidden" in found or found.get("aria-hidden", "").lower() == "true":
        return True
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", found.get("style", ""), re.I):
        return True
    return found.get("role", "").lower() in ROLES


def _marks(name: str, found: dict[str, str]) -> frozenset:
    """The listed words in an element's class and id."""
    if not found or name in KEPT:
        return frozenset()
    # words may share a sign between them, so each is looked for from the end of the one before
    marks = set()
    for key in ("class", "id"):
        value, at = html.unescape(found.get(key, "")), 0
        if name == "p" or name in HEADINGS or name not in BLOCKS:
            # a paragraph or a part of one only goes by a whole name
            marks |= {w.lower() for w in value.split() if (match := MARKED.search(w)) and len(match[0]) == len(w)}
            continue
        while match := MARKED.search(value, at):
            marks.add(match[0].strip(" \t\n\f\r_-").lower())
            at = max(match.end() - 1, match.start() + 1)
    return frozenset(marks)


def _is_comment(name: str, found: dict[str, str]) -> bool:
    if not found or name in ("html", "body", "main"):
        return False
    names = html.unescape(f"{found.get('class', '')} {found.get('id', '')}").split()
    return any(COMMENTS.fullmatch(w) for w in names) or found.get("itemprop", "").lower() == "comment"


def parse(source: str) -> Node:
    """The tree of a page. Open elements are closed as HTML closes them; a cut-off tag is no text."""
    root = Node("#root", None)
    node, at = root, 0
    # how many open elements have a name, so that looking for none costs nothing
    opened: Counter = Counter()

    def leave(node: Node, found: Node) -> Node:
        while node is not found:
            opened[node.name] -= 1
            node = node.parent
        opened[found.name] -= 1
        return found.parent or root

    while True:
        tag = TAG.search(source, at)
        text = source[at : tag.start() if tag else len(source)]
        if text:
            node.parts.append(html.unescape(text))
        if not tag:
            return root
        at = tag.end()
        name = (tag[2] or "").lower()
        if not name:
            continue
        if tag[1]:
            if name == "br" or name == "p" and not (opened["p"] and _open(node, "p", SCOPES)):
                node.parts.append(Node(name, node))
                continue
            limit = frozenset(("table",)) if name not in ("table", "body", "html") else frozenset()
            found = _open(node, name, limit) if opened[name] else None
            if found is not None and found.parent is not None:
                node = leave(node, found)
            continue
        for ended in ENDS.get(name, ()):
            limit = LIMITS.get(name, SCOPES)
            while opened[ended] and (found := _open(node, ended, limit)) is not None:
                node = leave(node, found)
        attributes = tag[3] or ""
        found = {m[1].lower(): next((g for g in m.groups()[1:] if g is not None), "") for m in ATTRIBUTE.finditer(attributes)}
        child = Node(name, node, _is_dropped(name, found, node), _marks(name, found))
        child.late = child.dropped and name in ("header", "button") and not _is_dropped("div", found, node)
        child.comment = _is_comment(name, found)
        if name in RAW:
            # nothing in it is markup but its own end
            at = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>|\Z", re.I).search(source, at).end()
            continue
        node.parts.append(child)
        if name not in VOID and not attributes.rstrip().endswith("/") or name in BLOCKS - VOID:
            node = child
            opened[name] += 1


def _open(node: Node, name: str, limit: frozenset) -> Node | None:
    """The nearest open element of that name, not beyond a limiting one."""
    at: Node | None = node
    while at is not None and at.parent is not None:
        if at.name == name:
            return at
        if at.name in limit:
            return None
        at = at.parent
    return None


def _nodes(root: Node) -> list[Node]:
    """All elements that are not left out, parents first."""
    found, todo = [], [root]
    while todo:
        node = todo.pop()
        found.append(node)
        todo += [p for p in node.parts if isinstance(p, Node) and not p.dropped]
    return found


def _count(nodes: list[Node]) -> None:
    """Characters, tags and links of elements, given parents first."""
    for node in reversed(nodes):
        node.chars = node.tags = node.link_chars = node.link_tags = 0
        for part in node.parts:
            if isinstance(part, str):
                node.chars += len(WHITE.sub("", part))
            elif not part.dropped:
                node.chars += part.chars
                node.tags += part.tags + 1
                node.link_chars += part.link_chars
                node.link_tags += part.link_tags
        if node.name == "a":
            node.link_chars, node.link_tags = node.chars, node.link_tags + 1


def settle(body: Node) -> None:
    """What depends on the surroundings of an element, before any density.

    A header beside paragraphs is the article's, and a button within a sentence is a word of it. Reader comments go
    whatever they hold, but an element with the page's title or main element in it is not a list of comments.
    """
    for node in _nodes(body):
        late = [p for p in node.parts if isinstance(p, Node) and p.late]
        if not late:
            continue
        prose = any(isinstance(p, str) and p.strip() for p in node.parts)
        paragraphs = node.name not in ("body", "html", "#root") and any(isinstance(p, Node) and p.name == "p" for p in node.parts)
        for part in late:
            part.dropped = not (paragraphs if part.name == "header" else prose and node.name == "p")
    nodes = _nodes(body)
    titled: set[int] = set()
    for node in reversed(nodes):
        if node.parent is not None and (node.name in ("h1", "main") or id(node) in titled):
            titled.add(id(node.parent))
    for node in nodes:
        node.dropped = node.dropped or node.comment and id(node) not in titled and node is not body


def drop_marked(body: Node) -> None:
    """Leave out the elements whose names say that they are no article, unless they hold most of the text.

    Text is what links do not hold. An element with half of the body's text stays, and so do elements with a common
    word in their names that hold half of it together, as the word then says nothing on that page.
    """
    nodes = _nodes(body)
    if not any(n.marks for n in nodes):
        return
    _count(nodes)
    half = (body.chars - body.link_chars) / 2
    held: dict[str, int] = {}
    minor, within = [], {}
    for node in nodes:
        over = within.get(id(node.parent), frozenset())
        within[id(node)] = over
        weak = node.marks <= WEAK and any(isinstance(p, Node) and p.name == "p" for p in node.parts)
        if node.marks and not weak and node is not body and node.chars - node.link_chars < half:
            minor.append(node)
            # what lies in an element of the same name is counted with it
            for word in node.marks - over:
                held[word] = held.get(word, 0) + node.chars - node.link_chars
            within[id(node)] = over | node.marks
    for node in minor:
        node.dropped = any(held[word] < half for word in node.marks)


def _density(node: Node, share: float) -> float:
    """Characters per tag, scaled down by the part in links; ``share`` is that part of the body."""
    c, t = node.chars, max(node.tags, 1)
    lc, lt = node.link_chars, max(node.link_tags, 1)
    if not c:
        return 0.0
    base = math.log(c / max(c - lc, 1) * lc + share * c + math.e)
    return c / t * (math.log(c / max(lc, 1) * t / lt + 1) / base)


def score(body: Node) -> list[Node]:
    """Densities and density sums of all elements of the body."""
    nodes = _nodes(body)
    _count(nodes)
    share = body.link_chars / body.chars if body.chars else 0.0
    for node in nodes:
        node.density = _density(node, share)
    for node in nodes:
        node.total = sum(p.density for p in node.parts if isinstance(p, Node) and not p.dropped)
    return nodes


def _own_article(node: Node) -> Node | None:
    """The only article or main below an element, if half of what lies in no element with a listed name is in it."""
    found, plain, todo = [], 0, [node]
    while todo:
        at = todo.pop()
        if at.name in ("article", "main") and at.chars:
            found.append(at)
            plain += at.chars
            continue
        for part in at.parts:
            if isinstance(part, str):
                plain += len(WHITE.sub("", part))
            elif not part.dropped and not part.marks:
                todo.append(part)
    return found[0] if len(found) == 1 and 2 * found[0].chars >= plain else None


def _links_only(node: Node) -> bool:
    """A block of several links and little else."""
    return node.link_tags > 1 and 2 * node.link_chars > node.chars


def _reaches(parts: list, body_share: float, threshold: float) -> bool:
    """Whether a run of texts and inline elements is dense enough."""
    run = Node("#run", None)
    run.parts = parts
    _count([run])
    return bool(run.chars) and not _links_only(run) and _density(run, body_share) >= threshold


def _select(top: Node, core: Node, path: set[int], body_share: float, threshold: float) -> Node:
    """A tree of ``core`` whole and of what is dense enough around it, below ``top``.

    ``path`` holds the elements from ``top`` to the parent of ``core``. A block stays if it reaches the threshold or
    lies in an element that does; blocks of links do not. Headings on the path stay too, as they are short by nature.
    """
    out = Node(top.name, None)
    todo = [(top, out, False)]
    blocky: set[int] = set()
    for node in reversed(_nodes(top)):
        if node.parent is not None and (node.name in BLOCKS or id(node) in blocky):
            blocky.add(id(node.parent))
    while todo:
        node, copy, dense = todo.pop()
        run: list = []

        def close() -> None:
            if run and (dense or _reaches(run, body_share, threshold)):
                copy.parts += run
            run.clear()

        for part in node.parts:
            if not isinstance(part, str) and part.dropped:
                continue
            if part is core:
                close()
                copy.parts.append(core)
            elif isinstance(part, Node) and id(part) in path:
                close()
                child = Node(part.name, copy)
                copy.parts.append(child)
                todo.append((part, child, False))
            elif isinstance(part, str) or part.name not in BLOCKS and id(part) not in blocky:
                run.append(part)
            else:
                close()
                if part.name in LINK_BLOCKS and _links_only(part):
                    continue
                child = Node(part.name, copy)
                copy.parts.append(child)
                heading = id(node) in path and part.name in HEADINGS and not _links_only(part)
                todo.append((part, child, dense or heading or part.density >= threshold))
        close()
    return out


def _with_peers(core: Node, threshold: float) -> Node:
    """An article with the other articles beside it that are dense enough."""
    if core.name != "article" or core.parent is None:
        return core
    out = Node("#articles", None)
    for part in core.parent.parts:
        if isinstance(part, Node) and part.name == "article" and not part.dropped and not part.marks:
            if part is core or part.density >= threshold and not _links_only(part):
                out.parts.append(part)
    return out


def main_node(root: Node) -> Node:
    """The element that holds the article, or a tree of its dense parts.

    The element with the largest sum of densities is whole in it. If the page calls an element around it article or
    main, the innermost one is whole, and what lies in a wider one stays if it is dense enough; else that holds for
    all of the body.
    """
    body = root
    for node in _nodes(root):
        if node.name == "body":
            body = node
            break
    settle(body)
    drop_marked(body)
    nodes = score(body)
    best = max(nodes, key=lambda n: (n.total, n.density))
    way, node = [], best
    while node is not body and node.parent is not None:
        way.append(node)
        node = node.parent
    marked = [n for n in way if n.name in ("article", "main") and n.chars]
    if not marked and (own := _own_article(best)):
        return own
    core, top = (marked[0], marked[-1]) if marked else (best, body)
    threshold = min([n.density for n in way] + [body.density])
    if core is top:
        return _with_peers(core, threshold)
    path, node = {id(top)}, core.parent
    while node is not None and node is not top:
        path.add(id(node))
        node = node.parent
    return _select(top, core, path, body.link_chars / body.chars if body.chars else 0.0, threshold)


def blocks_of(node: Node) -> list[str]:
    """Texts of the blocks below an element, in page order, white space as one space."""
    found: list[str] = []
    line: list[str] = []

    def flush() -> None:
        text = WHITE.sub(" ", "".join(line)).strip(" ")
        line.clear()
        if text:
            found.append(text)

    todo: list = [node]
    while todo:
        part = todo.pop()
        if part is None:
            flush()
        elif isinstance(part, str):
            line.append(part)
        elif part.dropped:
            continue
        elif part.name == "br":
            line.append(" ")
        else:
            block = part.name in BLOCKS
            if block:
                flush()
                todo.append(None)
            todo += reversed(part.parts)
    flush()
    return found


def page_text(source: str | None) -> str:
    """Main text of one page; empty for null and empty pages."""
    if not source:
        return ""
    return "\n".join(blocks_of(main_node(parse(source))))


def _run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        texts = [page_text(h if isinstance(h, str) else None) for h in batch["html"]]
        yield batch[["page_id", "url"]].assign(text=texts)


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: id, url, text (blocks joined by a line break; empty if none), n_chars (code points).

    Null and empty pages have an empty text; null ids and urls are passed on; repeated rows give repeated rows; an
    empty table gives none. Long pages are read whole, in time that grows with their length. Of elements with the same
    sum of densities the densest is taken, of these the first.
    """
    rows = clean_columns(pages, page_id=id_col, url=url_col, html=html_col)
    kind = rows.schema["page_id"].dataType.simpleString()
    texts = rows.mapInPandas(_run, f"page_id {kind}, url string, text string")
    return texts.select(
        F.col("page_id").alias(id_col), F.col("url").alias(url_col), "text", F.length("text").cast("long").alias("n_chars")
    )
