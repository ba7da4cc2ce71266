"""Main text of web pages, with site templates found by counting element subtrees per host.

Every element of a page is hashed twice: its content is all that it holds, its shape the tags, roles and names
of itself and of what it holds, runs of equal parts folded, without the words. Spark counts on how many different
pages of a host each hash stands. Pages that are whole copies of each other count once.

* A content that recurs on many pages of its host belongs to the site, at every size of the host. Articles do repeat
  each other's paragraphs, so text blocks and inline elements take a large share of the host's pages besides; inline
  elements count if they stand alone in their block or hold four words, as short ones inside a sentence are words of it.
* A shape that recurs on half of the host's pages with ever different words belongs to the site too, where those words
  are links for the most part, or fewer than the article's and outside the element that holds it: see `slots`.

What neither count decides, as it changes from page to page inside the article or the host has too few pages, is
left to tag, role and class: menus, headers, footers, sidebars, notices, adverts, forms, comments. A class or id says so
only of elements that hold neither the page's largest `article` or `main` nor most of its text, and not if nothing
would be left; comments may hold most. Where `article` or `main` elements hold half of what is kept at least, the text
is what stands in them.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroom.llm.frames import all_rows, discard, settle
from tallyroom.llm.urls import host_and_path

#: A container is a template from so many different pages of its host on, however large the host is.
MIN_PAGES, MIN_SHARE = 10, 0.0
#: Text blocks and inline elements are from so many on, if they are at least that share of the host's.
TEXT_PAGES, TEXT_SHARE = 10, 0.3
#: Shapes are from so many on, if they are at least that share of the host's.
SHAPE_PAGES, SHAPE_SHARE = 10, 0.5
#: Up to so many templates (8 MB) are sent to every task; beyond, pages are joined with theirs.
SENT_TEMPLATES = 1 << 20
CONTAINER, TEXTUAL, SHAPE = 0, 1, 2

TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"'<]|"[^"<]*"|'[^'<]*'|"[^"]*"(?=[\s/>])|'[^']*'(?=[\s/>]))*+>|[^>]*(?:>|\Z))|<[!?][^>]*(?:>|\Z)""", re.S)
MARK = re.compile(r"class|id|role|hidden|style", re.I)
ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
PIECE = re.compile(r"[a-z]+|[0-9]+")
RAW = ("script", "style", "textarea", "title", "noscript", "iframe", "xmp", "template")
RAW_END = {t: re.compile(rf"</{t}\s*>", re.I) for t in RAW}
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
GONE = frozenset("head nav footer aside form script style noscript template iframe button select option textarea svg canvas object dialog menu title math video audio".split())
TEXT_BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th pre blockquote figcaption caption summary".split())
BLOCKS = TEXT_BLOCKS | frozenset("html body div section article main header footer nav aside ul ol dl table tr tbody thead tfoot figure hr address form details fieldset hgroup".split())
INLINE_IN_P = frozenset("p div section article main header footer nav aside ul ol dl table figure hr address form details fieldset blockquote pre h1 h2 h3 h4 h5 h6".split())
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
BOUNDS = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table", "tr"), "th": ("table", "tr"), "option": ("select",)}
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar".split())
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert popup modal overlay newsletter "
    "subscribe signup login sidebar aside menu menus nav navbar navigation breadcrumb breadcrumbs footer masthead comment comments disqus reply replies respond share sharing "
    "social related recommended widget pagination pager toolbar skip".split()
)
COMMENTS = frozenset("comment comments disqus reply replies respond".split())
HOLDERS = frozenset(("article", "main"))
#: Never text of a page, so not worth counting.
GONE_UNSEEN = frozenset("head script style noscript template iframe textarea svg canvas object title math video audio".split())


class Node:
    __slots__ = ("tag", "marks", "parts", "up", "said")

    def __init__(self, tag: str, marks: str, up: Node | None):
        self.tag, self.marks, self.parts, self.up, self.said = tag, marks, [], up, None


def parse(text: str) -> Node:
    """The element tree; `parts` of a node are nodes and texts in page order."""
    top = here = Node("", "", None)
    at, end = 0, len(text)
    while at < end:
        found = TAG.search(text, at)
        if not found:
            here.parts.append(text[at:])
            break
        if found.start() > at:
            here.parts.append(text[at : found.start()])
        at = found.end()
        name = found[2]
        if name is None:
            continue
        tag = name.lower()
        if found[1]:
            node = here
            while node.up and node.tag != tag:
                node = node.up
            if node.up:
                here = node.up
            elif tag in BLOCKS:
                here.parts.append(Node(tag, "", here))  # a closing tag without its opening one still ends a block
            continue
        if tag in INLINE_IN_P or tag in CLOSES:
            closes, bounds = (("p",), ("td", "th", "div", "article", "section", "body", "li")) if tag in INLINE_IN_P else (CLOSES[tag], BOUNDS[tag])
            node = here
            while node.up and node.tag not in closes and node.tag not in bounds:
                node = node.up
            if node.up and node.tag in closes:
                here = node.up
        node = Node(tag, found[3], here)
        here.parts.append(node)
        if tag in RAW:
            stop = RAW_END[tag].search(text, at)
            node.parts.append(text[at : stop.start() if stop else end])
            at = stop.end() if stop else end
        elif tag not in VOID and not found[3].endswith("/>"):
            here = node
    return top


def said_by(node: Node) -> tuple[bool, bool, bool, bool]:
    """Whether role or style say that an element is no part of the article, whether class or id do, whether they name
    a header, and whether a name begins with comments."""
    if node.said is None:
        sure = named = header = comments = False
        if MARK.search(node.marks):
            for key, value in ATTRIBUTE.findall(node.marks):
                key, value = key.lower(), value.strip("\"'").lower()
                if key == "hidden" or key == "style" and "display:none" in value.replace(" ", "") or key == "role" and value in ROLES:
                    sure = True
                elif key in ("class", "id") and node.tag not in ("html", "body"):
                    for name in value.split():
                        pieces = PIECE.findall(name)
                        named, header = named or not NAMES.isdisjoint(pieces), header or "header" in pieces
                        comments = comments or bool(pieces) and pieces[0] in COMMENTS
        node.said = sure, named, header, comments
    return node.said


def no_article(node: Node, inside: bool, spared: set[int] | None = frozenset()) -> bool:
    """Whether tag, role, class or id say that an element is not part of the article. Class and id are not asked
    for elements that are spared; None spares all."""
    if node.tag in GONE or node.tag == "header" and not inside:
        return True
    sure, named, header, _ = said_by(node)
    return sure or (named or header and not inside) and spared is not None and id(node) not in spared


def spare(top: Node) -> set[int]:
    """The elements, by their ids, that hold the largest article or main or most of the page's text outside links."""
    weights: dict[int, int] = {}
    nodes, stack = [], [top]
    while stack:
        node = stack.pop()
        if node.tag in GONE or node.tag == "a" or said_by(node)[0]:
            weights[id(node)] = 0
            continue
        nodes.append(node)
        stack.extend(part for part in node.parts if isinstance(part, Node))
    largest = None
    for node in reversed(nodes):  # parts before the elements that hold them
        weight = sum(weights[id(part)] if isinstance(part, Node) else len(part.strip()) for part in node.parts)
        weights[id(node)] = weight
        if node.tag in HOLDERS and (largest is None or weight >= weights[id(largest)]):
            largest = node
    spared = set()
    node = largest
    while node:
        spared.add(id(node))
        node = node.up
    for node in nodes:
        if 2 * weights[id(node)] > weights[id(top)] and id(node) not in spared:
            if not (said_by(node)[3] and largest and apart(node, largest, weights)):
                spared.add(id(node))
    return spared


def apart(node: Node, holder: Node, weights: dict[int, int]) -> bool:
    """Whether an article or main has text outside an element that does not hold it."""
    up = node
    while up and up is not holder:
        up = up.up
    return weights[id(holder)] > (weights[id(node)] if up else 0)


class Facts:
    """What is known of an element from all that it holds: its two hashes, words, characters, those in links, links,
    and whether it is or holds a main heading, `article` or `main`."""

    __slots__ = ("content", "shape", "words", "chars", "linked", "links", "titled")

    def __init__(self, content: bytes, shape: bytes, words: int, chars: int, linked: int, links: int, titled: bool):
        self.content, self.shape, self.words, self.chars = content, shape, words, chars
        self.linked, self.links, self.titled = linked, links, titled


def subtrees(top: Node) -> tuple[list[tuple[Node, bytes, int]], dict[int, Facts]]:
    """The elements of a tree whose content may be a template, with its hash and kind, and the facts of all elements by id."""
    out: list[tuple[Node, bytes, int]] = []
    facts: dict[int, Facts] = {}
    stack = [(top, True, False)]
    while stack:
        node, alone, ready = stack.pop()
        if not ready:
            stack.append((node, alone, True))
            if len(node.parts) > 1 or node.parts and isinstance(node.parts[0], Node):
                single = lone_parts(node) if alone or node.tag in BLOCKS else ()
                stack.extend((part, id(part) in single, False) for part in node.parts if isinstance(part, Node))
            continue
        tag = node.tag
        words = chars = linked = links = 0
        whole, form, titled = [tag.encode()], [], tag == "h1" or tag in HOLDERS
        for part in node.parts:
            if isinstance(part, Node):
                own = facts[id(part)]
                whole.append(b"<" + own.content)
                words += own.words
                if part.tag in GONE_UNSEEN:
                    continue
                chars, linked, links, titled = chars + own.chars, linked + own.linked, links + own.links, titled or own.titled
                if own.shape and (not form or form[-1] != own.shape):
                    form.append(own.shape)
            else:
                pieces = part.split()
                words += len(pieces)
                chars += sum(map(len, pieces))
                whole.append(b">" + " ".join(pieces).encode("utf-8", "replace"))
        shape = b""
        if tag == "a":
            linked, links = chars, 1
        if tag == "a" or tag in BLOCKS:
            shape = blake2b(f"{tag} {names_of(node)}<".encode("utf-8", "replace") + b"".join(form), digest_size=8).digest()
        content = blake2b(b"".join(whole), digest_size=8).digest()
        facts[id(node)] = Facts(content, shape, words, chars, linked, links, titled)
        if words and node.tag not in ("", "html", "body", "article", "main", "hr") and node.tag not in GONE_UNSEEN:
            container = node.tag in BLOCKS and node.tag not in TEXT_BLOCKS
            if container or node.tag in TEXT_BLOCKS or words >= 4 or alone:
                out.append((node, content, CONTAINER if container else TEXTUAL))
    return out, facts


def names_of(node: Node) -> str:
    """Role and class names of an element without their numbers, in one order."""
    if len(node.marks) < 5 or not MARK.search(node.marks):
        return ""
    found: set[str] = set()
    for key, value in ATTRIBUTE.findall(node.marks):
        if key.lower() in ("class", "role"):
            found.update(PIECE.findall(value.lower()))
    return " ".join(sorted(name for name in found if not name.isdigit()))


def slots(top: Node, facts: dict[int, Facts]) -> list[tuple[Node, bytes]]:
    """The containers whose shape may be a template, with its hash.

    These are the ones with two links at least and most of their characters in links. Where an `article` or `main`
    holds more than half of the page's characters outside links, these are also the ones outside it with
    fewer characters, unless they hold a main heading or another `article` or `main`. Neither the holder nor what it
    stands in is asked for.
    """
    holder, most = None, -1
    inner = [top]
    for node in inner:  # grows as it is gone through
        own = facts[id(node)]
        if node.tag in HOLDERS and own.chars - own.linked > most:
            holder, most = node, own.chars - own.linked
        if own.words and (node.tag in BLOCKS or not node.tag):
            inner.extend(part for part in node.parts if isinstance(part, Node) and part.tag not in GONE_UNSEEN)
    rest = facts[id(top)].chars - facts[id(top)].linked
    ruling = holder if 2 * most > rest else None
    around: set[int] = set()
    node = holder
    while node:
        around.add(id(node))
        node = node.up
    out = []
    stack = [(top, False)]
    while stack:
        node, inside = stack.pop()
        own = facts[id(node)]
        if id(node) not in around and own.words and node.tag in BLOCKS and node.tag not in TEXT_BLOCKS and node.tag not in ("html", "body", "hr"):
            mostly_links = own.links > 1 and 2 * own.linked > own.chars
            if mostly_links or ruling and not inside and not own.titled and own.chars < facts[id(ruling)].chars:
                out.append((node, own.shape))
        inside = inside or node is holder
        if own.words and (node.tag in BLOCKS or node is top) and (not inside or own.links > 1):
            stack.extend((part, inside) for part in node.parts if isinstance(part, Node) and part.tag not in GONE_UNSEEN)
    return out


def candidates(top: Node) -> list[tuple[Node, bytes, int]]:
    """The elements of a page that may be templates: element, hash and kind; an element may stand there twice."""
    found, facts = subtrees(top)
    found.extend((node, shape, SHAPE) for node, shape in slots(top, facts))
    return found


def template_key(host: bytes, whole: bytes, kind: int) -> int:
    """The number of a content or a shape on a host."""
    return number(blake2b(whole + bytes((kind,)) + host, digest_size=8).digest())


def lone_parts(node: Node) -> set[int]:
    """The ids of the parts of a node that nothing else shares a line with."""
    out, line = set(), []
    for part in (*node.parts, None):
        if part is None or isinstance(part, Node) and (part.tag in BLOCKS or part.tag == "br"):
            if len(line) == 1:
                out.add(id(line[0]))
            line.clear()
        elif isinstance(part, Node) or part.strip():
            line.append(part)
    return out


def holders(top: Node, gone: set[int], spared: set[int] | None) -> list[Node]:
    """The outermost article or main elements that are kept; the whole tree if more text is kept outside them."""
    found, within, total = [], 0, 0
    stack = [(top, False, False)]
    while stack:
        node, inside, link = stack.pop()
        if node.tag in HOLDERS and not inside:
            if no_article(node, True, spared) or id(node) in gone:
                continue
            inside = True
            found.append(node)
        elif node is not top and (no_article(node, inside, spared) or id(node) in gone):
            continue
        link = link or node.tag == "a"
        if not link:
            weight = sum(len(part.strip()) for part in node.parts if isinstance(part, str))
            total += weight
            within += weight if inside else 0
        stack.extend((part, inside, link) for part in reversed(node.parts) if isinstance(part, Node))
    return found if found and 2 * within >= total else [top]


def main_text(page: str | None) -> str:
    """The text of a page by itself, blocks joined by line breaks."""
    return text_without(parse(page), set()) if page else ""


def text_without(top: Node, gone: set[int]) -> str:
    """The text of a tree without the elements whose ids are given."""
    spared = spare(top)
    text = kept_text(top, gone, spared)
    if not text and not (gone and kept_text(top, set(), spared)):
        text = kept_text(top, gone, None)
    return text


def kept_text(top: Node, gone: set[int], spared: set[int] | None) -> str:
    blocks: list[str] = []
    run: list[str] = []

    def close() -> None:
        if run:
            text = "".join(run)
            text = " ".join((html.unescape(text) if "&" in text else text).split())
            if text:
                blocks.append(text)
            run.clear()

    for holder in holders(top, gone, spared):
        stack: list[tuple[Node | str | None, bool]] = [(holder, False)]
        while stack:
            part, inside = stack.pop()
            if part is None:
                close()
                continue
            if isinstance(part, str):
                run.append(part)
                continue
            inside = inside or part.tag in HOLDERS
            if part is not holder and no_article(part, inside, spared) or id(part) in gone:
                if part.tag in BLOCKS:
                    close()
            elif part.tag == "br":
                run.append(" ")
            else:
                if part.tag in BLOCKS:
                    close()
                    stack.append((None, inside))
                stack.extend((p, inside) for p in reversed(part.parts))
        close()
    return "\n".join(blocks)


def found_on(batch: pa.RecordBatch, with_key: bool) -> pa.RecordBatch:
    """The candidates of a batch of pages: host and template as numbers, kind, and the page's article, or its key.
    A row of kind `SHAPE` with the host as template stands for the page itself."""
    last, hosts, hashes, kinds = [], [], [], []
    keys = batch.column("key").to_pylist()
    for key, url, page in zip(keys, batch.column("url").to_pylist(), batch.column("html").to_pylist()):
        host = host_digest(url)
        top = parse(page or "")
        article = key if with_key else number(blake2b(text_without(top, set()).encode("utf-8", "replace"), digest_size=8).digest())
        own = {(template_key(host, whole, kind), kind) for _, whole, kind in candidates(top)}
        if not with_key:
            own.add((number(host), SHAPE))
        for template, kind in own:
            hashes.append(template)
            kinds.append(kind)
        hosts.extend([number(host)] * len(own))
        last.extend([article] * len(own))
    columns = [pa.array(hosts, pa.int64()), pa.array(hashes, pa.int64()), pa.array(kinds, pa.int8()), pa.array(last, pa.int64())]
    return pa.RecordBatch.from_arrays(columns, names=["host", "template", "kind", "page"])


FOUND = "host long, template long, kind byte, page long"


def host_digest(url: str | None) -> bytes:
    return blake2b(host_and_path(url)[0].encode("utf-8", "replace"), digest_size=8).digest()


def number(digest: bytes) -> int:
    return int.from_bytes(digest, "little", signed=True)


def site_templates(pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """(template): the numbers of contents and shapes to delete, each of one host.

    Only numbers are shuffled: first by host, template and article, so that one that stands on a third of all
    pages spreads over all tasks, then counts of these by host and template.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield found_on(batch, False)

    n = pages.mapInArrow(scan, FOUND).distinct().groupBy("host", "template", "kind").agg(F.count(F.lit(1)).alias("n"))
    counted = settle(n.filter("n >= IF(host = template, 1, 2)"), "site-counts")
    sizes = counted.filter("host = template").select("host", F.col("n").alias("pages"))
    least = f"CASE kind WHEN {CONTAINER} THEN {min_pages} WHEN {TEXTUAL} THEN {max(min_pages, TEXT_PAGES)} ELSE {max(min_pages, SHAPE_PAGES)} END"
    share = f"CASE kind WHEN {CONTAINER} THEN {min_share} WHEN {TEXTUAL} THEN {max(min_share, TEXT_SHARE)} ELSE {SHAPE_SHARE} END"
    often = counted.filter(f"host <> template AND n >= {least}").join(sizes, "host").filter(f"n >= pages * {share}").select("template")
    templates = settle(often, "site-templates")
    discard(counted)
    return templates


def extract_pages(pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE, sent: int = SENT_TEMPLATES) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every page.

    Null, empty and unreadable html gives an empty text. Repeated rows are extracted each. An empty
    table gives no rows. Other columns are not read. Pages without a host count as pages of one.

    Up to `sent` templates go to every task and no page moves; if there are more, pages are joined with
    their own templates, which shuffles the html once. The texts are the same.
    """
    keyed = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", F.xxhash64("url", "html").alias("key"))
    templates = site_templates(keyed.select("key", "url", "html"), min_pages, min_share)
    if templates.count() <= sent:
        all_of_them = np.sort(np.array([row[0] for row in all_rows(templates)], np.int64))
        discard(templates)
        shared = pages.sparkSession.sparkContext.broadcast(all_of_them)

        def extract_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield extracted(batch, [shared.value] * batch.num_rows)

        return keyed.select("page_id", "url", "html").mapInArrow(extract_all, EXTRACTED)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield found_on(batch, True)

    found = keyed.select("key", "url", "html").mapInArrow(scan, FOUND).select(F.col("page").alias("key"), "template").distinct()
    own = settle(found.join(templates, "template").groupBy("key").agg(F.sort_array(F.collect_set("template")).alias("own")), "site-own")

    def extract_own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield extracted(batch, [np.array(one or (), np.int64) for one in batch.column("own").to_pylist()])

    return keyed.join(own, "key", "left").select("page_id", "url", "html", "own").mapInArrow(extract_own, EXTRACTED)


EXTRACTED = "page_id long, url string, text string, n_chars long"


def extracted(batch: pa.RecordBatch, templates: list[np.ndarray]) -> pa.RecordBatch:
    """The texts of a batch of pages, with the sorted templates to look up for each."""
    texts = []
    for url, page, known in zip(batch.column("url").to_pylist(), batch.column("html").to_pylist(), templates):
        if not page:
            texts.append("")
            continue
        top = parse(page)
        texts.append(text_without(top, deleted(top, host_digest(url), known) if len(known) else set()))
    return pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=["page_id", "url", "text", "n_chars"])


def deleted(top: Node, host: bytes, known: np.ndarray) -> set[int]:
    """The ids of the elements that are templates of the host."""
    found = candidates(top)
    own = np.array([template_key(host, whole, kind) for _, whole, kind in found], np.int64)
    at = np.minimum(np.searchsorted(known, own), len(known) - 1)
    return {id(found[i][0]) for i in np.flatnonzero(known[at] == own)}
