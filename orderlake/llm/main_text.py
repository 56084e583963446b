"""The main text of web pages, by a minimum cut between content and boilerplate.

A page is read once, tolerant of unclosed and stray tags, into blocks: runs of text that no block element parts. Each
block gets a gain, in tenths of a log-odds unit, from what it is in (article or main element; navigation, header,
footer, sidebar, form, notice, advert, comments, by element, role, class and id) and from its shape (words, final
punctuation, share of link text). Gains are the capacities to the two terminals. Blocks that follow one another are
joined by an edge, the heavier the closer they are in the tree, and so are blocks that follow one another below the
same parent. The minimum cut (`mincut`) labels all blocks of a page at once.

A hint in a class or id does not count on an element that holds the article itself (`Page.around_article`).

White space within a block is one space, `br` is white space, blocks are joined by a line feed. Character references
are decoded. Scripts, styles, the head, comments in the markup and all tags are no text. A null or empty page, and one
without content, has an empty text. Nothing is cut off: a page of any length is read whole by one task. Repeated rows
are read as often as they are there; columns of the results' names are replaced.
"""

import re
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from orderlake.llm.encode import arrow_groups
from orderlake.llm.mincut import cheapest_labels

# Elements by their part in a page.
VOID = frozenset("area base br col embed frame hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea xmp iframe noembed noframes".split())
UNSEEN = frozenset("head noscript template svg math object select button datalist audio video canvas".split())
BREAKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section "
    "select summary table tbody td tfoot th thead tr ul caption".split()
)
# A start tag of the first kind ends an open element of the second, up to one of the third.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table", "thead", "tbody", "tfoot"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
IN_HEAD = frozenset("base link meta noscript template script style title basefont bgsound".split())
CELLS = frozenset({"td", "th", "table", "caption", "template", "html"})
TABLE_PARTS = frozenset({"table", "thead", "tbody", "tfoot", "tr", "td", "th", "caption", "html", "body"})
BOILERPLATE = frozenset("nav footer aside form dialog menu".split())
BOILERPLATE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())
BOILERPLATE_WORDS = frozenset(
    "ad ads adsense advert adverts advertisement advertising sponsor sponsored sponsors promo promoted promotion banner "
    "cookie cookies consent gdpr notice notices notification popup modal overlay newsletter subscribe subscription "
    "signup login nav navbar navigation menu menus breadcrumb breadcrumbs sidebar aside widget widgets footer header "
    "masthead topbar toolbar comment comments commentlist disqus respond reply replies discussion share sharing social "
    "related recommended recommendations trending pagination pager search form copyright disclaimer skip outbrain taboola "
    "sitemap teaser teasers".split()
)
CONTENT_WORDS = frozenset("article articlebody content main post entry story text body blog".split())

MARKUP = re.compile(r"<(?:!--|[!?]|/?[a-zA-Z]|/)")
TAG = re.compile(
    r"""</?([a-zA-Z][^\s/>]*+)((?:[\s/]++|=|[^\s/>=]++(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|(?!["'])[^\s>]++))?+)*+)>"""
)
ATTRIBUTE = re.compile(r"""(?<![^\s/"'])(class|id|role|hidden|aria-hidden|style|itemprop)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+))?""", re.I)
CLOSING = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in RAW}
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

# Gains.
IN_BOILERPLATE = -90
IN_MAIN = 40
BESIDE_MAIN = -40
IN_CONTENT = 24
PLAIN = 12
MOST_WORDS = 25
FEW_WORDS, IS_SHORT = 4, -10
ENDS_SENTENCE = 6
LINKED, LINKED_IN_MAIN = -40, -15
# Edges.
SAME_PARENT, NEAR_PARENT, FAR_PARENT, SIBLINGS = 6, 3, 1, 4
OUT_BYTES = 8 << 20


class Element:
    __slots__ = ("tag", "parent", "boilerplate", "hinted", "main", "content", "headline", "chars", "unseen")

    def __init__(self, tag, parent):
        self.tag, self.parent = tag, parent
        self.boilerplate = self.hinted = self.main = self.content = self.headline = self.unseen = False
        self.chars = 0


class Page:
    """Blocks of a page: text, share of link text, block element they are in."""

    def __init__(self, html: str):
        self.root = Element("", None)
        self.elements, self.blocks = [self.root], []
        self.stack, self.open = [self.root], {}
        self.parts, self.linked, self.at = [], 0, None
        self.read(html)
        self.end_block()

    def read(self, html: str) -> None:
        place, end = 0, len(html)
        while place < end:
            found = MARKUP.search(html, place)
            start = found.start() if found else end
            if start > place:
                self.add_text(html[place:start])
            if not found:
                return
            if found.group() == "<!--":
                stop = start + 4 if html.startswith((">", "->"), start + 4) else html.find("-->", start + 4)
                place = end if stop < 0 else html.find(">", stop) + 1
                continue
            tag = TAG.match(html, start) if found.group()[-1].isalpha() else None
            if tag is None:
                # Declarations, what looks like a tag but is none, and a tag that the page's end cuts off.
                place = html.find(">", start) + 1 or end
                continue
            place, name = tag.end(), tag[1].lower()
            if html[start + 1] == "/":
                self.end_tag(name)
                continue
            if name in RAW:
                closing = CLOSING[name].search(html, place)
                place = closing.start() if closing else end
                continue
            self.start_tag(name, tag[2])

    def add_text(self, text: str) -> None:
        if self.stack[-1].unseen:
            return
        if "&" in text:
            text = unescape(text)
        self.parts.append(text)
        if self.open.get("a"):
            self.linked += len("".join(text.split()))
        if self.at is None and not text.isspace():
            self.at = self.stack[-1]

    def add_space(self) -> None:
        if self.parts:
            self.parts.append(" ")

    def end_block(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                at = self.at
                while at.tag not in BREAKS and at.parent is not None:
                    at = at.parent
                letters = len(text) - text.count(" ")
                self.blocks.append((text, min(1.0, self.linked / letters), at))
                at.chars += len(text)
            self.parts = []
        self.linked, self.at = 0, None

    def start_tag(self, name: str, attributes: str) -> None:
        if self.open.get("head") and name not in IN_HEAD:
            self.close({"head"}, {"body"})
        if name in BREAKS:
            self.end_block()
            if self.open.get("p"):
                self.close({"p"}, CELLS)
            if name in ENDS:
                self.close(*ENDS[name])
        elif name == "br":
            self.add_space()
        if name in VOID:
            return
        parent = self.stack[-1]
        element = Element(name, parent)
        element.unseen = parent.unseen or name in UNSEEN
        element.boilerplate = name in BOILERPLATE
        element.main = name in ("article", "main")
        if attributes:
            self.read_hints(element, attributes)
        if name == "a" and self.open.get("a"):
            self.close({"a"}, CELLS)
            element.parent = self.stack[-1]
        self.elements.append(element)
        self.stack.append(element)
        self.open[name] = self.open.get(name, 0) + 1

    def read_hints(self, element: Element, attributes: str) -> None:
        for key, value in ATTRIBUTE.findall(attributes):
            key, value = key.lower(), value.strip("\"'")
            if key == "hidden":
                element.unseen = True
            elif key == "aria-hidden":
                element.hinted |= value.lower() == "true"
            elif key == "style":
                element.unseen |= "display:none" in value.lower().replace(" ", "")
            elif key == "role":
                element.boilerplate |= value.lower() in BOILERPLATE_ROLES
                element.main |= value.lower() in ("main", "article")
            elif key == "itemprop":
                element.main |= value.lower() == "articlebody"
            else:
                words = {word.lower() for word in WORDS.findall(value)}
                element.hinted |= not words.isdisjoint(BOILERPLATE_WORDS)
                element.content |= not words.isdisjoint(CONTENT_WORDS)

    def end_tag(self, name: str) -> None:
        if name in BREAKS:
            self.end_block()
        elif name == "br":
            self.add_space()
        if not self.open.get(name):
            return
        if name in BREAKS:
            self.close({name}, frozenset() if name in TABLE_PARTS else CELLS)
        else:
            # The end of an inline element does not end the blocks around it.
            self.close({name}, BREAKS)

    def close(self, names, border) -> None:
        """Close the innermost open element of these names, with all in it, unless a border comes first."""
        stack = self.stack
        for depth in range(len(stack) - 1, 0, -1):
            tag = stack[depth].tag
            if tag in names:
                for element in stack[depth:]:
                    self.open[element.tag] -= 1
                del stack[depth:]
                return
            if tag in border:
                return

    def settle(self) -> None:
        """What each element is in, from the outermost in; elements are in the order of the page."""
        for element in reversed(self.elements):
            up = element.parent
            if up is not None:
                up.chars += element.chars
                up.headline |= element.headline or element.tag == "h1"
        total = self.root.chars
        around = self.around_article()
        self.has_main = bool(around)
        for element in self.elements[1:]:
            up = element.parent
            # Neither the frame around the article nor the headline's box is boilerplate for its name.
            frame = element in around or element.headline and up.main or element.tag in ("html", "body", "main")
            frame |= not around and 2 * element.chars > total
            own = element.boilerplate and not (element.tag == "form" and element in around)
            own |= element.hinted and not frame or element.tag == "header" and not up.main
            element.boilerplate = up.boilerplate or own
            element.main |= up.main
            element.content |= up.content

    def around_article(self) -> set:
        """The element that holds the article, and all around it: of the main and article elements one with a
        headline, and the longest of those."""
        several = [e for e in self.elements if e.main and e.chars and not e.hinted and not e.boilerplate]
        around: set = set()
        if several:
            up = max(several, key=lambda e: (e.tag != "article", e.headline, e.chars))
            while up is not None:
                around.add(up)
                up = up.parent
        return around

    def gain(self, text: str, linked: float, at: Element) -> int:
        words = text.count(" ") + 1
        gain = min(words, MOST_WORDS) + (IS_SHORT if words < FEW_WORDS else 0)
        if text[-1] in ".!?…。！？\"”»":
            gain += ENDS_SENTENCE
        if at.boilerplate:
            return gain + IN_BOILERPLATE
        if at.main:
            return gain + IN_MAIN + round(LINKED_IN_MAIN * linked)
        return gain + round(LINKED * linked) + (BESIDE_MAIN if self.has_main else IN_CONTENT if at.content else PLAIN)

    def edges(self) -> list[tuple[int, int, int]]:
        found, before = [], {}
        for i, (_, _, at) in enumerate(self.blocks):
            if i:
                last = self.blocks[i - 1][2]
                parents = (at.parent, last.parent)
                near = at is last or parents[0] is parents[1]
                wider = parents[0] is last or parents[1] is at
                found.append((i - 1, i, SAME_PARENT if near else NEAR_PARENT if wider else FAR_PARENT))
            above = at.parent or at
            if before.get(above, i - 1) < i - 1:
                found.append((before[above], i, SIBLINGS))
            before[above] = i
        return found

    def labels(self) -> list[bool]:
        self.settle()
        return cheapest_labels([self.gain(*block) for block in self.blocks], self.edges())


def labelled_blocks(html: str | None) -> list[tuple[str, bool]]:
    """The blocks of a page in order, and whether they are content."""
    if not html:
        return []
    page = Page(html)
    return [(text, label) for (text, _, _), label in zip(page.blocks, page.labels())]


def main_text(html: str | None) -> str:
    return "\n".join(text for text, label in labelled_blocks(html) if label)


def with_main_text(pages: DataFrame, html: str = "html") -> DataFrame:
    """`pages` without its markup, with `text` (its main text), `n_chars` and `n_blocks` (blocks of content)."""
    kept = [name for name in pages.columns if name not in (html, "text", "n_chars", "n_blocks")]
    schema = T.StructType([*(pages.schema[name] for name in kept), *T._parse_datatype_string("text string, n_chars long, n_blocks int")])
    arrow = to_arrow_schema(schema)

    def run(batches):
        for batch in batches:
            # A large page must not wait for others in memory.
            for low, high in arrow_groups(batch.column(len(kept)), OUT_BYTES):
                part = batch.slice(low, high - low)
                texts, blocks = [], []
                for value in part.column(len(kept)):
                    found = [text for text, label in labelled_blocks(value.as_py()) if label]
                    texts.append("\n".join(found))
                    blocks.append(len(found))
                columns = [pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64()), pa.array(blocks, pa.int32())]
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(len(kept))), *columns], schema=arrow)

    return pages.select(*kept, html).mapInArrow(run, schema)


def block_labels(pages: DataFrame, html: str = "html") -> DataFrame:
    """Every block of every page: `page_id, block` (from 0), `text, content`."""
    schema = T.StructType([pages.schema["page_id"], *T._parse_datatype_string("blocks array<struct<text:string,content:boolean>>")])
    arrow = to_arrow_schema(schema)

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                page = batch.slice(i, 1)
                blocks = [{"text": text, "content": label} for text, label in labelled_blocks(page.column(1)[0].as_py())]
                yield pa.RecordBatch.from_arrays([page.column(0), pa.array([blocks], arrow.field("blocks").type)], schema=arrow)

    blocks = pages.select("page_id", html).mapInArrow(run, schema)
    return blocks.select("page_id", F.posexplode("blocks").alias("block", "x")).select("page_id", "block", "x.*")
