"""Layout-aware text of web pages: a tree builder with implied tags, visibility rules, and a renderer."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from topiclake.llm.common import table
from topiclake.llm.registry import query

# Element groups of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes".split())
ESCAPABLE = frozenset("textarea title".split())
HEAD = frozenset("base link meta title style script template noscript".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form "
                     "h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul li dd dt".split())
BLOCK = CLOSES_P | frozenset("html body caption legend optgroup option tr tbody thead tfoot listing".split())
MARGIN = frozenset("p h1 h2 h3 h4 h5 h6 ul ol menu dir dl blockquote pre figure table listing fieldset".split())
SCOPE = frozenset("html table td th caption template button object marquee applet".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PAGE, TABLE = frozenset(["html"]), frozenset(["table"])
IN_TABLE = frozenset("caption tbody thead tfoot tr td th".split())
HIDDEN = frozenset("head script style template noscript iframe noembed noframes object audio video canvas datalist area param source track".split())
SAME_SIBLING = {  # start tag -> open elements it ends, and the elements that guard those above
    "li": (frozenset(["li"]), frozenset("ul ol menu dir".split())),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])), "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "option": (frozenset(["option"]), frozenset(["select", "optgroup", "datalist"])),
    "optgroup": (frozenset(["optgroup"]), frozenset(["select"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])), "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "tr": (frozenset(["tr"]), frozenset(["table"])), "caption": (frozenset(["caption"]), frozenset(["table"])),
    **{t: (frozenset("tbody thead tfoot caption colgroup".split()), frozenset(["table"])) for t in ("tbody", "thead", "tfoot", "colgroup")},
}
TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))|<[!?][^>]*+(?:>|\Z)|</(?P<end>[a-zA-Z][^\s/>]*+)[^>]*+(?:>|\Z)|</[^a-zA-Z>][^>]*+(?:>|\Z)|</>"
    r"|<(?P<start>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[\s/]++|[^\s/>=]++(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|(?![\"'])[^\s>]*+))?|=)*+)>", re.S)
ATTRIBUTE = re.compile(r"([^\s/>=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]*)))?")
OPENING = re.compile(r"<[a-zA-Z]")
SPACE = re.compile(r"[ \t\n\f\r]+")
SIMPLE = re.compile(r"(\*|[a-zA-Z][\w-]*)?((?:[.#][\w-]+)*)\Z")
SAID = re.compile(r"(?:^|;)\s*(display(?=\s*:\s*[a-zA-Z])|visibility(?=\s*:\s*(?:hidden|collapse|visible)\b))\s*:\s*([a-zA-Z-]+)[^;!]*(!\s*important)?(?=\s*(?:;|\Z))", re.I)
DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*([a-zA-Z-]+)", re.I)
NOT_STYLED = {}  # no element writes to it
VISIBILITY = re.compile(r"(?:^|;)\s*visibility\s*:\s*(hidden|collapse|visible)\b", re.I)
KEPT_SPACE = re.compile(r"(?:^|;)\s*white-space\s*:\s*(?:pre|pre-wrap|break-spaces)\b", re.I)
INDENTS = 40  # deeper items hang no further
GRIDS = 20  # tables nested deeper are laid out as blocks
PAD = 60  # wider columns are not padded, so a huge cell costs its own size alone


class Node:
    __slots__ = ("tag", "attrs", "children", "said")

    def __init__(self, tag: str, attrs: dict):
        self.tag, self.attrs, self.children, self.said = tag, attrs, [], NOT_STYLED


def _attributes(text: str) -> dict:
    if not text or text.isspace():
        return {}
    found = {}
    for name, double, single, bare in ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), unescape(double or single or bare))
    return found


class Builder:
    """Builds the tree of a page. Start and end tags that authors leave out are supplied; end tags that
    match nothing are passed over. Depth costs no recursion."""

    def __init__(self):
        self.root = Node("html", {})
        self.stack, self.body = [self.root], None
        self.open = Counter()  # of tags on the stack, so that nothing is looked for in vain
        self.sheets = []

    def _open(self, tag: str, attrs: dict) -> Node:
        node = Node(tag, attrs)
        self.stack[-1].children.append(node)
        self.stack.append(node)
        self.open[tag] += 1
        return node

    def _cut(self, depth: int) -> None:
        for node in self.stack[depth:]:
            self.open[node.tag] -= 1
        del self.stack[depth:]

    def _pop_to(self, tags: frozenset, guard: frozenset) -> bool:
        """End the nearest open element of `tags`, with all inside it, unless one of `guard` is nearer."""
        if not any(self.open[t] for t in tags):
            return False
        for depth in range(len(self.stack) - 1, 0, -1):
            if self.stack[depth].tag in tags:
                self._cut(depth)
                return True
            if self.stack[depth].tag in guard:
                return False
        return False

    def _in_body(self) -> None:
        if self.body is None:
            self._cut(1)
            self.body = self._open("body", {})

    def start(self, tag: str, attrs: dict) -> None:
        if tag == "html":
            return
        if tag == "head":
            if self.body is None and len(self.stack) == 1:
                self._open("head", attrs)
            return
        if tag == "body":
            if self.body is None:
                self._in_body()
                self.body.attrs = attrs
            return
        if self.body is None and tag in HEAD:
            if len(self.stack) == 1:
                self._open("head", {})
        else:
            self._in_body()
        if tag in CLOSES_P:
            self._pop_to(frozenset(["p"]), SCOPE)
        if tag in SAME_SIBLING:
            self._pop_to(*SAME_SIBLING[tag])
        if tag in HEADINGS and self.stack[-1].tag in HEADINGS:  # a heading does not hold another
            self._cut(len(self.stack) - 1)
        if tag in ("td", "th") and self._needs("tr"):
            self.start("tr", {})
        elif tag == "tr" and self.stack[-1].tag == "table":
            self._open("tbody", {})
        node = self._open(tag, attrs)
        if tag in VOID:
            self._cut(len(self.stack) - 1)

    def _needs(self, tag: str) -> bool:
        return self.stack[-1].tag in ("table", "tbody", "thead", "tfoot") and self.stack[-1].tag != tag

    def end(self, tag: str) -> None:
        if tag == "p" and not self.open["p"]:
            self._in_body()
            self.stack[-1].children.append(Node("p", {}))
        elif tag == "br":
            self.start("br", {})
        elif tag == "head":
            if self.body is None:
                self._cut(1)
        elif tag not in ("html", "body"):
            self._pop_to(frozenset([tag]), PAGE if tag == "table" else TABLE if tag in IN_TABLE else SCOPE)

    def text(self, text: str) -> None:
        top = self.stack[-1]
        if self.body is None and top.tag not in HEAD:
            if text.isspace():
                return
            self._in_body()
        if "&" in text and self.stack[-1].tag not in RAW:
            text = unescape(text)
        self.stack[-1].children.append(text)


def parse(html: str) -> Builder:
    builder, at, size = Builder(), 0, len(html)
    while at < size:
        tag = html.find("<", at)
        if tag < 0:
            builder.text(html[at:])
            break
        found = TOKEN.match(html, tag)
        if found is None:
            if OPENING.match(html, tag):  # a tag that never ends takes the rest of the page with it
                if tag > at:
                    builder.text(html[at:tag])
                break
            builder.text(html[at:tag + 1])
            at = tag + 1
            continue
        if tag > at:
            builder.text(html[at:tag])
        at = found.end()
        if found["start"]:
            name = found["start"].lower()
            attrs = _attributes(found["attrs"])
            builder.start(name, attrs)
            if name in RAW or name in ESCAPABLE:
                close = re.compile(rf"</{name}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(html, at)
                inside = html[at:close.start() if close else size]
                if name == "style" and for_screen(attrs.get("media", "")):
                    builder.sheets.append(inside)
                elif inside and name == "textarea":
                    builder.text(inside[1:] if inside[0] == "\n" else inside)
                at = close.end() if close else size
                builder.end(name)
        elif found["end"]:
            builder.end(found["end"].lower())
    return builder


def rules_of(sheets: list[str]) -> Iterator[tuple[str, str]]:
    """(selectors, declarations) in order. Blocks of `@media` for all media or the screen, without further conditions,
    count; those of other at-rules do not."""
    for sheet in sheets:
        text, at = re.sub(r"/\*.*?(?:\*/|\Z)", "", sheet, flags=re.S), 0
        while stop := re.compile(r"[{};]").search(text, at):
            head, at = text[at:stop.start()].strip(), stop.end()
            if stop[0] != "{":
                continue  # the end of a block that counts, or of a statement
            if head.startswith("@"):
                name, _, media = head.partition(" ")
                if name.lower() != "@media" or not for_screen(media):
                    depth = 1
                    while depth and (brace := re.compile(r"[{}]").search(text, at)):
                        depth, at = depth + (1 if brace[0] == "{" else -1), brace.end()
                    at = len(text) if depth else at
                continue
            end = text.find("}", at)
            end = len(text) if end < 0 else end
            yield head, text[at:end]
            at = end + 1


def for_screen(media: str) -> bool:
    return any(m.strip().lower() in ("", "all", "screen", "only screen", "only all") for m in media.split(","))


class Cascade:
    """What style sheets say of display and visibility. Selectors of tags, classes and ids, alone, together, as
    descendants or as children, are read, all others passed over. The most specific rule wins, of equal ones the last."""

    def __init__(self, sheets: list[str]):
        self.by_key = {}  # tag, class or id -> (selector, place in it, tag, names, is a child, is the last)
        self.said = []  # of each selector: (property, rank, value)
        for selectors, body in rules_of(sheets):
            told = [(m[1].lower(), m[2].lower(), bool(m[3])) for m in SAID.finditer(body)]
            for selector in selectors.split(",") if told else ():
                self._add(selector, told)

    def _add(self, selector: str, told: list) -> None:
        parts, child = [], False
        for word in re.findall(r">|[^\s>]+", selector):
            if word == ">":
                child = True
                continue
            simple = SIMPLE.match(word)
            if not simple:
                return
            tag = (simple[1] or "*").lower()
            parts.append((tag, frozenset(re.findall(r"[.#][\w-]+", simple[2])), child))
            child = False
        if not parts or child:
            return
        number, names = len(self.said), [n for _, own, _ in parts for n in own]
        weight = sum(n[0] == "#" for n in names), sum(n[0] == "." for n in names), sum(t != "*" for t, _, _ in parts)
        self.said.append([(prop, (important, weight, number), value) for prop, value, important in told])
        for place, (tag, own, is_child) in enumerate(parts):
            key = min(own) if own else tag
            self.by_key.setdefault(key, []).append((number, place, tag, own, is_child, place == len(parts) - 1))

    def apply(self, root: Node) -> None:
        """Give each element what holds for it, from the top down; an element knows the selectors begun above it."""
        if not self.said:
            return
        walk = [(root, frozenset(), frozenset())]
        while walk:
            node, above, parent = walk.pop()
            a = node.attrs
            names = {*("." + c for c in a.get("class", "").split()), *(["#" + a["id"]] if a.get("id") else [])}
            here, best = set(), {}
            for key in (node.tag, "*", *names):
                for number, place, tag, own, is_child, is_last in self.by_key.get(key, ()):
                    if tag in ("*", node.tag) and own <= names and (place == 0 or (number, place - 1) in (parent if is_child else above)):
                        here.add((number, place))
                        for prop, rank, value in self.said[number] if is_last else ():
                            if prop not in best or rank >= best[prop][0]:
                                best[prop] = rank, value
            node.said = {prop: (value, rank[0]) for prop, (rank, value) in best.items()}
            below = above | here if here else above
            walk.extend((c, below, frozenset(here)) for c in node.children if not isinstance(c, str))


class Renderer:
    """Turns a tree into lines. Blocks start lines, some with a blank line around them; items get bullets or
    numbers and hang; cells of a row stand side by side in columns of even width."""

    def shown(self, node: Node) -> bool:
        a, tag = node.attrs, node.tag
        if tag in HIDDEN or "hidden" in a or tag == "dialog" and "open" not in a or tag == "input" and a.get("type", "").lower() == "hidden":
            return False
        value, important = node.said.get("display", ("", False))
        if "style" in a and not important:
            inline = DISPLAY.findall(a["style"])
            value = inline[-1].lower() if inline else value
        return value != "none"

    def render(self, top: Node, visible: bool = True, depth: int = 0) -> list[str]:
        """The lines of a subtree, by a walk with a stack of its own."""
        out = _Lines()
        walk = [(top, visible, False, None)]
        while walk:
            node, visible, kept, leave = walk.pop()
            if leave:
                leave()
            elif isinstance(node, str):
                if visible:
                    out.text(node, kept)
            elif node is top or self.shown(node):
                self._enter(node, visible, kept, depth, out, walk, node is top)
        return out.done()

    def _enter(self, node, visible, kept, depth, out, walk, is_top):
        tag, style = node.tag, node.attrs.get("style")
        if "visibility" in node.said:
            visible = node.said["visibility"][0] == "visible"
        if style:
            seen = VISIBILITY.search(style)
            if seen and not node.said.get("visibility", ("", False))[1]:
                visible = seen[1].lower() == "visible"
            kept = kept or bool(KEPT_SPACE.search(style))
        kept = kept or tag in ("pre", "textarea", "listing")
        if tag == "br":
            out.line()
            return
        if tag == "hr":
            out.block(1)
            return
        if tag == "input":
            if visible and node.attrs.get("type", "text").lower() in ("text", "search", "submit", "button", "reset", "email", "url", "tel", "number"):
                out.text(node.attrs.get("value", ""), False)
            return
        if tag == "table" and depth < GRIDS:
            out.block(1)
            for line in self._grid(node, visible, depth):
                out.text(line, True)
                out.line()
            out.block(1)
            return
        children = node.children
        if tag == "details" and "open" not in node.attrs:
            children = [c for c in children if not isinstance(c, str) and c.tag == "summary"]
        elif tag == "select":
            options = [c for c in _descendants(node, "option")]
            children = [c for c in options if "selected" in c.attrs] or options[:1]
        margin = 1 if tag in MARGIN else 0
        if is_top or tag not in BLOCK:
            if tag in ("td", "th"):
                out.text(" ", False)
            walk.extend((c, visible, kept, None) for c in reversed(children))
            return
        out.block(margin)
        if tag in ("ul", "ol", "menu", "dir"):
            nested = out.lists > 0
            if nested:
                out.block(0, drop=True)
            numbers = _numbers(node) if tag == "ol" else {}
            for c in children:
                if not isinstance(c, str) and c.tag == "li":
                    c.attrs["\0mark"] = f"{numbers[id(c)]}. " if numbers else "* "
            out.lists += 1

            def leave():
                out.lists -= 1
                out.block(0 if nested else margin)
        elif tag == "li":
            out.hang(node.attrs.get("\0mark", "* "))

            def leave():
                out.unhang()
        elif tag in ("blockquote", "dd"):
            out.hang("  ")

            def leave():
                out.unhang()
                out.block(margin)
        else:
            def leave():
                out.block(margin)
        walk.append((None, visible, kept, leave))
        walk.extend((c, visible, kept, None) for c in reversed(children))

    def _grid(self, node: Node, visible: bool, depth: int) -> list[str]:
        caption, rows = [], []
        groups = {"thead": [], "": [], "tfoot": []}
        for child in node.children:
            if isinstance(child, str):
                if child.strip():
                    caption.append(SPACE.sub(" ", child).strip())  # text that is in no cell stands above
            elif not self.shown(child):
                continue
            elif child.tag == "tr":
                groups[""].append(child)
            elif child.tag in ("tbody", "thead", "tfoot"):
                loose = []
                for c in child.children:
                    if isinstance(c, str) or c.tag != "tr":
                        loose.append(c)
                    elif self.shown(c):
                        groups["" if child.tag == "tbody" else child.tag].append(c)
                caption += self._loose(loose, visible, depth)
            else:
                caption += self._loose([child], visible, depth)
        held: dict[int, int] = {}  # column -> rows that a cell from above still takes there
        for row in (*groups["thead"], *groups[""], *groups["tfoot"]):
            cells, column, loose = [], 0, []
            for cell in row.children:
                if isinstance(cell, str) or cell.tag not in ("td", "th"):
                    loose.append(cell)
                    continue
                if not self.shown(cell):
                    continue
                while held.get(column):
                    column += 1
                wide, high = _span(cell, "colspan", 1000), _span(cell, "rowspan", 65534)
                cells.append((column, wide, self.render(cell, self._seen(row, visible), depth + 1)))
                for c in range(column, column + wide):
                    held[c] = high
                column += wide
            caption += self._loose(loose, visible, depth)
            held = {c: n - 1 for c, n in held.items() if n > 1}
            rows.append(cells)
        widths: dict[int, int] = {}
        for cells in rows:
            for column, wide, lines in cells:
                if wide == 1:
                    longest = max(map(len, lines), default=0)
                    widths[column] = max(widths.get(column, 0), min(longest, PAD))
        place, starts = 0, {}
        for column in range(max((c + w for cells in rows for c, w, _ in cells), default=0)):
            starts[column] = place
            place += widths.get(column, 0) + 2 if widths.get(column) else 0
        out = caption
        for cells in rows:
            for n in range(max((len(lines) for _, _, lines in cells), default=0)):
                line = ""
                for column, _, lines in cells:
                    if n < len(lines) and lines[n]:
                        line = line.ljust(starts[column]) if len(line) < starts[column] else line + "  " if line else line
                        line += lines[n]
                out.append(line.rstrip())
        return out

    def _seen(self, row: Node, visible: bool) -> bool:
        seen = VISIBILITY.search(row.attrs.get("style", ""))
        return seen[1].lower() == "visible" if seen else visible

    def _loose(self, children: list, visible: bool, depth: int) -> list[str]:
        if not any(c.strip() if isinstance(c, str) else True for c in children):
            return []
        holder = Node("div", {})
        holder.children = children
        return [line for line in self.render(holder, visible, depth + 1) if line]


class _Lines:
    """Lines being written: white space collapses, blank lines wait until text follows, items hang."""

    def __init__(self):
        self.lines, self.now = [], []
        self.blank, self.gap, self.lists = 0, False, 0
        self.marks: list[list] = []  # [mark, already written]
        self.any = False

    def _begin(self) -> None:
        if not self.now:
            if self.any:
                self.lines.extend([""] * self.blank)
            self.blank, self.any = 0, True
            prefix = []
            for mark in self.marks:
                prefix.append(" " * len(mark[0]) if mark[1] else mark[0])
                mark[1] = True
            self.now.append("".join(prefix))

    def text(self, text: str, kept: bool) -> None:
        if kept:
            for n, part in enumerate(text.replace("\r\n", "\n").replace("\r", "\n").split("\n")):
                if n:
                    self.line()
                if part:
                    self._begin()
                    self.now.append(part)
            self.gap = False
            return
        words = SPACE.sub(" ", text)
        if words.startswith(" "):
            self.gap = bool(self.now)
            words = words[1:]
        if not words:
            return
        self._begin()
        if self.gap and len(self.now) > 1:
            self.now.append(" ")
        self.gap = words.endswith(" ")
        self.now.append(words[:-1] if self.gap else words)

    def line(self) -> None:
        """End the line; one without text is a blank line between others."""
        if self.now:
            self.lines.append("".join(self.now).rstrip())
            self.now = []
        elif self.any:
            self.blank += 1
        self.gap = False

    def block(self, margin: int, drop: bool = False) -> None:
        if self.now:
            self.lines.append("".join(self.now).rstrip())
            self.now = []
        self.gap = False
        self.blank = 0 if drop else max(self.blank, margin)

    def hang(self, mark: str) -> None:
        self.block(0)
        self.marks.append([mark if len(self.marks) < INDENTS else "", False])

    def unhang(self) -> None:
        self.block(0)
        self.marks.pop()

    def done(self) -> list[str]:
        self.block(0)
        return self.lines


def _descendants(node: Node, tag: str) -> Iterator[Node]:
    walk = list(reversed(node.children))
    while walk:
        n = walk.pop()
        if not isinstance(n, str):
            if n.tag == tag:
                yield n
            walk.extend(reversed(n.children))


def _whole(text: str | None, default: int) -> int:
    found = re.match(r"\s*([+-]?[0-9]{1,9})", text or "")
    return int(found[1]) if found else default


def _span(cell: Node, name: str, most: int) -> int:
    return min(max(_whole(cell.attrs.get(name), 1), 1), most)


def _numbers(node: Node) -> dict[int, int]:
    items = [c for c in node.children if not isinstance(c, str) and c.tag == "li"]
    down = "reversed" in node.attrs
    number, out = _whole(node.attrs.get("start"), len(items) if down else 1), {}
    for item in items:
        number = _whole(item.attrs.get("value"), number)
        out[id(item)] = number
        number += -1 if down else 1
    return out


def text_of(html: str | None) -> str:
    """All visible text of a page, laid out in lines."""
    if not html:
        return ""
    built = parse(html.replace("\0", ""))
    Cascade(built.sheets).apply(built.root)
    return "\n".join(Renderer().render(built.root))


def extracted(pages: DataFrame) -> DataFrame:
    """(page_id, text, n_lines) of every page. Null and empty pages have an empty text and no lines, as have
    pages that show nothing; repeated rows and rows without a page_id are rendered like any other, and
    other columns are not looked at."""
    kind = pages.select("page_id").schema.add("text", "string").add("n_lines", "long")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [text_of(h.as_py()) for h in batch.column("html")]
            lines = [t.count("\n") + 1 if t else 0 for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), pa.array(texts, pa.string()), pa.array(lines, pa.int64())], names=["page_id", "text", "n_lines"])

    return pages.select("page_id", "html").mapInArrow(run, kind)


@query("op4_html_text")
def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(table(spark, sf_dir, "pages"))
