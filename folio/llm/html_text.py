"""HTML extraction by layout-aware rendering.

A tree builder reads the tags, adds end tags that HTML implies (a paragraph before a block, an item before the next, a cell before a row)
and closes what is left open. A renderer walks the tree and emits all text that a browser would show: hidden elements (head, scripts,
styles, templates, `hidden`, `display: none`, closed details and dialogs) are left out, white space is collapsed outside <pre>, blocks are
put on lines of their own, paragraphs are set apart by a blank line, list items get a mark and an indent by depth, and the cells of a table
stand in aligned columns.

What is hidden is told by the page's own rules too: `display` and `visibility` in <style> elements (also within @media for all or screen) and in
style attributes, in the order of the cascade. Selectors of types, classes, ids and *, alone, together, as descendants or as children are
matched; rules with other selectors (attributes, pseudo-classes, siblings) or other @-rules are not read, nor are linked style sheets. What
shows itself again within something invisible (visibility: visible) is shown; nothing is within display: none.

SVG and MathML are read by their own rules: any element may close itself (<svg/>), no text is raw, CDATA is text, and an HTML block ends what
is open of them. Of SVG the drawn text is shown (text elements and foreign objects), of MathML all but annotations and phantoms. Text that SVG
draws only through <use> or a pattern is left out.

Edge cases: null gives null; an empty page gives an empty text. Malformed markup never fails: a stray end tag is ignored, an open comment
ends the page, a lone < is text. Nesting of any depth is walked without recursion, but below DEEPEST levels elements are put beside their
parent. Repeated rows are kept; an input column named like the output is replaced.
"""

from __future__ import annotations

import re
from collections import Counter
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.llm.common import small_batches, without

DEEPEST = 400
#: Cells up to this width set the width of their column; longer ones overflow it.
WIDEST = 60
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript template iframe noembed noframes xmp".split())
HIDDEN = set("head script style title noscript template iframe noembed noframes datalist audio video canvas object rp area base link meta param source track embed".split())
BLOCKS = set("html body address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul caption".split())
SPACED = set("p h1 h2 h3 h4 h5 h6 ul ol dl table pre blockquote figure menu".split())
#: Of SVG and MathML: what is never drawn, whose text SVG draws, parts of a formula that stand apart, and where HTML's rules hold again.
UNDRAWN = set("title desc defs metadata script style annotation annotation-xml symbol clippath mask marker pattern lineargradient radialgradient filter mphantom".split())
DRAWN = set("text tspan textpath a foreignobject".split())
APART = set("mfrac mroot munder mover munderover mtable mtr mlabeledtr".split())
HTML_WITHIN = {"svg": set("foreignobject desc title".split()), "math": set("mi mo mn ms mtext".split())}
#: HTML tags that end open SVG and MathML.
BREAKS = set("b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre ruby s small span strong strike sub sup table tt u ul var".split())
#: What closes an open <p>.
ENDS_P = BLOCKS - set("html body tr td th thead tbody tfoot caption option optgroup".split())
#: New tag: what it closes, and where the search for it stops.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "table", "td", "th"}),
    "dt": ({"dt", "dd"}, {"dl", "table", "td", "th"}),
    "dd": ({"dt", "dd"}, {"dl", "table", "td", "th"}),
    "option": ({"option"}, {"select", "datalist", "table"}),
    "optgroup": ({"option", "optgroup"}, {"select", "table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "tbody": ({"tr", "td", "th", "tbody", "thead", "tfoot", "caption"}, {"table"}),
    "thead": ({"tr", "td", "th", "tbody", "thead", "tfoot", "caption"}, {"table"}),
    "tfoot": ({"tr", "td", "th", "tbody", "thead", "tfoot", "caption"}, {"table"}),
    "body": ({"head"}, {"body"}),
}
_MARKUP = re.compile(r"<!--(?:(?=-?>)|.*?(?:-->|--!>|\Z))|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*)((?>[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*+)>", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_SAYS = re.compile(r"(?:^|;)\s*(display|visibility)\s*:\s*([a-zA-Z-]+)\s*(!\s*important)?", re.I)
_COMPOUND = re.compile(r"(\*|[a-zA-Z][\w-]*)?((?:[.#][\w-]+)*)\Z")
_SHEET = re.compile(r"/\*.*?(?:\*/|\Z)|<!--|-->", re.S)
_SCREEN = re.compile(r"@media\s+(?:only\s+)?(?:all|screen)\s*\Z", re.I)
_STYLED = re.compile("style|visibility", re.I)
_SPACE = re.compile(r"[ \t\n\r\f]+")


class Node:
    __slots__ = ("attrs", "children", "display", "ns", "tag", "unseen")

    def __init__(self, tag: str, attrs: dict | None = None, ns: str = "") -> None:
        self.tag, self.attrs, self.children, self.ns = tag, attrs or {}, [], ns  # ns: svg, math, or empty for HTML
        self.display, self.unseen = "", False  # what style rules say of display, and whether text in it is invisible

    def number(self, name: str, most: int) -> int:
        value = self.attrs.get(name, "")
        return min(most, max(1, int(value))) if value.isascii() and value.isdigit() and len(value) < 6 else 1


def foreign(top: Node, tag: str) -> bool:
    """Whether a new tag within top is one of SVG or MathML."""
    if not top.ns:
        return False
    if top.tag in HTML_WITHIN[top.ns]:
        return top.ns == "math" and tag in ("mglyph", "malignmark")
    return not (top.ns == "math" and top.tag == "annotation-xml" and (tag == "svg" or top.attrs.get("encoding", "").lower() in ("text/html", "application/xhtml+xml")))


def self_closing(text: str) -> bool:
    """Whether the slash at the end of a tag's text closes it, and is not the end of an unquoted value."""
    if text[-1:] != "/":
        return False
    start = max(text.rfind(c) for c in " \t\n\r\f\"'") + 1
    return "=" not in text[start:] and not text[:start].rstrip().endswith("=")


def tree(page: str) -> Node:
    """The page's elements; a child is a Node or a text."""
    root = Node("#root")
    stack, at, lower = [root], 0, ""
    last = page.rfind(">") + 1  # no tag ends behind it
    count: Counter[str] = Counter()  # of open elements by name

    def cut(i: int) -> None:
        count.subtract(n.tag for n in stack[i:])
        del stack[i:]

    def close(tags: set, until: set) -> None:
        if not any(count[t] > 0 for t in tags):
            return
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in tags:
                cut(i)
                tags = tags - {"li", "option"}  # these close one of their kind
                if not tags:
                    return
            elif stack[i].tag in until or stack[i].ns:
                return

    def leave() -> None:
        """Closes SVG and MathML down to where HTML's rules hold."""
        i = len(stack)
        while foreign(stack[i - 1], "p"):
            i -= 1
        cut(i)

    while at < len(page):
        m = _MARKUP.search(page, at, last) if at < last else None
        if not m:
            rest = page.find("<!--", max(at, last))
            page = page if rest < 0 else page[:rest]
            stack[-1].children.append(unescape(page[at:]))
            break
        if m.start() > at:
            stack[-1].children.append(unescape(page[at : m.start()]))
        at = m.end()
        if m[0][:4] == "<!--" and m.end() == last and not m[0].endswith(("-->", "--!>")) and m[0] != "<!--":
            break
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            if stack[-1].ns and m[0].startswith("<![CDATA[") and foreign(stack[-1], ""):
                end = page.find("]]>", m.start())
                stack[-1].children.append(page[m.start() + 9 : end if end >= 0 else len(page)])
                at = end + 3 if end >= 0 else len(page)
            continue
        if m[1] or m[4]:
            if tag in ("p", "br"):
                leave()
            if tag == "br":
                stack[-1].children.append(Node("br"))
            for i in range(len(stack) - 1, 0, -1) if count[tag] > 0 else ():
                if stack[i].tag == tag:
                    cut(i)
                    break
                if stack[i].tag == "table" or stack[i].tag in ("td", "th") and tag not in ("tr", "tbody", "thead", "tfoot", "table"):
                    break  # what is open outside a cell is not closed from within
            continue
        text = m[3] or m[6] or ""
        attrs = {k.lower(): unescape(a or b or c) for k, a, b, c in reversed(_ATTRIBUTE.findall(text))} if text.strip(" /") else {}
        if stack[-1].ns and foreign(stack[-1], tag):
            if tag in BREAKS or tag == "font" and attrs.keys() & {"color", "face", "size"}:
                leave()
            else:
                stack[-1].children.append(Node(tag, attrs, stack[-1].ns))
                if len(stack) < DEEPEST and not self_closing(text):
                    stack.append(stack[-1].children[-1])
                    count[tag] += 1
                continue
        if tag in ENDS_P:
            close({"p"}, {"table", "td", "th", "button", "caption", "object"})
        if tag in CLOSES:
            close(*CLOSES[tag])
        if tag in ("td", "th") and stack[-1].tag in ("table", "tbody", "thead", "tfoot"):
            stack[-1].children.append(Node("tr"))
            stack.append(stack[-1].children[-1])
            count["tr"] += 1
        node = Node(tag, attrs, tag if tag in HTML_WITHIN else "")
        stack[-1].children.append(node)
        if tag in RAW:
            lower = lower or page.lower()
            if len(lower) != len(page):  # a rare letter whose small form is longer
                lower = "".join(c if len(c.lower()) > 1 else c.lower() for c in page)
            end = lower.find(f"</{tag}", at)
            body, at = (page[at:], len(page)) if end < 0 else (page[at:end], end)
            if tag in ("textarea", "xmp", "style"):
                node.children.append(unescape(body) if tag == "textarea" else body)
            if end >= 0:
                stop = page.find(">", end)
                at = len(page) if stop < 0 else stop + 1
        elif tag not in VOID and len(stack) < DEEPEST and not (node.ns and self_closing(text)):
            stack.append(node)
            count[tag] += 1
    return root


def _rules(sheet: str) -> list[tuple[list, tuple, list]]:
    """(selector, its weight, what it says of display and visibility) of a style sheet's rules, in order. A selector is a list of (how, tag, names),
    the element's own first; how tells what the one before it is to it: its parent or any ancestor."""
    out, stack, at = [], [], 0
    sheet = _SHEET.sub(" ", sheet)
    for m in re.finditer(r"[{}]", sheet):
        text, at = sheet[at : m.start()].rsplit(";", 1)[-1].strip() if m[0] == "{" else sheet[at : m.start()], m.end()
        if m[0] == "{":
            stack.append(text)
            continue
        if not stack:
            continue
        head = stack.pop()
        says = [(k.lower(), v.lower(), bool(i)) for k, v, i in _SAYS.findall(text)]
        if not says or head.startswith("@") or not all(_SCREEN.match(h) for h in stack):
            continue
        for one in head.split(","):
            parts, how = [], ""
            for part in one.replace(">", " > ").split():
                c = None if part == ">" else _COMPOUND.match(part)
                if part == ">":
                    how = ">"
                elif c:
                    parts.insert(0, ["", c[1].lower() if c[1] and c[1] != "*" else "", re.findall(r"[.#][\w-]+", c[2])])
                    parts[0][0] = how or " "
                    how = ""
                else:
                    parts = []
                    break
            if parts and not how:
                names = [n for p in parts for n in p[2]]
                weight = (sum(n[0] == "#" for n in names), sum(n[0] == "." for n in names), sum(bool(p[1]) for p in parts))
                out.append((parts, weight, says))
    return out


def style(root: Node) -> None:
    """Works out display and unseen of all elements from <style> elements, style and visibility attributes. Rules are found by the id, class or tag that
    they end with, so elements look at few of them."""
    sheets, todo = [], [root]
    while todo:
        node = todo.pop()
        if node.tag == "style":
            sheets += [c for c in node.children if isinstance(c, str)]
        else:
            todo += [c for c in reversed(node.children) if not isinstance(c, str)]
    by: dict[str, list] = {}
    for i, (parts, weight, says) in enumerate(r for sheet in sheets for r in _rules(sheet)):
        by.setdefault(parts[0][2][0] if parts[0][2] else parts[0][1], []).append((weight, i, parts, says))
    path: list[tuple[Node, str, set]] = []  # the open elements: node, tag, names

    def fits(part, entry) -> bool:
        return (not part[1] or part[1] == entry[1]) and entry[2].issuperset(part[2])

    def match(parts, depth: int) -> bool:
        """Whether path[depth] is what the selector means: the depths at which each part may stand, from the element outwards."""
        at = {depth} if fits(parts[0], path[depth]) else set()
        for k in range(1, len(parts)):
            if not at:
                return False
            above = {d - 1 for d in at} if parts[k - 1][0] == ">" else range(max(at))
            at = {d for d in above if d >= 0 and fits(parts[k], path[d])}
        return bool(at)

    steps: list = [(c, root) for c in reversed(root.children) if not isinstance(c, str)]
    while steps:
        node, parent = steps.pop()
        if node is None:
            path.pop()
            continue
        a = node.attrs
        names = {f".{c}" for c in a.get("class", "").split()} | ({f"#{a['id']}"} if a.get("id") else set())
        path.append((node, node.tag, names))
        found = [(weight, i, says) for key in (*names, node.tag, "") for weight, i, parts, says in by.get(key, ()) if match(parts, len(path) - 1)]
        says = [(important, weight, i, k, v) for weight, i, told in found for k, v, important in told]
        says += [(bool(i), (1 << 20,), 0, k.lower(), v.lower()) for k, v, i in _SAYS.findall(a.get("style", ""))]
        if node.ns == "svg":
            says += [(False, (-1,), 0, k, a[k].lower()) for k in ("display", "visibility") if k in a]
        node.unseen = parent.unseen
        for _, _, _, k, v in sorted(says, key=lambda x: x[:3]):
            if k == "display":
                node.display = v
            elif v != "inherit":
                node.unseen = v in ("hidden", "collapse")
            else:
                node.unseen = parent.unseen
        steps.append((None, node))
        steps += [(c, node) for c in reversed(node.children) if not isinstance(c, str)]


def visible(node: Node, parent: Node) -> bool:
    a = node.attrs
    if node.display == "none":
        return False
    if node.ns:
        if node.tag in UNDRAWN or not node.display and a.get("display") == "none":
            return False
    elif node.tag in HIDDEN or "hidden" in a and not node.display or node.tag == "input":
        return False
    if node.tag == "dialog" and "open" not in a:
        return False
    return not (parent.tag == "details" and "open" not in parent.attrs and node.tag != "summary")


class Lines:
    """Collects text into lines: collapses white space, and sets blocks apart by blank lines."""

    def __init__(self) -> None:
        self.done: list[str] = []
        self.now: list[str] = []
        self.gap = self.blank = False
        self.indent = self.mark = ""

    def add(self, text: str) -> None:
        text = _SPACE.sub(" ", text)
        if text[:1] == " ":
            self.gap, text = True, text[1:]
        if not text:
            return
        more, text = text[-1] == " ", text.rstrip(" ")
        if self.gap and self.now:
            self.now.append(" ")
        self.now.append(text)
        self.gap = more

    def line(self, spaced: bool = False) -> None:
        if any(self.now):
            self.put("".join(self.now))
        self.now, self.gap = [], False
        self.blank |= spaced

    def put(self, line: str) -> None:
        """A finished line; a waiting blank line and list mark come first."""
        if self.blank and self.done:
            self.done.append("")
        self.blank = False
        self.done.append((self.indent[: len(self.indent) - len(self.mark)] + self.mark + line if self.mark else self.indent + line).rstrip())
        self.mark = ""


def render(root: Node) -> str:
    return "\n".join(_block(root))


def _block(root: Node) -> list[str]:
    """Lines of all that is visible in root. A stack of steps takes the place of recursion; tables within tables call this again."""
    out = Lines()
    todo: list[tuple] = [("open", child, root) for child in reversed(root.children)]
    depth, numbers = 0, []
    while todo:
        what, node, parent = todo.pop()
        if what == "close":
            tag = node.tag
            if tag in ("ul", "ol", "menu", "dir"):
                depth -= 1
                numbers.pop()
            out.line(tag in SPACED and not (depth and tag in ("ul", "ol", "menu", "p")))
            if tag in ("li", "dd", "blockquote"):
                out.indent, out.mark = parent, ""
            continue
        if what == "gap":
            out.gap = True
            continue
        if isinstance(node, str):
            if parent.unseen:
                continue
            if parent.tag in ("table", "tbody", "thead", "tfoot", "tr", "ul", "ol", "select") and not node.strip(" \t\n\r\f"):
                continue
            if parent.tag == "details" and "open" not in parent.attrs or parent.ns == "svg" and parent.tag not in DRAWN:
                continue
            if parent.tag in ("pre", "textarea", "xmp"):
                *whole, open_line = node.replace("\r\n", "\n").split("\n")
                if whole and not whole[0] and node is parent.children[0] and not out.now:
                    whole = whole[1:]  # a line feed right after the tag is not shown
                for x in whole:
                    out.put("".join([*out.now, x]))
                    out.now = []
                out.now.append(open_line)
                continue
            out.add(node)
            continue
        if not visible(node, parent):
            continue
        tag = node.tag
        if node.ns:
            if node.ns == "svg" and tag in ("tspan", "textpath", "a") and parent.tag not in DRAWN:
                node.tag = tag = "g"  # text is drawn within a text element only
            apart = node.ns == "svg" and (tag in ("text", "foreignobject") or tag == "tspan" and not node.attrs.keys().isdisjoint({"x", "y", "dy"}))
            block = tag == "math" and node.attrs.get("display", "").lower() == "block"
            if block:
                out.line()
            out.gap |= apart
            todo += [("close", node, out.indent)] if block else [("gap", node, parent)] if apart else []
            children = [c for c in node.children if not isinstance(c, str)][:1] if tag in ("semantics", "maction") else node.children  # these show their first part
            steps = [step for child in reversed(children) for step in (("open", child, node), ("gap", node, parent))]
            todo += steps[:-1] if node.ns == "math" and tag in APART else steps[::2]
        elif tag == "br":
            out.put("".join(out.now)) if out.now else None if out.mark or not out.done or out.blank else out.put("")
            out.now, out.gap = [], False
        elif tag == "table":
            out.line(True)
            for x in _table(node):
                out.put(x)
            out.line(True)
        elif tag in BLOCKS:
            out.line(tag in SPACED and not (depth and tag in ("ul", "ol", "menu", "p")))
            before = out.indent
            if tag in ("ul", "ol", "menu", "dir"):
                depth += 1
                numbers.append(node.number("start", 99_999) if tag == "ol" else 0)
            elif tag == "li":
                out.mark = f"{numbers[-1]}. " if numbers and numbers[-1] else "- "
                if numbers and numbers[-1]:
                    numbers[-1] += 1
                out.indent += " " * len(out.mark)
            elif tag in ("dd", "blockquote"):
                out.indent += "    " if tag == "dd" else "  "
            todo.append(("close", node, before))
            todo += [("open", child, node) for child in reversed(node.children)]
        else:
            if parent.tag == "pre" and not parent.ns:  # markup within preformatted text keeps it preformatted
                node.tag = "pre"
            todo += [("open", child, node) for child in reversed(node.children)]
    out.line()
    return out.done


def _table(table: Node) -> list[str]:
    """A table's lines: captions and stray text first, then rows with columns padded to their width."""
    head, rows, todo = Node("#caption"), [], [(c, table) for c in reversed(table.children)]
    while todo:
        node, parent = todo.pop()
        if isinstance(node, str):
            if node.strip() and not parent.unseen:
                head.children.append(node)
        elif visible(node, parent):
            if node.tag == "tr":
                rows.append([c for c in node.children if not isinstance(c, str) and visible(c, node)])
                head.children += [c for c in node.children if isinstance(c, str) and c.strip() and not node.unseen]
            elif node.tag in ("tbody", "thead", "tfoot"):
                todo += [(c, node) for c in reversed(node.children)]
            else:
                head.children.append(node)
    lines = _block(head)
    grid: list[list[tuple[int, list[str]]]] = []  # (column, lines) of each row's cells
    busy: dict[int, int] = {}  # columns that cells above reach into, and for how many more rows
    width: dict[int, int] = {}
    for cells in rows:
        place, row, reach = 0, [], {}
        for cell in cells:
            while busy.get(place):
                place += 1
            text, span = _block(cell) or [""], cell.number("colspan", 100)
            row.append((place, text))
            if span == 1:
                width[place] = max(width.get(place, 0), max((len(x) for x in text if len(x) <= WIDEST), default=0))
            if (down := cell.number("rowspan", 1000)) > 1:
                reach |= dict.fromkeys(range(place, place + span), down)
            place += span
        busy = {c: n - 1 for c, n in (busy | reach).items() if n > 1}
        grid.append(row)
    left, total = {}, 0
    for c in range(max(width, default=-1) + 2):
        left[c] = total
        total += width.get(c, 0) + 2 if c in width else 0
    for row in grid:
        for i in range(max((len(text) for _, text in row), default=0)):
            line = ""
            for place, text in row:
                if i < len(text) and text[i]:
                    line = line.ljust(left.get(place, total))
                    line += ("  " if line and not line.endswith("  ") else "") + text[i]
            if line.strip():
                lines.append(line.rstrip())
    return lines


def extract(page: str | None) -> str | None:
    if page is None:
        return None
    root = tree(page)
    if _STYLED.search(page):
        style(root)
    return render(root)


def visible_text(df: DataFrame, html: str = "html", output: str = "text") -> DataFrame:
    """Adds the page's visible text, laid out, to every row."""

    small_batches()
    @F.arrow_udf("string")
    def laid_out(pages: pa.Array) -> pa.Array:
        return pa.array([extract(p.as_py()) for p in pages], pa.string())

    return without(df, output).select("*", laid_out(F.col(html)).alias(output)) if output.lower() != html.lower() else df.withColumn(html, laid_out(F.col(html)))
