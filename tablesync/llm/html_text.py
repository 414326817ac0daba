"""HTML to text with layout.

Method: a tokenizer feeds a tree builder that supplies the tags HTML lets
authors leave out; a renderer walks the tree, skips what a browser would not
show, and emits all visible text with block spacing, list markers and aligned
table cells.  One page is one row, so this is a column function: no shuffle.

What hides text are the elements a browser shows nothing of, the ``hidden``
attribute, and ``display`` and ``visibility`` of inline styles and of the
page's own style sheets (``page_styles``).

Elements nested deeper than ``MAX_DEPTH`` become siblings at that depth, as
browsers do; no text is lost.  A page is read once from front to back, whatever
it holds: where a tag's quotes would swallow all the rest, tags end at the next
``>`` from there on, and a ``<`` without a ``>`` after it is text.
"""

from __future__ import annotations

import re
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesync.llm import common
from tablesync.llm.page_styles import Sheet, declarations

MAX_DEPTH = 120

# Element groups of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes".split())
RCDATA = frozenset("textarea title".split())
HEAD_ONLY = frozenset("base link meta title style script".split())
HIDDEN = frozenset(("area base datalist head link meta noembed noframes noscript param rp script "
                    "style template title iframe audio video canvas annotation annotation-xml").split())
FOREIGN = frozenset("svg math".split())
# Of an SVG image its text elements show, unless they are only there to be referred to.
SVG_HIDDEN = frozenset("defs symbol desc metadata clippath mask pattern marker".split())
HTML_POINTS = frozenset("foreignobject mi mo mn ms mtext".split())  # HTML inside SVG or MathML
BREAKOUT = frozenset(("b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li "
                      "listing menu meta nobr ol p pre ruby s small span strong strike sub sup table tt u ul var").split())
SPACED = frozenset("p blockquote dl fieldset figure h1 h2 h3 h4 h5 h6 ol pre table ul menu xmp".split())
BLOCK = SPACED | frozenset((
    "address article aside body center dd details dialog dir div dt figcaption footer form header "
    "hgroup hr html legend li main nav optgroup option search section summary tbody td tfoot th "
    "thead tr caption colgroup").split())
CLOSES_P = frozenset((
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section summary "
    "table ul li dd dt xmp").split())
#: start tag -> (open tags it ends, tags that shield them)
IMPLIED_END = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist", "optgroup"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}),
    "tr": ({"tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "tbody": ({"tbody", "thead", "tfoot", "caption", "colgroup"}, {"table"}),
    "thead": ({"tbody", "thead", "tfoot", "caption", "colgroup"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "caption", "colgroup"}, {"table"}),
}
TABLE_PARTS = frozenset("caption colgroup tbody td tfoot th thead tr".split())
SCOPE = frozenset("table td th caption html template button".split())

# A quote opens a value directly after "=" only; elsewhere it is a character of a
# name or an unquoted value, and ">" ends the tag.
_INSIDE = r"(?:[\s/]++|(?:=[^\s/>=]*+|[^\s/>=]++)(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>\"'][^\s>]*+)?+)?+)*+"
_COMMENT = re.compile(r"<!--(?:>|->|.*?--!?>|.*\Z)", re.S)
_TAG = re.compile(rf"<([a-zA-Z][^\s/>]*+)({_INSIDE})>|</([a-zA-Z][^\s/>]*+){_INSIDE}>|<[!?/][^>]*>")
_PLAIN_TAG = re.compile(r"<([a-zA-Z][^\s/>]*+)([^>]*+)>|</([a-zA-Z][^\s/>]*+)[^>]*+>|<[!?/][^>]*>")
_MARKUP = re.compile(r"<[a-zA-Z!?/]")
_ATTR = re.compile(r"(=[^\s/>=]*+|[^\s/>=]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>\"'][^\s>]*+))?+)?+")
_SPACE = re.compile(r"[ \t\n\r\f]+")


class Node:
    __slots__ = ("tag", "attrs", "children", "display", "visibility")

    def __init__(self, tag, attrs=None):
        self.tag, self.attrs, self.children = tag, attrs or {}, []
        self.display = self.visibility = None  # what styles say


def _attributes(source: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for m in _ATTR.finditer(source):
        out.setdefault(m[1].lower(), unescape(m[2] or m[3] or m[4] or ""))
    return out


def _self_closing(source: str) -> bool:
    """Whether a tag ends in a slash that is no part of an unquoted value."""
    last = source.rsplit(None, 1)[-1] if source.endswith("/") else ""
    return last == "/" or last.endswith(("\"/", "'/")) or bool(last) and "=" not in last


def parse(html: str) -> Node:
    """The tree of a page; ``children`` are nodes and strings."""
    root = Node("html")
    stack, seen_body, seen_foreign = [root], False, False

    def close(names, shields):
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in names:
                del stack[i:]
                return True
            if stack[i].tag in shields:
                return False
        return False

    def text(s):
        nonlocal seen_body
        if not s:
            return
        if not seen_body and stack[-1].tag in ("html", "head"):
            if not s.strip():
                return
            body()
        stack[-1].children.append(s)

    def body(attrs=None):
        nonlocal seen_body
        close({"head"}, ())
        seen_body = True
        n = Node("body", attrs)
        stack[-1].children.append(n)
        stack.append(n)

    def foreign():
        """Place in the stack of the image or formula whose own elements come next."""
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in HTML_POINTS:
                return 0
            if stack[i].tag in FOREIGN:
                return i
        return 0

    def start(tag, source):
        nonlocal seen_body, seen_foreign
        if seen_foreign and tag in BREAKOUT:
            while i := foreign():
                del stack[i:]
        attrs = _attributes(source) if source.strip(" /\n\t") else {}
        if tag == "html":
            for name, value in attrs.items():  # a later tag adds what the first lacks
                root.attrs.setdefault(name, value)
            return
        if tag == "body":
            if not seen_body:
                body(attrs)
            return
        if tag == "head":
            if not seen_body:
                stack[-1].children.append(n := Node("head"))
                stack.append(n)
            return
        if not seen_body and stack[-1].tag in ("html", "head") and tag not in HEAD_ONLY and tag not in (
                "noscript", "template"):
            body()
        if tag in CLOSES_P:
            close({"p"}, SCOPE)
        if tag in IMPLIED_END:
            names, shields = IMPLIED_END[tag]
            # A tag that ends several levels (tr: td, tr) ends them all.
            while close(names, shields):
                pass
        if tag in ("td", "th") and stack[-1].tag in ("table", "tbody", "thead", "tfoot"):
            push(Node("tr"))
        if tag == "tr" and stack[-1].tag == "table":
            push(Node("tbody"))
        n = Node(tag, attrs)
        seen_foreign = seen_foreign or tag in FOREIGN
        if tag in VOID or seen_foreign and _self_closing(source) and (tag in FOREIGN or foreign()):
            stack[-1].children.append(n)
        else:
            push(n)

    def push(n):
        if len(stack) < MAX_DEPTH:
            stack[-1].children.append(n)
            stack.append(n)
        else:
            stack[-2].children.append(n)
            stack[-1] = n

    at, end = 0, len(html)
    last, tags = html.rfind(">"), _TAG
    while at < end:
        found = _MARKUP.search(html, at)
        if not found:
            text(unescape(html[at:]))
            break
        here = found.start()
        m = _COMMENT.match(html, here) or (tags.match(html, here) if here < last else None)
        if not m and here < last and tags is _TAG:
            # Every ">" to the end is within quotes: from here on they are characters.
            tags = _PLAIN_TAG
            m = tags.match(html, here)
        if not m:
            # Markup without an end is text; so is a "</" before no name.
            step = end if here >= last else here + 1
            text(unescape(html[at:step]))
            at = step
            continue
        if here > at:
            text(unescape(html[at:here]))
        at = m.end()
        if m.re is _COMMENT:
            continue
        if m[1]:
            tag = m[1].lower()
            start(tag, m[2])
            if tag in RAW or tag in RCDATA:
                stop = re.compile(f"</{tag}(?=[\\s/>])[^>]*>", re.I).search(html, at, last + 1)
                inner = html[at:stop.start() if stop else end]
                if seen_foreign and _self_closing(m[2]) and foreign():
                    continue
                if stack[-1].tag == tag:
                    stack[-1].children.append(unescape(inner) if tag in RCDATA else inner)
                    stack.pop()
                at = stop.end() if stop else end
        elif m[3]:
            tag = m[3].lower()
            if tag == "br":
                start("br", "")
            elif tag == "head":
                close({"head"}, ())
            elif tag not in ("body", "html"):
                close({tag}, () if tag in ("table", "template") else
                      {"table"} if tag in TABLE_PARTS else SCOPE - {tag})
    _style(root)
    return root


def _style(root: Node) -> None:
    """``display`` and ``visibility`` of all elements, from style sheets and
    inline styles."""
    sheets, work = [], [root]
    while work:
        n = work.pop()
        if n.tag == "style":
            sheets.append((n, "".join(c for c in n.children if isinstance(c, str))))
        work.extend(c for c in reversed(n.children) if not isinstance(c, str))
    sheet = Sheet([text for n, text in sheets if n.attrs.get("media", "all").strip().lower() in ("", "all", "screen")])
    path: list[Node] = []
    todo: list[tuple[Node, int]] = [(root, 0)]
    while todo:
        n, depth = todo.pop()
        del path[depth:]
        path.append(n)
        if sheet:
            said = sheet.style(path)
        elif "style" in n.attrs:
            order = sorted(declarations(n.attrs["style"]), key=lambda d: d[2])
            said = {name: value for name, value, _ in order}
        else:
            said = {}
        n.display, n.visibility = said.get("display"), said.get("visibility")
        todo.extend((c, depth + 1) for c in reversed(n.children) if not isinstance(c, str))


class _Flow:
    """Lines under construction: collapsed blanks, collapsed margins."""

    def __init__(self):
        self.lines, self.now, self.end, self.gap = [], [], "", 0  # ``end``: last character of the line so far

    def text(self, s, pre=False):
        if pre:
            first, *rest = s.replace("\r\n", "\n").split("\n")
            self._put(first)
            for x in rest:
                self.line(force=True)
                self._put(x)
            return
        s = _SPACE.sub(" ", s)
        if s.startswith(" ") and self.end in ("", " "):
            s = s[1:]
        self._put(s)

    def _put(self, s):
        if s:
            if not self.now and self.gap and self.lines:
                self.lines += [""] * self.gap
            self.gap = 0
            self.now.append(s)
            self.end = s[-1]

    def line(self, force=False):
        if self.now or force:
            self.lines.append("".join(self.now).rstrip(" "))
            self.now, self.end = [], ""

    def block(self, margin):
        self.line()
        self.gap = max(self.gap, margin)

    def put_lines(self, lines, margin):
        self.block(margin)
        if lines:
            if self.lines and self.gap:
                self.lines += [""] * self.gap
            self.gap = 0
            self.lines += lines
        self.block(margin)

    def done(self):
        self.line()
        a, b = 0, len(self.lines)
        while a < b and not self.lines[a]:
            a += 1
        while b > a and not self.lines[b - 1]:
            b -= 1
        return self.lines[a:b]


def _hidden(n: Node) -> bool:
    if n.tag in HIDDEN:
        return True
    if n.display:
        return n.display == "none"
    if not n.attrs:
        return n.tag == "dialog"
    return ("hidden" in n.attrs or n.tag == "input" and n.attrs.get("type", "").lower() == "hidden"
            or n.tag == "dialog" and "open" not in n.attrs)


def _shown(n: Node, seen: bool) -> bool:
    """``visibility`` is inherited and a child may set it back."""
    return n.visibility == "visible" if n.visibility in ("visible", "hidden", "collapse") else seen


def _int(value, default, least, most):
    m = re.match(r"\s*([+-]?\d{1,9})", value or "")
    return min(max(int(m[1]), least), most) if m else default


def _walk(n: Node, flow: _Flow, pre: bool, seen: bool):
    for c in n.children:
        if isinstance(c, str):
            if seen:
                flow.text(c, pre)
        elif not _hidden(c):
            _element(c, flow, pre, seen)


def _svg(n: Node, flow: _Flow, pre: bool, seen: bool):
    """Text elements of an image, a blank between them."""
    for c in n.children:
        if isinstance(c, str) or c.tag in SVG_HIDDEN or _hidden(c):
            continue
        if c.tag in ("text", "foreignobject"):
            flow.text(" ")
            _walk(c, flow, pre, _shown(c, seen))
            flow.text(" ")
        else:
            _svg(c, flow, pre, _shown(c, seen))


def _element(n: Node, flow: _Flow, pre: bool, seen: bool):
    seen = _shown(n, seen)
    tag = n.tag
    if tag == "svg":
        _svg(n, flow, pre, seen)
    elif tag == "br":
        if seen:
            flow.line(force=True)
    elif tag == "wbr" or tag == "img":
        return
    elif tag == "input":
        if seen and n.attrs.get("type", "text").lower() in ("text", "submit", "button", "reset", "search"):
            flow.text(" " + n.attrs.get("value", "") + " ")
    elif tag in ("ul", "ol", "menu", "dir"):
        flow.put_lines(_list(n, pre, seen), 0 if getattr(flow, "in_list", False) else 1)
    elif tag == "table":
        flow.put_lines(_table(n, pre, seen), 1)
    elif tag == "details" and "open" not in n.attrs:
        flow.block(0)
        for c in n.children:
            if not isinstance(c, str) and c.tag == "summary" and not _hidden(c):
                _element(c, flow, pre, seen)
                break
        flow.block(0)
    elif tag in BLOCK:
        margin = 1 if tag in SPACED else 0
        flow.block(margin)
        if tag in ("blockquote", "dd"):
            inner = _Flow()
            _walk(n, inner, pre, seen)
            flow.put_lines([("  " + x) if x else x for x in inner.done()], margin)
        else:
            inner_pre = pre or tag in ("pre", "xmp", "listing")
            _walk(n, flow, inner_pre, seen)
        flow.block(margin)
    else:
        _walk(n, flow, pre or tag == "textarea", seen)


def _list(n: Node, pre: bool, seen: bool) -> list[str]:
    number = _int(n.attrs.get("start"), 1, -10**9, 10**9)
    out: list[str] = []
    loose = _Flow()
    loose.in_list = True

    def flush():
        nonlocal loose
        out.extend("  " + x for x in loose.done())
        loose = _Flow()
        loose.in_list = True

    for c in n.children:
        if isinstance(c, str):
            if seen:
                loose.text(c, pre)
        elif _hidden(c):
            continue
        elif c.tag != "li":
            _element(c, loose, pre, seen)
        else:
            flush()
            number = _int(c.attrs.get("value"), number, -10**9, 10**9)
            mark = f"{number}. " if n.tag == "ol" else "- "
            number += 1
            inner = _Flow()
            inner.in_list = True
            _walk(c, inner, pre, _shown(c, seen))
            lines = inner.done()
            if lines:
                out.append((mark + lines[0]).rstrip(" "))
                out.extend((" " * len(mark) + x) if x else x for x in lines[1:])
    flush()
    return out


def _table(n: Node, pre: bool, seen: bool) -> list[str]:
    """Caption, then rows with every column padded to its widest cell; a cell
    over several columns or rows takes up its places."""
    caption, rows, order = [], [], {"thead": 0, "tbody": 1, "tfoot": 2}
    sections: list[tuple[int, Node]] = []
    loose = _Flow()
    for c in n.children:
        if isinstance(c, str):
            if seen:
                loose.text(c, pre)
        elif _hidden(c):
            continue
        elif c.tag == "caption":
            inner = _Flow()
            _element(c, inner, pre, seen)
            caption += inner.done()
        elif c.tag in order:
            sections.append((order[c.tag], c))
        elif c.tag not in ("colgroup", "col"):
            _element(c, loose, pre, seen)
    held: dict[int, int] = {}  # column -> rows it is still taken for
    widths: dict[int, int] = {}
    for _, section in sorted(sections, key=lambda x: x[0]):
        held.clear()
        for r in section.children:
            if isinstance(r, str) or r.tag != "tr":
                if isinstance(r, str):
                    if seen:
                        loose.text(r, pre)
                elif not _hidden(r):
                    _element(r, loose, pre, seen)
                continue
            if _hidden(r):
                continue
            cells, col, taken = [], 0, {}
            for c in r.children:
                if isinstance(c, str) or c.tag not in ("td", "th"):
                    if isinstance(c, str):
                        if seen:
                            loose.text(c, pre)
                    elif not _hidden(c):
                        _element(c, loose, pre, seen)
                    continue
                if _hidden(c):
                    continue
                while held.get(col, 0) > 0:
                    col += 1
                inner = _Flow()
                _walk(c, inner, pre, _shown(c, seen))
                lines = inner.done()
                across = _int(c.attrs.get("colspan"), 1, 1, 1000)
                down = _int(c.attrs.get("rowspan"), 1, 1, 65534)
                cells.append((col, lines))
                if across == 1 and lines:
                    widths[col] = max(widths.get(col, 0), *map(len, lines))
                if down > 1:
                    taken.update((x, down) for x in range(col, col + across))
                col += across
            held = {k: v - 1 for k, v in {**held, **taken}.items() if v > 1}
            if any(lines for _, lines in cells):
                rows.append(cells)
    columns = sorted(set(widths) | {c for row in rows for c, _ in row})
    starts, x = {}, 0
    for c in columns:
        starts[c] = x
        x += widths.get(c, 0) + 2
    out = caption + loose.done()
    for row in rows:
        for i in range(max(len(lines) for _, lines in row)):
            line = ""
            for c, lines in row:
                if i < len(lines) and lines[i]:
                    line = line.ljust(starts[c]) if len(line) <= starts[c] else line + "  "
                    line += lines[i]
            out.append(line.rstrip(" "))
    return out


def visible_text(html: str | None) -> str:
    """The text a reader of the page sees; ``""`` for a null or empty page."""
    return render(parse(html)) if html else ""


def render(root: Node) -> str:
    flow = _Flow()
    _element(root, flow, False, True)
    return "\n".join(flow.done()).replace(" ", " ")


def extract(pages: DataFrame, html_col: str = "html", out_col: str = "text") -> DataFrame:
    """``pages`` plus ``out_col``.  Null and empty pages give ``""``; repeated
    rows and other columns pass through; a column named ``out_col`` is replaced."""
    common.prepare(pages.sparkSession)

    @F.pandas_udf("string")
    def rendered(html: pd.Series) -> pd.Series:
        return pd.Series([visible_text(h) for h in html], dtype=object)

    return pages.withColumn(out_col, rendered(F.col(html_col)))


def op2_html_text(spark, sf_dir):
    out = extract(common.table(spark, sf_dir, "pages").select("page_id", "html"))
    return out.select("page_id", F.length("text").cast("long").alias("n_chars"),
                      F.size(F.split("text", "\n", -1)).cast("long").alias("n_lines"), "text")
