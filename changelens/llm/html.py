"""HTML extraction: a tree builder with implied tags, visibility rules, and a renderer that keeps block spacing,
lists and aligned table cells."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element classes of HTML.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style template noscript iframe noframes noembed object audio video canvas".split())
TEXT_ONLY = set("title textarea".split())
HIDDEN = set("head title script style template noscript iframe noframes noembed object audio video canvas datalist meta link base param source track".split())
BLOCK = set("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table ul".split())
SPACED = set("blockquote dl fieldset figure h1 h2 h3 h4 h5 h6 hr menu ol p pre table ul".split())
# What a start tag ends if it is open, and where the search for it stops.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}), "optgroup": ({"option", "optgroup"}, {"select"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
}
CLOSES_P = BLOCK - {"body", "html", "legend", "optgroup", "option"}
SCOPE = set("table td th caption button".split())
# SVG and MathML. Where HTML goes on inside them, start tags that end them, and what of them is not drawn itself.
POINTS = set("foreignobject desc title mi mo mn ms mtext annotation-xml".split())
BREAKOUT = set("b big blockquote br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 hr i img li listing menu meta nobr ol p pre ruby s small span strong strike sub sup table tt u ul var".split())
UNDRAWN = set("defs desc metadata symbol clippath mask pattern marker filter lineargradient radialgradient annotation annotation-xml".split())
# The screen for which style sheets are read, in pixels; a pixel's multiple by unit; other features of a screen.
SCREEN = {"width": 1280.0, "height": 800.0}
UNITS = {"": 1.0, "px": 1.0, "em": 16.0, "rem": 16.0, "pt": 4 / 3, "in": 96.0, "cm": 96 / 2.54}
FEATURES = {"orientation": "landscape", "hover": "hover", "any-hover": "hover", "pointer": "fine", "any-pointer": "fine", "prefers-color-scheme": "light", "prefers-reduced-motion": "no-preference", "scripting": "enabled"}

# All patterns are read in time that grows with the text: what may repeat is possessive, and what is not closed ends with the page.
MARKUP = re.compile(r"<(?=[a-zA-Z/!?])")
COMMENT = re.compile(r"<!--(?:-?>|.*?(?:--!?>|\Z))", re.DOTALL)
TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)")
#: The usual case of a tag's attributes up to its end, all well formed.
WELL_FORMED = re.compile(r"((?:\s++[^\s/>=\"'<]++(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>\"'=<`]++))?+)*+\s*+/?)>")
ATTRIBUTE = re.compile(r"[\s/]*+([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:\"([^\"]*+)(?:\"|\Z)|'([^']*+)(?:'|\Z)|([^\s>]*+)))?+")
GAP = re.compile(r"[\s/]*+")
MARK = re.compile(r"\"(?:\\.|[^\"\\])*+(?:\"|\Z)|'(?:\\.|[^'\\])*+(?:'|\Z)|[{};]", re.DOTALL)
DECLARED = re.compile(r"(?:^|;)\s*+(display|visibility)\s*+:\s*+([a-z-]++)[^;!]*+(!\s*+important)?", re.IGNORECASE)
SELECTOR = re.compile(r"(?:[^,(]++|\([^)]*+\)?)++")
STEP = re.compile(r"(\s*+[>+~]\s*+|\s++)?(\*|[a-zA-Z][\w-]*+)?((?:[.#][\w-]++)*+)")
BOUND = re.compile(r"(min-|max-)?(width|height)\s*+(:|[<>]=?|=)\s*+(\d++(?:\.\d++)?|\.\d++)([a-z]*+)\Z")
SPACE = re.compile(r"[ \t\n\r\f]+")
NUMBER = re.compile(r"[ \t\n\r\f]*+([+-]?)0*+([0-9]++)?")
LONG_REFERENCE = re.compile(r"&#([xX]?)0*+([0-9a-fA-F]{8,}+|(?=[0-9a-fA-F])[0-9a-fA-F]*+)(;?)")
HEADINGS = {f"h{k}" for k in range(1, 7)}

# How far layout goes; no text depends on it. A column is padded to the widest of its lines that are no longer than COLUMN, cells are
# moved to their column within the first WIDTH characters of a line, only the first COLUMNS columns are kept free below a cell over several rows,
# items of lists are indented by INDENT characters at most, and tables inside TABLES others are written cell by cell. So time and output stay within
# a multiple of the page, however it nests.
COLUMN, WIDTH, COLUMNS, INDENT, TABLES = 80, 240, 1024, 64, 8
#: Selectors with combinators are read until they have so many steps together, of rules that set display or visibility; and of how many kinds of elements
#: it is remembered what they may meet.
STEPS, KINDS = 16_384, 1000


class Node:
    __slots__ = ("attrs", "children", "foreign", "tag")

    def __init__(self, tag: str, attrs: dict[str, str], foreign: bool = False):
        self.tag, self.attrs, self.children, self.foreign = tag, attrs, [], foreign


def number(text: str | None, default: int, least: int, most: int) -> int:
    """The whole number that an attribute begins with, held between least and most; the default if there is none."""
    m = NUMBER.match(text or "")
    if m is None or (m[2] is None and "0" not in m[0]):
        return default
    value = int((m[2] or "0")[:10])
    return max(least, min(most, -value if m[1] == "-" else value))


def unescaped(text: str) -> str:
    """Character references resolved; a number with too many digits for a character is U+FFFD."""
    if "&" not in text:
        return text
    if "&#" in text:
        text = LONG_REFERENCE.sub(lambda m: "\ufffd" if len(m[2]) > 7 else f"&#{m[1]}{m[2] or '0'}{m[3]}", text)
    return unescape(text)


def attributes(raw: str) -> dict[str, str]:
    out: dict[str, str] = {}
    at = GAP.match(raw).end()
    while at < len(raw):
        m = ATTRIBUTE.match(raw, at)
        out.setdefault(m[1].lower(), unescaped(m[2] or m[3] or m[4] or ""))
        at = GAP.match(raw, m.end()).end()
    return out


def tag_end(html: str, at: int) -> tuple[str, int] | None:
    """The attributes that begin at a place, as they stand there, and where the tag has ended; None if the page ends before."""
    if m := WELL_FORMED.match(html, at):
        return m[1], m.end()
    start = at
    while True:
        at = GAP.match(html, at).end()
        if at >= len(html):
            return None
        if html[at] == ">":
            return html[start:at], at + 1
        at = ATTRIBUTE.match(html, at).end()


def on_screen(media: str) -> bool:
    """Whether a list of media queries holds for SCREEN. A query with a feature that is not known here does not."""

    def holds(query: str) -> bool:
        m = re.match(r"(?:(not|only)\s+)?(.*)", query, re.DOTALL)
        true = True
        for part in re.split(r" ?\band\b ?", m[2]):
            if part in ("all", "screen"):
                continue
            if not part.startswith("("):
                true = False  # print, speech and other media
                continue
            name, _, value = (x.strip() for x in part[1:-1].partition(":"))
            if b := BOUND.match(part[1:-1].strip()):
                if b[5] not in UNITS or (b[3] == ":") != (":" in part):
                    return False
                have, asked = SCREEN[b[2]], float(b[4]) * UNITS[b[5]]
                sign = {"min-": ">=", "max-": "<=", None: "="}[b[1]] if b[3] == ":" else b[3]
                true &= {">=": have >= asked, "<=": have <= asked, ">": have > asked, "<": have < asked, "=": have == asked}[sign]
            elif name in FEATURES:
                true &= not value or value == FEATURES[name]
            else:
                return False
        return true != (m[1] == "not")

    media = " ".join(media.lower().split())
    return not media or any(holds(q.strip()) for q in media.split(","))


def declared(body: str) -> dict[tuple[str, bool], str]:
    """The last display and visibility of a list of declarations, by name and importance."""
    if "isp" not in body.lower() and "isib" not in body.lower():
        return {}
    return {(m[1].lower(), bool(m[3])): m[2].lower() for m in DECLARED.finditer(re.sub(r"/\*.*?(?:\*/|\Z)", "", body, flags=re.DOTALL))}


def steps_of(selector: str) -> list[tuple[str, str, frozenset]]:
    """The steps of a selector, each a tag, classes and ids of one element, after a combinator ("" in the first): blank, >, ~ or +.
    No steps if it has anything else."""
    steps, at = [], 0
    while at < len(selector):
        m = STEP.match(selector, at)
        how = (m[1].strip() or " ") if m[1] else ""
        if not (m[2] or m[3]) or bool(how) != bool(steps):
            return []
        steps.append((how, "" if m[2] in (None, "*") else m[2].lower(), frozenset(re.findall(r"[.#][\w-]+", m[3]))))
        at = m.end()
    return steps


class Sheets:
    """The rules of style sheets that set display or visibility on a screen. Plain ones, for one element, by a mark that it must have: rank
    (important, specificity and place), tag, marks, name and value. Chains have combinators: rank, name, value and steps."""

    def __init__(self):
        self.plain: dict[str, list] = {}
        self.chains: list[tuple] = []
        self.steps = self.place = 0

    def add(self, selector: str, sets: dict[tuple[str, bool], str]) -> None:
        steps = steps_of(selector)
        ids = sum(m[0] == "#" for _, _, marks in steps for m in marks)
        classes, tags = sum(len(marks) for _, _, marks in steps) - ids, sum(bool(tag) for _, tag, _ in steps)
        if len(steps) > 1:
            self.steps += len(steps) * len(sets)
        for (name, important), value in sets.items():
            rank = (important, ids, classes, tags, self.place)
            if len(steps) == 1:
                _, tag, marks = steps[0]
                self.plain.setdefault(min(marks, default=tag or "*"), []).append((rank, tag, marks, name, value))
            elif steps and self.steps <= STEPS:
                self.chains.append((rank, name, value, steps))


class Chains:
    """Selectors with combinators, followed on the way down the tree. Each step is a bit, those of one selector stand side by side in their order:
    what elements before an element meet, shifted by one, is what it may meet itself. So time grows with the elements and not with their
    ancestors. Selectors are in order of rank: of those that an element meets to the end, the highest bit decides."""

    def __init__(self, chains: list[tuple]):
        self.by, self.ends, self.said, self.known = {}, {}, [], {}
        for rank, name, value, steps in sorted(chains, key=lambda c: c[0]):
            for how, tag, marks in steps:
                can = self.by.setdefault(min(marks, default=tag or "*"), {}).setdefault((tag, marks), {})
                can[how] = can.get(how, 0) | 1 << len(self.said)
                self.said.append((rank, value))
            self.ends[name] = self.ends.get(name, 0) | 1 << len(self.said) - 1

    def met(self, kind: tuple[str, str, str], above: int, parent: int, before: int, last: int) -> int:
        """The steps that an element (tag, classes, id) meets, from those of all elements around it, of the one right around it, of all earlier
        ones beside it, and of the last of these."""
        if not self.by:
            return 0
        if kind not in self.known:
            if len(self.known) >= KINDS:
                self.known.clear()
            can, marks = dict.fromkeys(("", " ", ">", "~", "+"), 0), marks_of(kind[1], kind[2])
            for key in (*marks, kind[0], "*"):
                for (tag, needed), bits in self.by.get(key, {}).items():
                    if tag in ("", kind[0]) and needed <= marks:
                        can |= {how: can[how] | b for how, b in bits.items()}
            self.known[kind] = tuple(can.values())
        first, inside, child, later, beside = self.known[kind]
        return first | (above << 1) & inside | (parent << 1) & child | (before << 1) & later | (last << 1) & beside

    def says(self, met: int) -> dict[str, tuple]:
        """Rank and value by property."""
        return {name: self.said[(met & ends).bit_length() - 1] for name, ends in self.ends.items() if met & ends}


def read_sheet(css: str, rules: Sheets) -> None:
    """Adds what a style sheet has for a screen. Selectors with anything but tags, classes, ids and combinators are not read."""
    css = re.sub(r"/\*.*?(?:\*/|\Z)|<!--|-->|<!\[CDATA\[|\]\]>", "", css, flags=re.DOTALL)
    found: list[tuple[int, str, str]] = []
    blocks: list[list] = [[True, None, "", 0]]  # read, selectors, declarations, place
    at = 0

    def end(on, selectors, body, place) -> None:
        if on and selectors:
            found.append((place, selectors, body))

    for m in MARK.finditer(css):
        if m[0] not in "{};":
            continue
        text, at = css[at : m.start()].strip(), m.end()
        top = blocks[-1]
        if m[0] == "{" and text.startswith("@"):
            name, asked = [*text[1:].replace("(", " (", 1).lower().split(None, 1), "", ""][:2]
            on = on_screen(asked) if name == "media" else not asked.startswith("not") if name == "supports" else name == "layer"
            blocks.append([top[0] and on, top[1], "", m.start()])
        elif m[0] == "{":
            blocks.append([top[0] and top[1] is None, text, "", m.start()])  # nested selectors are not read
        else:
            top[2] += text + ";"
            if m[0] == "}" and len(blocks) > 1:
                end(*blocks.pop())
    blocks[-1][2] += css[at:]
    for block in blocks:
        end(*block)
    for _, selectors, body in sorted(found):
        sets = declared(body)
        for x in SELECTOR.findall(selectors) if sets else ():
            rules.add(x.strip(), sets)
        rules.place += 1


class Open:
    """The open elements. What a start or end tag closes is known without a search: for each rule of ENDS (and for p) the outermost
    element that it would close, kept with each open element, and the places of the open elements of each name."""

    RULES = {"p": ({"p"}, SCOPE), **ENDS}
    CONCERNED = frozenset().union(*(tags | stop for tags, stop in RULES.values()))

    def __init__(self, root: Node):
        self.nodes, self.ends, self.named, self.cells = [root], [dict.fromkeys(self.RULES, 0)], {}, []

    def push(self, node: Node) -> None:
        at, ends = len(self.nodes), self.ends[-1]
        if node.foreign:
            ends = self.ends[0]  # nothing inside SVG and MathML ends what stands outside
        elif node.tag in self.CONCERNED:
            ends = {rule: 0 if node.tag in stop else ends[rule] or at if node.tag in tags else ends[rule] for rule, (tags, stop) in self.RULES.items()}
        self.nodes.append(node)
        self.ends.append(ends)
        self.named.setdefault(node.tag, []).append(at)
        if node.tag in ("table", "td", "th"):
            self.cells.append(at)

    def pop(self) -> None:
        node = self.nodes.pop()
        self.ends.pop()
        self.named[node.tag].pop()
        if node.tag in ("table", "td", "th"):
            self.cells.pop()

    def cut(self, at: int) -> None:
        while len(self.nodes) > at:
            self.pop()

    def close(self, rule: str) -> None:
        """Ends what a start tag of this name ends."""
        if at := self.ends[-1][rule]:
            self.cut(at)

    def end(self, tag: str) -> bool:
        """Ends the element that an end tag names, unless a table or its cell stands between; whether nothing stood in the way."""
        places, across = self.named.get(tag), tag in ("table", "tr", "tbody", "thead", "tfoot", "body", "html")
        wall = self.cells[-1] if self.cells and not across else 0
        if places and places[-1] >= wall:
            self.cut(places[-1])
            return True
        return not wall and not places


def build(html: str) -> tuple[Node, Node, Sheets]:
    """The tree of a page, the element html without it, and the rules of its style sheets. The root is the body, with the head inside.
    A tag that the page ends in is no tag, and nothing follows it."""
    page, root = Node("html", {}), Node("body", {})
    stack, rules, at = Open(root), Sheets(), 0

    def text(s: str) -> None:
        if s:
            if stack.nodes[-1].tag == "head" and s.strip():
                stack.pop()
            stack.nodes[-1].children.append(unescaped(s))

    while True:
        m = MARKUP.search(html, at)
        text(html[at : m.start() if m else len(html)])
        if not m:
            return root, page, rules
        at = m.start()
        top = stack.nodes[-1]
        foreign = top.foreign and top.tag not in POINTS
        if not (m := TAG.match(html, at)):
            if html.startswith("<!--", at):
                at = COMMENT.match(html, at).end()
            elif foreign and html.startswith("<![CDATA[", at):
                end = html.find("]]>", at)
                top.children.append(html[at + 9 : end if end >= 0 else len(html)])
                at = end + 3 if end >= 0 else len(html)
            else:  # a declaration, an instruction, or an end tag without a name
                at = html.find(">", at) + 1 or len(html)
            continue
        if not (ended := tag_end(html, m.end())):
            return root, page, rules
        tag, (raw, at) = m[2].lower(), ended
        if m[1]:
            if stack.end(tag) and tag in ("p", "br") and stack.nodes[-1] is top:
                top.children.append(Node(tag, {}))  # an end tag alone stands for an empty element
            continue
        if tag in ("html", "body"):
            named = root if tag == "body" else page
            named.attrs |= {k: v for k, v in attributes(raw).items() if k not in named.attrs}
            if top.tag == "head":
                stack.pop()
            continue
        if foreign and tag in BREAKOUT:
            while stack.nodes[-1].foreign and stack.nodes[-1].tag not in POINTS:
                stack.pop()
            foreign = False
        if stack.nodes[-1].tag == "head" and tag not in HIDDEN:
            stack.pop()
        if tag in CLOSES_P and not foreign:
            stack.close("p")
        if tag in ENDS and not foreign:
            stack.close(tag)
        if tag in HEADINGS and stack.nodes[-1].tag in HEADINGS:
            stack.pop()
        node = Node(tag, attributes(raw) if raw else {}, foreign or tag in ("svg", "math"))
        stack.nodes[-1].children.append(node)
        if node.foreign and raw.endswith("/"):
            continue
        if tag in ("style", "script") or not foreign and (tag in RAW or tag in TEXT_ONLY):
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*+>", re.IGNORECASE).search(html, at)
            inside = html[at : end.start() if end else len(html)]
            at = end.end() if end else len(html)
            if tag in TEXT_ONLY:
                node.children.append(unescaped(inside))
            if tag == "style" and on_screen(node.attrs.get("media", "")):
                read_sheet(inside, rules)
        elif foreign or tag not in VOID:
            stack.push(node)


def marks_of(classes: str, name: str) -> set[str]:
    return {*("." + c for c in classes.split()), *(["#" + name] if name else [])}


def ruled(tag: str, classes: str, name: str, rules: dict[str, list]) -> dict[str, tuple]:
    """What plain rules say of an element: rank and value by property."""
    best: dict[str, tuple] = {}
    marks = marks_of(classes, name)
    for key in (*marks, tag, "*"):
        for rank, t, needed, prop, value in rules.get(key, ()):
            if t in ("", tag) and needed <= marks and rank >= best.get(prop, ((False, -3), ""))[0]:
                best[prop] = (rank, value)
    return best


class Styles:
    """What the page says of its elements' display and visibility."""

    def __init__(self, rules: Sheets):
        self.plain, self.chains, self.known = rules.plain, Chains(rules.chains), {}

    def of(self, node: Node, above: int, parent: int, before: int = 0, last: int = 0) -> tuple[bool, bool | None, int]:
        """Whether an element is shown, whether its own text is hidden (None: as in its parent), and the steps of chains that it meets. What
        the page says last and most specifically decides: a style attribute before style sheets, and what is important before both."""
        a, tag = node.attrs, node.tag
        kind = (tag, a.get("class", ""), a.get("id", ""))
        met = self.chains.met(kind, above, parent, before, last)
        if tag in HIDDEN or (node.foreign and tag in UNDRAWN):
            return False, None, met
        best: dict[str, tuple] = {}
        if "hidden" in a or (tag == "dialog" and "open" not in a):
            best["display"] = ((False, -2), "none")
        if node.foreign:
            best |= {k: ((False, -1), a[k].strip().lower()) for k in ("display", "visibility") if k in a}
        if self.plain:
            if kind not in self.known:
                self.known[kind] = ruled(*kind, self.plain)
            best |= self.known[kind]
        said = [*self.chains.says(met).items()] if met else []
        if "style" in a:
            said += [(name, ((important, float("inf")), value)) for (name, important), value in declared(a["style"]).items()]
        for name, (rank, value) in said:
            if rank >= best.get(name, ((False, -3), ""))[0]:
                best[name] = (rank, value)
        seen = best.get("visibility", ("", "inherit"))[1]
        return best.get("display", ("", ""))[1] != "none", None if seen in ("inherit", "unset", "revert") else seen in ("hidden", "collapse"), met


def prune(root: Node, page: Node, rules: Sheets) -> None:
    """Leaves in the tree what a screen shows."""
    styles = Styles(rules)
    shown, around, html = styles.of(page, 0, 0)
    body_shown, own, met = styles.of(root, html, html)
    if not (shown and body_shown):
        root.children = []
    todo = [(root, bool(around if own is None else own), True, html | met, met)]
    while todo:
        node, off, drawn, above, parent = todo.pop()
        kept: list = []
        before = last = 0
        for c in node.children:
            if isinstance(c, str):
                if drawn and not off:
                    kept.append(c)
                continue
            shown, own, last = styles.of(c, above, parent, before, last)
            before |= last
            if shown:
                kept.append(c)
                # SVG draws the text of its text elements alone
                todo.append((c, off if own is None else own, drawn if not c.foreign or c.tag == "math" else c.tag != "svg" and (drawn or c.tag in ("text", "foreignobject")), above | last, last))
        node.children = kept


class Lines:
    """Output in lines; white space collapses, and blank lines between spaced blocks merge. Inside lists, lines are indented, an item's
    first line bears its mark, and there are no blank lines."""

    def __init__(self):
        self.lines: list[str] = []
        self.parts: list[str] = []  # of the line that is being written
        self.open, self.blank, self.space = False, False, False
        self.indent, self.marks, self.lists = 0, [], 0

    def _begin(self) -> None:
        if self.open:
            return
        if self.blank and self.lines:
            self.lines.append("")
        self.open, self.blank = True, False
        width = self.marks[0][0] if self.marks else self.indent
        self.parts = [" " * min(width, INDENT), *(m for _, m in self.marks)]
        self.marks = []

    def text(self, s: str) -> None:
        s = SPACE.sub(" ", s)
        if s.startswith(" ") and self.open:
            self.space = True
        if body := s.strip(" "):
            joined = self.space and self.open
            self._begin()
            self.parts.append(" " + body if joined else body)
            self.space = s.endswith(" ")

    def exact(self, s: str) -> None:
        for k, part in enumerate(s.split("\n")):
            if k:
                if not self.open and not self.lists:
                    self.lines.append("")
                self.line()
            if part:
                self._begin()
                self.parts.append(part)

    def line(self) -> None:
        if self.open:
            self.lines.append("".join(self.parts))
        self.parts, self.open, self.space = [], False, False

    def gap(self) -> None:
        self.line()
        self.blank = self.blank or not self.lists

    def broken(self) -> None:
        if not self.open:
            self.lines.append("")
        self.line()

    def block(self, lines: list[str]) -> None:
        self.line()
        for x in lines:
            self._begin()
            self.parts.append(x)
            self.line()

    def item(self, mark: str) -> tuple:
        """Begins an item; what it returns ends it."""
        self.line()
        before = (self.indent, len(self.marks))
        if mark.strip():
            self.marks.append((self.indent, mark))
        self.indent += len(mark)
        return before

    def ended(self, before: tuple) -> None:
        self.line()
        self.indent = before[0]
        del self.marks[before[1] :]  # an item without text has no line

    def done(self) -> list[str]:
        self.line()
        return self.lines


class Cell:
    __slots__ = ("column", "lines", "node", "row")

    def __init__(self, node: Node | str, row: int, column: int):
        self.node, self.row, self.column, self.lines = node, row, column, []


def table_rows(node: Node) -> list[list[Node]]:
    """The rows of a table, by the group they stand in."""
    groups: list[list[Node]] = [[]]
    for c in node.children:
        if isinstance(c, Node) and c.tag == "tr":
            groups[-1].append(c)
        elif isinstance(c, Node) and c.tag in ("thead", "tbody", "tfoot"):
            found, todo = [], [c]
            while todo:
                x = todo.pop()
                if x.tag == "tr":
                    found.append(x)
                else:
                    todo += [y for y in reversed(x.children) if isinstance(y, Node) and y.tag in ("tr", "thead", "tbody", "tfoot")]
            groups += [found, []]
    return groups


def placed(node: Node) -> list[Cell]:
    """The cells of a table with their columns. A cell over several columns or rows keeps them free, the rows up to the end of its group."""
    cells: list[Cell] = []
    row = 0
    for group in table_rows(node):
        last = row + len(group)
        taken: list[tuple[int, int, int]] = []  # from a column, up to another, before a row
        for tr in group:
            taken = [t for t in taken if t[2] > row]
            free, at, fresh = iter([*taken, None]), 0, []
            block = next(free)
            for c in tr.children:
                if isinstance(c, str) and not c.strip():
                    continue
                while block and block[0] <= at:
                    at, block = max(at, block[1]), next(free)
                cells.append(Cell(c, row, at))
                wide = 1 if isinstance(c, str) else number(c.attrs.get("colspan"), 1, 0, 1000) or 1
                deep = 1 if isinstance(c, str) else number(c.attrs.get("rowspan"), 1, 0, 65534)
                until = min(last, row + deep) if deep > 0 else last
                if until > row + 1 and at < COLUMNS:
                    fresh.append((at, at + wide, until))
                at += wide
            if fresh:
                merged: list[tuple[int, int, int]] = []
                for t in sorted([*taken, *fresh]):
                    if merged and merged[-1][1] >= t[0] and merged[-1][2] == t[2]:
                        merged[-1] = (merged[-1][0], max(merged[-1][1], t[1]), t[2])
                    else:
                        merged.append(t)
                taken = merged
            row += 1
    return cells


def aligned(cells: list[Cell]) -> list[str]:
    """Rows as lines with their cells in columns, each as wide as its widest line up to COLUMN; a cell's lines stand below each other,
    and a column in which no cell begins takes no room. Beyond WIDTH, cells just follow each other."""
    wide: dict[int, int] = {}
    for c in cells:
        wide[c.column] = max([wide.get(c.column, 0), *(len(x) for x in c.lines if len(x) <= COLUMN)])
    order = sorted(wide)
    start, at = {}, 0
    for column in order:
        start[column] = min(at, WIDTH)
        at += wide[column] + 2
    out: list[str] = []
    k = 0
    while k < len(cells):
        row = [c for c in cells[k : _row_end(cells, k)]]
        k += len(row)
        for j in range(max(len(c.lines) for c in row)):
            line: list[str] = []
            width = 0
            for c in row:
                if j < len(c.lines) and c.lines[j]:
                    room = max(start[c.column] - width, 2 if width else 0)
                    line.append(" " * room + c.lines[j])
                    width += room + len(c.lines[j])
            if line:
                out.append("".join(line).rstrip())
    return out


def _row_end(cells: list[Cell], k: int) -> int:
    end = k
    while end < len(cells) and cells[end].row == cells[k].row:
        end += 1
    return end


def render(root: Node) -> list[str]:
    """The lines of a tree, without recursion: pages may nest deeper than Python's calls do."""
    out, outer, tables = Lines(), [], 0
    todo: list[tuple] = [("children", root, False)]
    while todo:
        what, c, pre = todo.pop()
        if what == "line":
            out.line()
        elif what == "gap":
            out.gap()
        elif what == "children":
            todo += [("in", x, pre) for x in reversed(c.children)]
        elif what == "item":
            item, mark = c
            todo += [("ended", out.item(mark), pre), ("children" if item.tag == "li" else "in", item, pre)]
        elif what == "ended":
            out.ended(c)
        elif what == "listed":
            out.lists -= 1
            out.gap()
        elif what == "cell":
            outer.append(out)
            out = Lines()
        elif what == "filled":
            c.lines = out.done()
            out = outer.pop()
        elif what == "table":
            out.block(aligned(c))
            tables -= 1
            out.gap()
        elif isinstance(c, str):
            out.exact(c) if pre else out.text(c)
        elif c.tag == "br":
            out.broken()
        elif c.tag == "hr":
            out.gap()
        elif c.tag == "table":
            out.gap()
            cells = placed(c)
            deep = tables >= TABLES
            steps: list[tuple] = []
            for x in c.children:
                if isinstance(x, str) or x.tag not in ("tr", "thead", "tbody", "tfoot"):
                    steps += [("in", x, False), ("line", None, False)]
            for x in cells:
                inside = [("children" if isinstance(x.node, Node) and x.node.tag in ("td", "th") else "in", x.node, False)]
                steps += [*inside, ("line", None, False)] if deep else [("cell", x, False), *inside, ("filled", x, False)]
            todo += reversed([*steps, ("gap", None, False) if deep else ("table", cells, False)])
            tables += not deep
        elif c.tag in ("ul", "ol", "menu"):
            out.gap()
            out.lists += 1
            count, steps = number(c.attrs.get("start"), 1, -(1 << 31), 1 << 31), []
            for x in c.children:
                if isinstance(x, str):
                    steps += [("in", x, False), ("line", None, False)]
                elif x.tag == "li":
                    count = number(x.attrs.get("value"), count, -(1 << 31), 1 << 31)
                    steps.append(("item", (x, f"{count}. " if c.tag == "ol" else "- "), False))
                    count += 1
                else:
                    steps.append(("item", (x, "  "), False))
            todo += reversed([*steps, ("listed", None, False)])
        else:
            edge = "gap" if c.tag in SPACED else "line" if c.tag in BLOCK or (c.foreign and c.tag == "text") else ""
            if edge:
                out.gap() if edge == "gap" else out.line()
                todo.append((edge, None, pre))
            todo.append(("children", c, pre or c.tag in ("pre", "textarea")))
    return out.done()


def extract(html: str | None) -> str:
    """All visible text of a page; "" for null or empty pages. Time grows with the page, and with nesting no text is lost: layout alone
    stops at COLUMN, WIDTH, COLUMNS, INDENT and TABLES, and selectors with combinators are read up to STEPS."""
    if not html:
        return ""
    root, page, rules = build(html)
    prune(root, page, rules)
    return "\n".join(x.rstrip() for x in render(root)).strip("\n")


def extract_text(df: DataFrame, html_col: str = "html", name: str = "text") -> DataFrame:
    """df with the visible text of each row's page, "" for a null or empty one. Other columns stay; rows are
    independent, so nothing is shuffled; an empty table gives an empty one."""

    @F.pandas_udf("string")
    def run(pages: pd.Series) -> pd.Series:
        return pages.map(lambda p: extract(p if isinstance(p, str) else None)).astype(object)

    return df.withColumn(name, run(df[html_col].cast("string")))
