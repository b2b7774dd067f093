"""Visible text of web pages."""

from __future__ import annotations

import re
import sys
from html import unescape

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusmill.functions.encodings import decode_page

# Workers get the reader by value: the package need not be installed on them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Elements whose content is not shown, elements set off by a blank line,
# and elements that only start a line of their own.
HIDDEN = frozenset("script style title noscript template textarea select button iframe object svg".split())
PARAGRAPHS = frozenset(
    "p h1 h2 h3 h4 h5 h6 ul ol dl blockquote pre table figure hr article section form fieldset".split()
)
LINES = frozenset(
    "div header footer nav aside main address dt dd tr caption thead tbody tfoot "
    "figcaption details summary center body html head".split()
)
BULLET = "  • "
# Fixed values of the HTML standard: elements that hold nothing, elements whose content is text up
# to their end tag, and start tags that end a drawing or a formula.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea iframe noembed noframes xmp".split())
BREAKOUT = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta "
    "nobr ol p pre ruby s small span strong strike sub sup table tt u ul var".split()
)
FOREIGN = frozenset(("svg", "math"))
# Elements of drawings that hold ordinary elements again.
INTEGRATION = frozenset("foreignobject desc title annotation-xml mi mo mn ms mtext".split())

# Stand-ins while white space is tidied: the start of an item and its end, the edge of a line,
# the edge of a paragraph. Edges that meet are one edge.
_ITEM, _LINE, _PARAGRAPH, _END = "\x02", "\x03", "\x04", "\x05"
_OWN = str.maketrans("", "", _ITEM + _LINE + _PARAGRAPH + _END)

# The rest of a tag up to its ">", or to the end of the page. A value quoted after "=" may hold
# "<" or ">"; a quote elsewhere is a character like others. No part is scanned twice.
_REST = re.compile(
    r"""((?:[^>"'=]++|=\s*+"[^"]*+(?:"|\Z)|=\s*+'[^']*+(?:'|\Z)|["'=])*+)(>|\Z)"""
)
_NAME = re.compile(r"[a-zA-Z][^\s/>]*+")
_COMMENT_END = re.compile(r"--!?>")
# A slash that belongs to an unquoted value closes nothing.
_UNQUOTED = re.compile(r"""=\s*+[^\s"'>]++\Z""")
_BLANKS = re.compile(r"[ \t\n\f\r]+")
_EDGES = f"{_LINE}{_PARAGRAPH}"
_TIDY = [
    (re.compile(" {2,}"), " "),
    (re.compile(rf" ?([\n{_ITEM}{_EDGES}{_END}]) ?"), r"\1"),
    # An item without anything is none; its edges count.
    (re.compile(rf"{_ITEM}[{_EDGES}\n]*+{_END}"), _LINE),
    (re.compile(_END), _LINE),
    (re.compile(rf"{_ITEM}[{_EDGES}{_ITEM}\n]*+"), _ITEM),
    (re.compile(rf"{_LINE}*+{_PARAGRAPH}[{_EDGES}]*+"), "\n\n"),
    (re.compile(f"{_LINE}++"), "\n"),
    (re.compile(r"\n{3,}"), "\n\n"),
]


def _edge(name: str, end: bool) -> str:
    """What stands for a tag in the text."""
    if name == "li":
        return _END if end else _LINE + _ITEM
    if name in PARAGRAPHS:
        return _PARAGRAPH
    if name in LINES:
        return _LINE
    return {"br": "\n", "td": " ", "th": " "}.get(name, "")


class _Page:
    """One page, read once from left to right.

    ``parts`` is the text so far. An element that is not shown takes what it added back when it is
    closed: by its own end tag, by the start of another that it cannot hold, or, for a drawing, by
    an ordinary element. One that nothing closes hides nothing, so a forgotten end tag does
    not cost the rest of the page. Text that only an end tag ends (a script, a title) is skipped.
    """

    def __init__(self, page: str) -> None:
        self.page = page
        self.parts: list[str] = []
        # Open elements: their names, and where their text begins; how many there are of a name.
        self.open: list[tuple[str, int]] = []
        self.count: dict[str, int] = {}
        self.foreign = 0
        self.endless: set[str] = set()

    def text(self) -> str:
        page, at, size = self.page, 0, len(self.page)
        while at < size:
            tag = page.find("<", at)
            if tag < 0:
                tag = size
            if tag > at:
                self.add(page[at:tag])
            if tag == size:
                break
            at = self.markup(tag)
        out = "".join(self.parts)
        for pattern, by in _TIDY:
            out = pattern.sub(by, out)
        return out.strip("\n ").removesuffix(_ITEM).replace(_ITEM, BULLET)

    def add(self, raw: str) -> None:
        raw = raw.translate(_OWN)
        self.parts.append(_BLANKS.sub(" ", unescape(raw) if "&" in raw else raw))

    def markup(self, at: int) -> int:
        """Read what a "<" begins; returns where it ends."""
        page = self.page
        after = page[at + 1 : at + 2]
        if after.isascii() and after.isalpha():
            return self.start(at + 1)
        if after == "/":
            name = _NAME.match(page, at + 2)
            if name:
                rest = _REST.match(page, name.end())
                if rest[2]:
                    self.end(name[0].lower())
                return rest.end()
            return self.bogus(at)
        if after == "!":
            return self.declaration(at)
        if after == "?":
            return self.bogus(at)
        self.parts.append("<")
        return at + 1

    def bogus(self, at: int) -> int:
        end = self.page.find(">", at)
        return len(self.page) if end < 0 else end + 1

    def declaration(self, at: int) -> int:
        page = self.page
        if page.startswith("<!--", at):
            for empty in ("<!-->", "<!--->"):
                if page.startswith(empty, at):
                    return at + len(empty)
            end = _COMMENT_END.search(page, at + 4)
            return end.end() if end else len(page)
        if self.foreign and page.startswith("<![CDATA[", at):
            end = page.find("]]>", at)
            end = len(page) if end < 0 else end
            self.parts.append(_BLANKS.sub(" ", page[at + 9 : end].translate(_OWN)))
            return end + 3
        return self.bogus(at)

    def start(self, at: int) -> int:
        page = self.page
        name = _NAME.match(page, at)
        rest = _REST.match(page, name.end())
        if not rest[2]:
            # A tag that the page ends in is none.
            return len(page)
        name = name[0].lower()
        if self.foreign and name in BREAKOUT and not self.inside_integration():
            while self.foreign:
                self.close()
        closed = rest[1].endswith("/") and not _UNQUOTED.search(rest[1])
        if self.foreign or name in FOREIGN:
            if not closed:
                self.push(name)
            self.parts.append(_edge(name, False))
            return rest.end()
        if name in RAW:
            return self.raw(name, rest.end())
        if name in ("select", "button") and self.count.get(name):
            self.end(name)
        if name in VOID:
            self.parts.append(_edge(name, False))
            return rest.end()
        if name not in HIDDEN:
            self.parts.append(_edge(name, False))
        self.push(name)
        return rest.end()

    def raw(self, name: str, at: int) -> int:
        """Skip to behind the end tag."""
        if name not in self.endless:
            end = re.compile(rf"</{name}(?=[\s/>])", re.IGNORECASE).search(self.page, at)
            if end:
                if name == "xmp":
                    self.parts.append(self.page[at : end.start()].translate(_OWN))
                self.parts.append(" ")
                return _REST.match(self.page, end.end()).end()
            # Looked for once: there is none further on either.
            self.endless.add(name)
        return len(self.page) if name in ("script", "style") else at

    def inside_integration(self) -> bool:
        return any(self.count.get(name) for name in INTEGRATION)

    def push(self, name: str) -> None:
        self.open.append((name, len(self.parts)))
        self.count[name] = self.count.get(name, 0) + 1
        self.foreign += name in FOREIGN

    def close(self, own: bool = True) -> None:
        """Close the innermost element; what is not shown goes if it is closed for itself."""
        name, begin = self.open.pop()
        self.count[name] -= 1
        self.foreign -= name in FOREIGN
        if name in HIDDEN and own:
            del self.parts[begin:]
            self.parts.append(" ")

    def end(self, name: str) -> None:
        if name == "br":
            self.parts.append("\n")
            return
        if self.count.get(name):
            while self.open[-1][0] != name:
                self.close(own=False)
            self.close()
        if name not in HIDDEN:
            self.parts.append(_edge(name, True))


def page_text(page: str) -> str:
    return _Page(page).text()


def html_to_text(html: Column | str) -> Column:
    """The whole page as text: blocks on their own lines with a blank line between
    paragraphs, white space collapsed within a block, list items led by a bullet.

    Pages are read in Arrow batches, each once from left to right; broken ones take no longer.
    """

    @F.pandas_udf("string")
    def read(batch: pd.Series) -> pd.Series:
        return batch.map(page_text, na_action="ignore")

    return read(html)


def html_strip(html: Column) -> Column:
    """A plainer extraction in six replacements and a few entities."""
    out = F.regexp_replace(html, r"(?s)<!--.*?-->", "")
    for name in ("script", "style", "head", "title"):
        out = F.regexp_replace(out, rf"(?is)<{name}\b[^>]*>.*?</{name}>", "")
    out = F.regexp_replace(out, r"(?i)</?(p|div|h[1-6]|ul|ol|li|br|tr|article|nav|footer)\b[^>]*>", "\n")
    out = F.regexp_replace(out, r"<[^>]+>", "")
    for entity, char in ENTITIES:
        out = F.replace(out, F.lit(entity), F.lit(char))
    out = F.regexp_replace(out, r"[ \t]+", " ")
    return F.trim(F.regexp_replace(out, r" ?\n[ \n]*", "\n"))


# Fixed values, "&amp;" last so that nothing is decoded twice.
ENTITIES = (
    ("&nbsp;", " "),
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;", "'"),
    ("&copy;", "©"),
    ("&middot;", "·"),
    ("&amp;", "&"),
)


def decode_bytes(content: Column) -> Column:
    """Detect the encoding of page bytes and decode them, bad bytes ignored (``encodings``).

    Valid UTF-8, the common case, stays in the JVM. Only other pages go through Python,
    because Spark's decoder cannot leave out malformed input.
    """

    @F.pandas_udf("string")
    def decode(batch: pd.Series) -> pd.Series:
        return batch.map(decode_page, na_action="ignore")

    as_text = content.cast("string")
    valid = F.is_valid_utf8(as_text)
    plain = F.when(valid, F.regexp_replace(as_text, r"\A\x{FEFF}", ""))
    return F.coalesce(plain, decode(F.when(~valid, content)))
