"""HTML over Arrow batches: main content blocks and infobox rows. The parser is the standard library's."""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import fixed
from .spread import spread
from .text import clean_web_text, is_meaningful

_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}


class Node:
    def __init__(self, tag: str, attrs: dict, parent=None):
        self.tag, self.attrs, self.parent, self.children = tag, attrs, parent, []

    def walk(self):
        stack = [self]
        while stack:
            n = stack.pop()
            yield n
            stack += [c for c in reversed(n.children) if isinstance(c, Node)]

    def text(self, sep: str = " ") -> str:
        parts, stack = [], [self]
        while stack:
            n = stack.pop()
            if isinstance(n, str):
                if n.strip():
                    parts.append(n.strip())
            elif n.tag not in ("script", "style"):
                stack += reversed(n.children)
        return sep.join(parts)

    def child_tags(self, *tags):
        return [c for c in self.children if isinstance(c, Node) and c.tag in tags]

    @property
    def classes(self) -> list[str]:
        return (self.attrs.get("class") or "").lower().split()


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("[document]", {})

    def handle_starttag(self, tag, attrs):
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(node)
        if tag not in _VOID:
            self.at = node

    def handle_endtag(self, tag):
        n = self.at
        while n is not self.root and n.tag != tag:
            n = n.parent
        if n is not self.root:
            self.at = n.parent

    def handle_data(self, data):
        self.at.children.append(data)


def parse(html: str | None) -> Node:
    b = _Builder()
    b.feed(html or "")
    b.close()
    return b.root


_RAW = ("script", "style")


class _Flat(HTMLParser):
    """Elements and texts in document order, from one pass with the stack of open elements.

    An element is known by its number; `end` is the number after its last descendant. A text piece is kept
    with the number of elements before it.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.tags, self.end, self.out, self.first, self.open = [], [], [], {}, []
        self.owners, self.pieces, self.first_piece, self.last_piece = [], [], [], []

    def handle_starttag(self, tag, attrs):
        n, given = len(self.tags), {k: v or "" for k, v in attrs}
        classes, ident = (given.get("class") or "").lower().split(), given.get("id")
        for i, s in enumerate(fixed.MAIN_SELECTORS):
            if i not in self.first and (s[1:] in classes if s[0] == "." else ident == s[1:] if s[0] == "#" else tag == s):
                self.first[i] = n
        if tag == "body":
            self.first.setdefault("body", n)
        joined, low = " ".join(classes), (ident or "").lower()
        self.tags.append(tag)
        self.out.append(tag in fixed.EXCLUDED_TAGS or any(c in joined for c in fixed.EXCLUDED_CLASSES if joined) or any(i in low for i in fixed.EXCLUDED_IDS if low))
        self.end.append(n + 1)
        self.first_piece.append(len(self.pieces))
        self.last_piece.append(len(self.pieces))
        if tag not in _VOID:
            self.open.append(n)

    def _leave(self, upto: int) -> None:
        for n in self.open[upto:]:
            self.end[n], self.last_piece[n] = len(self.tags), len(self.pieces)
        del self.open[upto:]

    def handle_endtag(self, tag):
        for i in range(len(self.open) - 1, -1, -1):
            if self.tags[self.open[i]] == tag:
                self._leave(i)
                return

    def handle_data(self, data):
        if data.strip():
            self.owners.append(self.open[-1] if self.open else -1)
            self.pieces.append(data.strip())

    def read(self, html: str | None) -> "_Flat":
        self.feed(html or "")
        self.close()
        self._leave(0)
        return self


def content_blocks(html: str | None, leaf_only: bool = False) -> list[str]:
    """Texts of block tags in the first main element or the body, in document order; nested blocks repeat theirs unless leaf_only."""
    page = _Flat().read(html)
    tags, end, out = page.tags, page.end, page.out
    main = next((page.first[k] for k in (*range(len(fixed.MAIN_SELECTORS)), "body") if k in page.first), -1)
    n, stop = main + 1, end[main] if main >= 0 else len(tags)
    kept = [main]
    while n < stop:
        if out[n]:
            n = end[n]
            continue
        kept.append(n)
        n += 1
    silent: set[int] = set()  # within a script or style; these are left out of texts, though their blocks are not
    for k in kept[1:]:
        if tags[k] in _RAW:
            silent.update(range(k, end[k]))
    inside = set(kept) - silent
    before, texts = [0], []
    for owner, piece in zip(page.owners, page.pieces):
        if owner in inside:
            texts.append(piece)
        before.append(len(texts))
    blocks = [k for k in kept[1:] if tags[k] in fixed.BLOCK_TAGS]
    if leaf_only:
        outer, opened = set(), []
        for k in blocks:
            while opened and end[opened[-1]] <= k:
                opened.pop()
            outer.update(opened[-1:])
            opened.append(k)
        blocks = [k for k in blocks if k not in outer]
    found = [" ".join(texts[before[page.first_piece[k]] : before[page.last_piece[k]]]) for k in blocks]
    return [t for t in found if t]


def extract_blocks(pages: DataFrame, key: str = "page_id", leaf_only: bool = False) -> DataFrame:
    """(key, pos, text) of pages(key, html): raw block texts."""
    def run(batches):
        for batch in batches:
            keys, out = batch.column(0).to_pylist(), [[], [], []]
            for k, html in zip(keys, batch.column(1).to_pylist()):
                for i, t in enumerate(content_blocks(html, leaf_only)):
                    for c, v in zip(out, (k, i, t)):
                        c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], batch.schema.types[0]), pa.array(out[1], pa.int32()), pa.array(out[2], pa.string())], names=[key, "pos", "text"])

    kind = dict(pages.dtypes)[key]
    return spread(pages.select(key, "html")).mapInArrow(run, f"{key} {kind}, pos int, text string")


def extract_main_content(pages: DataFrame, key: str = "page_id", leaf_only: bool = False) -> DataFrame:
    """(key, pos, text): cleaned blocks of 10 to 2000 characters that are meaningful."""
    # a generator, so that the filter doesn't work the text out once more
    rows = extract_blocks(pages, key, leaf_only).select(key, "pos", F.explode(F.array(clean_web_text("text"))).alias("text"))
    return rows.where(F.length("text").between(10, 2000) & is_meaningful("text"))


# --- infoboxes -----------------------------------------------------------------------------------
def _cell_text(cell: Node) -> str:
    """Text of a cell: citations and hidden parts go, 10 with a superscript becomes 10^n, list items and lines are joined by commas."""
    def pieces(n):
        out = []
        for c in n.children:
            if isinstance(c, str):
                if c.strip():
                    out.append(re.sub(r"\s+", " ", c).strip())
            elif c.tag in ("script", "style") or "noprint" in c.classes or "display:none" in (c.attrs.get("style") or "").lower().replace(" ", ""):
                continue
            elif c.tag == "sup":
                t = c.text("").strip()
                cite = "reference" in c.classes or t.startswith("[")
                if cite:
                    continue
                t = {"²": "2", "³": "3"}.get(t, t)
                if re.fullmatch(r"[+\-−]?\d+", t) and out and re.search(r"(?:^|[\s×xeE])10$|[^\W\d_]$|\)$", out[-1]):
                    out[-1] += "^" + t
            elif c.tag == "br":
                out.append("\0")
            elif c.tag in ("ul", "ol"):
                items = [" ".join(pieces(li)).lstrip("•").strip() for li in c.child_tags("li")]
                out.append(", ".join(i for i in items if i))
            else:
                out += pieces(c)
        return out

    value = ""
    for p in pieces(cell):
        if p == "\0":
            value += "" if not value or value.endswith(", ") else ", "
        else:
            value += (" " if value and value[-1] not in " ([-" and p[:1] not in ".,;:)]-" else "") + p
    value = re.sub(r"(\s*,\s*)+", ", ", value).strip(", ")
    value = re.sub(r"\s*\[[a-zA-Z0-9\s-]+\]\s*", "", value)
    value = re.sub(r"(?i)\s*\(\s*listen\s*\)\s*|\s*Coordinates:.*", "", value)
    return re.sub(r"\s+", " ", value).strip()


def _spaced(label: str) -> str:
    if " " not in label and label.lower() != label and label.upper() != label:
        label = re.sub(r"(?<=[a-z])(?=[A-Z])|(?<=[a-zA-Z])(?=\d)|(?<=\d)(?=[a-zA-Z])", " ", label)
    return re.sub(r"\s*\[\w+\]$", "", label).strip()


def infobox(html: str | None) -> list[tuple[str, str]]:
    """(label, value) of the first infobox table, in order; a label that comes again holds its last value."""
    box = next((n for n in parse(html).walk() if n.tag == "table" and any("infobox" in c for c in n.classes)), None)
    if box is None:
        return []
    out: dict[str, str] = {}
    heading = None
    bodies = box.child_tags("tbody") or [box]
    for row in (r for b in bodies for r in b.child_tags("tr")):
        heads, cells = row.child_tags("th"), row.child_tags("td")
        wide = next((h for h in heads if "colspan" in h.attrs), None)
        label = value = None
        if wide is not None:
            heading = _spaced(_cell_text(wide)) or heading
            continue
        named = next((h for h in heads if h.attrs.get("scope") == "row"), None)
        if named is not None:
            label, value, heading = _cell_text(named), _cell_text(cells[0]) if cells else "", None
        elif len(cells) == 2:
            first = _cell_text(cells[0])
            marked = any(d.tag == "b" or d.tag == "a" and "image" not in d.classes for d in cells[0].walk())
            if first and len(first.split()) < 5 and marked:
                label, value, heading = first, _cell_text(cells[1]), None
        elif len(cells) == 1 and heading:
            label, value = heading, _cell_text(cells[0])
        if label and (label := _spaced(re.sub(r"\s+", " ", label).strip())):
            out[label] = value or ""
    return list(out.items())


def infobox_rows(pages: DataFrame, key: str = "entity") -> DataFrame:
    """(key, pos, label, value) of pages(key, html)."""
    def run(batches):
        for batch in batches:
            rows = [(k, i, a, b) for k, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for i, (a, b) in enumerate(infobox(html))]
            types = (batch.schema.types[0], pa.int32(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=[key, "pos", "label", "value"])

    return pages.select(key, "html").mapInArrow(run, f"{key} {dict(pages.dtypes)[key]}, pos int, label string, value string")
