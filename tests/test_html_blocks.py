"""Main content against a tree that is walked by the rules as they are stated, and by hand."""

import random

import duckdb
import pytest

from tessera.functions import fixed, html

from .conftest import SMALL


def matches(n, selector):
    if selector[0] == ".":
        return selector[1:] in n.classes
    return n.attrs.get("id") == selector[1:] if selector[0] == "#" else n.tag == selector


def excluded(n):
    classes, ident = " ".join(n.classes), (n.attrs.get("id") or "").lower()
    return n.tag in fixed.EXCLUDED_TAGS or any(c in classes for c in fixed.EXCLUDED_CLASSES if classes) or any(i in ident for i in fixed.EXCLUDED_IDS if ident)


def tree_blocks(text, leaf_only=False):
    root = html.parse(text)
    nodes = list(root.walk())
    main = next((n for s in fixed.MAIN_SELECTORS for n in nodes if matches(n, s)), None) or next((n for n in nodes if n.tag == "body"), root)
    for n in list(main.walk()):
        n.children = [c for c in n.children if isinstance(c, str) or not excluded(c)]
    blocks = [n for n in main.walk() if n is not main and n.tag in fixed.BLOCK_TAGS]
    if leaf_only:
        blocks = [n for n in blocks if not any(d.tag in fixed.BLOCK_TAGS for d in n.walk() if d is not n)]
    return [t for t in (n.text() for n in blocks) if t]


HAND = [
    ("<body><p>a<p>b</body>", ["a b", "b"]), ("<p>only</p>", ["only"]), ("", []), (None, []), ("text alone", []),
    ("<main><div><p>x</p> y <nav><p>no</p></nav></div></main><p>outside</p>", ["x y", "x"]),
    ("<div class='ads'><article><p>in</p><div class='Sidebar2'>no</div><ul><li>one<li>two</ul></article></div>", ["in", "one two", "two"]),
    ("<div id=content><p>late</p></div><article><h2>first</h2></article>", ["first"]),
    ("<body><p>1 &lt; 2 &amp; 3<br>next<img src=x>end</p><script><p>no</p></script></body>", ["1 < 2 & 3 next end"]),
    ("</p></div><div>open <span>never closed", ["open never closed"]), ("<body><!-- <p>no</p> --><h1> t  i </h1></body>", ["t  i"]),
]


@pytest.mark.parametrize("text, want", HAND)
def test_by_hand(text, want):
    assert html.content_blocks(text) == want == tree_blocks(text)


def test_random_markup_against_the_tree():
    rng = random.Random(1)
    tags = ["p", "div", "li", "ul", "span", "b", "nav", "main", "article", "body", "h1", "script", "style", "br", "img", "footer", "section"]
    attrs = ["", "", "", " class='content'", " class='x ads'", " id=content", " id='social2'", " class=main-content", " class='Share post-content'"]
    for _ in range(3000):
        parts = []
        for _ in range(rng.randint(0, 25)):
            t = rng.choice(tags)
            parts.append(rng.choice([f"<{t}{rng.choice(attrs)}>", f"</{t}>", f"<{t}/>", f"w{rng.randint(0, 99)} ", "\n", "&amp;", "<!-- c -->"]))
        text = "".join(parts)
        for leaf in (False, True):
            assert html.content_blocks(text, leaf) == tree_blocks(text, leaf), text


def test_given_pages_against_the_tree():
    for (text,) in duckdb.sql(f"select html from '{SMALL}/pages.parquet'").fetchall():
        assert html.content_blocks(text) == tree_blocks(text) and html.content_blocks(text, True) == tree_blocks(text, True)


def test_deep_pages_take_time_by_their_length():
    n = 20_000
    assert len(html.content_blocks("<span>" * n + "<p>x</p>" + "</span>" * n)) == 1
    assert html.content_blocks("<body>" + "<b>" * n + "x" + "</p>" * 10) == []
