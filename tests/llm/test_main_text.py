"""Main text of small pages, by what the page shows."""

from __future__ import annotations

import math
import random

import pytest

from rollgraph.llm import main_text as module
from rollgraph.llm.main_text import extract_pages, main_text

ARTICLE = "<h1>Title &amp;  more</h1><p>A first   paragraph of <b>some</b> length,\nwith a <a href='#'>link</a>.</p><p>Second &#233; one, which is long enough.</p>"
TEXT = "Title & more\n\nA first paragraph of some length, with a link.\n\nSecond é one, which is long enough."
AROUND = (
    "<html><head><title>no</title><style>p{{}}</style></head><body><nav><a href='/'>Home</a><a href='/b'>B</a></nav>"
    "<div class='cookie-notice'>We use cookies</div>{0}<div id='comments'><p>I liked this a lot, thank you very much.</p></div>"
    "<form><p>Search</p></form><script>var x = '<p>no</p>';</script><footer>Contact us</footer></body></html>"
)


@pytest.mark.parametrize("wrap", ["<article>{}</article>", "<main>{}</main>", "<div class='post'>{}</div>"])
def test_only_the_article_stays(wrap):
    assert main_text(AROUND.format(wrap.format(ARTICLE))) == TEXT


def test_broken_pages():
    assert [main_text(h) for h in (None, "", "<html><body></body></html>", "<nav><a>only links</a></nav>")] == [""] * 4
    assert main_text("<body><article><p>one paragraph here<p>another paragraph here</article>") == "one paragraph here\n\nanother paragraph here"


def test_deep_and_long_pages():
    deep = "<div>" * 3000 + "<p>inside of everything there is a text</p>" + "</div>" * 3000
    assert main_text(deep) == "inside of everything there is a text"
    many = "<article>" + "".join(f"<p>paragraph number {i}</p>" for i in range(20_000)) + "</article>"
    assert main_text(many).count("\n\n") == 19_999


def test_rows(frame):
    schema = "page_id long, url string, html string, text string"
    html = AROUND.format(f"<article>{ARTICLE}</article>")
    got = extract_pages(frame([(1, "u", html, "clash"), (1, "u", html, ""), (None, None, None, None)], schema)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted([(1, "u", TEXT, len(TEXT))] * 2 + [(None, None, "", 0)], key=repr)
    assert extract_pages(frame([], schema)).count() == 0


LONG = ["The river rose for nine days and the lower town was left to the water and its birds.",
        "Nobody had thought that the old bridge would hold, yet it stood when morning came.",
        "Short one.", "Later the council wrote that all of it had been foreseen, which was not so."]


@pytest.mark.parametrize("wrap", ["<div>{}</div>", "<table><tr><td>{}</td></tr></table>", "<div class='content-widget'>{}</div>"])
def test_density_decides_without_article_or_main(wrap):
    body = "<h2>Flood</h2>" + "".join(f"<p>{p}</p>" for p in LONG)
    links = "".join(f"<li><a href='/{i}'>Another story {i}</a></li>" for i in range(12))
    page = f"<body><div><ul>{links}</ul></div>{wrap.format(body)}<div><a href='/x'>About us</a> <a href='/y'>Terms</a></div></body>"
    assert main_text(page) == "\n\n".join(["Flood", *LONG])


def test_names_never_take_the_heading_or_most_of_the_text():
    body = "".join(f"<p>{p}</p>" for p in LONG)
    page = f"<body><article><div class='post-header'><h1>Flood</h1></div>{body}<div class='share'>Share this with all of your friends today</div></article></body>"
    assert main_text(page) == "\n\n".join(["Flood", *LONG])
    assert main_text(f"<body><div id='comments-widget'>{body}</div></body>") == "\n\n".join(LONG)


def test_several_articles_and_sections_all_come_out():
    parts = [f"<h2>Part {i}</h2>" + "".join(f"<p>{p}</p>" for p in LONG) for i in range(3)]
    want = "\n\n".join(t for i in range(3) for t in [f"Part {i}", *LONG])
    for tag in ("article", "section"):
        assert main_text("<body><nav><a href='/'>Home</a></nav>" + "".join(f"<{tag}>{p}</{tag}>" for p in parts) + "</body>") == want
    assert main_text("<body><article>" + "".join(f"<section>{p}</section>" for p in parts) + "</article></body>") == want


def plain_density(node, body):
    """The formula over texts gathered anew for each node, by recursion."""

    def texts(n):
        return [(sum(map(len, p.split())), n) if isinstance(p, str) else None for p in n.parts if isinstance(p, str)] + [
            t for p in n.parts if not isinstance(p, str) and not p.aside for t in texts(p)
        ]

    def below(n):
        return [x for p in n.parts if not isinstance(p, str) and not p.aside for x in [p, *below(p)]]

    def in_link(n, top):
        while n is not None:
            if n.tag == "a":
                return True
            if n is top:
                return False
            n = n.parent
        return False

    c, t = sum(k for k, _ in texts(node)), max(len(below(node)), 1)
    lc = sum(k for k, n in texts(node) if in_link(n, node))
    lt = max(sum(x.tag == "a" for x in below(node)), 1)
    share = sum(k for k, n in texts(body) if in_link(n, body)) / max(sum(k for k, _ in texts(body)), 1)
    if not c:
        return 0.0
    base = math.log(c / max(c - lc, 1) * lc + share * c + math.e)
    return c / t if base <= 1.0001 else max(0.0, c / t * math.log(max(c / max(lc, 1) * t / lt, 1.0) + 1e-9) / math.log(base + 1e-9))


def test_densities_and_sums_equal_the_formula():
    pick = random.Random(3)

    def piece(depth):
        if depth == 0 or pick.random() < 0.2:
            return " ".join("x" * pick.randint(1, 9) for _ in range(pick.randint(0, 20)))
        tag = pick.choice(["div", "p", "a", "b", "ul", "section", "span", "nav"])
        return f"<{tag}>" + "".join(piece(depth - 1) for _ in range(pick.randint(1, 4))) + f"</{tag}>"

    for _ in range(150):
        tree = module._Tree()
        tree.feed("<body>" + "".join(piece(4) for _ in range(3)) + "</body>")
        tree.close()
        module._measure(tree.nodes, tree.body)
        counted = [n for n in tree.nodes[1:] if not n.aside and n.chars and not any(x.aside for x in above(n))]
        for n in counted:
            assert n.density == pytest.approx(plain_density(n, tree.body))
            kids = [p.density for p in n.parts if not isinstance(p, str) and p in counted and p.tag in module.BLOCKS]
            assert n.total == pytest.approx(sum(kids) or n.density / 2)
        best = module._largest(tree.nodes)
        for n in [n for n in counted if n.tag in module.BLOCKS]:
            inside = [x for x in counted if (x is n or n in above(x)) and x.tag in module.BLOCKS]
            assert best[n.order].total == pytest.approx(max(x.total for x in inside))


def above(node):
    out = []
    while node.parent is not None:
        node = node.parent
        out.append(node)
    return out


def test_hidden_and_named_parts_of_an_empty_text():
    assert main_text("<body><div class='ad'>Buy a new one today</div><article><h1>Ok.</h1></article></body>") == "Ok."
