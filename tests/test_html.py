"""Main text of pages: against the standard library's parser and every run of blocks, on generated pages."""

import random
from html.parser import HTMLParser

import pytest

from corpusloom.functions import html
from corpusloom.sources.documents import extract_article


class Plain(HTMLParser):
    """The same blocks by a separate parser, for pages whose tags are all in order."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.found, self.parts, self.linked, self.link, self.prose, self.stack = [], [], 0, False, False, []

    def cut(self):
        text = " ".join("".join(p for p, _ in self.parts).split())
        if text:
            words = len(text.split())
            linked = sum(len(p.split()) for p, link in self.parts if link)
            self.found.append((text, words, min(linked, words), self.prose))
        self.parts = []

    def handle_starttag(self, tag, attrs):
        if self.stack:
            self.stack.append(tag)
            return
        if tag in html.RAW or tag in html.ASIDE:
            if tag in html.ASIDE:
                self.cut()
                self.prose = False
            self.stack.append(tag)
            return
        if tag == "a":
            self.link = True
        if tag in html.BLOCKS:
            self.cut()
            if tag != "br":
                self.prose = tag in html.PROSE

    def handle_endtag(self, tag):
        if self.stack:
            assert self.stack.pop() == tag
            if not self.stack and tag in html.ASIDE:
                self.cut()
                self.prose = False
            return
        if tag == "a":
            self.link = False
        if tag in html.BLOCKS:
            self.cut()
            self.prose = False

    def handle_data(self, data):
        if not self.stack:
            self.parts.append((data, self.link))


def best_run(blocks):
    worth = [w - html.LINK_COST * n - (0 if prose else html.PLAIN_COST) for _, w, n, prose in blocks]
    runs = [(sum(worth[i:j]), -j, i, j) for i in range(len(blocks)) for j in range(i + 1, len(blocks) + 1)]
    top = max((r[0] for r in runs), default=0)
    return top, {" ".join(b[0] for b in blocks[i:j]) for total, _, i, j in runs if total == top and top > 0}


def page(rng, depth=0):
    words = lambda n: " ".join(rng.choice(["alpha", "beta", "&amp;", "ga<mma".replace("<", "&lt;"), "déjà", "x"]) for _ in range(n))
    out = []
    for _ in range(rng.randrange(1, 6)):
        kind = rng.randrange(9)
        if kind == 0 and depth < 4:
            tag = rng.choice(["div", "section", "main", "ul", "table", "header"])
            out.append(f'<{tag} class="a>b" data-x=\'"\'>{page(rng, depth + 1)}</{tag}>')
        elif kind == 1:
            out.append(f"<nav><ul><li><a href=/{words(1)}>{words(3)}</a></li></ul></nav>")
        elif kind == 2:
            out.append(rng.choice(["<script>if (a < b) {'<p>'}</script>", "<style>p{}</style>", "<!-- <p>no</p> > -->", "<br>", "<br/>"]))
        elif kind == 3:
            out.append(f"<li><a href='x'>{words(rng.randrange(1, 5))}</a> {words(rng.randrange(3))}</li>")
        elif kind == 4:
            out.append(f"<div>{words(rng.randrange(25))}</div>")
        else:
            tag = rng.choice(["p", "h1", "blockquote"])
            out.append(f"<{tag}>{words(rng.randrange(30))}<b>{words(2)}</b> <a href='y'>{words(rng.randrange(3))}</a>{words(rng.randrange(4))}</{tag}>")
    return "".join(out)


def test_same_as_plain():
    rng = random.Random(8)
    for _ in range(400):
        source = page(rng)
        plain = Plain()
        plain.feed(source)
        plain.close()
        plain.cut()
        assert list(html.blocks(source)) == plain.found
        if len(plain.found) <= 40:
            _, texts = best_run(plain.found)
            assert html.main_text(source) in (texts or {None})


@pytest.mark.parametrize(
    "source,text",
    [
        ("", None), (None, None), ("  ", None), ("<div>short</div>", None), ("<p>two words", "two words"),
        ("<p>one<p title='a>b'>two</p> <a href=x>a b c d e f</a>", "one two"), ("<p>text <b", "text"), ("<p>a < b and a<1", "a < b and a<1"),
        ("<nav><nav>x</nav>y</nav><p>z</p>", "z"), ("<p>x<!-- never ends", "x"), ("<p>a&nbsp;&lt;b&gt; <![CDATA[c <p>]]>", "a <b> c <p>"),
        ("<script>never ends <p>no", None), ("<P>A<BR>b</P>", "A b"), ("</div></p>loose", None), ("<nav>never ends<p>x", None),
    ],
)
def test_odd_pages(source, text):
    assert html.main_text(source) == text


def test_long_and_hostile_pages_are_linear():
    import time

    start = time.time()
    for source in ("<a \"" * 200_000, "<" * 500_000, "<!--" * 200_000, "<p>" * 300_000, "<div>x</div>" * 100_000, "<script>" * 100_000):
        html.main_text(source)
    assert time.time() - start < 20


def test_only_pages_without_article(spark):
    body = "<p>" + "word " * 30 + "</p>"
    menu = "<ul><li><a href='/'>home page</a></li><li><a href='/x'>more of it</a></li></ul>"
    rows = [(1, f"<body>{menu}<div>{body}</div>{menu}<footer>legal words</footer></body>"), (2, f"<article>short</article>{body}"), (3, f"{menu}"), (4, None)]
    got = {r.i: r.text for r in extract_article(spark.createDataFrame(rows, "i int, html string")).collect()}
    assert got == {1: " ".join(["word"] * 30), 2: "short", 3: "home page more of it", 4: None}
