"""The stack of open elements against a parser that keeps one, and texts worked out by hand."""

import random
from html.parser import HTMLParser

from pyspark.sql import functions as F

from postloom.functions import html as H
from postloom.functions.text import html_to_text

EXPECTED = [
    ("<p>a<p>b</p>c", "a|b|c"),
    ("a <template><div>no <template>deep</template> no</div> still no</template> b", "a|b"),
    ("<ruby>漢<rt>kan</ruby> visible", "漢|visible"),  # the end of ruby closes rt
    ("<ruby>漢<rt>kan<rp>)</rp> no</rt>字</ruby>", "漢|字"),
    ("x<template>unclosed <b>no</b>", "x"),
    ("</template>a</b><br/>b<hr>c", "a|b|c"),
    ('<a title="1 > 0" href=x>link</a> > tail', "link|> tail"),
    ("<template/>shown", "shown"),
    ("a < b <3 <i>c</i>", "a < b <3|c"),
    ("<!-- <template> --> a <script>'<template>'</script> b", "a|b"),
    ("<TEMPLATE>no</TeMpLaTe>yes &amp; <rt\n>no</rt >so", "yes &|so"),
    ("<section><template>no</section>yes</template>end", "yes|end"),
    ("", ""), (None, ""), ("plain", "plain"),
]


def test_visible_text(evaluate):
    got = evaluate([h for h, _ in EXPECTED], lambda c: html_to_text(c, "|"))
    assert got == [t for _, t in EXPECTED]


class Stack(HTMLParser):
    """Reads the same rules event by event."""

    def __init__(self, tag=None, test=None):
        super().__init__(convert_charrefs=False)
        self.stack, self.nodes, self.node = [], [], ""
        self.tag, self.test, self.depth, self.inner = tag, test, None, None

    def flush(self):
        if self.node.strip() and not any(n in H.HIDDEN for n in self.stack):
            self.nodes.append(self.node.strip())
        self.node = ""

    def handle_starttag(self, tag, attrs):
        self.flush()
        if self.inner is not None and self.depth:
            self.inner += self.get_starttag_text()
        hit = tag == self.tag and self.inner is None and self.test(dict(attrs))
        if hit:
            self.inner = ""
        if tag not in H.VOID:
            self.stack.append(tag)
            if hit:
                self.depth = len(self.stack)

    def handle_startendtag(self, tag, attrs):
        self.flush()
        if self.depth and self.inner is not None:
            self.inner += self.get_starttag_text()

    def handle_endtag(self, tag):
        self.flush()
        if tag in self.stack:
            at = len(self.stack) - 1 - self.stack[::-1].index(tag)
            self.stack = self.stack[:at]
            if self.depth and len(self.stack) < self.depth:
                self.depth = 0
        if self.depth:
            self.inner += f"</{tag}>"

    def handle_data(self, data):
        self.node += data
        if self.depth:
            self.inner += data


def soups(seed, n=250):
    rng = random.Random(seed)
    pieces = ["<div>", "</div>", '<div class="a b">', "<div id='x'>", "<p>", "</p>", "<b>", "</b>", "<br>",
              "<section>", "</section>", "<template>", "</template>", "<rt>", "</rt>", "<ruby>", "</ruby>",
              '<div data-x="> <b>" class="b">', "<hr/>", "<p/>", "text", " more ", "1"]
    return ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 40))) for _ in range(n)]


def test_visible_text_equals_a_parser_with_a_stack(evaluate):
    pages = soups(1)
    wanted = []
    for page in pages:
        reader = Stack()
        reader.feed(page)
        reader.close()
        reader.flush()
        wanted.append("|".join(reader.nodes))
    assert evaluate(pages, lambda c: html_to_text(c, "|")) == wanted
    assert sum("<template>" in p for p in pages) > 50


def test_elements_equal_a_parser_with_a_stack(evaluate):
    pages = soups(2)
    tests = [
        (lambda a: "b" in (a.get("class") or "").split(), H.has_class("b")),
        (lambda a: a.get("id") == "x", H.has_value("id", "x")),
        (lambda a: True, None),
    ]
    for ours, test in tests:
        wanted = []
        for page in pages:
            reader = Stack("div", ours)
            reader.feed(page)
            reader.close()
            wanted.append(reader.inner)
        got = evaluate(pages, lambda c, t=test: H.element_html(c, "div", t))
        assert got == wanted
        assert sum(w is not None for w in wanted) > 100


def test_elements_by_hand(evaluate):
    cases = [
        ('<div data-a="</div>" id=jd><p>one<div>two</div></section></div>three', "<p>one<div>two</div></section>"),
        ("<article><div id='jd'>one<p>two</article>three", "one<p>two"),
        ("<div ID=\"jd\">to <b>the</b> end", "to <b>the</b> end"),
        ("<script>'<div id=jd>no</div>'</script><!-- <div id=jd>no</div> -->", None),
        ("<div id=other>no</div>", None), ("", None), (None, None),
        ("<div id=jd></div>x", ""), ("<div id=first id=jd>last</div>", "last"),
    ]
    got = evaluate([c for c, _ in cases], lambda c: H.element_html(c, "div", H.has_value("id", "jd")))
    assert got == [w for _, w in cases]


def test_long_pages_keep_the_matcher_flat(spark):
    long = "<div id=jd>" + "<p class='x'>word</p>" * 4_000 + "</div>" + "<b>" * 500
    rows = spark.createDataFrame([(long,), ("<a " + "x" * 200_000 + ">t</a>",)], "h string")
    found = rows.select(F.length(H.element_html(F.col("h"), "div", H.has_value("id", "jd"))).alias("n"),
                        F.length(html_to_text(F.col("h"))).alias("t")).collect()
    assert [(r.n, r.t) for r in found] == [(4_000 * 21, 4_000 * 5 - 1), (None, 1)]
