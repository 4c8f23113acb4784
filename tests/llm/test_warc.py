"""WARC derivatives."""

import html
import random
import re
import time

from voltarc.llm import warc

PAGE = """<!DOCTYPE html><html lang="de"><head><title>A &amp; B</title><style>p{}</style><script>var t="</p>";</script></head>
<body><nav><a href="/x?a=1&amp;b=2">Link</a></nav><!-- no <b>this</b> --><p>One <b>two</b>th
three &lt;4&gt;&nbsp;&eacute;<br>line</p><div title="a > b">1 < 2</div></body></html>"""


def test_visible_text():
    assert warc.visible_text(PAGE) == "Link\nOne twoth three <4> é\nline\n1 < 2"
    assert warc.visible_text("") == "" and warc.visible_text("<script>x") == "" and warc.visible_text("a <!-- b") == "a"


def test_pages_that_leave_things_open_keep_their_text():
    for page, text in (
        ("<html><head><title>T</title><meta name=x><body><p>shown", "shown"),
        ("<head><title>T</title><p>shown</p>", "shown"),
        ("<svg-icon>shown</svg-icon> too", "shown\ntoo"),
        ("<p>a<svg viewBox='0 0'/>b<p>c", "a\nb\nc"),
        ("a<svg><svg><text>no</text></svg>no</svg>b", "a\nb"),
        ("a<svg>drawn<p>shown", "a\ndrawn\nshown"),
        ("a<template><p>no</template>b<noscript>no</noscript><iframe>no</iframe>c", "a\nb\nc"),
        ("a<script>no", "a"),
        ("x <3 y < z <!-- no --> w <!-->v", "x <3 y < z w v"),
        ("<header>shown</header>", "shown"),
        ('<p title="it\'s > 1" class=a"b>shown</p>', "shown"),
        ("a</>b</ x>c<?php no ?>d", "abcd"),
    ):
        assert warc.visible_text(page) == text, page


def plain_text(page):
    """The same rules over the library's parser, for pages that close what they open."""
    from html.parser import HTMLParser

    class Reader(HTMLParser):
        def __init__(self):
            super().__init__(convert_charrefs=False)
            self.out, self.hidden = [], []

        def handle_starttag(self, tag, attrs):
            if tag not in warc._INLINE:
                self.out.append("\n")
            if tag in warc._HIDDEN or tag in warc._NESTED:
                self.hidden.append(tag)

        def handle_startendtag(self, tag, attrs):
            self.out.append("" if tag in warc._INLINE else "\n")

        def handle_endtag(self, tag):
            if tag not in warc._INLINE:
                self.out.append("\n")
            if tag in self.hidden:
                self.hidden.remove(tag)

        def handle_data(self, data):
            if not self.hidden:
                self.out.append(data.replace("\n", " "))

        def handle_entityref(self, name):
            self.handle_data(f"&{name};")

        def handle_charref(self, name):
            self.handle_data(f"&#{name};")

    reader = Reader()
    reader.feed(page)
    reader.close()
    lines = (" ".join(html.unescape(x).split()) for x in "".join(reader.out).split("\n"))
    return "\n".join(x for x in lines if x)


def test_text_equals_that_of_the_library_s_parser():
    rng = random.Random(5)
    words = ["one", "two &amp; three", "4 &lt; 5", "caf&eacute;", "line\nbreak", "&#233;", "  spaced  "]

    def made(depth):
        if not depth:
            return rng.choice(words)
        name = rng.choice(["p", "div", "b", "span", "a", "td", "svg", "script", "style", "li", "section", "template"])
        if name in ("script", "style"):
            return f"<{name} type='x'>if (1) {{ }}</{name}>"
        attrs = rng.choice(["", " class=x", ' title="a > b"', " data-x='1'"])
        return f"<{name}{attrs}>" + "".join(made(depth - 1) for _ in range(rng.randint(0, 3))) + f"</{name}>" + rng.choice(["", "<br>", "<!-- no -->", " tail"])

    for _ in range(300):
        page = f"<!DOCTYPE html><html><head><title>no</title></head><body>{''.join(made(rng.randint(0, 4)) for _ in range(4))}</body></html>"
        assert warc.visible_text(page) == plain_text(page), page


def test_open_markup_is_read_in_linear_time():
    began = time.perf_counter()
    for part in ("<a ", "<html ", "<title ", "<title>", "<svg ", "<svg>", "<template>", "<noscript>", "<!-- ", "<a href='", '<a " ', "</svg", "<svg><svg></svg>", "<a href=x>"):
        warc.read_page(part * (1_000_000 // len(part)))
    assert time.perf_counter() - began < 30


def test_derivatives_link_to_their_source():
    data = warc.response("http://h/x", PAGE, "7")
    headers, block = warc.parse(data)
    have = dict(headers)
    assert have["WARC-Block-Digest"] == warc.digest(block) and have["WARC-Payload-Digest"] == warc.digest(PAGE.encode())
    (kind, meta_id, refers, meta, whole), (kind2, text_id, refers2, text, whole2) = warc.derivatives(data)
    assert (kind, kind2) == ("metadata", "conversion") and refers == refers2 == have["WARC-Record-ID"]
    assert text.decode() == warc.visible_text(PAGE)
    for raw, body, own in ((whole, meta, meta_id), (whole2, text, text_id)):
        h, b = warc.parse(raw)
        h = dict(h)
        assert b == body and h["WARC-Record-ID"] == own and h["WARC-Refers-To"] == refers
        assert h["WARC-Target-URI"] == "http://h/x" and h["WARC-Date"] == warc.CAPTURED and h["WARC-Block-Digest"] == warc.digest(body)
    fields = meta.decode()
    for line in (f"source-warc-payload-digest: {have['WARC-Payload-Digest']}", "http-status: HTTP/1.1 200 OK", "http-header: Content-Type: text/html; charset=utf-8", "title: A & B", "language: de", "outlink: /x?a=1&b=2", f"conversion: {text_id}"):
        assert line + "\r\n" in fields
    assert warc.derivatives(data) == warc.derivatives(data)


def test_chunked_bodies_and_other_charsets():
    body = "<p>Gr\xf6\xdfe</p>".encode("latin-1")
    chunked = b"5;x=1\r\n" + body[:5] + b"\r\n" + b"%x\r\n" % len(body[5:]) + body[5:] + b"\r\n0\r\n\r\n"
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=ISO-8859-1\r\nTransfer-Encoding: chunked\r\n\r\n" + chunked
    data = warc.record("response", [("WARC-Record-ID", "<urn:uuid:1>")], block)
    assert warc.derivatives(data)[1][3].decode() == "Größe"


def test_rows(spark):
    rows = [(1, "http://a/", PAGE, "x"), (1, "http://a/", PAGE, "x"), (2, None, None, "x"), (3, "http://b/", "", "x"), (None, "u", "<p>" + "long " * 200_000, "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, record_type string")
    got = warc.derive(warc.responses(pages)).collect()
    assert len(got) == 10 and len({r.record_id for r in got}) == 8
    assert sum(r.record_type == "conversion" and not r.block for r in got) == 2
    assert all(re.fullmatch(r"<urn:uuid:[0-9a-f-]{36}>", r.record_id) and r.refers_to for r in got)
    odd = spark.createDataFrame([(1, bytearray(b"nonsense")), (2, None), (3, bytearray(warc.record("request", [], b"x")))], "page_id long, record binary")
    assert [r.record_type for r in warc.derive(odd).collect()] == ["skipped"] * 3
    assert warc.derive(warc.responses(pages.limit(0))).count() == 0
    dotted = pages.selectExpr("page_id AS `a.b`", "url AS `url.x`", "html", "record_type AS record")
    assert warc.derive(warc.responses(dotted, "a.b", "url.x"), "a.b").count() == 10


def test_line_breaks_in_a_url_make_no_header():
    headers, _ = warc.parse(warc.response("http://a/\r\nWARC-Type: x", "b", "1"))
    assert dict(headers)["WARC-Type"] == "response" and dict(headers)["WARC-Target-URI"] == "http://a/%0D%0AWARC-Type:%20x"


def test_query_returns_texts_and_fields(spark, tmp_path):
    spark.createDataFrame([(1, "http://a/", PAGE), (2, None, None)], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = {(r.page_id, r.record_type): r for r in warc.op7_warc_derivatives(spark, str(tmp_path)).collect()}
    assert got[1, "conversion"].content == warc.visible_text(PAGE) and got[2, "conversion"].content == ""
    assert "source-warc-payload-digest: sha1:" in got[1, "metadata"].content and got[1, "metadata"].refers_to == got[1, "conversion"].refers_to
