"""Plain text against an HTML parser, digests, and what a written record keeps."""

import random
import re
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from driftwood.llm import warc

BLOCKS = set("p div br li ul ol h1 h2 h3 h4 h5 h6 tr table article section header footer nav aside title blockquote pre body html head".split())
HIDDEN = {"script", "style", "template", "noscript"}


class _Text(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out, self.hidden = [], []

    def handle_starttag(self, tag, attrs):
        if tag in HIDDEN:
            self.hidden.append(tag)
        elif tag in BLOCKS and not self.hidden:
            self.out.append("\n")

    def handle_endtag(self, tag):
        if self.hidden and tag == self.hidden[-1]:
            self.hidden.pop()
        elif tag in BLOCKS and not self.hidden:
            self.out.append("\n")

    def handle_data(self, data):
        if not self.hidden:
            self.out.append(data)


def _parsed(page):
    p = _Text()
    p.feed(page or "")
    p.close()
    return re.sub(r" ?\n[ \n]*", "\n", re.sub(r"[ \t\r\f\v\xa0]+", " ", "".join(p.out))).strip()


def test_text_of_all_pages_equals_a_parsers(spark, sf):
    for r in spark.read.parquet(f"{sf}/pages.parquet").select("html").collect():
        assert warc.plain_text(r["html"]) == _parsed(r["html"])


def test_text_of_hostile_markup_equals_a_parsers():
    r = random.Random(12)
    pieces = ['<a title="x > y" href=\'a>b\'>', "</a>", "<p data-x='\">'>", "</p>", "<br/>", "text ", "Tom &amp; J&eacute; ", "<script>if (a < b && '</p>') {}</script>",
              "<style>p > a {}</style>", "<!-- a > b -->", "<div class=\"q'r\">", "</div>", "1 < 2 ", "<b>", "</b>", "\n  ", "<img alt='>'>", "<h2>Head</h2>", "é\xa0ü"]
    for _ in range(400):
        page = "".join(r.choice(pieces) for _ in range(r.randint(1, 25)))
        assert warc.plain_text(page) == _parsed(page), page


@pytest.mark.parametrize("page, text", [("a<![CDATA[x > y & <b>z</b>]]>b", "ax > y & <b>z</b>b"), ('<a title="never closed>x</a> y', "x y"), ("<script>open", ""), (None, ""), ("<" * 50, "<" * 50)])
def test_text_of_odd_markup(page, text):
    assert warc.plain_text(page) == text


def test_a_long_page_of_quotes_takes_linear_time():
    assert warc.plain_text('<a href="x>' * 40_001).count("<") < 40_001


def test_written_records_keep_the_sources_headers_and_digest(spark, tmp_path):
    pages = spark.createDataFrame([(1, "http://a/", "<p>é</p>"), (2, None, None)], "page_id long, url string, html string")
    source = warc.responses(pages)
    digests = {r["record_id"]: (r["payload_digest"], r["payload"]) for r in source.collect()}
    for told, payload in digests.values():
        assert told == warc.digest(payload.encode())
    warc.write(warc.derive(source).coalesce(1), str(tmp_path / "w"), "none")
    parsed = warc.parse(b"".join(p.read_bytes() for p in sorted((tmp_path / "w").glob("part-*"))))
    assert len(parsed) == 4
    for h, block in parsed:
        told, payload = digests[h["WARC-Refers-To"]]
        assert h["WARC-Source-Payload-Digest"] == told and h["WARC-Source-HTTP-Status"] == "HTTP/1.1 200 OK"
        assert h["WARC-Source-HTTP-Content-Type"] == "text/html; charset=utf-8" and int(h["WARC-Source-HTTP-Content-Length"]) == len(payload.encode())
    odd = source.withColumn("http_headers", F.lit("HTTP/1.1 200 OK\r\nX-A:1\r\nno field\r\n folded: x\r\n")).limit(1)
    line = warc.derive(odd).filter("warc_type = 'conversion'").select(warc.serialised().alias("s")).first()["s"]
    assert "WARC-Source-HTTP-X-A: 1\r\n" in line and "folded" not in line.split("\r\n\r\n")[0]
