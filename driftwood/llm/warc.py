"""WARC derivatives: response records become linked metadata and plain-text conversion records.

Every response gives two records that refer to it (WARC-Refers-To) and keep its target URI and
date: ``metadata`` holds the source's headers and digests as warc-fields, ``conversion`` the page's plain text.
Record ids are UUIDs made from the response's id and the record's type, so a rerun or a retried task makes
the same records. Digests are SHA-1 in Base32, of the stored block (WARC-Block-Digest) and, for the source, as given. In written files both
records name the source's payload digest and HTTP headers in extension fields (WARC-Source-...), so a conversion record
read back alone has kept them. A file is one gzip stream, not one for each record.

Defined cases: a null payload is an empty one, and so gives an empty conversion; a null target URI is left out of the
headers; repeated responses give repeated records; an empty table gives none.
"""

from __future__ import annotations

import base64
import hashlib
import html
import re
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftwood.llm.text import slices

VERSION = "WARC/1.1"
SPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:warc:derived")
RECORD = ("page_id bigint, warc_type string, record_id string, refers_to string, target_uri string, warc_date string, content_type string, "
          "content_length bigint, block_digest string, source_digest string, http_headers string, block string")

# a tag ends at the first > outside quotes; where a quote is never closed, at the first >
_REST = r"""(?:(?>[^>"']+|"[^"]*"|'[^']*')*+|[^>]*)>"""
_CDATA = re.compile(r"(?s)<!\[CDATA\[(.*?)(?:\]\]>|\Z)")
_DROP = re.compile(r"(?is)<!--.*?(?:-->|\Z)|<(script|style|template|noscript)\b.*?(?:</\1\s*>|\Z)|<![^>]*>")
_BREAK = re.compile(r"(?i)</?(?:p|div|br|li|ul|ol|h[1-6]|tr|table|article|section|header|footer|nav|aside|title|blockquote|pre|body|html|head)\b" + _REST)
_TAG = re.compile(r"</?[A-Za-z]" + _REST)
_INNER, _LINES = re.compile(r"[ \t\r\f\v\xa0]+"), re.compile(r" ?\n[ \n]*")


def plain_text(page: str | None) -> str:
    """Visible text of an HTML page: a line for each block, entities resolved, blanks collapsed. The content of a CDATA section is
    text as it stands."""
    t = page or ""
    if "<![CDATA[" in t:
        t = _CDATA.sub(lambda m: html.escape(m[1]), t)
    t = _BREAK.sub("\n", _DROP.sub("", t))
    return _LINES.sub("\n", _INNER.sub(" ", html.unescape(_TAG.sub("", t)))).strip()


def digest(block: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()


def base32_sha1(raw: Column) -> Column:
    """``digest`` as a column: 20 bits at a time, five hex digits are four digits to the base of 32."""
    h = F.sha1(raw)
    digits = F.concat(*[F.lpad(F.conv(F.substring(h, k, 5), 16, 32), 4, "0") for k in range(1, 41, 5)])
    return F.concat(F.lit("sha1:"), F.translate(digits, "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"))


def record_id(source: str, kind: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(SPACE, f'{kind} {source}')}>"


def responses(pages: DataFrame, date: str = "1970-01-01T00:00:00Z", page_id: str = "page_id", url: str = "url", body: str = "html") -> DataFrame:
    """Response records of crawled pages: page_id, record_id, target_uri, warc_date, http_headers, payload, payload_digest."""
    p = F.coalesce(F.col(body), F.lit(""))
    raw = F.encode(p, "UTF-8")
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length(p).cast("string"), F.lit("\r\n"))
    h = F.sha2(F.concat_ws("\x00", F.coalesce(F.col(page_id).cast("string"), F.lit("-")), F.coalesce(F.col(url), F.lit("-")), p), 256)
    ident = F.concat(F.lit("<urn:uuid:"), *[x for k, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)) for x in (F.lit("-" if k > 1 else ""), F.substring(h, k, n))], F.lit(">"))
    return pages.select(F.col(page_id).cast("bigint").alias("page_id"), ident.alias("record_id"), F.col(url).alias("target_uri"), F.lit(date).alias("warc_date"),
                        head.alias("http_headers"), p.alias("payload"), base32_sha1(raw).alias("payload_digest"))


def _records(row: dict) -> list[tuple]:
    source, text = row["record_id"], plain_text(row["payload"])
    fields = [("source-record-id", source), ("source-type", "response"), ("source-payload-digest", row["payload_digest"]),
              ("source-payload-length", str(len((row["payload"] or "").encode())))]
    fields += [("source-http-" + k.strip().lower(), v.strip()) for k, _, v in (x.partition(":") for x in (row["http_headers"] or "").split("\r\n")) if v]
    meta = "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None)
    out = []
    for kind, content, block in (("metadata", "application/warc-fields", meta), ("conversion", "text/plain; charset=utf-8", text)):
        raw = block.encode("utf-8", "replace")
        out.append((row["page_id"], kind, record_id(source or "", kind), source, row["target_uri"], row["warc_date"], content, len(raw), digest(raw), row["payload_digest"], row["http_headers"], block))
    return out


def derive(source: DataFrame) -> DataFrame:
    """Two records, metadata and conversion, for each response record. A row is handled where it lies: nothing is shuffled."""
    def run(batches):
        for piece in slices(batches, "payload"):
            rows = [x for r in piece.to_pylist() for x in _records(r)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _TYPES)], names=_NAMES)

    need = ["page_id", "record_id", "target_uri", "warc_date", "http_headers", "payload", "payload_digest"]
    return source.select(*need).mapInArrow(run, RECORD)


_NAMES = [x.split()[0] for x in RECORD.split(", ")]
_TYPES = [pa.int64() if x.split()[1] == "bigint" else pa.string() for x in RECORD.split(", ")]


def serialised() -> Column:
    """A derived record as WARC text: version, headers, a blank line, the block."""
    def line(name: str, value: str) -> Column:
        return F.when(F.col(value).isNotNull(), F.concat(F.lit(f"{name}: "), F.col(value).cast("string"), F.lit("\r\n"))).otherwise(F.lit(""))

    # the status line, then the header fields, under names of their own
    lines = F.split(F.coalesce("http_headers", F.lit("")), "\r\n")
    named = F.transform(lines, lambda x, k: F.when(x.startswith("HTTP/"), F.concat(F.lit("WARC-Source-HTTP-Status: "), x, F.lit("\r\n")))
                        .when(x.rlike(r"^[^\s:]+:"), F.concat(F.lit("WARC-Source-HTTP-"), F.regexp_replace(x, r"^([^:]+):\s*", "$1: "), F.lit("\r\n"))).otherwise(""))
    return F.concat(F.lit(f"{VERSION}\r\n"), line("WARC-Type", "warc_type"), line("WARC-Record-ID", "record_id"), line("WARC-Date", "warc_date"),
                    line("WARC-Target-URI", "target_uri"), line("WARC-Refers-To", "refers_to"), line("WARC-Block-Digest", "block_digest"),
                    line("WARC-Source-Payload-Digest", "source_digest"), F.array_join(named, ""), line("Content-Type", "content_type"), line("Content-Length", "content_length"), F.lit("\r\n"), F.col("block"))


def write(records: DataFrame, path: str, compression: str = "gzip") -> None:
    """WARC files, one a task, each record followed by two line ends."""
    (records.select(serialised().alias("value")).write.option("lineSep", "\r\n\r\n").option("compression", compression).text(path))


def parse(data: bytes) -> list[tuple[dict[str, str], bytes]]:
    """Headers and block of every record of a (decompressed) WARC file."""
    out, at = [], 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        version, *lines = data[at:end].decode().split("\r\n")
        if version != VERSION:
            raise ValueError(f"no record at byte {at}")
        headers = dict(x.split(": ", 1) for x in lines)
        n = int(headers["Content-Length"])
        out.append((headers, data[end + 4 : end + 4 + n]))
        at = end + 4 + n + 4
    return out
