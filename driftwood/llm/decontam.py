"""Benchmark decontamination: one Aho-Corasick automaton over the windows of normalised benchmark items.

Words of items and documents are normalised alike (A-Z lower-cased; ASCII other than
letters and digits separates). Each word of the items gets a number; the automaton's
alphabet is these numbers, its patterns are the windows of ``width`` words of every item
(an item of fewer words is one window). A document is scanned once, as the sequence of
its words' numbers, and hits map back to words and from there to character offsets.

Defined cases: null or empty text has no words and no hits; an item without words has no
window; repeated items and items that share windows all count as items by their ``item_id``
(a null id counts as the id ``''``); repeated ids count once. An empty benchmark hits nothing.
"""

from __future__ import annotations

import re

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftwood.llm.annotate import annotate
from driftwood.llm.store import stored, text_bytes
from driftwood.llm.text import buffer, byte_table, lean, runs, span, sums, words

WIDTH = 13
#: bytes of windows in one automaton (some 100 000 windows of 13 words); a larger benchmark is scanned in several passes
PART_BYTES = 8 << 20
#: rows of a batch of windows
WINDOW_ROWS = 10_000

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLANK = np.ones(256, bool)
_BLANK[48:58] = _BLANK[65:91] = _BLANK[97:123] = _BLANK[128:] = False
_TABLE = byte_table(3)
_UPPER = {c: c + 32 for c in range(65, 91)}

HITS = "hits array<struct<first: bigint, last: bigint>>, items array<string>"
RESULT = "n_words bigint, n_hit bigint, items array<string>, spans array<struct<start: bigint, stop: bigint>>"


def item_words(text: str | None) -> list[str]:
    return WORD.findall((text or "").translate(_UPPER))


def windows(items: DataFrame, width: int) -> DataFrame:
    """window (its words joined by one space) and ids, a row for each different window of ``items`` (id, text)."""

    def run(batches):
        for b in batches:
            out: list[tuple[str, str]] = []
            for name, text in zip(b.column("id").to_pylist(), b.column("text").to_pylist()):
                w = item_words(text)
                for k in range(max(1, len(w) - width + 1)) if w else ():
                    out.append((" ".join(w[k : k + width]), name or ""))
                    if len(out) == WINDOW_ROWS:
                        yield _window_rows(out)
                        out = []
            if out:
                yield _window_rows(out)

    return items.mapInArrow(lean(run), "window string, id string").groupBy("window").agg(F.collect_set("id").alias("ids"))


def _window_rows(rows: list[tuple[str, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows)], names=["window", "id"])


class Scanner:
    """The automaton and the numbers of its words; made once in each task."""

    def __init__(self, given: pa.Table) -> None:
        found = {tuple(w.split(" ")): ids for w, ids in zip(given["window"].to_pylist(), given["ids"].to_pylist())}
        vocabulary = sorted({w for key in found for w in key})
        raw = [w.encode() for w in vocabulary]
        ends = np.cumsum([0, *map(len, raw)])
        hashes = span(sums(_TABLE[np.frombuffer(b"".join(raw), np.uint8)]), ends[:-1], ends[1:])
        order = np.argsort(hashes)
        self.hashes, self.numbers = hashes[order], (order + 1).astype(np.int64)
        number = {w: k + 1 for k, w in enumerate(vocabulary)}
        self.shortest = min(map(len, found), default=1)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for key, ids in found.items():
            self.automaton.add_word(tuple(number[w] for w in key), (len(key), sorted(ids)))
        if found:
            self.automaton.make_automaton()

    def __call__(self, piece: pa.RecordBatch, text: str) -> pa.Array:
        buf, offs = buffer(piece.column(text))
        hits, items = [[] for _ in range(piece.num_rows)], [set() for _ in range(piece.num_rows)]
        if len(self.hashes):
            low = _LOWER[buf]
            start, end, rows = words(buf, offs, _BLANK)
            h = span(sums(_TABLE[low]), start, end)
            at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
            numbers = np.where(self.hashes[at] == h, self.numbers[at], 0)
            # a match lies within a stretch of known words of one document
            known = numbers > 0
            for row in range(piece.num_rows):
                a, b = rows[row], rows[row + 1]
                for s, e in zip(*runs(known[a:b])):
                    if e - s < self.shortest:
                        continue
                    for last, (n, ids) in self.automaton.iter(tuple(numbers[a + s : a + e].tolist())):
                        hits[row].append((int(s + last - n + 1), int(s + last)))
                        items[row].update(ids)
        return pa.StructArray.from_arrays(
            [pa.array([[{"first": x, "last": y} for x, y in merged(h)] for h in hits], pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))),
             pa.array([sorted(x) for x in items], pa.list_(pa.string()))], ["hits", "items"])


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Inclusive stretches, sorted, touching and overlapping ones joined."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


def _result(piece: pa.RecordBatch, text: str, parts: list[str]) -> pa.Array:
    """Hits of all parts as counts, items and character spans of the original text."""
    buf, offs = buffer(piece.column(text))
    start, end, rows = words(buf, offs, _BLANK)
    chars = np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])
    found = [piece.column(p).to_pylist() for p in parts]
    n_words, n_hit, items, spans = np.diff(rows), [], [], []
    for row in range(piece.num_rows):
        cover = merged([(h["first"], h["last"]) for f in found for h in f[row]["hits"]])
        n_hit.append(sum(b - a + 1 for a, b in cover))
        items.append(sorted({x for f in found for x in f[row]["items"]}))
        base, a = chars[offs[row]], rows[row]
        spans.append([{"start": int(chars[start[a + x]] - base), "stop": int(chars[end[a + y]] - base)} for x, y in cover])
    return pa.StructArray.from_arrays(
        [pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(items, pa.list_(pa.string())),
         pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))], ["n_words", "n_hit", "items", "spans"])


def scan(docs: DataFrame, items: DataFrame, width: int = WIDTH, out: str = "found", text: str = "text",
         item_id: str = "item_id", item_text: str = "text", part_bytes: int = PART_BYTES) -> DataFrame:
    """``docs`` with a struct ``out``: n_words, n_hit, items (ids as strings, sorted) and spans (character offsets).

    Spark takes the windows apart and joins the ids of equal ones. They travel to the tasks in parts of about ``part_bytes`` of
    distinct windows, whatever the benchmark's size: each part is one automaton and one scan. With several parts
    what one has found is written before the next is collected, so the driver and every task hold one part at a time.
    """
    sc = docs.sparkSession.sparkContext
    rows = items.select(F.col(item_id).cast("string").alias("id"), F.col(item_text).cast("string").alias("text"))
    found = stored(windows(rows, width), "benchmark-windows")
    n = max(1, -(-text_bytes(found, "window") // part_bytes))
    df, parts = docs, []
    for k in range(n):
        part = found if n == 1 else found.filter(F.pmod(F.xxhash64("window"), F.lit(n)) == k)
        given = sc.broadcast(part.toArrow())
        parts.append(f"__hits{k}")

        def make(given=given):
            scanner = Scanner(given.value)
            return lambda piece: scanner(piece, text)

        df = annotate(df, parts[-1], HITS, make, text)
        if n > 1:
            df = stored(df, "benchmark-hits")
            given.destroy()
    return annotate(df, out, RESULT, lambda: lambda piece: _result(piece, text, parts), text).drop(*parts)


def contaminated(out: str = "found", share: int = 20) -> Column:
    """A document is contaminated if at least one word in ``share`` is hit."""
    return (F.col(f"{out}.n_hit") > 0) & (share * F.col(f"{out}.n_hit") >= F.col(f"{out}.n_words"))
