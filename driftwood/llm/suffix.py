"""Suffix-array deduplication: repeated byte strings found on Burrows-Wheeler transforms, bucket by bucket.

A window is ``length`` bytes of one document. Its anchor is the leftmost of its ``gram``-byte strings with the
smallest hash, so equal windows have equal anchors, wherever they stand. Windows that follow each other and share one anchor form a
segment: the bytes they cover. Then

1. segments are counted by anchor; an anchor that occurs once has no repeats. Equal segments collapse to one
   with a count.
2. all segments of an anchor go to one bucket. An anchor with more than ``hot_bytes`` of different segments is split:
   its windows are grouped by the place of the anchor in the window (in parts of 64) and by the bytes that all windows of
   the part share, and what is still hot after that by the window's own bytes. Equal windows stay together.
3. of a segment only the windows go on that may repeat: equal windows have their anchor at the same place, so they share half a window's
   bytes (less the anchor's) before it if it stands late in them, else after it, and some other segment of the anchor has to have these too.
4. in a bucket the segments' suffixes are sorted, and interval expansion on their Burrows-Wheeler transform finds the
   neighbours with a common prefix of ``length`` bytes or more (bwt.py). Their windows are repeats.
5. a document's repeated windows are removed together; overlaps count.

Defined cases: null text is an empty one; texts shorter than a window have no repeats; repeated rows and equal
ids are different documents, so their windows repeat one another; a null id is an id like any other.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftwood.llm.bwt import repeated
from driftwood.llm.store import packed, power_of_two, stored, unpacked
from driftwood.llm.text import U, buffer, byte_table, give_back, lean, mix, rolling, slices, span, sums

LENGTH, GRAM = 400, 32
#: bytes of segments in a bucket, of different segments of one anchor, and of text handled at once
BUCKET_BYTES, HOT_BYTES, STRETCH = 256 << 10, 1 << 20, 512 << 10
PART = 64
_T1, _T2 = byte_table(21), byte_table(22)
_PLACE = U(24)
#: h: what windows must share to be compared; d: a segment's bytes; first/last: places of its windows; anchor: its place;
#: copies: how many equal segments follow each other; n: windows of one segment
SEGMENT = "doc_id string, mark bigint, h bigint, d bigint, first bigint, last bigint, anchor bigint, copies bigint, n bigint"
_NAMES = [x.split()[0] for x in SEGMENT.split(", ")]


def _anchors(key: np.ndarray, width: int) -> np.ndarray:
    """The smallest key of every stretch of ``width``."""
    step, low = 1, key
    while 2 * step <= width:
        low = np.minimum(low[:-step], low[step:])
        step *= 2
    return np.minimum(low[: len(key) - width + 1], low[width - step :]) if step < width else low


def segments_of(buf: np.ndarray, offs: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(row, h, d, first, last, anchor, copies, n) of the segments of some texts; places count from the text's start."""
    total = len(buf)
    p1, p2 = sums(_T1[buf]), sums(_T2[buf])
    grams = rolling(p1, gram)
    if total < length:
        return tuple(np.empty(0, np.int64) for _ in range(8))
    low = _anchors((grams >> _PLACE << _PLACE) | np.arange(len(grams), dtype=np.uint64), length - gram + 1)
    place = (low & U((1 << 24) - 1)).astype(np.int64)
    row = np.repeat(np.arange(len(offs) - 1), np.diff(offs))[: len(place)]
    inside = np.arange(len(place)) + length <= offs[row + 1]
    start = np.flatnonzero(inside & np.concatenate([[True], (place[1:] != place[:-1]) | (row[1:] != row[:-1]) | ~inside[:-1]]))
    end = np.flatnonzero(inside & np.concatenate([(place[1:] != place[:-1]) | (row[1:] != row[:-1]) | ~inside[1:], [True]]))
    h, d = grams[place[start]], span(p2, start, end + length) + (place[start] - start).astype(np.uint64)
    row = row[start]
    # segments that repeat at once, as in text of one pattern, are one entry
    new = np.concatenate([[True], (h[1:] != h[:-1]) | (d[1:] != d[:-1]) | (row[1:] != row[:-1]) | (start[1:] != end[:-1] + 1)]) if len(h) else np.empty(0, bool)
    at = np.flatnonzero(new)
    copies = np.diff(np.concatenate([at, [len(h)]]))
    base = offs[row[at]]
    last = end[at + copies - 1] if len(at) else at
    return row[at], h[at].view(np.int64), d[at].view(np.int64), start[at] - base, last - base, place[start[at]] - base, copies, end[at] - start[at] + 1


def _stretches(buf: np.ndarray, offs: np.ndarray, length: int, gram: int):
    """Segments of the texts of a piece; a very long text in stretches that overlap by a window."""
    if len(buf) <= STRETCH:
        yield segments_of(buf, offs, length, gram)
        return
    for k in range(len(offs) - 1):
        for a in range(offs[k], max(offs[k] + 1, offs[k + 1] - length + 1), STRETCH):
            b = min(offs[k + 1], a + STRETCH + length - 1)
            row, h, d, first, last, anchor, copies, n = segments_of(buf[a:b], np.array([0, b - a]), length, gram)
            shift = a - offs[k]
            yield row + k, h, d, first + shift, last + shift, anchor + shift, copies, n


def segments(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """Segments of all documents (doc_id as string, mark, text)."""
    def run(batches):
        for piece in slices(batches, limit=STRETCH):  # segments take some 100 times the bytes at hand
            ids, marks = piece.column("doc_id"), piece.column("mark")
            for row, *rest in _stretches(*buffer(piece.column("text")), length, gram):
                at = pa.array(row)
                yield pa.RecordBatch.from_arrays([ids.take(at), marks.take(at), *(pa.array(x) for x in rest)], names=_NAMES)

    return docs.mapInArrow(lean(run), SEGMENT)


def _same_doc(a: str, b: str):
    return F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id")) & (F.col(f"{a}.mark") == F.col(f"{b}.mark"))


def _with_text(texts: DataFrame, rows: DataFrame, columns: list[str]) -> DataFrame:
    """``rows`` gathered by document (lists ``columns``), with the text: one row a document."""
    per = rows.groupBy("doc_id", "mark").agg(F.collect_list(F.struct(*columns)).alias("s"))
    return texts.alias("t").join(per.alias("p"), _same_doc("t", "p")).select("t.doc_id", "t.mark", "t.z", "p.s")


def _split(texts: DataFrame, hot: DataFrame, part: int, length: int) -> DataFrame:
    """Segments of hot anchors cut where the anchor's place in the window, by ``part``, changes."""
    def run(batches):
        for piece in slices(batches, "z", 1 << 20):
            ids, marks, lists = piece.column("doc_id").to_pylist(), piece.column("mark").to_pylist(), piece.column("s").to_pylist()
            for doc_id, mark, text, own in zip(ids, marks, unpacked(piece.column("z")), lists):
                buf = np.frombuffer(text, np.uint8)
                p1, p2 = sums(_T1[buf]), sums(_T2[buf])
                out = []
                for s in own:
                    # of equal neighbours the first stands for all: they repeat in any case
                    first, last, a = s["first"], s["first"] + s["n"] - 1, s["anchor"]
                    for k in range((a - last) // part, (a - first) // part + 1):
                        lo, hi = max(first, a - k * part - part + 1), min(last, a - k * part)
                        out.append((lo, hi, a, k, s["h"], s["copies"], s["last"] if s["copies"] > 1 and hi == last else hi))
                lo, hi, a, k, h, copies, end = (np.array(x, np.int64) for x in zip(*out))
                core = span(p1, a - k * part, a - k * part - part + 1 + length)
                new = mix(core ^ mix(h.view(np.uint64) + k.astype(np.uint64) * U(2) + U(part == 1)))
                d = span(p2, lo, hi + length) + (a - lo).astype(np.uint64)
                m = len(lo)
                yield pa.RecordBatch.from_arrays([pa.array([doc_id] * m, pa.string()), pa.array([mark] * m, pa.int64()), pa.array(new.view(np.int64)), pa.array(d.view(np.int64)),
                                                  pa.array(lo), pa.array(end), pa.array(a), pa.array(copies), pa.array(hi - lo + 1)], names=_NAMES)

    return _with_text(texts, hot, ["h", "first", "last", "anchor", "copies", "n"]).mapInArrow(lean(run), SEGMENT)


def _cutouts(texts: DataFrame, chosen: DataFrame, length: int) -> DataFrame:
    """The bytes of chosen segments: h, d, total, bytes."""
    def run(batches):
        for piece in slices(batches, "z", 1 << 20):
            for text, own in zip(unpacked(piece.column("z")), piece.column("s").to_pylist()):
                for k in range(0, len(own), 2000):
                    some = own[k : k + 2000]
                    yield pa.RecordBatch.from_arrays([pa.array([s[c] for s in some], pa.int64()) for c in ("h", "d", "total")]
                                                     + [pa.array([s["anchor"] - s["first"] for s in some], pa.int64()),
                                                        pa.array([text[s["first"] : s["first"] + s["n"] - 1 + length] for s in some], pa.binary())],
                                                     names=["h", "d", "total", "anchor", "bytes"])

    return _with_text(texts, chosen, ["h", "d", "total", "first", "n", "anchor"]).mapInArrow(lean(run), "h bigint, d bigint, total bigint, anchor bigint, bytes binary")


def candidates(buf: np.ndarray, offs: np.ndarray, h: np.ndarray, anchor: np.ndarray, total: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """The first and last window of each segment that may repeat (last below first: none does). ``anchor``: its place in the
    segment; ``total``: how often the segment occurs. All windows of segments with different h differ, and so do those of one segment."""
    half = (length - gram) // 2
    n = np.diff(offs) - length + 1
    late = anchor - half  # in windows up to here the anchor has half a window before it, in all others after it
    prefix = sums(_T2[buf])
    several = []
    for has, start in ((late >= 0, anchor - half), (late < n - 1, anchor + gram)):
        start = (offs[:-1] + start)[has]
        _, key = np.unique(mix(h[has].view(np.uint64)) ^ span(prefix, start, start + half), return_inverse=True)
        more = np.zeros(len(n), bool)
        more[has] = np.bincount(key, total[has])[key] > 1
        several.append(more)
    return np.where(several[0], 0, np.maximum(late + 1, 0)), np.where(several[1], n - 1, np.minimum(late, n - 1))


def _bucket(table: pa.Table, length: int, gram: int) -> pa.Table:
    """Repeated windows of the segments of one bucket: h, d, at (places from the segment's start, packed as stretches)."""
    h, d = (table[c].to_numpy() for c in ("h", "d"))
    _, keep = np.unique(np.stack([h, d]), axis=1, return_index=True)  # an owner that repeats has sent its segments twice
    h, d, total, anchor = (table[c].to_numpy()[keep] for c in ("h", "d", "total", "anchor"))
    own = table["bytes"].take(pa.array(keep)).combine_chunks()
    del table
    lo, hi = candidates(*buffer(own), h, anchor, total, length, gram)
    live = np.flatnonzero(lo <= hi)
    strings = [x[a : b + length] for x, a, b in zip(own.take(pa.array(live)).to_pylist(), lo[live].tolist(), hi[live].tolist())]
    del own
    out = []
    for k, at in zip(live, repeated(strings, total[live], length) if strings else ()):
        if len(at):
            at = at + lo[k]
            first = np.flatnonzero(np.concatenate([[True], at[1:] > at[:-1] + 1]))
            last = np.concatenate([first[1:], [len(at)]]) - 1
            out.append((h[k], d[k], np.stack([at[first], at[last]], 1).astype(np.int32).tobytes()))
    cols = list(zip(*out)) or [(), (), ()]
    del strings, out
    give_back()
    return pa.table([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.binary())], names=["h", "d", "at"])


def repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, bucket_bytes: int = BUCKET_BYTES, hot_bytes: int = HOT_BYTES) -> DataFrame:
    """doc_id (as string), mark (hash of the text) and ``at`` (list of packed stretches of places where repeated windows start).

    ``docs``: doc_id (string), mark, text.
    """
    found = stored(segments(docs.filter(F.octet_length("text") >= length), length, gram), "suffix-segments")

    def by_anchor(rows):
        distinct = rows.groupBy("h", "d").agg(F.sum("copies").alias("total"), F.first("n").alias("n"))
        return distinct.groupBy("h").agg(F.sum("total").alias("total"), F.sum(F.col("n") + length - 1).alias("bytes")).filter("total > 1")

    several = stored(by_anchor(found), "suffix-anchors")
    live = stored(found.join(several.select("h", F.col("bytes").alias("b")), "h"), "suffix-live")
    owners = live.select("doc_id", "mark").distinct()
    packed_docs = packed(docs, {"doc_id": F.col("doc_id"), "mark": F.col("mark")})
    texts = stored(packed_docs.alias("t").join(owners.alias("o"), _same_doc("t", "o"), "left_semi"), "suffix-texts")
    done = live.filter(F.col("b") <= hot_bytes).select(*_NAMES)
    hot = live.filter(F.col("b") > hot_bytes).select(*_NAMES)
    for part in (PART, 1):
        if hot.isEmpty():
            break
        finer = stored(_split(texts.dropDuplicates(["doc_id", "mark"]), hot, part, length), "suffix-split")
        sizes = stored(by_anchor(finer), "suffix-anchors")
        finer = finer.join(sizes.select("h", F.col("bytes").alias("b")), "h")
        still = (F.col("b") > hot_bytes) if part > 1 else F.lit(False)
        done = done.unionByName(finer.filter(~still).select(*_NAMES))
        hot = finer.filter(still).select(*_NAMES)

    chosen = stored(done.groupBy("h", "d").agg(F.sum("copies").alias("total"), F.min(F.struct("doc_id", "mark", "first", "n", "anchor")).alias("r"))
                    .select("h", "d", "total", "r.*"), "suffix-chosen")
    size = chosen.agg(F.sum(F.col("n") + length).alias("b")).first()["b"] or 0
    buckets = power_of_two(max(1, size / bucket_bytes))
    cut_ = _cutouts(texts, chosen, length).withColumn("bucket", F.pmod(F.xxhash64("h"), F.lit(buckets)))
    verdicts = cut_.groupBy("bucket").applyInArrow(lambda t: _bucket(t, length, gram), "h bigint, d bigint, at binary")

    def places(batches):
        """Stretches of repeated windows in their document; all of equal neighbours."""
        for b in batches:
            first, last, copies, n = (b.column(c).to_numpy() for c in ("first", "last", "copies", "n"))
            blobs = []
            for f, e, c, blob in zip(first, last, copies, b.column("at").to_pylist()):
                pairs = np.frombuffer(blob, np.int32).reshape(-1, 2).astype(np.int64) + f
                blobs.append((np.array([[f, e]]) if c > 1 else pairs).tobytes())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("mark"), pa.array(blobs, pa.binary())], names=["doc_id", "mark", "at"])

    hits = done.join(verdicts, ["h", "d"]).select("doc_id", "mark", "first", "last", "copies", "n", "at").mapInArrow(lean(places), "doc_id string, mark bigint, at binary")
    return hits.groupBy("doc_id", "mark").agg(F.collect_list("at").alias("at"))


def whole(text: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The spans without characters of which only some bytes are covered."""
    out = []
    for a, b in spans:
        while a < b and text[a] & 0xC0 == 0x80:
            a += 1
        while b > a and b < len(text) and text[b] & 0xC0 == 0x80:
            b -= 1
        if a < b:
            out.append((a, b))
    return out


def byte_spans(blobs: list[bytes] | None, length: int) -> list[tuple[int, int]]:
    """Removed stretches of bytes, joined where they overlap or touch."""
    if not blobs:
        return []
    pairs = np.frombuffer(b"".join(blobs), np.int64).reshape(-1, 2)
    pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
    end = np.maximum.accumulate(pairs[:, 1] + length)
    new = np.flatnonzero(np.concatenate([[True], pairs[1:, 0] > end[:-1]]))
    return list(zip(pairs[new, 0].tolist(), np.concatenate([end[new[1:] - 1], end[-1:]]).tolist()))


def cut(docs: DataFrame, length: int = LENGTH, keep: tuple = (), characters: bool = False, **sizes) -> DataFrame:
    """doc_id, n_bytes, n_removed, spans (removed stretches of bytes) and kept (the other bytes), a row for each row of ``docs``;
    ``keep`` names more columns to carry along (none of these names); ``characters`` keeps every character of which a byte stays."""
    base = docs.withColumns({"__key": F.col("doc_id").cast("string"), "__text": F.coalesce(F.col("text").cast("string"), F.lit(""))})
    base = base.withColumn("__mark", F.xxhash64("__text"))
    narrow = base.select(F.col("__key").alias("doc_id"), F.col("__mark").alias("mark"), F.col("__text").alias("text"))
    found = repeats(narrow, length, **sizes)
    names = list(dict.fromkeys(["doc_id", *keep]))
    texts = packed(base, {"doc_id": F.col("__key"), "mark": F.col("__mark"), "__own": F.struct(*names)}, "__text")
    both = texts.alias("t").join(found.alias("f"), _same_doc("t", "f"), "left").select("t.__own", "t.z", "f.at")

    def run(batches):
        for piece in slices(batches, "z", 1 << 20):
            n, removed, spans, kept = [], [], [], []
            for text, at in zip(unpacked(piece.column("z")), piece.column("at").to_pylist()):
                own = byte_spans(at, length)
                own = whole(text, own) if characters else own
                n.append(len(text))
                removed.append(sum(b - a for a, b in own))
                spans.append([{"first": a, "stop": b} for a, b in own])
                edges = [0, *(x for s in own for x in s), len(text)]
                kept.append(b"".join(text[edges[k] : edges[k + 1]] for k in range(0, len(edges), 2)))
            yield pa.RecordBatch.from_arrays([piece.column("__own"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()),
                                              pa.array(spans, pa.list_(pa.struct([("first", pa.int64()), ("stop", pa.int64())]))), pa.array(kept, pa.binary())],
                                             names=["__own", "n_bytes", "n_removed", "spans", "kept"])

    result = T.StructType.fromDDL("n_bytes bigint, n_removed bigint, spans array<struct<first: bigint, stop: bigint>>, kept binary")
    out = both.mapInArrow(lean(run), T.StructType([both.schema["__own"], *result.fields]))
    return out.select("__own.*", "n_bytes", "n_removed", "spans", "kept")
