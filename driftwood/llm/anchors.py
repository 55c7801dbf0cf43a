"""Substring deduplication by fixed-block anchors.

Words of a document that a window of ``WINDOW`` words covers are repeats if that window's words also
start somewhere in a document with a smaller id. Any such window holds one whole block of the
earlier document's words cut every ``BLOCK`` words (2 * BLOCK <= WINDOW), so:

1. index: the blocks of every document, as hashes; probe: every rolling window of BLOCK words of every
   document. Both are shuffled by hash in packed form (4 bytes a probe). A task collapses what it holds of one
   hash before that, so a passage that a third of all documents share costs a task one probe, and the task's own
   documents that share a hash are candidates at once.
2. a hit makes candidates of the words around it: both documents get the places where the hash stands.
3. extension: at each candidate place the windows of WINDOW words that hold the block are compared by a 96-bit
   hash with the smallest document that has them, again collapsed in each task first. Neighbouring hits join to
   maximal repeated stretches.

Defined cases: null, empty and short texts have no repeats; a null id neither repeats another document nor is repeated;
rows with equal ids never repeat one another; repeated rows get the same result each.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftwood.llm.store import packed, power_of_two, text_bytes, unpacked
from driftwood.llm.text import U, buffer, byte_table, mix, ranges, rolling, slices, span, sums, words

WINDOW, BLOCK = 50, 25
#: text bytes behind one bucket of the shuffles, and words a task gathers before it sends
BUCKET_BYTES, CHUNK_WORDS = 32 << 20, 1 << 20
_T1, _T2 = byte_table(11), byte_table(12)
_PACKED = "bucket int, kind int, ids binary, marks binary, counts binary, a binary, b binary, c binary"
_NAMES = [x.split()[0] for x in _PACKED.split(", ")]
_EMPTY = b""


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int32(), pa.int32()] + [pa.binary()] * 6
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * len(types), types)], names=_NAMES)


def _by_bucket(bucket: np.ndarray, doc: np.ndarray, ids: np.ndarray, marks: np.ndarray, kind: int, columns: list[np.ndarray]) -> list[tuple]:
    """A packed row for each bucket: its documents, how many entries each has, and the entries' columns."""
    order = np.lexsort((doc, bucket))
    bucket, doc, columns = bucket[order], doc[order], [c[order] for c in columns]
    at = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(bucket) else np.empty(0, np.int64)
    out = []
    for s, e in zip(at, np.concatenate([at[1:], [len(bucket)]]).astype(np.int64)):
        d, n = np.unique(doc[s:e], return_counts=True)
        blobs = [c[s:e].tobytes() for c in columns] + [_EMPTY] * (3 - len(columns))
        out.append((int(bucket[s]), kind, ids[d].tobytes(), marks[d].tobytes(), n.astype(np.uint32).tobytes(), *blobs))
    return out


def _entries(table: pa.Table, kind: int, types: list) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Ids, marks and columns of all entries of one kind in a bucket."""
    ids, marks, cols = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [[np.empty(0, t)] for t in types]
    for r in table.filter(pa.compute.equal(table["kind"], kind)).select(_NAMES[2:]).to_batches():
        for row in r.to_pylist():
            n = np.frombuffer(row["counts"], np.uint32)
            ids.append(np.repeat(np.frombuffer(row["ids"], np.int64), n))
            marks.append(np.repeat(np.frombuffer(row["marks"], np.int64), n))
            for k, (name, t) in enumerate(zip("abc", types)):
                cols[k].append(np.frombuffer(row[name], t))
    return np.concatenate(ids), np.concatenate(marks), [np.concatenate(c) for c in cols]


def _word_hashes(buf: np.ndarray, offs: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    start, end, rows = words(buf, offs)
    return span(sums(table[buf]), start, end), rows


def _key(v: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and 32 more bits of a hash."""
    return (v & U(buckets - 1)).astype(np.int32), (v >> U(32)).astype(np.uint32)


def _probes(batches, buckets: int, window: int, block: int, chunk: int):
    """Packed rows: kind 0 probes, 1 index blocks, 2 places of hashes that the chunk's documents share."""
    v, d, p, ids, held = [], [], [], [], 0

    def flush():
        if not v:
            return None
        own, inverse = np.unique(np.array(ids, np.int64), return_inverse=True)
        vv, dd, pp = np.concatenate(v), inverse[np.concatenate(d)], np.concatenate(p)
        order = np.argsort(vv, kind="stable")
        vv, dd, pp = vv[order], dd[order], pp[order]
        first = np.flatnonzero(np.concatenate([[True], vv[1:] != vv[:-1]]))
        size = np.diff(np.concatenate([first, [len(vv)]]))
        top, low = np.maximum.reduceat(dd, first), np.minimum.reduceat(dd, first)
        none = np.zeros(len(own), np.int64)
        bucket, key = _key(vv[first], buckets)
        out = _by_bucket(bucket, top, own, none, 0, [key])
        aligned = np.where(pp % block == 0, dd, len(own))
        least = np.minimum.reduceat(aligned, first)
        has = least < len(own)
        out += _by_bucket(bucket[has], least[has], own, none, 1, [key[has]])
        shared = np.repeat(top != low, size)
        if shared.any():
            sd, sp = dd[shared], pp[shared]
            order = np.lexsort((sp, sd))
            sd, sp = sd[order], sp[order]
            run = np.concatenate([[True], (sd[1:] != sd[:-1]) | (sp[1:] > sp[:-1] + 1)])
            a, b = np.flatnonzero(run), np.concatenate([np.flatnonzero(run)[1:], [len(sd)]]) - 1
            out += _by_bucket((sd[a] % buckets).astype(np.int32), sd[a], own, none, 2, [sp[a].astype(np.uint32), sp[b].astype(np.uint32)])
        v.clear(), d.clear(), p.clear(), ids.clear()
        return _rows(out)

    for piece in slices(batches):
        buf, offs = buffer(piece.column("text"))
        h, rows = _word_hashes(buf, offs, _T1)
        roll = rolling(sums(h), block)
        n = np.diff(rows)
        live = np.flatnonzero(n >= window)
        if not len(live):
            continue
        starts = n[live] - block + 1
        at = ranges(rows[:-1][live], starts)
        v.append(roll[at])
        d.append(np.repeat(np.arange(len(live)), starts) + len(ids))
        p.append(ranges(np.zeros(len(live), np.int64), starts))
        ids.extend(piece.column("doc_id").take(pa.array(live)).to_pylist())
        held += len(at)
        if held >= chunk:
            yield flush()
            held = 0
    last = flush()
    if last is not None:
        yield last


def _per_doc(ids: np.ndarray, marks: np.ndarray, columns: list[np.ndarray]) -> list[tuple]:
    """(id, mark, blob of each column) for every document."""
    order = np.lexsort((marks, ids))
    ids, marks, columns = ids[order], marks[order], [c[order] for c in columns]
    at = np.flatnonzero(np.concatenate([[True], (ids[1:] != ids[:-1]) | (marks[1:] != marks[:-1])])) if len(ids) else np.empty(0, np.int64)
    return [(int(ids[s]), int(marks[s]), *(c[s:e].tobytes() for c in columns)) for s, e in zip(at, np.concatenate([at[1:], [len(ids)]]).astype(np.int64))]


def _to_docs(ids: np.ndarray, marks: np.ndarray, kind: int, columns: list[np.ndarray], buckets: int) -> list[tuple]:
    """Packed rows of entries, dealt by document: what one bucket has found for many documents is a row for each bucket of documents."""
    order = np.lexsort((marks, ids))
    ids, marks, columns = ids[order], marks[order], [c[order] for c in columns]
    new = np.concatenate([[True], (ids[1:] != ids[:-1]) | (marks[1:] != marks[:-1])]) if len(ids) else np.empty(0, bool)
    doc = np.cumsum(new) - 1
    own = ids[new]
    bucket = (mix(own.view(np.uint64)) & U(buckets - 1)).astype(np.int32)
    return _by_bucket(bucket[doc], doc, own, marks[new], kind, columns)


def _meet(table: pa.Table, buckets: int) -> pa.Table:
    """Hits of one bucket, dealt by document: kind 0 hash keys that stand at hits, 1 places shared in a chunk."""
    bucket = table["bucket"][0].as_py()
    ids, _, (key,) = _entries(table, 0, [np.uint32])
    block_ids, _, (block_key,) = _entries(table, 1, [np.uint32])
    order = np.lexsort((block_ids, block_key))
    block_ids, block_key = block_ids[order], block_key[order]
    first = np.flatnonzero(np.concatenate([[True], block_key[1:] != block_key[:-1]])) if len(block_key) else np.empty(0, np.int64)
    known, least = block_key[first], block_ids[first]
    rows: list[tuple] = []
    if len(known) and len(key):
        at = np.minimum(np.searchsorted(known, key), len(known) - 1)
        met = known[at] == key
        ids, key, at = ids[met], key[met], at[met]
        most = np.full(len(known), np.iinfo(np.int64).min)
        np.maximum.at(most, at, ids)
        later = ids > least[at]
        which = np.repeat(np.arange(len(known)), np.diff(np.concatenate([first, [len(block_key)]])))
        earlier = block_ids < most[which]
        both_ids = np.concatenate([ids[later], block_ids[earlier]])
        both = np.concatenate([key[later], block_key[earlier]]).astype(np.uint64) | (U(bucket) << U(32))
        rows += _to_docs(both_ids, np.zeros(len(both_ids), np.int64), 0, [both], buckets)
    ids, _, (a, b) = _entries(table, 2, [np.uint32, np.uint32])
    rows += _to_docs(ids, np.zeros(len(ids), np.int64), 1, [a, b], buckets)
    return pa.Table.from_batches([_rows(rows)])


def _places(table: pa.Table) -> pa.Table:
    """A row for each document: keys (hash keys that stand at hits), first and last (stretches of places)."""
    found: dict[int, list[bytes]] = {}
    ids, marks, columns = _entries(table, 0, [np.uint64])
    for i, _, keys in _per_doc(ids, marks, columns):
        found[i] = [keys, _EMPTY, _EMPTY]
    ids, marks, columns = _entries(table, 1, [np.uint32, np.uint32])
    for i, _, a, b in _per_doc(ids, marks, columns):
        found.setdefault(i, [_EMPTY, _EMPTY, _EMPTY])[1:] = [a, b]
    return pa.table([pa.array(found, pa.int64()), *(pa.array([v[k] for v in found.values()], pa.binary()) for k in range(3))], names=["doc_id", "keys", "first", "last"])


def _windows(batches, buckets: int, key_buckets: int, window: int, block: int, chunk: int):
    """Packed rows: kind 0 the windows of candidates (of each window those of the chunk's smallest document), 1 repeats found in the chunk."""
    w1, w2, d, p, ids, marks, held = [], [], [], [], [], [], 0

    def flush():
        if not w1:
            return None
        own = np.array(ids, np.int64)
        a, b, dd, pp = np.concatenate(w1), np.concatenate(w2), np.concatenate(d), np.concatenate(p)
        order = np.lexsort((own[dd], b, a))
        a, b, dd, pp = a[order], b[order], dd[order], pp[order]
        first = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
        least = np.repeat(own[dd[first]], np.diff(np.concatenate([first, [len(a)]])))
        later = own[dd] > least
        own_marks = np.array(marks, np.int64)
        keep = ~later
        out = _by_bucket((a[keep] & U(buckets - 1)).astype(np.int32), dd[keep], own, own_marks, 0, [a[keep], b[keep], pp[keep].astype(np.uint32)])
        out += _by_bucket((dd[later] % buckets).astype(np.int32), dd[later], own, own_marks, 1, [pp[later].astype(np.uint32)])
        for x in (w1, w2, d, p, ids, marks):
            x.clear()
        return _rows(out) if out else None

    for piece in slices(batches, "z", 1 << 20):
        texts = unpacked(piece.column("z"))
        offs = np.cumsum([0, *map(len, texts)])
        buf = np.frombuffer(b"".join(texts), np.uint8)
        h1, rows = _word_hashes(buf, offs, _T1)
        h2, _ = _word_hashes(buf, offs, _T2)
        roll, one, two = rolling(sums(h1), block), rolling(sums(h1), window), rolling(sums(h2), window)
        names, seals = piece.column("doc_id").to_pylist(), piece.column("mark").to_pylist()
        keys, firsts, lasts = (piece.column(c).to_pylist() for c in ("keys", "first", "last"))
        for k in range(piece.num_rows):
            s, n = rows[k], rows[k + 1] - rows[k]
            starts = n - window + 1
            if starts <= 0:
                continue
            # a block at q may lie in the windows that start at q - (window - block) to q
            edge = np.zeros(n + 2, np.int64)
            mine = np.frombuffer(keys[k], np.uint64)
            if len(mine):
                low, high = _key(roll[s : s + n - block + 1], key_buckets)
                q = np.flatnonzero(np.isin(high.astype(np.uint64) | (low.astype(np.uint64) << U(32)), mine))
                np.add.at(edge, np.maximum(q - (window - block), 0), 1)
                np.add.at(edge, q + 1, -1)
            a, b = (np.frombuffer(x[k], np.uint32).astype(np.int64) for x in (firsts, lasts))
            np.add.at(edge, np.maximum(np.minimum(a, n) - (window - block), 0), 1)
            np.add.at(edge, np.minimum(b, n) + 1, -1)
            q = np.flatnonzero(np.cumsum(edge[:starts]) > 0)
            if not len(q):
                continue
            w1.append(one[s + q])
            w2.append((two[s + q] >> U(32)).astype(np.uint32))
            d.append(np.full(len(q), len(ids)))
            p.append(q)
            ids.append(names[k])
            marks.append(seals[k])
            held += len(q)
        if held >= chunk:
            if (out := flush()) is not None:
                yield out
            held = 0
    if (out := flush()) is not None:
        yield out


def _repeats(table: pa.Table, buckets: int) -> pa.Table:
    """Places of the windows of one bucket that a smaller document has, and those found in the chunks, dealt by document."""
    ids, marks, (a, b, p) = _entries(table, 0, [np.uint64, np.uint32, np.uint32])
    order = np.lexsort((ids, b, a))
    ids, marks, a, b, p = ids[order], marks[order], a[order], b[order], p[order]
    first = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])) if len(a) else np.empty(0, np.int64)
    later = ids > np.repeat(ids[first], np.diff(np.concatenate([first, [len(a)]])).astype(np.int64))
    more_ids, more_marks, (more,) = _entries(table, 1, [np.uint32])
    rows = _to_docs(np.concatenate([ids[later], more_ids]), np.concatenate([marks[later], more_marks]), 0, [np.concatenate([p[later], more])], buckets)
    return pa.Table.from_batches([_rows(rows)])


def _starts(table: pa.Table) -> pa.Table:
    """A row for each document: ``at``, the places where its repeated windows start."""
    rows = _per_doc(*_entries(table, 0, [np.uint32]))
    cols = list(zip(*rows)) or [(), (), ()]
    return pa.table([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.binary())], names=["doc_id", "mark", "at"])


def repeats(docs: DataFrame, window: int = WINDOW, block: int = BLOCK, bucket_bytes: int = BUCKET_BYTES, chunk: int = CHUNK_WORDS) -> DataFrame:
    """doc_id, mark (hash of the text) and ``at`` (packed word numbers where repeated windows start), for documents that have any.

    ``docs``: doc_id (bigint), text.
    """
    if 2 * block > window:
        raise ValueError("a window must hold a whole block wherever it starts: block <= window / 2")
    docs = docs.filter("doc_id IS NOT NULL AND text IS NOT NULL")
    buckets = power_of_two(max(1, text_bytes(docs) / bucket_bytes))

    def dealt(rows: DataFrame) -> DataFrame:
        """Rows by bucket. Up to the session's number of shuffle partitions Spark joins small ones; beyond it a bucket has a
        partition, so what one task reads does not grow with the input."""
        many = buckets > int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        return rows.repartition(buckets, "bucket") if many else rows

    sent = docs.select("doc_id", "text").mapInArrow(lambda it: _probes(it, buckets, window, block, chunk), _PACKED)
    met = dealt(sent).groupBy("bucket").applyInArrow(lambda t: _meet(t, buckets), _PACKED)
    places = dealt(met).groupBy("bucket").applyInArrow(_places, "doc_id bigint, keys binary, first binary, last binary")
    texts = packed(docs, {"doc_id": F.col("doc_id"), "mark": F.xxhash64("text")})
    near = texts.join(places, "doc_id").select("doc_id", "mark", "z", "keys", "first", "last")
    windows = near.mapInArrow(lambda it: _windows(it, buckets, buckets, window, block, chunk), _PACKED)
    found = dealt(windows).groupBy("bucket").applyInArrow(lambda t: _repeats(t, buckets), _PACKED)
    return dealt(found).groupBy("bucket").applyInArrow(_starts, "doc_id bigint, mark bigint, at binary")


RESULT = "n_words bigint, n_removed bigint, spans array<struct<first: bigint, stop: bigint>>, kept string"


def cut(docs: DataFrame, window: int = WINDOW, block: int = BLOCK, **sizes) -> DataFrame:
    """doc_id, n_words, n_removed, spans (removed stretches of words) and kept (the other words joined by one space), a row for each row of ``docs``."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = repeats(docs, window, block, **sizes).withColumnsRenamed({"doc_id": "d", "mark": "m"})
    texts = packed(docs, {"doc_id": F.col("doc_id"), "mark": F.xxhash64("text")})
    both = texts.join(found, (F.col("doc_id") == F.col("d")) & (F.col("mark") == F.col("m")), "left").select("doc_id", "z", "at")

    def run(batches):
        for piece in slices(batches, "z", 1 << 20):
            out = []
            for doc_id, text, at in zip(piece.column("doc_id").to_pylist(), unpacked(piece.column("z")), piece.column("at").to_pylist()):
                w = text.split()
                start = np.unique(np.frombuffer(at or b"", np.uint32)).astype(np.int64)
                spans = []
                if len(start):
                    new = np.flatnonzero(np.concatenate([[True], start[1:] > start[:-1] + window]))
                    ends = np.concatenate([start[new[1:] - 1], start[-1:]]) + window
                    spans = [{"first": int(a), "stop": int(b)} for a, b in zip(start[new], ends)]
                removed = sum(s["stop"] - s["first"] for s in spans)
                for s in reversed(spans):
                    del w[s["first"] : s["stop"]]
                out.append((doc_id, len(w) + removed, removed, spans, b" ".join(w).decode()))
            c = list(zip(*out))
            yield pa.RecordBatch.from_arrays([pa.array(c[0], pa.int64()), pa.array(c[1], pa.int64()), pa.array(c[2], pa.int64()),
                                              pa.array(c[3], pa.list_(pa.struct([("first", pa.int64()), ("stop", pa.int64())]))), pa.array(c[4], pa.string())],
                                             names=["doc_id", "n_words", "n_removed", "spans", "kept"])

    return both.mapInArrow(run, "doc_id bigint, " + RESULT)
