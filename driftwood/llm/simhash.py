"""SimHash near-duplicates by meet-in-the-middle ball hashing.

A fingerprint has a bit set where more than half of the XXH64 hashes of the document's word shingles
have it. To link fingerprints at ``distance`` or fewer differing bits, every distinct fingerprint emits all
variants within half of that; two fingerprints so near share a variant at least. The variants are shuffled,
and colliding fingerprints are linked to the smallest one of their variant after their distance is verified: all
fingerprints around one variant lie within ``distance`` of each other, so these links connect the same documents
as all pairs would, and a variant has at most as many fingerprints as it has variants (65 for distance 2).

Defined cases: null, empty or blank text has fingerprint zero, linked like any other; fewer words than
a shingle are one shingle; repeated rows share a fingerprint and so a class; a class whose ids are all
null has a null component_id.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from driftwood.llm.annotate import annotate
from driftwood.llm.components import components
from driftwood.llm.store import stored
from driftwood.llm.text import buffer, words

SHINGLE, DISTANCE, SEED = 3, 2, 42
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def fingerprints_of(piece: pa.RecordBatch, text: str, shingle: int) -> pa.Array:
    buf, offs = buffer(piece.column(text))
    buf = _LOWER[buf]
    start, end, rows = words(buf, offs)
    # all words of the piece joined by one space
    size = end - start
    at = np.concatenate([[0], np.cumsum(size + 1)])
    joined = np.full(at[-1], 32, np.uint8)
    if len(size):
        joined[np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(at[:-1], size)] = buf[np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(start, size)]
    raw, digest = joined.tobytes(), xxhash.xxh64_intdigest
    per_row = np.diff(rows)
    out = np.zeros(len(per_row), np.uint64)
    n = np.where(per_row > 0, np.maximum(1, per_row - shingle + 1), 0)
    if n.sum():
        first = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(rows[:-1], n)
        last = np.minimum(first + shingle, np.repeat(rows[1:], n)) - 1
        h = np.fromiter((digest(raw[a:b], SEED) for a, b in zip(at[first].tolist(), (at[last] + size[last]).tolist())), np.uint64, len(first))
        full = np.flatnonzero(n)
        bounds = np.cumsum(n) - n
        # bits from the highest on; a block of rows at a time keeps the 64-fold table small
        set_ = np.empty((len(full), 64), np.int64)
        step, k = 1 << 17, 0
        while k < len(full):
            to = max(k + 1, int(np.searchsorted(bounds[full], bounds[full[k]] + step, "left")))
            a, b = bounds[full[k]], bounds[full[to - 1]] + n[full[to - 1]]
            bits = np.unpackbits(h[a:b].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
            set_[k:to] = np.add.reduceat(bits, bounds[full[k:to]] - a, axis=0, dtype=np.int32)
            k = to
        major = (2 * set_ > n[full][:, None]).astype(np.uint8)
        out[full] = np.packbits(major, axis=1).view(">u8").reshape(-1)
    return pa.StructArray.from_arrays([pa.array(out.view(np.int64))], ["bits"])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, out: str = "simhash", text: str = "text") -> DataFrame:
    """``docs`` with a struct ``out`` holding ``bits``, the fingerprint as a signed long."""
    return annotate(docs, out, "bits bigint", lambda: lambda piece: fingerprints_of(piece, text, shingle), text)


def links(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Links u > v between distinct fingerprints (column ``fp``, no repeats) that connect all at ``distance`` or fewer bits."""
    if distance < 0 or distance % 2:
        raise ValueError("the distance must be even: half of it is the radius of the variants")
    masks = [0] + [sum(1 << b for b in c) for r in range(1, distance // 2 + 1) for c in combinations(range(64), r)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    balls = prints.select("fp", F.explode(F.transform(F.lit(signed), lambda m: F.col("fp").bitwiseXOR(m))).alias("variant"))
    met = balls.withColumn("v", F.min("fp").over(W.partitionBy("variant")))
    pairs = met.filter("fp <> v").select("v", F.col("fp").alias("u")).distinct()
    return pairs.filter(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= distance)


def classes(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """``prints`` (doc_id, fp) -> fp, root (the smallest fingerprint of its class) and component_id (the smallest doc_id)."""
    own = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-prints")
    roots = components(links(own, distance))
    known = own.join(roots, own["fp"] == roots["u"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = known.groupBy("root").agg(F.min("least").alias("component_id"))
    return known.join(least, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, doc_id: str = "doc_id", text: str = "text", keep: tuple = ()) -> DataFrame:
    """doc_id, the columns ``keep``, fp and root (signed longs: the fingerprint and its class) and component_id for every row of ``docs``."""
    own = docs.select(F.col(doc_id).alias("doc_id"), *keep, F.col(text).cast("string").alias("__text"))
    prints = fingerprints(own, shingle, "__simhash", "__text").select("doc_id", *keep, F.col("__simhash.bits").alias("fp"))
    prints = stored(prints, "simhash-docs")
    found = stored(classes(prints, distance), "simhash-classes")
    return prints.join(found, "fp").select("doc_id", *keep, "fp", "root", "component_id")
