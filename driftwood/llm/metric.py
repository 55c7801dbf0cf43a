"""Embedding near-duplicates: an exact range join on the unit sphere, partitioned by pivots.

Distance is the angle between vectors, a metric; ``cosine`` bounds it by T. Pivots are the distinct vectors of lowest digest, one for
``CELL`` of them and MOST_PIVOTS at most, so dense regions get many. A vector lives at its nearest pivot, in the band of
its distance there (bands are T / 2 wide); a cell is a pivot's band, in chunks of about ``CELL`` vectors.

For two cells, the vectors of the one with fewer residents visit the other. By the triangle inequality a vector x at
angle a from the pivot of a cell whose residents lie between ``low`` and ``high``

- has no link there if a > high + T, a < low - T or a > (angle to its own pivot) + 2T, nor if it lies beyond T from the
  pivots' bisector: it does not go there;
- is linked to every resident if a + high <= T: the cell's number of rows is added, it does not go there either;
- goes there otherwise. In the first band (a <= T / 2) all residents are linked to one another without any comparison.

So a tight group of copies costs no pair of vectors, whatever its size. Every chunk compares its residents with one another and with the visitors, which
stream by behind them: a task holds one chunk and one batch. Results are counts per vector and links that span a chunk's linked
vectors, never all pairs. Equal vectors collapse to one with a count before all that. How many cells a vector visits depends on
the data: in clustered or low-dimensional data few, in unclustered high-dimensional data up to all.

Defined cases: a vector that is null, empty, zero or holds null or non-finite components links with nothing; vectors of unequal
length compare as if the shorter ended in zeros; equal rows are different vectors and link; a null id is an id like any other, its class has
the smallest id that is not null; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftwood.llm.components import components
from driftwood.llm.store import stored

COSINE = 0.95
#: vectors of a cell's chunk; pivots and their bytes at most (they bound what is collected and broadcast)
CELL, MOST_PIVOTS, PIVOT_BYTES = 4096, 4096, 16 << 20
#: slack of angles and products, above what rounding can do: beyond it a bound decides, within it the product itself
SLACK = 1e-6
RESIDENT, VISITOR, HOME, ADDED, SPAN = range(5)
ROW = "kind int, cell int, chunk int, key binary, v binary, w bigint, n bigint, root binary"
_NAMES = [x.split()[0] for x in ROW.split(", ")]
_TYPES = [pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.binary()]


def _batch(rows: int, **columns) -> pa.RecordBatch:
    """A batch of ROW with the given columns, the others null; single numbers stand for all rows."""
    out = []
    for name, kind in zip(_NAMES, _TYPES):
        x = columns.get(name)
        out.append(pa.nulls(rows, kind) if x is None else pa.array(np.full(rows, x) if np.isscalar(x) else x, kind))
    return pa.RecordBatch.from_arrays(out, names=_NAMES)


def keyed(rows: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """vec_id, key (a digest of the vector; null where it links with nothing) and v (its components as bytes)."""
    single = isinstance(rows.schema[embedding].dataType.elementType, T.FloatType)
    kind = "float" if single else "double"
    own = rows.select(F.col(vec_id).alias("vec_id"), F.col(embedding).cast(f"array<{kind}>").alias("e"))
    number = np.float32 if single else np.float64

    def run(batches):
        for b in batches:
            e, keys, vs = b.column("e"), [], []
            ends, flat = e.offsets.to_numpy(), e.values
            missing = np.concatenate([[0], np.cumsum(flat.is_null().to_numpy(zero_copy_only=False))])
            x = flat.fill_null(0).to_numpy(zero_copy_only=False).astype(number)
            for k, none in enumerate(e.is_null().to_pylist()):
                v = x[ends[k] : ends[k + 1]]
                live = not none and len(v) and missing[ends[k]] == missing[ends[k + 1]] and np.isfinite(v).all() and v.any()
                v = np.trim_zeros(v + 0, "b").tobytes() if live else None  # -0 becomes 0, zeros at the end mean nothing
                vs.append(v)
                keys.append(hashlib.blake2b(v, digest_size=16).digest() if live else None)
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array(keys, pa.binary()), pa.array(vs, pa.binary())], names=["vec_id", "key", "v"])

    return own.mapInArrow(run, T.StructType([own.schema["vec_id"], *T.StructType.fromDDL("key binary, v binary").fields]))


def units(vs, dim: int, number: str) -> np.ndarray:
    """Unit vectors in double precision, scaled first so that no square over- or underflows."""
    out = np.zeros((len(vs), dim))
    for k, v in enumerate(vs):
        v = np.frombuffer(v, number)
        out[k, : len(v)] = v
    out /= np.abs(out).max(axis=1, keepdims=True, initial=0)
    return out / np.sqrt(np.einsum("ij,ij->i", out, out))[:, None]


def _angles(x: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(x, -1, 1))


class Cells:
    """The pivots, and the cells that have residents, in order (pivot, band)."""

    def __init__(self, pivots: np.ndarray, bound: float, found: list, cell: int):
        self.pivots, self.bound = pivots, bound
        rows = sorted((r["pivot"], r["band"], r["n"], r["w"], r["low"], r["high"], bytes(r["rep"])) for r in found)
        self.pivot, self.band, self.n, self.w = (np.array([r[k] for r in rows], np.int64) for k in range(4))
        self.low, self.high = (np.array([r[k] for r in rows]) for k in (4, 5))
        self.rep = [r[6] for r in rows]
        self.chunks = -(-self.n // cell)
        self.place = {r[:2]: k for k, r in enumerate(rows)}
        # of two cells the smaller one's residents visit
        self.rank = np.empty(len(rows), np.int64)
        self.rank[np.lexsort((np.arange(len(rows)), self.n))] = np.arange(len(rows))

    def core(self) -> np.ndarray:
        return self.high <= self.bound / 2 - SLACK


def nearest(x: np.ndarray, pivots: np.ndarray, bound: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest pivot of each vector, the angle to it and its band."""
    p, best = np.zeros(len(x), np.int64), np.full(len(x), -2.0)
    for a in range(0, len(pivots), 1024):
        s = x @ pivots[a : a + 1024].T
        k = s.argmax(axis=1)
        top = s[np.arange(len(x)), k]
        p, best = np.where(top > best, k + a, p), np.maximum(top, best)
    angle = _angles(best)
    # the first band ends below T / 2, so that its residents are linked for certain
    return p, angle, np.where(angle <= bound / 2 - SLACK, 0, 1 + np.floor(angle / (bound / 2))).astype(np.int64)


def _chunk(keys, chunks: np.ndarray) -> np.ndarray:
    """A vector's chunk of its cell, from its key."""
    h = np.array([int.from_bytes(k[:6], "big") for k in keys], np.int64)
    return h % chunks


def _visits(x: np.ndarray, home: np.ndarray, own: np.ndarray, c: Cells, cosine: float):
    """(row, cell) pairs of vectors that go to a cell, and of those linked to all of a cell."""
    product = x @ c.pivots.T
    angle = _angles(product)[:, c.pivot]
    t = c.bound
    near = (angle <= c.high + t + SLACK) & (angle >= c.low - t - SLACK)
    apart = c.pivot[None, :] != c.pivot[home][:, None]
    near &= ~apart | (angle <= own[:, None] + 2 * t + SLACK)
    # both vectors are nearest to their own pivots, so they lie on the two sides of the bisector
    gap = np.sqrt(np.maximum(0, 2 - 2 * (c.pivots[c.pivot[home]] @ c.pivots.T)))[:, c.pivot]
    lead = product[np.arange(len(x)), c.pivot[home]][:, None] - product[:, c.pivot]
    near &= ~apart | (lead <= np.sqrt(2 - 2 * cosine) * gap + SLACK)
    near &= c.rank[home][:, None] < c.rank[None, :]
    all_ = near & (angle + c.high <= t - SLACK)
    return np.nonzero(near & ~all_), np.nonzero(all_)


def _parts(batches, dim: int):
    """Batches cut so that a piece's rows times ``dim`` stay small."""
    step = max(1, (1 << 19) // max(1, dim))
    for b in batches:
        for a in range(0, b.num_rows, step):
            yield b.slice(a, step)


def _dealt(distinct: DataFrame, share, number: str, cosine: float) -> tuple[DataFrame, DataFrame]:
    """Residents and visitors of all cells; and each vector's home, what bounds alone link, and what is added to whole cells."""
    def placed(b):
        c = share.value
        keys, x = b.column("key").to_pylist(), units(b.column("v").to_pylist(), c.pivots.shape[1], number)
        p, own, band = nearest(x, c.pivots, c.bound)
        home = np.array([c.place[q] for q in zip(p.tolist(), band.tolist())], np.int64)
        return c, keys, x, home, own, _chunk(keys, c.chunks[home])

    def travel(batches):
        for b in _parts(batches, max(len(share.value.n), share.value.pivots.shape[0])):
            c, keys, x, home, own, chunk = placed(b)
            yield _batch(len(keys), kind=RESIDENT, cell=home, chunk=chunk, key=keys, v=b.column("v"), w=b.column("w"))
            (row, cell), _ = _visits(x, home, own, c, cosine)
            # all chunks of the cells that are visited, and the later chunks of the own cell unless all its residents are linked anyway
            rows, cells, first = [row], [cell], [np.zeros(len(row), np.int64)]
            split = np.flatnonzero((c.chunks[home] > chunk + 1) & ~c.core()[home])
            rows.append(split), cells.append(home[split]), first.append(chunk[split] + 1)
            row, cell, first = np.concatenate(rows), np.concatenate(cells), np.concatenate(first)
            many = c.chunks[cell] - first
            at = np.repeat(np.arange(len(row)), many)
            to = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + first[at]
            for a in range(0, len(at), 8192):
                k = pa.array(row[at[a : a + 8192]])
                yield _batch(len(k), kind=VISITOR, cell=cell[at[a : a + 8192]], chunk=to[a : a + 8192], key=b.column("key").take(k), v=b.column("v").take(k), w=b.column("w").take(k))

    def bound(batches):
        spans: set = set()
        for b in _parts(batches, max(len(share.value.n), share.value.pivots.shape[0])):
            c, keys, x, home, own, _ = placed(b)
            w = b.column("w").to_numpy()
            _, (row, cell) = _visits(x, home, own, c, cosine)
            core = c.core()[home]
            n = np.bincount(row, c.w[cell], len(keys)).astype(np.int64) + np.where(core, c.w[home] - w, 0) + w - 1
            root: list = [c.rep[h] if k else None for h, k in zip(home.tolist(), core.tolist())]
            fresh = set()
            for r, k in zip(row.tolist(), cell.tolist()):
                root[r] = root[r] or c.rep[k]
                if root[r] != c.rep[k]:
                    fresh.add((root[r], c.rep[k]))
            yield _batch(len(keys), kind=HOME, cell=home, key=keys, w=w, n=n, root=root)
            fresh -= spans
            if fresh:
                spans |= fresh
                u, v = zip(*fresh)
                yield _batch(len(u), kind=SPAN, key=list(u), root=list(v), n=0)
            if len(cell):
                more = np.bincount(cell, w[row], len(c.n)).astype(np.int64)
                yield _batch(np.count_nonzero(more), kind=ADDED, cell=np.flatnonzero(more), n=more[more > 0])

    return distinct.mapInArrow(travel, ROW), distinct.mapInArrow(bound, ROW)


class _Chunk:
    """The residents of one chunk: compared with one another, then with visitors, batch by batch."""

    def __init__(self, keys: list, x: np.ndarray, w: np.ndarray, core: bool, cosine: float):
        self.keys, self.x, self.w, self.cosine = keys, x, w, cosine
        self.n, self.parent = np.zeros(len(keys), np.int64), np.arange(len(keys))
        if not core:
            for a in range(0, len(keys), 512):
                linked = x[a : a + 512] @ x.T >= cosine
                linked[np.arange(len(linked)), np.arange(a, a + len(linked))] = False
                self.n[a : a + 512] += linked @ w
                for k in np.flatnonzero(linked.any(axis=1)):
                    self._unite(np.append(np.flatnonzero(linked[k]), a + k))

    def _unite(self, of: np.ndarray) -> None:
        while (up := self.parent[of]).tobytes() != of.tobytes():
            of = up
        of = np.unique(of)
        self.parent[of] = of[0]

    def visit(self, keys: list, x: np.ndarray, w: np.ndarray):
        """Counts and a link of the visitors that have any."""
        out_keys, out_n, out_root = [], [], []
        for a in range(0, len(keys), 512):
            linked = x[a : a + 512] @ self.x.T >= self.cosine
            hit = np.flatnonzero(linked.any(axis=1))
            self.n += w[a : a + 512][hit] @ linked[hit]
            for k, n in zip(hit.tolist(), (linked[hit] @ self.w).tolist()):
                of = np.flatnonzero(linked[k])
                self._unite(of)
                out_keys.append(keys[a + k]), out_n.append(n), out_root.append(self.keys[of[0]])
        return _batch(len(out_keys), kind=SPAN, key=out_keys, n=out_n, root=out_root) if out_keys else None

    def close(self):
        """Counts of the residents that have any links, and links that span them."""
        while (self.parent[self.parent] != self.parent).any():
            self.parent = self.parent[self.parent]
        of = np.flatnonzero((self.n > 0) | (self.parent != np.arange(len(self.n))))
        return _batch(len(of), kind=SPAN, key=[self.keys[k] for k in of], n=self.n[of], root=[self.keys[self.parent[k]] for k in of]) if len(of) else None


def _joined(dealt: DataFrame, share, number: str, cosine: float) -> DataFrame:
    """Counts and spanning links found inside the cells."""
    def run(batches):
        c = share.value
        dim, core = c.pivots.shape[1], c.core()
        at, held, chunk = None, [], None

        def settle():
            keys = [k for part in held for k in part[0]]
            return _Chunk(keys, np.concatenate([part[1] for part in held]), np.concatenate([part[2] for part in held]), bool(core[at[0]]), cosine) if held else None

        for b in batches:
            kind, cell, part = (b.column(x).to_numpy() for x in ("kind", "cell", "chunk"))
            edges = np.flatnonzero(np.concatenate([[True], (cell[1:] != cell[:-1]) | (part[1:] != part[:-1]) | (kind[1:] != kind[:-1])])) if len(cell) else []
            for a, z in zip(edges, [*edges[1:], len(cell)]):
                if at != (cell[a], part[a]):
                    chunk = chunk or settle()
                    if chunk and (found := chunk.close()):
                        yield found
                    at, held, chunk = (cell[a], part[a]), [], None
                piece = b.slice(a, z - a)
                keys, w = piece.column("key").to_pylist(), piece.column("w").to_numpy()
                x = units(piece.column("v").to_pylist(), dim, number)
                if kind[a] == RESIDENT:
                    held.append((keys, x, w))
                    continue
                if chunk is None:
                    chunk, held = settle(), []
                if chunk and (found := chunk.visit(keys, x, w)):
                    yield found
        chunk = chunk or settle()
        if chunk and (found := chunk.close()):
            yield found

    by_cell = dealt.repartition("cell", "chunk").sortWithinPartitions("cell", "chunk", "kind")
    return by_cell.mapInArrow(run, ROW)


def links(rows: DataFrame, cosine: float = COSINE, cell: int = CELL, pivots: int = MOST_PIVOTS, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """vec_id, n_links (other rows at ``cosine`` or more), component_id (the smallest vec_id reachable) and kept, a row for each row."""
    if not 0 < cosine < 1:
        raise ValueError("the cosine must lie between 0 and 1")
    spark = rows.sparkSession
    number = "float32" if isinstance(rows.schema[embedding].dataType.elementType, T.FloatType) else "float64"
    own = keyed(rows, vec_id, embedding)
    distinct = stored(own.filter("key IS NOT NULL").groupBy("key").agg(F.first("v").alias("v"), F.count("*").alias("w"), F.min("vec_id").alias("least")), "metric-vectors")
    size = distinct.agg(F.count("*").alias("n"), F.max(F.octet_length("v")).alias("bytes")).first()
    if not size["n"]:
        found = own.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
        return found.withColumn("kept", F.lit(True))
    dim, bound = size["bytes"] // np.dtype(number).itemsize, float(np.arccos(cosine))
    # a bounded number of vectors, those of lowest digest: the same in every run, spread as the vectors are
    most = max(1, min(pivots, PIVOT_BYTES // (8 * dim), -(-size["n"] // cell)))
    chosen = distinct.orderBy("key").limit(most).select("v").collect()
    centres = units([r["v"] for r in chosen], dim, number)
    share = spark.sparkContext.broadcast(centres)

    def place(batches):
        for b in _parts(batches, len(share.value)):
            p, angle, band = nearest(units(b.column("v").to_pylist(), dim, number), share.value, bound)
            yield pa.RecordBatch.from_arrays([pa.array(p, pa.int32()), pa.array(band, pa.int32()), pa.array(angle), b.column("w"), b.column("key")], names=["pivot", "band", "angle", "w", "key"])

    # at most one row for each pivot and band
    stats = distinct.mapInArrow(place, "pivot int, band int, angle double, w bigint, key binary").groupBy("pivot", "band").agg(
        F.count("*").alias("n"), F.sum("w").alias("w"), F.min("angle").alias("low"), F.max("angle").alias("high"), F.min("key").alias("rep")).collect()
    cells = spark.sparkContext.broadcast(Cells(centres, bound, stats, cell))
    dealt, bounded = _dealt(distinct.select("key", "v", "w"), cells, number, cosine)
    bounded = stored(bounded, "metric-bounds")
    met = stored(_joined(dealt, cells, number, cosine).select("key", "n", "root"), "metric-links")

    added = bounded.filter(F.col("kind") == ADDED).groupBy("cell").agg(F.sum("n").alias("more"))
    rep = spark.createDataFrame([(k, bytearray(r)) for k, r in enumerate(cells.value.rep)], "cell int, rep binary")
    added = F.broadcast(added.join(rep, "cell"))  # at most one row a cell
    home = bounded.filter(F.col("kind") == HOME).join(added, "cell", "left").select("key", (F.col("n") + F.coalesce("more", F.lit(0))).alias("n"), "root", "rep")
    counts = home.select("key", "n").unionByName(met.select("key", "n")).groupBy("key").agg(F.sum("n").alias("n"))
    spans = [home.select("key", "root"), home.select("key", F.col("rep").alias("root")), met.select("key", "root"), bounded.filter(F.col("kind") == SPAN).select("key", "root")]
    edges = spans[0].unionByName(spans[1]).unionByName(spans[2]).unionByName(spans[3]).filter("root IS NOT NULL AND root <> key")
    roots = components(edges.select(F.col("key").alias("u"), F.col("root").alias("v")))

    known = distinct.select("key", "least").join(counts, "key").join(roots.withColumnRenamed("u", "key"), "key", "left").withColumn("root", F.coalesce("root", "key"))
    least = known.groupBy("root").agg(F.min("least").alias("component"))
    known = known.join(least, "root").select("key", "n", "component")
    out = own.select("vec_id", "key").join(known, "key", "left")
    out = out.select("vec_id", F.coalesce("n", F.lit(0)).alias("n_links"), F.when(F.col("key").isNull(), F.col("vec_id")).otherwise(F.col("component")).alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
