"""Quality classifier: a generalised additive model with pairwise interactions.

Every feature has a lookup table over its quantile bins. Training boosts in cycles: each round visits every
feature, fits a shallow tree (up to four leaves) over its bins to the log-loss gradients and adds a fraction of it to
the table. Then the pairs that reduce the remaining loss most get tables over coarse bin pairs, boosted
in the same way with trees of one cut on each axis. A score is the logistic of the sum of the looked-up bins.

Features come from the text alone. Defined cases: null and empty text have all features 0 and a score like any other;
rows without a label teach nothing; repeated rows teach as often as they occur; if the sample lacks a class every score is its base rate (0.5 for an
empty one).
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftwood.llm.annotate import annotate
from driftwood.llm.text import buffer, byte_table, rolling, span, sums, words

#: rows that teach the model, at most about so many (the bound of the labelled sample)
SAMPLE = 20_000
BINS, COARSE, ROUNDS, PAIRS, PAIR_ROUNDS, RATE = 32, 8, 60, 8, 30, 0.15
#: rows a leaf has at least, and the weight added to its curvature
LEAF, RIDGE = 10, 1.0

FEATURES = ("log_words", "log_bytes", "word_bytes", "upper", "digit", "symbol", "mark", "end_mark", "non_ascii", "lines", "distinct_words", "repeated_windows",
            "repeated_lines", "symbol_words", "upper_words", "long_words", "one_byte_words", "line_words")
_TABLE = byte_table(5)


def _class(chars: bytes) -> np.ndarray:
    t = np.zeros(256, bool)
    t[list(chars)] = True
    return t


_UPPER, _DIGIT = _class(bytes(range(65, 91))), _class(bytes(range(48, 58)))
_SYMBOL, _MARK, _END = _class(b"#*$%&|<>{}[]=_~^@\\"), _class(b"!?"), _class(b".,;:")
_OTHER = _class(bytes(range(128, 256)))


def _per_row(flag: np.ndarray, offs: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(flag)])[offs])


def _repeats(keys: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    """For each row how many of its keys equal an earlier one of the row."""
    order = np.lexsort((keys, row))
    k, r = keys[order], row[order]
    same = (k[1:] == k[:-1]) & (r[1:] == r[:-1])
    return np.bincount(r[1:][same], minlength=n).astype(float)


def features(buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """A row of FEATURES for each text."""
    n = len(offs) - 1
    size = np.diff(offs).astype(float)
    start, end, rows = words(buf, offs)
    count = np.diff(rows).astype(float)
    row = np.repeat(np.arange(n), np.diff(rows))
    length = end - start
    h = span(sums(_TABLE[buf]), start, end) if len(start) else np.empty(0, np.uint64)

    def mean(flag):
        return np.bincount(row[flag], minlength=n) / np.maximum(count, 1)

    def share(table):
        return _per_row(table[buf], offs) / np.maximum(size, 1)

    prefix = np.concatenate([[0], np.cumsum(_SYMBOL[buf])])
    symbols = prefix[end] - prefix[start]
    prefix = np.concatenate([[0], np.cumsum(_UPPER[buf])])
    uppers = prefix[end] - prefix[start]
    five = rolling(sums(h), 5)
    inside = row[4:] == row[: len(five)] if len(five) else np.empty(0, bool)
    windows = np.maximum(count - 4, 1)
    # lines: stretches between line ends that hold a word
    broken = np.flatnonzero(buf == 10)
    cuts = np.unique(np.concatenate([offs[:-1], broken + 1]))
    cuts = cuts[cuts < len(buf)]
    at = np.searchsorted(cuts, start, "right") - 1
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]])) if len(at) else np.empty(0, np.int64)
    last = np.concatenate([first[1:], [len(at)]]) if len(at) else first
    line_hash = span(sums(h), first, last) if len(first) else np.empty(0, np.uint64)
    line_row = row[first] if len(first) else np.empty(0, np.int64)
    n_lines = np.bincount(line_row, minlength=n).astype(float)
    return np.column_stack([
        np.log1p(count), np.log1p(size), np.bincount(row, length, minlength=n) / np.maximum(count, 1),
        share(_UPPER), share(_DIGIT), share(_SYMBOL), share(_MARK), share(_END), share(_OTHER), n_lines / np.maximum(count, 1),
        1 - _repeats(h, row, n) / np.maximum(count, 1), _repeats(five[inside], row[: len(five)][inside], n) / windows, _repeats(line_hash, line_row, n) / np.maximum(n_lines, 1),
        mean(symbols > 0), mean((uppers == length - symbols) & (uppers > 1) | (uppers > 2)), mean(length > 14), mean(length == 1), count / np.maximum(n_lines, 1),
    ])


@dataclass
class Model:
    base: float = 0.0
    edges: list = field(default_factory=list)      # of each feature's bins
    coarse: list = field(default_factory=list)     # of each feature's coarse bins
    tables: list = field(default_factory=list)     # of each feature
    pairs: dict = field(default_factory=dict)      # (feature, feature) -> table over coarse bins

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for k, (edge, table) in enumerate(zip(self.edges, self.tables)):
            total += table[np.searchsorted(edge, x[:, k], "right")]
        for (a, b), table in self.pairs.items():
            total += table[np.searchsorted(self.coarse[a], x[:, a], "right"), np.searchsorted(self.coarse[b], x[:, b], "right")]
        return 1 / (1 + np.exp(-np.clip(total, -40, 40)))


def _cut(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> tuple[float, int]:
    """Gain of the best cut of a stretch of bins, and the bin it stands before."""
    if len(g) < 2:
        return 0.0, 0
    gl, hl, nl = np.cumsum(g)[:-1], np.cumsum(h)[:-1], np.cumsum(n)[:-1]
    gr, hr, nr = g.sum() - gl, h.sum() - hl, n.sum() - nl
    gain = gl**2 / (hl + RIDGE) + gr**2 / (hr + RIDGE) - g.sum() ** 2 / (h.sum() + RIDGE)
    gain = np.where((nl >= LEAF) & (nr >= LEAF), gain, 0)
    k = int(np.argmax(gain))
    return float(gain[k]), k + 1


def _tree(g: np.ndarray, h: np.ndarray, n: np.ndarray, depth: int = 2) -> np.ndarray:
    """The step of every bin: a tree of cuts, each leaf's Newton step."""
    gain, at = _cut(g, h, n) if depth else (0.0, 0)
    if gain <= 1e-9:
        return np.full(len(g), -g.sum() / (h.sum() + RIDGE))
    return np.concatenate([_tree(g[:at], h[:at], n[:at], depth - 1), _tree(g[at:], h[at:], n[at:], depth - 1)])


def _quadrants(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> tuple[float, np.ndarray]:
    """The best tree of one cut on each axis over a table of bins: its gain and every cell's step."""
    def corner(x):
        return np.pad(np.cumsum(np.cumsum(x, 0), 1), ((1, 0), (1, 0)))

    cg, ch, cn = corner(g), corner(h), corner(n)
    i, j = np.arange(1, g.shape[0])[:, None], np.arange(1, g.shape[1])[None, :]

    def parts(c):
        a, top, left, whole = c[i, j], c[i, -1], c[-1, j], c[-1, -1]
        return a, top - a, left - a, whole - top - left + a

    gs, hs, ns = parts(cg), parts(ch), parts(cn)
    gain = sum(x**2 / (y + RIDGE) for x, y in zip(gs, hs)) - cg[-1, -1] ** 2 / (ch[-1, -1] + RIDGE)
    gain = np.where(sum((z > 0) & (z < LEAF) for z in ns) == 0, gain, 0)
    if not gain.size:
        return 0.0, np.zeros_like(g)
    a, b = np.unravel_index(int(np.argmax(gain)), gain.shape)
    step = [-x[a, b] / (y[a, b] + RIDGE) for x, y in zip(gs, hs)]
    out = np.empty_like(g)
    out[: a + 1, : b + 1], out[: a + 1, b + 1 :], out[a + 1 :, : b + 1], out[a + 1 :, b + 1 :] = step
    return float(gain[a, b]), out


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """Trains on a sample of feature rows and labels (0 or 1)."""
    m = Model()
    if not len(y):
        return m
    rate = min(max(y.mean(), 1e-3), 1 - 1e-3)
    m.base = float(np.log(rate / (1 - rate)))
    if y.min() == y.max():
        return m
    k = x.shape[1]
    quantile = lambda v, n: np.unique(np.quantile(v, np.arange(1, n) / n, method="lower"))
    m.edges, m.coarse = [quantile(x[:, i], BINS) for i in range(k)], [quantile(x[:, i], COARSE) for i in range(k)]
    fine = [np.searchsorted(e, x[:, i], "right") for i, e in enumerate(m.edges)]
    wide = [np.searchsorted(e, x[:, i], "right") for i, e in enumerate(m.coarse)]
    m.tables = [np.zeros(len(e) + 1) for e in m.edges]
    total = np.full(len(y), m.base)

    def slopes():
        p = 1 / (1 + np.exp(-np.clip(total, -40, 40)))
        return p - y, p * (1 - p)

    def cells(i, j):
        shape = (len(m.coarse[i]) + 1, len(m.coarse[j]) + 1)
        return wide[i] * shape[1] + wide[j], shape

    for _ in range(ROUNDS):
        for i in range(k):
            g, h = slopes()
            n = len(m.tables[i])
            step = RATE * _tree(np.bincount(fine[i], g, n), np.bincount(fine[i], h, n), np.bincount(fine[i], minlength=n))
            m.tables[i] += step
            total += step[fine[i]]
    g, h = slopes()
    gains = []
    for i in range(k):
        for j in range(i):
            c, shape = cells(j, i)
            size = shape[0] * shape[1]
            gains.append((-_quadrants(*(np.bincount(c, v, size).reshape(shape) for v in (g, h)), np.bincount(c, minlength=size).reshape(shape))[0], j, i))
    m.pairs = {(j, i): np.zeros(cells(j, i)[1]) for gain, j, i in sorted(gains)[:PAIRS] if gain < 0}
    for _ in range(PAIR_ROUNDS):
        for (i, j), table in m.pairs.items():
            g, h = slopes()
            c, shape = cells(i, j)
            size = shape[0] * shape[1]
            _, step = _quadrants(np.bincount(c, g, size).reshape(shape), np.bincount(c, h, size).reshape(shape), np.bincount(c, minlength=size).reshape(shape))
            table += RATE * step
            total += RATE * step.reshape(-1)[c]
    return m


def _features(piece: pa.RecordBatch, text: str) -> pa.Array:
    x = features(*buffer(piece.column(text)))
    return pa.StructArray.from_arrays([pa.FixedSizeListArray.from_arrays(pa.array(x.reshape(-1)), x.shape[1]).cast(pa.list_(pa.float64()))], ["x"])


def sampled(docs: DataFrame, labels: DataFrame, key: str = "doc_id", sample: int = SAMPLE) -> DataFrame:
    """``docs`` joined with ``labels`` (key, label); of more than ``sample`` labels, those whose key hash falls in a share that
    leaves about ``sample``. A column ``label`` of ``docs`` is ignored. Both sides are thinned before the join, so it moves a bounded number of labelled texts and their share of others."""
    known = labels.filter(F.col("label").isNotNull())
    share = min(1.0, sample / max(1, known.count()))
    thin = F.pmod(F.xxhash64(F.lit("sample"), key), F.lit(1 << 20)) < share * (1 << 20)
    return docs.drop("label").filter(thin).join(known.filter(thin).hint("merge"), key)


def train(labelled: DataFrame, label: str = "label", text: str = "text") -> Model:
    """A model learned from rows with text and a 0/1 label (see ``sampled``). Only their features and labels reach the driver."""
    rows = labelled.filter(F.col(label).isNotNull()).select(F.col(text).alias("text"), F.col(label).cast("int").alias("label"))
    got = annotate(rows, "f", "x array<double>", lambda: lambda piece: _features(piece, "text")).select("label", "f.x").toPandas()
    if got.empty:
        return Model()
    x, y = np.array(got["x"].tolist(), float), got["label"].to_numpy(float)
    order = np.lexsort((*x.T, y))
    return fit(x[order], y[order])


def predict(docs: DataFrame, model: Model, out: str = "quality", text: str = "text") -> DataFrame:
    """``docs`` with a struct ``out`` holding the score."""
    given = docs.sparkSession.sparkContext.broadcast(model)

    def score(piece):
        return pa.StructArray.from_arrays([pa.array(given.value.score(features(*buffer(piece.column(text)))))], ["score"])

    return annotate(docs, out, "score double", lambda: score, text)
