"""Language identification by rank-order n-gram profiles.

A profile lists the ``top`` most frequent character n-grams (1 to 3 code points of lower-cased text;
every stretch of non-letters is one blank) in order of frequency, ties by code point. A document's
profile is compared to each language's by out-of-place distance: the sum over the document's
n-grams of how far their ranks differ, ``top`` for one that the language's profile lacks. The nearest language
wins (ties: the first by name); score = 1 - distance / largest possible distance.

Defined cases: null text, or text without a letter, is ``und`` with score 0, as is everything when nothing
was learned; rows without a language teach nothing; repeated rows teach as often as they occur.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from driftwood.llm.annotate import annotate
from driftwood.llm.text import lean, slices

TOP = 300
#: documents that teach a language, at most about so many (the bound of the labelled sample)
SAMPLE = 4000
#: text bytes counted at once: an n-gram takes some 30 times its bytes while it is sorted
SLICE = 256 << 10
UNKNOWN = "und"
BLANK = 1
_BITS = 21


def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


class Counter:
    """Distinct n-grams of the rows of a piece, with counts."""

    def __init__(self) -> None:
        self.letter = _letters()

    def __call__(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, n-gram, count), sorted by row and n-gram; an n-gram is its code points, 21 bits each."""
        if len(texts) > 4096:  # row numbers and n-grams share 63 bits
            a, b = self(texts[:4096]), self(texts[4096:])
            return np.concatenate([a[0], b[0] + 4096]), np.concatenate([a[1], b[1]]), np.concatenate([a[2], b[2]])
        low = [(t or "").lower() for t in texts]
        # a blank before and after each text; blanks in a row become one
        c = np.frombuffer(("\x01" + "\x01".join(low) + "\x01").encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        edge = np.cumsum([0, *(len(t) + 1 for t in low)])
        is_edge = np.zeros(len(c), bool)
        is_edge[edge] = True
        letter = self.letter[c]
        c[~letter] = BLANK
        keep = letter.copy()
        keep[1:] |= letter[:-1] | is_edge[1:]
        keep[0] = True
        row = np.cumsum(is_edge) - 1
        c, row, letter, is_edge = c[keep], row[keep], letter[keep], is_edge[keep]
        # small numbers for the code points at hand, so that row and n-gram fit one sort key
        points, small = np.unique(c, return_inverse=True)
        bits = max(1, int(len(points)).bit_length())
        small = small.astype(np.int64) + 1
        nxt = letter[1:] | letter[:-1]
        uni = np.flatnonzero(letter)
        # a pair belongs to the row of its first character, or of its second if it begins with the blank at the row's edge
        two = np.flatnonzero(nxt)
        tri = np.flatnonzero(letter[1:-1])
        keys = [(row[uni] << 3 * bits) | small[uni],
                (np.where(letter[two], row[two], row[two + 1]) << 3 * bits) | (small[two] << bits) | small[two + 1],
                (row[tri + 1] << 3 * bits) | (small[tri] << 2 * bits) | (small[tri + 1] << bits) | small[tri + 2]]
        k = np.sort(np.concatenate(keys))
        if not len(k):
            return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
        new = np.concatenate([[True], k[1:] != k[:-1]])
        at = np.flatnonzero(new)
        count = np.diff(np.concatenate([at, [len(k)]]))
        k = k[at]
        back = np.concatenate([[0], points])
        mask = (1 << bits) - 1
        gram = (back[(k >> 2 * bits) & mask] << 2 * _BITS) | (back[(k >> bits) & mask] << _BITS) | back[k & mask]
        return k >> 3 * bits, gram, count


def ranked(row: np.ndarray, gram: np.ndarray, count: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, n-gram, rank from 0) of each row's ``top`` most frequent n-grams."""
    order = np.lexsort((gram, -count, row))
    row, gram = row[order], gram[order]
    first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]])) if len(row) else np.empty(0, np.int64)
    rank = np.arange(len(row)) - np.repeat(first, np.diff(np.concatenate([first, [len(row)]])))
    keep = rank < top
    return row[keep], gram[keep], rank[keep]


def sampled(docs: DataFrame, sample: int = SAMPLE, text: str = "text", lang: str = "lang", key: str = "doc_id") -> DataFrame | None:
    """lang and text of the rows that teach: those with a language; of a language with more than ``sample`` rows, those whose
    hash of key and text falls in a share that leaves about ``sample``, and in any case the row of least hash (of those with a letter, if any).

    So copies of a text under other keys are sampled one by one; rows that repeat key and text are in or out together. None if no row has a language.
    """
    known = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"), F.xxhash64(key, text).alias("h"))
    sizes = known.groupBy("lang").agg(F.count("*").alias("n"), F.min(F.struct(~F.col("text").rlike(r"\p{L}"), "h"))["h"].alias("least")).collect()
    if not sizes:
        return None
    # a share and a hash for each language: as many numbers as there are languages, so a filter and no join
    of = lambda x: F.element_at(F.create_map(*[F.lit(v) for r in sorted(sizes) for v in (r["lang"], x(r))]), F.col("lang"))
    share, least = of(lambda r: min(1.0, sample / r["n"])), of(lambda r: r["least"])
    return known.filter((F.pmod("h", F.lit(1 << 20)) < share * (1 << 20)) | (F.col("h") == least)).select("lang", "text")


def profiles(docs: DataFrame, top: int = TOP, sample: int = SAMPLE, text: str = "text", lang: str = "lang", key: str = "doc_id") -> dict[str, np.ndarray]:
    """The learned profile (n-grams in rank order) of every language of ``docs``.

    Learns from the rows of ``sampled``. What reaches the driver is ``top`` n-grams a language.
    """
    taught = sampled(docs, sample, text, lang, key)
    if taught is None:
        return {}

    def count(batches):
        counter = Counter()
        for piece in slices(batches, "text", SLICE):
            langs = piece.column("lang").to_pylist()
            names = sorted(set(langs))
            which = np.array([names.index(x) for x in langs], np.int64)
            row, gram, n = counter(piece.column("text").to_pylist())
            row = which[row]
            order = np.lexsort((gram, row))
            row, gram, n = row[order], gram[order], n[order]
            new = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (gram[1:] != gram[:-1])])) if len(row) else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([names[i] for i in row[new]], pa.string()), pa.array(gram[new], pa.int64()),
                                              pa.array(np.add.reduceat(n, new) if len(new) else n, pa.int64())], names=["lang", "gram", "n"])

    counts = taught.mapInArrow(lean(count), "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    best = counts.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(F.desc("n"), "gram"))).filter(F.col("rank") <= top)
    learned: dict[str, list] = {}
    for r in best.orderBy("lang", "rank").collect():
        learned.setdefault(r["lang"], []).append(r["gram"])
    return {k: np.array(v, np.int64) for k, v in learned.items()}


class Predictor:
    def __init__(self, learned: dict[str, np.ndarray], top: int) -> None:
        self.names, self.top, self.counter = sorted(learned), top, Counter()
        grams = np.unique(np.concatenate([np.empty(0, np.int64), *learned.values()]))
        # rank of every known n-gram in every language, -1 where the profile lacks it; the last row is for unknown ones
        self.grams, self.rank = grams, np.full((len(grams) + 1, len(self.names)), -1, np.int64)
        for k, name in enumerate(self.names):
            self.rank[np.searchsorted(grams, learned[name]), k] = np.arange(len(learned[name]))

    def __call__(self, piece: pa.RecordBatch, text: str) -> pa.Array:
        n = piece.num_rows
        row, gram, rank = ranked(*self.counter(piece.column(text).to_pylist()), self.top)
        names, score = np.full(n, UNKNOWN, object), np.zeros(n)
        if len(row) and self.names:
            at = np.minimum(np.searchsorted(self.grams, gram), max(0, len(self.grams) - 1))
            at = np.where(self.grams[at] == gram, at, len(self.grams))
            theirs = self.rank[at]
            out = np.where(theirs < 0, self.top, np.abs(theirs - rank[:, None]))
            first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
            total = np.add.reduceat(out, first, axis=0)
            size = np.diff(np.concatenate([first, [len(row)]]))
            best = np.argmin(total, axis=1)
            names[row[first]] = np.array(self.names, object)[best]
            score[row[first]] = 1 - total[np.arange(len(first)), best] / (size * self.top)
        return pa.StructArray.from_arrays([pa.array(names.tolist(), pa.string()), pa.array(score)], ["lang", "score"])


def predict(docs: DataFrame, learned: dict[str, np.ndarray], top: int = TOP, out: str = "language", text: str = "text") -> DataFrame:
    """``docs`` with a struct ``out``: lang and score."""
    given = docs.sparkSession.sparkContext.broadcast(learned)

    def make():
        f = Predictor(given.value, top)
        return lambda piece: f(piece, text)

    return annotate(docs, out, "lang string, score double", make, text, SLICE)


def held_out(doc_id: Column) -> Column:
    """The third of the rows that no model learns from: crc32 of the id as text, modulo 3, is 1 (a null id is held out)."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(True))
