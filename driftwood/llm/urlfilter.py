"""URL filters: a blocked Bloom filter of listed canonical URLs passes possible hits to an exact hash join.

A listed URL is a host and a path; its canonical form is the two joined (``net/``,
``example.net/en/``). It fits its host and all subdomains, if the page's path starts with
its path. So a page asks for every suffix of its host at a dot with every prefix of its path
that has the length of some listed path. The filter drops nearly all of these; what passes
is joined by the exact string, which removes false positives. The longest listed URL wins
(then the longer host, then the greater string).

Defined cases: null URLs and those without ``://`` have an empty host and path; listed rows
that repeat count once, and a host and path listed with both verdicts is blocked; listed
nulls are ignored; with nothing listed every page gets the default verdict.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftwood.llm.store import power_of_two

#: longs of a block (512 bits), bits set for each URL, bits wished for each URL
BLOCK, PROBES, BITS_EACH = 8, 6, 12
#: proven bound of the broadcast filter: 2**20 longs are 8 MB. Beyond about 5.5 million URLs the filter
#: passes more pages than it need, which the join then removes
MOST_LONGS = 1 << 20

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty without ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    raw = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(raw) + 1), r"^[^?#]*", 0)
    return F.coalesce(F.translate(raw, UPPER, LOWER), F.lit("")), F.coalesce(path, F.lit(""))


def _places(block: np.ndarray, bits: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(index of a long, its bit) of each probe; all probes of a key lie in one block."""
    at = [(bits >> np.uint64(9 * k)) & np.uint64(511) for k in range(PROBES)]
    return [((block * BLOCK + (x >> np.uint64(6)).astype(np.int64)), np.uint64(1) << (x & np.uint64(63))) for x in at]


def _hashed(df: DataFrame, blocks: int) -> DataFrame:
    return df.withColumns({"block": F.pmod(F.xxhash64("key"), F.lit(blocks)), "bits": F.xxhash64(F.lit("bits"), "key")})


def bloom(listed: DataFrame, n: int) -> np.ndarray:
    """The filter of the column ``key`` of ``listed``: rows of blocks. Tasks make parts of it, which are or-ed by block."""
    blocks = min(MOST_LONGS, max(BLOCK, power_of_two(n * BITS_EACH / 64))) // BLOCK
    longs = [f"w{k}" for k in range(BLOCK)]

    def part(batches):
        for b in batches:
            block = b.column("block").to_numpy()
            own, at = np.unique(block, return_inverse=True)
            table = np.zeros(len(own) * BLOCK, np.uint64)
            for word, bit in _places(at.astype(np.int64), b.column("bits").to_numpy().view(np.uint64)):
                np.bitwise_or.at(table, word, bit)
            table = table.view(np.int64).reshape(-1, BLOCK)
            yield pa.RecordBatch.from_arrays([pa.array(own), *(pa.array(table[:, k].copy()) for k in range(BLOCK))], names=["block", *longs])

    parts = _hashed(listed.select("key"), blocks).select("block", "bits").mapInArrow(part, "block bigint, " + ", ".join(f"{w} bigint" for w in longs))
    out = np.zeros((blocks, BLOCK), np.int64)
    for r in parts.groupBy("block").agg(*[F.bit_or(w).alias(w) for w in longs]).collect():  # at most ``blocks`` rows
        out[r["block"]] = r[1:]
    return out.view(np.uint64)


def passing(asked: DataFrame, table: np.ndarray) -> DataFrame:
    """The rows of ``asked`` whose column ``key`` the filter lets pass."""
    given, names = asked.sparkSession.sparkContext.broadcast(table), asked.columns

    def test(batches):
        flat = given.value.reshape(-1)
        for b in batches:
            ok = np.ones(b.num_rows, bool)
            for word, bit in _places(b.column("block").to_numpy(), b.column("bits").to_numpy().view(np.uint64)):
                ok &= (flat[word] & bit) != 0
            yield b.filter(pa.array(ok)).select(names)

    return _hashed(asked, len(table)).mapInArrow(test, asked.schema)


def judge(pages: DataFrame, listed: DataFrame, default: str = "allow", url: str = "url") -> DataFrame:
    """``pages`` with host, path, rule (the listed URL that won, else null) and verdict.

    ``listed``: host, path, verdict. Columns of ``pages`` with these four names are replaced.
    """
    rules = (listed.filter("host IS NOT NULL AND path IS NOT NULL AND verdict IS NOT NULL")
             .groupBy("host", "path").agg(F.max("verdict").alias("verdict"))  # 'block' after 'allow'
             .select(F.concat("host", "path").alias("key"), F.length("host").alias("host_length"), "verdict", F.length("path").alias("n")))
    about = rules.agg(F.count("*").alias("rows"), F.array_sort(F.collect_set("n")).alias("lengths")).first()
    host, path = host_and_path(F.col(url))
    u = pages.drop("host", "path", "rule", "verdict").withColumns({"host": host, "path": path})
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))
    prefixes = F.transform(F.filter(F.array(*[F.lit(x) for x in about["lengths"]]) if about["lengths"] else F.array().cast("array<int>"), lambda n: n <= F.length("path")),
                           lambda n: F.substr(F.col("path"), F.lit(1), n))
    keys = F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(s, p))))
    asked = u.select("host", "path").distinct().select("host", "path", F.explode(keys).alias("key"))
    passed = passing(asked, bloom(rules, about["rows"]))
    won = (passed.join(rules, "key")
           .groupBy("host", "path").agg(F.max(F.struct(F.length("key").alias("l"), "host_length", "key", "verdict")).alias("w"))
           .select("host", "path", F.col("w.key").alias("rule"), F.col("w.verdict").alias("verdict")))
    return u.join(won, ["host", "path"], "left").withColumn("verdict", F.coalesce("verdict", F.lit(default)))
