"""Quality rules by DataFrame functions: base rules, then a log-likelihood ratio of hashed n-grams.

A document's n-grams are hashed to ``buckets`` numbers. Two multinomials over the buckets are
counted: one from a trusted target, one from the whole raw corpus. A document's score is the sum of
log(target / raw) over its n-grams, divided by their number; it is kept if the score reaches the
threshold. No step draws at random.

Defined cases: null or empty text has no words, fails the base rules and has score 0; repeated
rows count each; without target documents every ratio is 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"
BUCKETS = 1 << 14
#: pseudo count added to every bucket of both multinomials
SMOOTH = 1.0
THRESHOLD = -0.1


def base_rules(docs: DataFrame, text: str = "text", window: int = 5) -> DataFrame:
    """Adds words (array), n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    t = F.coalesce(F.col(text), F.lit(""))
    d = docs.withColumn("words", F.regexp_extract_all(t, F.lit(WORD), F.lit(0)))
    lines = F.filter(F.split(t, "\n"), lambda x: F.rlike(x, F.lit(r"[^\x20\x09-\x0D]")))
    d = d.withColumns({
        "n_words": F.size("words").cast("long"),
        "word_chars": F.length(F.array_join("words", "")).cast("long"),
        "n_symbols": F.regexp_count(t, F.lit(SYMBOL)).cast("long"),
        "__lines": lines,
    })
    d = d.withColumn("n_dup_lines", (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long")).drop("__lines")
    # equal windows have equal hashes: a text whose window hashes all differ repeats none, and its windows are never built
    starts = F.when(F.col("n_words") >= window, F.sequence(F.lit(1), (F.col("n_words") - window + 1).cast("int"))).otherwise(F.array().cast("array<int>"))
    d = d.withColumn("__h", F.transform("words", lambda x: F.xxhash64(x)))
    d = d.withColumn("__h", F.transform(starts, lambda i: F.xxhash64(*[F.get("__h", i + k - 1) for k in range(window)])))
    d = d.withColumn("__again", F.size(F.array_distinct("__h")) < F.size("__h")).drop("__h")
    # windows sorted with their places: equal neighbours are found twice or more
    at = F.when(F.col("__again"), F.sequence(F.lit(1), (F.col("n_words") - window + 1).cast("int"))).otherwise(F.array().cast("array<int>"))
    d = d.withColumn("__w", F.transform(at, lambda i: F.struct(F.array_join(F.slice("words", i, window), " ").alias("w"), i.alias("i"))))
    d = d.withColumn("__s", F.sort_array("__w")).drop("__w")
    twice = F.filter("__s", lambda x, k: F.coalesce(F.get("__s", k - 1)["w"] == x["w"], F.lit(False)) | F.coalesce(F.get("__s", k + 1)["w"] == x["w"], F.lit(False)))
    d = d.withColumn("__d", F.transform(twice, lambda x: x["i"])).drop("__s").withColumn("__d", F.sort_array("__d"))
    covered = F.aggregate(F.transform("__d", lambda x, k: F.least(F.lit(window), F.coalesce(F.get("__d", k + 1) - x, F.lit(window)))), F.lit(0), lambda a, x: a + x)
    return (d.withColumn("n_repeat_words", covered.cast("long")).drop("__d", "__again")
            .withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))))


def grams(words: str = "words", buckets: int = BUCKETS) -> Column:
    """Bucket numbers (1 to ``buckets``) of a document's words and word pairs."""
    w = F.col(words)
    one = F.transform(w, lambda x: F.pmod(F.xxhash64(x), F.lit(buckets)).cast("int") + 1)
    at = F.when(F.size(w) > 1, F.sequence(F.lit(1), F.size(w) - 1)).otherwise(F.array().cast("array<int>"))
    two = F.transform(at, lambda i: F.pmod(F.xxhash64(F.element_at(w, i), F.element_at(w, i + 1)), F.lit(buckets)).cast("int") + 1)
    return F.concat(one, two)


def weights(docs: DataFrame, is_target: Column, text: str = "text", buckets: int = BUCKETS, smooth: float = SMOOTH) -> DataFrame:
    """One row with ``w``: log(target / raw) for every bucket, counted over all of ``docs``.

    Counts are summed in each task before the shuffle, so that moves ``buckets`` rows a task; the
    result has ``buckets`` numbers whatever the corpus.
    """
    d = docs.select(F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(WORD), F.lit(0)).alias("words"), is_target.cast("int").alias("t"))
    c = (d.select("t", F.explode(grams("words", buckets)).alias("b")).groupBy("b")
         .agg(F.count("*").alias("raw"), F.sum("t").alias("target")))
    every = docs.sparkSession.range(1, buckets + 1).select(F.col("id").cast("int").alias("b"))
    c = every.join(c, "b", "left").select("b", (F.coalesce("raw", F.lit(0)) + smooth).alias("raw"), (F.coalesce("target", F.lit(0)) + smooth).alias("target"))
    all_ = c.agg(F.sort_array(F.collect_list(F.struct("b", "raw", "target"))).alias("a"), F.sum("raw").alias("r"), F.sum("target").alias("t"))
    return all_.select(F.transform("a", lambda x: F.when(F.col("t") > buckets * smooth, F.log(x["target"] / F.col("t")) - F.log(x["raw"] / F.col("r"))).otherwise(0.0)).alias("w"))


def score(docs: DataFrame, weight: DataFrame, words: str = "words", buckets: int = BUCKETS) -> DataFrame:
    """``docs`` (with ``words``) and ``ratio``: the mean log ratio of a document's n-grams."""
    # a constant of ``buckets`` numbers, folded once
    w = F.split(F.lit(",".join(map(repr, weight.first()["w"]))), ",").cast("array<double>")
    d = docs.withColumn("__g", grams(words, buckets))
    total = F.aggregate("__g", F.lit(0.0), lambda a, b: a + F.get(w, b - 1))
    return d.withColumn("ratio", F.when(F.size("__g") > 0, total / F.size("__g")).otherwise(0.0)).drop("__g")


def judge(docs: DataFrame, is_target: Column, text: str = "text", threshold: float = THRESHOLD, buckets: int = BUCKETS) -> DataFrame:
    """Base rules, ratio and ``kept`` for every row. ``is_target`` marks the trusted rows of ``docs``."""
    w = weights(docs, is_target, text, buckets)
    d = score(base_rules(docs, text), w, "words", buckets)
    return d.withColumn("kept", ~F.col("base_failed") & (F.col("ratio") >= threshold)).drop("words")
