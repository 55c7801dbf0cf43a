"""The corpus pipeline: language ID, near-duplicates, repeated passages, benchmark passages, then the mix.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes every stage's result to the shared
folder as Parquet and reads it back as the next stage's ``docs``. All stages but the last return the columns of ``docs``.
Rows that differ only in order give the same result; null or empty texts have no letter and leave in the first stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftwood.llm import decontam, langid, mixing, simhash, suffix
from driftwood.llm.store import prepared, stored, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is one of those learned; what is ``und`` goes."""
    prepared(spark)
    learned = langid.profiles(docs.filter(~langid.held_out(F.col("doc_id"))))
    found = langid.predict(docs, learned, out="__language")
    return found.filter(F.col("__language.lang") != langid.UNKNOWN).drop("__language")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash class: the one with the smallest id (null last), of rows with equal ids the one with
    the smallest row hash, of equal rows one."""
    prepared(spark)
    mark = {"__k1": F.xxhash64(*docs.columns), "__k2": F.xxhash64(F.lit(1), *docs.columns)}
    found = simhash.near_duplicates(docs.withColumns(mark), keep=("__k1", "__k2"))
    first = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "__k1", "__k2")).alias("r"))
    chosen = stored(first.select("r.__k1", "r.__k2"), "pipeline-chosen")
    kept = docs.withColumns(mark).join(chosen, ["__k1", "__k2"], "left_semi")
    return kept.dropDuplicates(["__k1", "__k2"]).select(*docs.columns)


#: bytes of a passage: runs of 51 words and more that two documents share are shorter than the operator's 400 bytes in half of the
#: cases, and at least this long in 97 of 100
PASSAGE_BYTES = 300


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that stand elsewhere too; a character goes if all its bytes do. A document of which
    nothing is left goes. ``n_chars`` counts the new text."""
    prepared(spark)
    # the other columns travel as one, so that none can clash with the operator's
    row = F.struct(*[F.col(c) for c in docs.columns if c != "text"])
    parts = suffix.cut(docs.select("doc_id", "text", row.alias("__row"), F.col("text").isNull().alias("__null")), length=PASSAGE_BYTES, keep=("__row", "__null"), characters=True)
    new = parts.filter((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_bytes")))
    new = new.select("__row.*", F.when(~F.col("__null"), F.decode("kept", "UTF-8")).alias("text"), (F.col("n_removed") > 0).alias("__cut"))
    if "n_chars" in docs.columns:
        new = new.withColumn("n_chars", F.when(F.col("__cut"), F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return new.select(*docs.columns)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no more of the benchmark than the contamination rule allows."""
    prepared(spark)
    found = decontam.scan(docs, table(spark, sf_dir, "benchmark"), out="__found")
    return found.filter(~decontam.contaminated("__found")).drop("__found")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: for every document how many of its words are taken, which and how often."""
    prepared(spark)
    return mixing.mix(docs)


STAGES = [
    ("language ID", language),
    ("SimHash near-dedup", near_duplicates),
    ("suffix-array dedup", passages),
    ("benchmark decontamination", benchmark),
    ("mixing", mix),
]

#: language profiles, fingerprints and suffix order have no SQL form; tests compare with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepared(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "pipeline-" + name.split()[0].lower())
    return docs
