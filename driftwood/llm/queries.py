"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftwood.llm import anchors, conversation, decontam, gam, langid, merkle, metric, mixing, ratio, simhash, suffix, urlfilter, warc
from driftwood.llm.store import prepared, table

#: host, path, verdict of the listed URLs
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def op1_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata and conversion records of every page's response."""
    return warc.derive(warc.responses(table(spark, sf_dir, "pages")))


def op2_fixed_block_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that repeat 50 words of an earlier one."""
    return anchors.cut(documents(spark, sf_dir)).select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op3_aho_corasick(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages in every document."""
    d = decontam.scan(documents(spark, sf_dir).select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return d.select("doc_id", "found.n_words", "found.n_hit", F.size("found.items").cast("long").alias("n_items"),
                    F.sha2(F.array_join("found.items", ",").cast("binary"), 256).alias("items_sha256"), decontam.contaminated().alias("contaminated"))


def op4_additive_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned from two thirds of the labels."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    taught = ~langid.held_out(F.col("doc_id"))
    model = gam.train(gam.sampled(docs.filter(taught), labels.filter(taught)))
    return gam.predict(docs, model).select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "quality.score",
                                           (F.col("quality.score") >= 0.5).cast("int").alias("predicted"))


def op5_ball_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash class of every document."""
    d = simhash.near_duplicates(documents(spark, sf_dir))
    return d.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op6_rank_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from two thirds of them."""
    docs = documents(spark, sf_dir)
    learned = langid.profiles(docs.filter(~langid.held_out(F.col("doc_id"))))
    return langid.predict(docs.select("doc_id", "text"), learned).select(
        "doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), F.col("language.lang").alias("lang_pred"), "language.score")


def op7_blocked_bloom(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's URL."""
    listed = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return urlfilter.judge(table(spark, sf_dir, "pages").select("page_id", "url"), listed).select("page_id", "host", "path", "rule", "verdict")


def op8_ngram_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and verdict of the n-gram ratio for every document; trusted are those labelled of good quality."""
    good = table(spark, sf_dir, "labels").filter("quality = 1").select("doc_id").distinct().withColumn("trusted", F.lit(True))
    # labels grow with the documents, so the join is a shuffle at every size
    docs = documents(spark, sf_dir).select("doc_id", "text").join(good.hint("merge"), "doc_id", "left")
    d = ratio.judge(docs, F.coalesce("trusted", F.lit(False)))
    return d.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "ratio")


def op9_apportionment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes from every document."""
    return mixing.mix(documents(spark, sf_dir)).select("doc_id", "source", "size", "source_size", "target", "taken")


def op10_interval_expansion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document covered by 400 bytes that also stand elsewhere."""
    return suffix.cut(documents(spark, sf_dir).select("doc_id", "text")).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op11_metric_range_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class and number of links of every vector."""
    return metric.links(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults of every damaged conversation, and its cheapest repair."""
    rows = conversation.damaged(table(spark, sf_dir, "conversations"))
    return conversation.report(rows, conversation.plan(rows))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, proof and root of every document, and what a tampered text makes of them."""
    names = ("doc_id", "source", "lang", "n_chars", "text")
    docs = documents(spark, sf_dir)
    leaf = merkle.leaf(*[F.col(x) for x in names])
    tampered = merkle.leaf(*[F.col(x) for x in names[:-1]], F.translate("text", "\n", ""))
    hit = (F.crc32(F.col("doc_id").cast("string")) % 2 == 0) & F.contains("text", F.lit("\n"))
    leaves = docs.select("doc_id", "source", leaf.alias("leaf"), F.when(hit, tampered).alias("tampered"))
    d = merkle.manifest(leaves, "source", ["doc_id"])
    d = d.withColumn("folded_root", merkle.folded(F.coalesce("tampered", "leaf"), F.col("path")))
    return d.select("doc_id", "leaf", "subroot", "root", merkle.proof(F.col("path")).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus pipeline's stages over all documents."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


_ALL = (op1_warc_derivatives, op2_fixed_block_anchors, op3_aho_corasick, op4_additive_model, op5_ball_hashing, op6_rank_order,
        op7_blocked_bloom, op8_ngram_ratio, op9_apportionment, op10_interval_expansion,
        op11_metric_range_join, op12_conversation_repair, op13_merkle_manifest, pipeline)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepared(spark)
            return f(spark, sf_dir)

        run.__name__, run.__doc__ = f.__name__, f.__doc__
        return run

    return {f.__name__: bind(f) for f in _ALL}


def oracle_sql() -> dict[str, str]:
    from driftwood.llm import sql

    return sql.ORACLES
