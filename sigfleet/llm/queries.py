"""One registered query per operator, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sigfleet.llm import (
    collocations,
    corpus_sql,
    cotraining,
    language_id,
    license_scan,
    mixing,
    near_dedup,
    packing,
    pii,
    quality_rules,
    spelling,
    token_counts,
    topk,
    warc,
)
from sigfleet.llm.common import table


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of the learned decision list for every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rules = quality_rules.fit(spark, docs, table(spark, sf_dir, "labels"))
    q, r = F.col("qstat"), F.col("qrule")
    return quality_rules.score(docs, rules).select(
        "doc_id",
        q["n_words"].alias("n_words"),
        q["word_chars"].cast("long").alias("word_chars"),
        q["n_symbols"].cast("long").alias("n_symbols"),
        q["n_dup_lines"].alias("n_dup_lines"),
        q["n_repeat_words"].alias("n_repeat_words"),
        r["base_failed"].alias("base_failed"),
        r["kept"].alias("kept"),
        r["rule"].alias("rule"),
    )


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pattern spans and disclosing terms of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    base = F.col("spans")
    return pii.sanitise(spark, docs).select(
        "doc_id",
        *[pii.kind_count(base, k).alias(f"n_{k}") for k in pii.KINDS],
        F.sha2(pii.span_text(base), 256).alias("base_sha256"),
        pii.span_text(F.col("all_spans")).alias("spans"),
    )


# Path of the tokenizer's vocabulary; a setting of the session overrides it.
VOCABULARY = "file:///opt/tokenizers/byte_bpe_50k.tiktoken"


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token length histogram of all documents with its suffix sums."""
    vocabulary = spark.conf.get("sigfleet.llm.vocabulary", VOCABULARY)
    lengths = token_counts.lengths(spark, table(spark, sf_dir, "documents"), vocabulary)
    return token_counts.totals(token_counts.histogram(lengths))


def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best inner products of every hundredth vector."""
    return topk.top_k(
        spark, table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10
    )


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class of every document (smallest doc_id of the class)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_dedup.classes(spark, docs).select(
        "doc_id",
        "class_id",
        "class_size",
        (F.col("row") == F.col("class_row")).alias("kept"),
    )


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bin of every piece of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return packing.packed_documents(spark, docs)


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Co-trained quality score of every document."""
    docs = table(spark, sf_dir, "documents")
    sample = cotraining.training_sample(spark, docs, table(spark, sf_dir, "labels"))
    return cotraining.score(docs, cotraining.fit(sample)).withColumn("kept", F.col("score") >= 0.5)


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words taken of every document by the mix at weights 5, 2, 1."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix(spark, docs).select("doc_id", "size", "source_size", "target", "taken")


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and notices in every document."""
    return license_scan.scan(spark, table(spark, sf_dir, "documents").select("doc_id", "text"))[0]


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from two thirds of the labelled ones."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    rest = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3
    docs = docs.withColumn("held_out", F.coalesce(rest == 1, F.lit(False)))
    sample = language_id.training_sample(spark, docs, ~F.col("held_out"))
    return language_id.predict(docs, language_id.fit(sample), keep=["doc_id", "held_out"])


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best phrases of two to five words of each language."""
    docs = table(spark, sf_dir, "documents").select("lang", "text")
    return collocations.collocations(spark, docs)


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Form and root of every word of the corpus."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return spelling.variants(spark, spelling.word_counts(docs))


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page, written to archives, deduplicated, and read back."""
    archives = warc.write_archives(spark, table(spark, sf_dir, "pages"))
    return warc.payloads(spark, warc.deduplicated(spark, archives)).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


QUERIES = {
    "op1_pii": op1_pii,
    "op8_license_scan": op8_license_scan,
    "op2_token_counts": op2_token_counts,
    "op3_topk": op3_topk,
    "op4_near_dedup": op4_near_dedup,
    "op5_packing": op5_packing,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_mixing": op7_mixing,
    "op9_quality_rules": op9_quality_rules,
    "op10_language_id": op10_language_id,
    "op11_collocations": op11_collocations,
    "op12_spelling": op12_spelling,
    "op13_warc": op13_warc,
}

ORACLE_SQL: dict[str, str] = {
    "op3_topk": corpus_sql.TOPK,
    "op7_mixing": corpus_sql.MIXING,
    "op11_collocations": corpus_sql.COLLOCATIONS,
    "op12_spelling": corpus_sql.SPELLING,
    "op13_warc": corpus_sql.WARC,
}
