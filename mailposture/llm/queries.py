"""The registered queries of the text operators: thin, over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailposture.llm import compression_bands, language_id, lexical_search, main_text, mixing, ordinal_quality, quotation, rendezvous, simhash, spelling, string_tiling, toxicity, url_filter
from mailposture.llm.common import id_remainder, table

SHARDS = 24


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grades of all documents by the ordinal model learned from a bounded sample of the labels."""
    docs = table(spark, sf_dir, "documents")
    model = ordinal_quality.fit(ordinal_quality.graded(docs, table(spark, sf_dir, "labels")))
    return ordinal_quality.score(docs.select("doc_id", "text"), model).drop("text")


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Law ``key``: rendezvous hashing of doc_id over 24 shards, and over 25."""
    docs = table(spark, sf_dir, "documents")
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 8
    rows = docs.select("doc_id", size.alias("size"), F.crc32(F.col("text").cast("binary")).alias("text_crc32"), F.lit("key").alias("law"))
    return rendezvous.assign(rows, "doc_id", [1.0] * SHARDS, ["text_crc32", "size"], [1.0] * (SHARDS + 1))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and the benchmark items that they hold."""
    return string_tiling.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all documents, learned where crc32(doc_id) mod 3 is not 1."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    fold = id_remainder("doc_id", 3)
    model = language_id.fit(docs.filter(fold != 1))
    rows = docs.select("doc_id", "text", F.coalesce(fold == 1, F.lit(False)).alias("held_out"))
    return language_id.predict(rows, model).drop("text")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, learned where crc32(doc_id) mod 4 is not 2."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    fold = id_remainder("doc_id", 4)
    labels = table(spark, sf_dir, "labels").filter(fold != 2)
    model = toxicity.learn(toxicity.sampled(docs, labels))
    rows = docs.select("doc_id", "text", F.coalesce(fold == 2, F.lit(False)).alias("held_out"))
    return toxicity.score(rows, model).drop("text")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of 4-word shingles, linked at 4 or fewer differing bits."""
    prints = simhash.fingerprints(table(spark, sf_dir, "documents"), words=4)
    return simhash.groups(prints, radius=4).select("doc_id", simhash.as_hex(F.col("fp")).alias("fingerprint"), F.col("component").alias("component_id"))


def op7_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, compression ratios and verdicts of all documents."""
    return compression_bands.judge(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all documents with weights 1, 2, 3 over the sources."""
    return mixing.mix(table(spark, sf_dir, "documents")).drop("source")


def op9_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All messages with the message they reply to, their place in reply order, and their text without quotes; and
    all conversations in reply order (kind ``conversation``, in numbered parts; the turn is the first one of the part)."""
    messages = table(spark, sf_dir, "conversations")
    placed = quotation.conversations(messages).drop("text").withColumn("kind", F.lit("message"))
    parts = quotation.assemble(placed, repeated=quotation.repeats(messages)).select(F.lit("conversation").alias("kind"), "conv_id", F.col("first_turn").alias("turn"), "part", F.col("conversation").alias("chat"))
    return placed.unionByName(parts, allowMissingColumns=True)


# The rules of the query.
URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on all pages; the list holds one in sixteen of their canonical URLs, by hash, in another spelling."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    chosen = pages.filter((url_filter.host() != "") & F.md5(url_filter.canonical().cast("binary")).startswith("0"))
    listed = chosen.select(url_filter.respelled().alias("url")).select(url_filter.canonical().alias("canonical"))
    return url_filter.judge(pages, listed, URL_RULES).drop("url")


def op11_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of all pages."""
    return main_text.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty best documents of each benchmark item."""
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All words of seven letters or more with their near words, their form and its root."""
    return spelling.group(spelling.words(table(spark, sf_dir, "documents").select("doc_id", "text")))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Queries by name."""
    found = (
        op1_quality_classifier,
        op2_sharding,
        op3_decontamination,
        op4_language_id,
        op5_toxicity,
        op6_simhash,
        op7_compression_bands,
        op8_mixing,
        op9_quotation_linking,
        op10_url_filter,
        op11_main_text,
        op12_lexical_search,
        op13_spelling_variants,
    )
    return {f.__name__: f for f in found}
