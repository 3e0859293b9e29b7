"""The registered queries of this package: each applies one operator, with
production parameters, to its whole table."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finlake.llm import (
    collocations, decontam, html_blocks, hyperplanes, langid, mixing, prefix_trie, quality_rules, simhash, token_files,
    toxicity, url_filter, warc)
from finlake.llm.common import table
from finlake.session import scratch_path

# Fixed values of the contracts.
URL_RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
FIRST_CAPTURE = 1_700_000_000  # seconds; a page's capture time adds its id
END_ID = 0


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_token_files(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    token_files.write(table(spark, sf, "documents"), path, tokenizer_file(), end=END_ID)
    return token_files.read(spark, path)


def op2_warc_index(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    pages = table(spark, sf, "pages")
    warc.write(pages.withColumn("captured", F.lit(FIRST_CAPTURE) + F.coalesce("page_id", F.lit(0))), path)
    merged = warc.merge_index(warc.scan(spark, path))
    return merged.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "captured")


def op3_language_profiles(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    docs = docs.withColumn("held_out", held_out)
    profiles = langid.learn(docs.filter(~F.col("held_out")))
    return langid.predict(docs, profiles).select("doc_id", "held_out", "lang_pred", "score")


def op4_source_mix(spark: SparkSession, sf: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf, "documents"), weights=(3, 1, 2), share=1.5, most=2.0)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op5_simhash_pigeonring(spark: SparkSession, sf: str) -> DataFrame:
    found = simhash.groups(table(spark, sf, "documents"), shingle=3, max_distance=3)
    return found.select("doc_id", simhash.hex16(F.col("fp")).alias("fingerprint"), "component_id")


def op6_host_reputation(spark: SparkSession, sf: str) -> DataFrame:
    """A page's outcome is the label of the document its path numbers."""
    pages = table(spark, sf, "pages")
    labels = table(spark, sf, "labels")
    bad = ((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int")
    number = F.regexp_extract(url_filter.split_url(F.col("url"))[1], "^/[a-z]+/([0-9]+)", 1).try_cast("long")
    outcomes = pages.select("url", number.alias("of")).join(labels.select(F.col("doc_id").alias("of"), bad.alias("bad")), "of")
    judged = url_filter.judge(pages, outcomes, URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op7_severity(spark: SparkSession, sf: str) -> DataFrame:
    """Grades from the two labels: 0 not toxic, 1 toxic, 2 toxic and of low
    quality."""
    docs = table(spark, sf, "documents")
    grade = F.when(F.col("toxic") == 0, 0).when(F.col("toxic") == 1, F.when(F.col("quality") == 0, 2).otherwise(1))
    labels = table(spark, sf, "labels").select("doc_id", grade.alias("grade"))
    model = toxicity.train(docs.join(labels, "doc_id"))
    return toxicity.score(docs, model).select("doc_id", "severity", "p_toxic", "toxic")


def op8_distribution_quality(spark: SparkSession, sf: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, sf, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op9_latent_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    """A row per contaminated document and item."""
    found = decontam.search(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    hits = found.select("doc_id", F.explode("hits").alias("hit"))
    return hits.select("doc_id", "hit.item_id", "hit.lcs_ratio", "hit.answer_ratio", F.round("hit.cosine", 3).alias("cosine"))


def op10_main_text(spark: SparkSession, sf: str) -> DataFrame:
    return html_blocks.extract(table(spark, sf, "pages")).select("page_id", "url", "text", "n_chars")


def op11_hyperplane_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return hyperplanes.near_duplicates(table(spark, sf, "embeddings"), min_cosine=0.9)


def op12_prefix_trie(spark: SparkSession, sf: str) -> DataFrame:
    turns = prefix_trie.rebuilt(prefix_trie.turns(table(spark, sf, "conversations")), stride=20)
    return prefix_trie.trie(prefix_trie.paths(turns))


def op13_collocations(spark: SparkSession, sf: str) -> DataFrame:
    return collocations.collocations(table(spark, sf, "documents"), min_count=30, top=2000, inside_percent=80)


def pipeline(spark: SparkSession, sf: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_token_files, op2_warc_index, op3_language_profiles, op4_source_mix, op5_simhash_pigeonring,
        op6_host_reputation, op7_severity, op8_distribution_quality, op9_latent_decontamination, op10_main_text, op11_hyperplane_dedup,
        op12_prefix_trie, op13_collocations, pipeline)
}
