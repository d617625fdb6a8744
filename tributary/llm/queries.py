"""The registered queries of this package: thin digests of what its operators return."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir
from . import (
    conversation_repair,
    decontaminate,
    filter_audit,
    licenses,
    line_dedup,
    mixing,
    quality_cascade,
    simhash,
    substring_dedup,
    suffix_dedup,
    token_files,
    toxicity,
    url_filter,
)

WORD_BPE_VOCABULARY = 49_408


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_bpe() -> str:
    """The public tokenizer file, as installed on every machine."""
    import public_tokenizers

    return str(Path(public_tokenizers.path("word_bpe_49k.json")))


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "tokens")
    token_files.write_tokens(table(spark, sf_dir, "documents"), path, word_bpe(), WORD_BPE_VOCABULARY)
    return token_files.read_tokens(spark, path, WORD_BPE_VOCABULARY)


def op5_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_cascade.judge(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def as_files(docs: DataFrame) -> DataFrame:
    """The documents as files below source and language; every 40th is the licence file of its directory."""
    path = F.expr(
        "concat_ws('/', coalesce(source, 'none'), coalesce(lang, 'none'), "
        "if(doc_id % 400 = 0, null, concat('d', doc_id div 400)), "
        "if(doc_id % 40 = 0, 'LICENSE', concat(doc_id, '.txt')))"
    )
    return docs.select(F.col("doc_id").alias("key"), path.alias("path"), "text")


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(as_files(table(spark, sf_dir, "documents")))
    return found.select(F.col("key").alias("doc_id"), "path", "license", "how")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3)


URL_RULES = [
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
]

# Weights of domains and of languages inside the largest one; all others weigh 1.
MIX_LEVELS = ["domain", "lang", "source"]
MIX_WEIGHTS = {("web",): 2, ("reference",): 3, ("web", "en"): 4, ("reference", "es"): 5}
MIX_SHARE = 0.9
MIX_EPOCHS = 2
MIX_SEED = 7


def with_domain(docs: DataFrame) -> DataFrame:
    """The documents' sources under three domains."""
    number = F.expr("try_cast(regexp_extract(source, '^src([0-9]+)$', 1) as int)")
    domain = F.when(number == 0, "web").when(number < 10, "reference").otherwise("forum")
    return docs.select("doc_id", "text", "lang", "source", domain.alias("domain"))


def chosen_documents(docs: DataFrame) -> DataFrame:
    return mixing.choose(with_domain(docs), MIX_LEVELS, MIX_WEIGHTS, MIX_SHARE, MIX_EPOCHS, MIX_SEED)


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), url_filter.rule_table(spark, URL_RULES))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.repeated_lines(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_lines",
        F.size("removed").cast("bigint").alias("n_removed"),
        F.array_join(F.col("removed").cast("array<string>"), ",").alias("removed"),
    )


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = chosen_documents(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "domain", "lang", "source", "n_tokens", "copies")


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_passages(table(spark, sf_dir, "documents"), window=13).drop("kept")


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = filter_audit.masks(table(spark, sf_dir, "documents"))
    return filter_audit.report(found, table(spark, sf_dir, "labels")).drop("filter")


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), window=400).drop("kept")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair(conversation_repair.damage(table(spark, sf_dir, "conversations")))


QUERIES = {
    "op1_decontaminate": op1_decontaminate,
    "op2_toxicity": op2_toxicity,
    "op3_token_files": op3_token_files,
    "op4_url_filter": op4_url_filter,
    "op5_quality_cascade": op5_quality_cascade,
    "op6_licenses": op6_licenses,
    "op7_simhash": op7_simhash,
    "op8_line_dedup": op8_line_dedup,
    "op9_mixing": op9_mixing,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_filter_audit": op11_filter_audit,
    "op12_suffix_dedup": op12_suffix_dedup,
    "op13_conversation_repair": op13_conversation_repair,
}
