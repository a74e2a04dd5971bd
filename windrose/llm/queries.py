"""The training-data queries, opN_<name>: thin wrappers that derive digest columns from the operators' results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, chroma, decontaminate, gru_lm, minhash, packing, prefix_trie, quality, runs, substring_dedup, suffix_dedup, toxicity, url_filter
from .common import fold
from .oracles import ORACLE_SQL

#: The rules that op9 judges by (host, path, verdict).
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]

#: The conversation that op13 formats besides those of the table.
CONTROL_STRINGS = [(-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok")]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_contamination(docs, _table(spark, sf_dir, "benchmark"))
    return decontaminate.with_digest(found).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    trees = quality.train_quality(docs, _table(spark, sf_dir, "labels"))
    scored = quality.score_quality(docs, trees)
    return scored.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op3_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = gru_lm.score_documents(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept_bytes", 256).alias("kept_sha256"))


def op5_chroma(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recordings made of all vectors: class, and the best of the queries (ids divisible by 50) that align with it."""
    recordings = chroma.as_recordings(_table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    membership, pairs = chroma.match_recordings(chroma.fingerprints(recordings, "id", "audio"))
    best = pairs.groupBy("class_id").agg(
        F.count("*").alias("n_queries"),
        F.min(F.struct((F.col("errors") / F.col("bits")).alias("bit_error"), "query_class", "offset")).alias("best"),
    )
    return membership.join(best, "class_id", "left").select(
        F.col("id").alias("vec_id"), "class_id", "n_integers", F.coalesce("n_queries", F.lit(0)).alias("n_queries"),
        "best.query_class", "best.offset", "best.bit_error",
    )


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack(docs, str(public_tokenizers.path("byte_bpe_50k.json")))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.remove_repeats(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    machine = toxicity.train_toxicity(docs, _table(spark, sf_dir, "labels"))
    scored = toxicity.score_toxicity(docs, machine)
    return scored.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge_urls(pages, rules).select("page_id", "host", "path", "rule", "verdict")


def op10_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of conversations of which each first takes a few turns over from the one that leads its twenty."""
    turns = prefix_trie.digested(_table(spark, sf_dir, "conversations"))
    return prefix_trie.trie(*prefix_trie.with_shared_heads(turns))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = runs.with_planted_runs(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return runs.with_digests(runs.collapse_runs(docs))


def op13_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.createDataFrame(CONTROL_STRINGS, "conv_id long, turn long, role string, text string")
    return chat.digest_chats(chat.format_chats(turns.unionByName(more)))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v for k, v in globals().items() if k.startswith("op") and k[2:3].isdigit()}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE_SQL)
