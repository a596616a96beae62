"""The registered query of each training-data operator, over whole tables, and its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.llm import decontaminate, divergence, jaccard_join, language_id, mixing, near_dedup, oracles, quality_pu, quality_rules, secret_scan, sharding, token_files, toxicity, vector_codes
from lakeops.llm.common import Tables, crc_mod

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under ``name``."""

    def register(fn: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def vocabulary(name: str) -> str:
    """Path of an installed tokenizer file."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_secret_scan", oracles.secrets())
def op1_secret_scan(t: Tables) -> DataFrame:
    """Spans of secrets in every document: counts and digest of the base kinds, and all spans."""
    found = secret_scan.scan(t.documents)
    base = F.filter("found", lambda x: x["kind"].isin("assign", "access", "hex"))

    def count(kind: str):
        return F.size(F.filter("found", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(secret_scan.listed(base), 256).alias("base_sha256"), secret_scan.listed(F.col("found")).alias("spans"))


@query("op2_decontamination")
def op2_decontamination(t: Tables) -> DataFrame:
    """Every benchmark item found in every document, with its score and overlaps."""
    return decontaminate.leaks(t.documents, t.benchmark)


@query("op3_toxicity")
def op3_toxicity(t: Tables) -> DataFrame:
    """Toxicity score of every document; labels of every fifth id, by crc32, are never read."""
    model = toxicity.train(t.documents, t.labels, crc_mod("doc_id", 5) != 0)
    return toxicity.scored(t.documents.select("doc_id", "text"), model).select("doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


@query("op4_quality_classifier")
def op4_quality_classifier(t: Tables) -> DataFrame:
    """Quality score of every document; labels of every fourth id, by crc32, are never read."""
    model = quality_pu.train(t.documents, t.labels, crc_mod("doc_id", 4) != 2)
    return quality_pu.scored(t.documents.select("doc_id", "text"), model).select("doc_id", (crc_mod("doc_id", 4) == 2).alias("held_out"), "score", "predicted")


@query("op5_quality_rules", oracles.quality())
def op5_quality_rules(t: Tables) -> DataFrame:
    """Counts and verdict of the quality rules for every document."""
    judged = quality_rules.judge(t.documents.select("doc_id", "text"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.array_join("failed_rules", ",").alias("failed_rules"))


@query("op6_near_dedup", oracles.near_duplicates())
def op6_near_dedup(t: Tables) -> DataFrame:
    """The near-duplicate component of every document."""
    return near_dedup.near_duplicates(t.documents)


@query("op7_shard_tree")
def op7_shard_tree(t: Tables) -> DataFrame:
    """Every document's place in 40 shards, and its shard when there is one more."""
    return sharding.shard_documents(t.documents, 40)


@query("op8_language_id")
def op8_language_id(t: Tables) -> DataFrame:
    """Language of every document; languages of every fourth id, by crc32, are never read."""
    model = language_id.train(t.documents, crc_mod("doc_id", 4) != 2)
    return language_id.identified(t.documents.select("doc_id", "text"), model).select("doc_id", (crc_mod("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score", "ambiguous")


@query("op9_token_files")
def op9_token_files(t: Tables) -> DataFrame:
    """The place and checksum of every document's ids in the written files."""
    return token_files.read_documents(token_files.write_token_files(t.documents, vocabulary("word_bpe_49k.json")))


@query("op10_source_mix", oracles.mix())
def op10_source_mix(t: Tables) -> DataFrame:
    """How many words of each document the mix takes."""
    return mixing.mix(t.documents.select("doc_id", "source", "text")).select("doc_id", "size", "source_size", "target", "taken")


@query("op11_jaccard_join", oracles.jaccard_components())
def op11_jaccard_join(t: Tables) -> DataFrame:
    """The component of every document under links at similarity 0.8."""
    return jaccard_join.jaccard_components(t.documents)


@query("op12_source_divergence", oracles.divergence())
def op12_source_divergence(t: Tables) -> DataFrame:
    """How far each language's sources are from each other, and the terms that mark each source."""
    return divergence.audit(t.documents)


@query("op13_vector_codes", oracles.vector_codes())
def op13_vector_codes(t: Tables) -> DataFrame:
    """Product code and errors of every vector."""
    return vector_codes.compress(t.embeddings)
