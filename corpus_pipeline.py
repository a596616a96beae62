"""A training corpus from documents: quality, near-duplicates, benchmark leaks, source mix, token files.

Each stage takes what the stage before kept, written as Parquet and read again,
so a lost executor costs no earlier stage. All but the last return rows with the
columns of ``documents``; the last writes the token files and returns the place
and checksum of each row's ids in them. A row that the mix takes twice is there twice.

Defined results
- a null text counts as empty in every stage; texts of any length are read whole.
- an id with several texts is several documents; rows that repeat both are one, of
  which near-duplicate removal keeps one. Rows with a null id are never removed as copies.
- ties are decided by id and text, so reruns agree.
- other columns are carried as they are, whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakeops.llm import decontaminate, mixing, near_dedup, quality_pu, token_files
from lakeops.llm.common import Tables, crc_mod, materialise
from lakeops.llm.queries import vocabulary


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    model = quality_pu.train(docs, Tables(spark, sf_dir).labels, crc_mod("doc_id", 4) != 2)
    return quality_pu.scored(docs, model).where("predicted = 1").select(*docs.columns)


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return near_dedup.one_of_each(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return decontaminate.clean_rows(docs, Tables(spark, sf_dir).benchmark)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mixed_rows(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of all rows, and where each row is in them."""
    return token_files.read_documents(token_files.write_token_files(docs, vocabulary("word_bpe_49k.json")))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("minhash_near_dedup", minhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mix", source_mix),
    ("token_output", token_output),
]

#: SQL has no tokenizer, trained model or similarity sketch; tests hold the result against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``."""
    docs = Tables(spark, sf_dir).documents
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name=name)
    return docs
