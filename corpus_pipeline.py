"""From raw documents to packed sequences: language, near copies, personal data, packing.

Each stage takes what its predecessor kept; ``run`` writes every stage to the shared
folder and reads it again, so a lost executor costs one stage at most."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from contrail.llm import language_id, minhash, pii
from contrail.llm.queries import pack_documents
from contrail.operators.dedupe import one_per_key
from contrail.session import stage

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is clear.  Learns from the labelled ones among them; null and
    empty texts, texts without a letter and those with a narrow margin go."""
    learned = language_id.train(docs.filter(language_id.fold("doc_id", 3) != 1))
    return language_id.identify(docs, learned).filter(~F.col("rejected")).select(*docs.columns)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id.

    Of rows that share that id one stays, the first by its columns.  Rows without an id belong
    to no group that could name them: one of each text stays."""
    named = docs.filter("doc_id is not null")
    ids, _ = stage(minhash.near_documents(named).filter("kept").select("doc_id").distinct(), "pipeline-kept")
    shared = named.groupBy("doc_id").count().filter("count > 1").select("doc_id")
    of_groups = named.join(ids, "doc_id", "left_semi")
    alone = of_groups.join(shared, "doc_id", "left_anti")
    first = one_per_key(of_groups.join(shared, "doc_id", "left_semi"), ["doc_id"], docs.columns)
    unnamed = one_per_key(docs.filter("doc_id is null"), ["text"], docs.columns)
    return alone.unionByName(first).unionByName(unnamed).select(*docs.columns)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, personal data replaced by its kind; ``n_chars`` follows the text."""
    found = pii.find_personal_data(docs, pii.train(docs), redact="_redacted")
    changed = {"text": F.col("_redacted"), "n_chars": F.length("_redacted").cast(docs.schema["n_chars"].dataType)}
    return found.withColumns(changed).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the documents in sequences of fixed length, with their ids."""
    return pack_documents(docs)


STAGES = [
    ("language_id", keep_known_language),
    ("minhash_near_dedup", keep_one_of_each),
    ("pii", redact_personal_data),
    ("best_fit_packing", pack),
]

#: SQL states none of the stages: compression, sampling, a trained network and tokenizers.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs, _ = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
