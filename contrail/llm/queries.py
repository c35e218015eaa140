"""Registered queries of the operators, each over its whole table, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from contrail.llm import (
    hard_negatives,
    language_id,
    language_model,
    minhash,
    packing,
    pii,
    sentencepiece_codec,
    sharding,
    token_counts,
    topk,
    toxicity,
    treap_search,
    vectors,
)
from contrail.session import stage

CONTEXT = 4_096


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def _embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    encoded = sentencepiece_codec.encode_documents(_documents(spark, sf_dir).select("doc_id", "text"), model)
    slim = encoded.withColumn("n_bytes", F.octet_length(F.coalesce("text", F.lit(""))).cast("long")).drop("text")
    decoded = sentencepiece_codec.decode_documents(slim, model)
    return decoded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
        "n_bytes",
        F.crc32("offsets").alias("offsets_crc32"),
    )


def pack_documents(documents: DataFrame) -> DataFrame:
    """Pieces of the documents with their sequences and their token ids.

    The ids of a sequence are those of its pieces in the order of ``offset``."""
    packed = packing.pack_documents(documents, public_tokenizers.path("word_bpe_49k.json"), CONTEXT, end_id=1)
    return packed.select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset", "ids"
    )


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces by the digest of their ids; the ids themselves are in the staged sequences."""
    return pack_documents(_documents(spark, sf_dir)).drop("ids")


def op3_hypergeometric_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.coalesce("text", F.lit("")).cast("binary")
    narrow = _documents(spark, sf_dir).select(
        "doc_id", (F.octet_length(raw) + 1).cast("long").alias("size"), F.crc32(raw).alias("text_crc32")
    )
    return sharding.shuffle_to_shards(narrow, 8).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _documents(spark, sf_dir).select("doc_id", "text")
    found = pii.find_personal_data(documents, pii.train(documents))

    def joined(spans):
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))

    base = F.filter("spans", lambda s: s["base"])
    def count(kind):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in pii.KINDS]
    return found.select(
        "doc_id", *counts, F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


def op5_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(_embeddings(spark, sf_dir))


def op6_interpolated_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score_documents(_documents(spark, sf_dir))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    lengths = token_counts.token_lengths(_documents(spark, sf_dir).select("text"), ranks, public_tokenizers.PATTERN)
    return token_counts.length_table(lengths)


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _documents(spark, sf_dir)
    held_out = language_id.fold("doc_id", 3) == 1
    model = language_id.train(documents.filter(~held_out))
    found = language_id.identify(documents.select("doc_id", "text"), model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "margin", "rejected")


def op9_bag_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_documents(_documents(spark, sf_dir))


def op10_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_embeddings(spark, sf_dir), F.col("vec_id") % 20 == 0, k=20, scale=64.0)


def op11_treap_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    return treap_search.rank_documents(_documents(spark, sf_dir).select("doc_id", "text"), items, k=50)


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _documents(spark, sf_dir).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(language_id.fold("doc_id", 5) != 0)
    scored = toxicity.score_documents(documents, toxicity.train(documents, labels))
    held_out = F.coalesce(language_id.fold("doc_id", 5) == 0, F.lit(False))
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted")
    )


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = _embeddings(spark, sf_dir).withColumn("label", moved)
    return hard_negatives.hard_negatives(rows, F.col("vec_id") % 50 == 0, scale=256.0, positives=5, negatives=3)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    f.__name__: f
    for f in (
        op1_sentencepiece, op2_best_fit_packing, op3_hypergeometric_shards, op4_personal_data, op5_near_vectors,
        op6_interpolated_scores, op7_token_counts, op8_language, op9_bag_minhash, op10_exact_top_k, op11_treap_search,
        op12_toxicity, op13_hard_negatives, pipeline,
    )
}

#: Integer products and their ranks are the one result here that SQL states in full.
ORACLE = {
    "op10_exact_top_k": """
        with whole as (
            select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)::bigint) as v
            from embeddings
            where embedding is not null and vec_id is not null and len(embedding) > 0
              and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
        ),
        scored as (
            select q.vec_id as query_id, c.vec_id,
                   list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::bigint as score
            from whole q join whole c on q.vec_id % 20 = 0 and q.vec_id <> c.vec_id and len(q.v) = len(c.v)
        ),
        ranked as (
            select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from scored
        )
        select query_id, rank, vec_id, score from ranked where rank <= 20
    """,
    "op11_treap_search": r"""
        with words as (
            select doc_id, row_number() over () as d,
                   regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as terms
            from documents where text is not null
        ),
        whole as (select *, len(terms)::bigint as n from words where len(terms) > 0),
        total as (select count(*)::bigint as big_n, sum(n)::bigint as l from whole),
        counts as (select d, doc_id, n, term, count(*)::bigint as tf from (select d, doc_id, n, unnest(terms) as term from whole) group by all),
        weights as (
            select term, floor(1000 * ln((2 * big_n + 2)::double / (2 * count(*) + 1)::double))::bigint as w
            from counts, total group by term, big_n
        ),
        asked as (
            select distinct item_id, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
            from benchmark where text is not null and item_id is not null
        ),
        scored as (
            select item_id, d, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * big_n) // l))))::bigint as score
            from asked join weights using (term) join counts using (term), total
            group by item_id, d, doc_id
        ),
        ranked as (
            select *, row_number() over (partition by item_id order by score desc, doc_id)::int as rank
            from scored where score > 0 and doc_id is not null
        )
        select item_id, rank, doc_id, score from ranked where rank <= 50
    """,
    "op13_hard_negatives": """
        with whole as (
            select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
                   list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v
            from embeddings
            where embedding is not null and vec_id is not null and label is not null and len(embedding) > 0
              and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
        ),
        scored as (
            select a.vec_id as anchor_id, c.vec_id, a.label = c.label as same,
                   list_sum(list_transform(list_zip(a.v, c.v), lambda p: p[1] * p[2]))::bigint as score
            from whole a join whole c on a.vec_id % 50 = 0 and a.vec_id <> c.vec_id and len(a.v) = len(c.v)
        ),
        positives as (
            select anchor_id, vec_id as positive_id, score as positive_score from scored where same
            qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5
        ),
        ranked as (
            select anchor_id, positive_id, vec_id as negative_id, positive_score, score as negative_score,
                   row_number() over (partition by anchor_id, positive_id order by score desc, vec_id)::int as rank
            from positives join scored using (anchor_id)
            where not same and 50 * positive_score <= 100 * score and 100 * score <= 95 * positive_score
        )
        select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from ranked where rank <= 3
    """,
}
