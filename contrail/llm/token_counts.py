"""Exact token counts from a histogram of encoded lengths."""

from __future__ import annotations

import base64
import functools

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window, functions as F, types as T

from contrail.llm.common import free_name, prepare, text_parts, whole_text
from contrail.session import stage

#: Lengths per block of the running sums, so that no task sees all lengths.
BLOCK = 4_096


@functools.lru_cache(maxsize=2)
def _encoding(ranks: str, pattern: str) -> tiktoken.Encoding:
    table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line)}
    return tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=table, special_tokens={})


def token_lengths(df: DataFrame, ranks_file: str, pattern: str, text_col: str = "text", to: str = "n_tokens") -> DataFrame:
    """Add the number of tokens of every whole text; null counts as empty, empty has none.

    Strings of special tokens are ordinary text.  ``to`` may not be a column already."""
    if to in df.columns:
        raise ValueError(f"the input already has a column {to}")
    prepare(df.sparkSession)
    with open(ranks_file, encoding="ascii") as file:
        ranks = file.read()
    work = free_name(df, "_text")
    schema = T.StructType(list(df.schema.fields)).add(to, "long")

    def run(batches):
        encoding = _encoding(ranks, pattern)
        for batch, texts in text_parts(batches, work):
            lengths = pa.array([len(encoding.encode_ordinary(t)) for t in texts], pa.int64())
            kept = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*kept, lengths], schema.names)

    return df.withColumn(work, whole_text(text_col)).mapInArrow(run, schema)


def _running(df: DataFrame, columns: dict[str, str], down: bool) -> DataFrame:
    """Running sums over ``n_tokens``: in blocks of lengths, plus what the blocks before hold."""
    order = F.col("n_tokens").desc() if down else F.col("n_tokens")
    block = F.floor(F.col("n_tokens") / BLOCK).alias("_block")
    blocks = df.groupBy(block).agg(*[F.sum(c).alias(c) for c in columns])
    far = F.col("_block").desc() if down else F.col("_block")
    outer = Window.orderBy(far).rowsBetween(Window.unboundedPreceding, -1)
    before = blocks.select("_block", *[F.coalesce(F.sum(c).over(outer), F.lit(0)).alias(f"_{c}") for c in columns])
    inner = Window.partitionBy("_block").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    joined = df.withColumn("_block", block).join(before, "_block")
    return joined.withColumns(
        {to: F.sum(c).over(inner) + F.col(f"_{c}") for c, to in columns.items()}
    ).drop("_block", *[f"_{c}" for c in columns])


def length_table(lengths: DataFrame, column: str = "n_tokens") -> DataFrame:
    """One row per length that occurs: what every context limit between two lengths needs.

    ``documents, tokens``: of this length; ``documents_to, tokens_to``: of this length or
    less; ``documents_from, tokens_from``: of this length or more; ``share_to``: the
    quantile that the length is; ``truncated_total``: tokens left if every document is cut
    to this length.  Null lengths are left out; no rows give no rows."""
    counts = lengths.filter(F.col(column).isNotNull()).groupBy(F.col(column).cast("long").alias("n_tokens"))
    # Written once: the running sums below read it several times, the texts are encoded once.
    counts, _ = stage(counts.agg(F.count("*").alias("documents")), "length-histogram")
    counts = counts.withColumn("tokens", F.col("n_tokens") * F.col("documents"))
    up = _running(counts, {"documents": "documents_to", "tokens": "tokens_to"}, down=False)
    both = _running(up, {"documents": "documents_from", "tokens": "tokens_from"}, down=True)
    total = F.col("documents_to") + F.col("documents_from") - F.col("documents")
    return both.withColumns(
        {
            "share_to": F.col("documents_to") / total,
            "truncated_total": F.col("tokens_to") + F.col("n_tokens") * (F.col("documents_from") - F.col("documents")),
        }
    )


def at_limits(table: DataFrame, limits: list[int]) -> DataFrame:
    """``context_limit, documents_within, documents_cut, tokens_kept, tokens_lost`` for any limits.

    All come from the length table: what fits is summed, the rest is cut to the limit."""
    kept = []
    for limit in limits:
        inside = F.col("n_tokens") <= limit
        within = F.coalesce(F.sum(F.when(inside, F.col("documents"))), F.lit(0))
        cut = F.coalesce(F.sum(F.when(~inside, F.col("documents"))), F.lit(0))
        whole = F.coalesce(F.sum(F.when(inside, F.col("tokens"))), F.lit(0))
        over = F.coalesce(F.sum(F.when(~inside, F.col("tokens") - F.lit(limit) * F.col("documents"))), F.lit(0))
        kept.append(F.struct(
            F.lit(limit).cast("long").alias("context_limit"), within.alias("documents_within"),
            cut.alias("documents_cut"), (whole + F.lit(limit) * cut).alias("tokens_kept"), over.alias("tokens_lost"),
        ))
    return table.agg(F.array(*kept).alias("all")).select(F.explode("all").alias("one")).select("one.*")


def quantiles(table: DataFrame, shares: list[float]) -> DataFrame:
    """``share, n_tokens``: the smallest length that at least this share of documents does not pass."""
    found = [
        F.struct(F.lit(s).alias("share"), F.min(F.when(F.col("share_to") >= s, F.col("n_tokens"))).alias("n_tokens"))
        for s in shares
    ]
    return table.agg(F.array(*found).alias("all")).select(F.explode("all").alias("one")).select("one.*")
