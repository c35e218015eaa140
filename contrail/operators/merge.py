"""Keyed upsert as pure DataFrame functions (SNK-04, SNK-05, JOIN-03, JOIN-04)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from contrail.operators.dedupe import one_per_key
from contrail.operators.skew import skew_join


def anti_join(
    candidates: DataFrame, done: DataFrame, keys: Sequence[str], hot: Sequence[int] = ()
) -> DataFrame:
    """JOIN-03: candidates without a counterpart in ``done``; ``hot`` names the
    hashes of keys with many candidates (``skew.hot_hashes``)."""
    return skew_join(candidates, done, keys, "left_anti", hot)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1)


def require_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Two source rows for one target row have no defined outcome: refuse them."""
    clash = duplicate_keys(df, keys).first()
    if clash is not None:
        raise ValueError(f"duplicate source key: {clash.asDict()}")
    return df


def require_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A NULL key names no row: refuse it."""
    missing = F.lit(False)
    for key in keys:
        missing = missing | F.col(key).isNull()
    if not df.where(missing).isEmpty():
        raise ValueError(f"NULL in source key {list(keys)}")
    return df


def _same(left: str, right: str, keys: Sequence[str]) -> list[Column]:
    """Keys of two sides agree; NULL agrees with NULL, so that no row is added twice."""
    return [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys]


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows replace or join the target rows; ``source`` is unique on ``keys``.

    When the source carries every target column nothing of a replaced row
    survives, so an anti join is enough.  Otherwise columns the source lacks keep
    their target value."""
    if set(target.columns) <= set(source.columns):
        kept = target.alias("t").join(source.select(*keys).alias("s"), _same("t", "s", keys), "left_anti")
        return kept.unionByName(source, allowMissingColumns=True)
    updates = {c: F.col(f"s.{c}") for c in source.columns if c not in keys}
    return merge(target, source, keys, updates)


def merge(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    set_when_matched: Mapping[str, Column],
    when: Column | None = None,
) -> DataFrame:
    """Full merge; expressions name the two sides ``t`` and ``s``.

    Matched rows for which ``when`` holds take ``set_when_matched`` and keep the
    rest; other matched and target-only rows stay; source-only rows are added."""
    columns = list(dict.fromkeys([*target.columns, *source.columns]))
    t = target.withColumn("_in_target", F.lit(True)).alias("t")
    s = source.withColumn("_in_source", F.lit(True)).alias("s")
    joined = t.join(s, _same("t", "s", keys), "full_outer")
    inserted = F.col("t._in_target").isNull()
    changed = F.col("t._in_target").isNotNull() & F.col("s._in_source").isNotNull()
    if when is not None:
        changed = changed & F.coalesce(when, F.lit(False))

    def value(name: str) -> Column:
        old = F.col(f"t.{name}") if name in target.columns else F.lit(None)
        new = F.col(f"s.{name}") if name in source.columns else F.lit(None)
        if name in keys:
            return F.coalesce(old, new).alias(name)
        result = F.when(inserted, new)
        if name in set_when_matched:
            result = result.when(changed, set_when_matched[name])
        return result.otherwise(old).alias(name)

    return joined.select(*[value(c) for c in columns])


def differs(columns: Sequence[str]) -> Column:
    """Any of ``columns`` differs between ``t`` and ``s``; NULLs compare (D10)."""
    condition = F.lit(False)
    for c in columns:
        condition = condition | ~F.col(f"t.{c}").eqNullSafe(F.col(f"s.{c}"))
    return condition


def newest(df: DataFrame, keys: Sequence[str], by: Sequence[str]) -> DataFrame:
    """The row with the greatest ``by`` per key; rows equal in ``by`` are settled
    by the remaining columns, so the outcome does not depend on their order."""
    rest = [
        f.name
        for f in df.schema.fields
        if f.name not in keys and f.name not in by and f.dataType.typeName() != "map"
    ]
    return one_per_key(df, keys, [F.col(c).desc_nulls_last() for c in [*by, *rest]])


def upsert_newest(
    target: DataFrame, source: DataFrame, keys: Sequence[str], by: Sequence[str]
) -> DataFrame:
    """Upsert in which the newest row wins on either side: late, repeated and
    out-of-order batches all give the batch result."""
    return newest(target.unionByName(source, allowMissingColumns=True), keys, by)
