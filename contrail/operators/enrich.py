"""Fact to dimension joins (JOIN-01, JOIN-02, JOIN-05..07)."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from contrail.operators.skew import (
    BROADCAST_BYTES,
    BROADCAST_ROWS,
    SALTS,
    fits_broadcast,
    hot_hashes,
    skew_join,
)


@dataclass(frozen=True)
class Dimension:
    """A dimension, unique on its keys, and whether it may be broadcast."""

    frame: DataFrame
    small: bool

    @classmethod
    def of(
        cls,
        frame: DataFrame | Dimension,
        max_rows: int = BROADCAST_ROWS,
        max_bytes: int = BROADCAST_BYTES,
    ) -> Dimension:
        """Measure once, use in several joins."""
        if isinstance(frame, Dimension):
            return frame
        return cls(frame, fits_broadcast(frame, max_rows, max_bytes))


def join_dimension(
    fact: DataFrame,
    dim: DataFrame | Dimension,
    on: Mapping[str, str],
    columns: Mapping[str, str],
    how: str = "left",
    salts: int = SALTS,
) -> DataFrame:
    """Equi join that adds dimension attributes to a fact.

    ``on`` maps fact keys to dimension keys, ``columns`` maps dimension columns
    to their names in the result; renaming lets one dimension play several
    roles.  The dimension is unique on its keys (JOIN-07); grouping it by them
    tells the optimizer, which then drops the join from queries that use none of
    the attributes, and makes sure that rows never multiply.

    A dimension measured to be small is broadcast, so the fact is not shuffled.
    A larger one is joined by shuffle.  Only keys measured to be hot are joined apart
    (``skew.skew_join``); no other row of the dimension is repeated.  Fact rows with a NULL
    key meet nothing and are not shuffled."""
    if how not in ("left", "inner"):
        raise ValueError(f"unsupported join type: {how}")
    dim = Dimension.of(dim)
    attributes = _unique(dim.frame, list(on.values()), columns)
    conditions = [F.col(f) == F.col(f"_dim_{d}") for f, d in on.items()]
    if dim.small:
        joined = fact.join(F.broadcast(attributes), conditions, how)
    else:
        joined = _join_large(fact, attributes, on, list(columns.values()), how, salts)
    return joined.drop(*[f"_dim_{key}" for key in on.values()])


def _join_large(fact, attributes, on: Mapping[str, str], added: list[str], how: str, salts: int) -> DataFrame:
    keys = list(on)
    known = F.lit(True)
    for key in keys:
        known = known & F.col(key).isNotNull()
    dim = attributes.select(*[F.col(f"_dim_{d}").alias(f) for f, d in on.items()], *added)
    present = fact.where(known)
    order = [*fact.columns, *added]
    joined = skew_join(present, dim, keys, how, hot_hashes(present, keys), salts).select(*order)
    if how == "inner":
        return joined
    types = {f.name: f.dataType for f in attributes.schema.fields}
    absent = fact.where(~known).withColumns({name: F.lit(None).cast(types[name]) for name in added})
    return joined.unionByName(absent.select(*order))


def _unique(dim: DataFrame, keys: list[str], columns: Mapping[str, str]) -> DataFrame:
    named = [F.col(key).alias(f"_dim_{key}") for key in keys]
    if not columns:
        return dim.select(*named).distinct()
    carried = F.struct(*[F.col(source).alias(name) for source, name in columns.items()])
    grouped = dim.groupBy(*named).agg(F.max(carried).alias("_carried"))
    return grouped.select(
        *[f"_dim_{key}" for key in keys], *[f"_carried.{name}" for name in columns.values()]
    )
