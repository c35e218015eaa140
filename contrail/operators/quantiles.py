"""Exact interpolated quantiles by distributed rank selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from contrail.session import discard, stage

#: Relative rank error of the sketch is the inverse: of all groups together, and of each of many.
ACCURACY, GROUP_ACCURACY = 10_000, 1_000
#: Cuts of a bracket that is narrowed again.
CUTS = 64
#: Rows of a bracket that are sorted to pick from.
SMALL_BRACKET = 10_000
#: Brackets are broadcast up to so many rows, and beyond that meet the values by shuffle.
BROADCAST_BRACKETS = 100_000


def exact_quantiles(df: DataFrame, value: str, qs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """``(by.., q, value)`` with linear interpolation at rank ``q * (n - 1)``.

    1. The values are stored once, as narrow rows; no value is shuffled later on.
    2. A mergeable sketch per group gives cuts close to each wanted rank.
    3. Rows between the cuts are counted exactly, which names the bracket of each rank: a single
       value, or the values strictly between two cuts, whatever the sketch got wrong.
    4. Brackets with many rows are cut again; small ones are sorted and picked from.

    Every step is an aggregate that combines where the rows are.  A task sees cuts, counts per
    cut and at most ``SMALL_BRACKET`` values of a rank, however the values are spread: many equal
    ones form a bracket of their own.  NULL and NaN are left out, NULL groups are a group; an empty
    input gives no rows."""
    spark = df.sparkSession
    keys = [f"_by{i}" for i in range(len(by))] or ["_by0"]
    # Without groups a stored constant is the key: all joins below are equal joins.
    grouping = [F.col(c).alias(k) for c, k in zip(by, keys)] or [F.lit(0).alias("_by0")]
    v = F.col(value).cast("double")
    scratch: list[str] = []

    def kept(frame: DataFrame, label: str) -> DataFrame:
        staged, path = stage(frame, label)
        scratch.append(path)
        return staged

    try:
        rows = kept(df.where(v.isNotNull() & ~F.isnan(v)).select(*grouping, v.alias("v")), "quantile-values")
        accuracy = GROUP_ACCURACY if by else ACCURACY
        near = sorted({min(1.0, max(0.0, q + d / accuracy)) for q in qs for d in (-2, 0, 2)})
        summary = kept(
            rows.groupBy(*keys).agg(F.count("v").alias("size"), F.percentile_approx("v", near, accuracy).alias("cuts")),
            "quantile-cuts",
        )
        ranks = [F.lit(float(q)) * (F.col("size") - 1) for q in qs]
        ends = [f(r).cast("long") for r in ranks for f in (F.floor, F.ceil)]
        brackets = summary.select(
            *keys, F.explode(F.array_distinct(F.array(*ends))).alias("k"), F.lit(float("-inf")).alias("lo"),
            F.lit(float("inf")).alias("hi"), F.lit(0).cast("long").alias("below"), "size",
        )
        brackets = kept(_narrowed(rows, brackets, summary.select(*keys, "cuts"), keys), "quantile-brackets")
        while not (wide := brackets.where((F.col("size") > SMALL_BRACKET) & (F.col("lo") < F.col("hi")))).isEmpty():
            # Ranks that share a bracket are cut together.
            distinct = wide.select(*keys, "lo", "hi").distinct()
            evenly = [i / CUTS for i in range(CUTS + 1)]
            cuts = _inside(rows, distinct, keys).groupBy(*keys, "lo", "hi").agg(
                F.percentile_approx("v", evenly, ACCURACY).alias("cuts")
            )
            cuts = kept(cuts, "quantile-cuts")
            again = _narrowed(rows, wide, cuts, [*keys, "lo", "hi"])
            others = brackets.where((F.col("size") <= SMALL_BRACKET) | (F.col("lo") >= F.col("hi")))
            brackets = kept(others.unionByName(again), "quantile-brackets")
        return _interpolated(spark, rows, brackets, summary, keys, by, qs)
    finally:
        for path in scratch:
            discard(spark, path)


def _met(brackets: DataFrame) -> DataFrame:
    return F.broadcast(brackets) if brackets.count() <= BROADCAST_BRACKETS else brackets


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    condition = F.lit(True)
    for key in keys:
        condition = condition & left[key].eqNullSafe(right[key])
    return condition


def _inside(rows: DataFrame, brackets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each value with every bracket of its group that holds it."""
    held = (rows["v"] >= brackets["lo"]) & (rows["v"] <= brackets["hi"])
    joined = rows.join(_met(brackets), _same(rows, brackets, keys) & held)
    return joined.drop(*[brackets[k] for k in keys])


def _narrowed(rows: DataFrame, brackets: DataFrame, cuts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The brackets of the same ranks after ``cuts`` (one array per ``keys``): rows are counted at
    and between the cuts, and the part that reaches the rank is the new bracket."""
    group = [k for k in keys if k.startswith("_by")]
    ranged = "lo" in keys
    cuts = cuts.withColumn("cuts", F.array_sort(F.array_distinct("cuts")))
    held = _same(rows, cuts, group)
    if ranged:
        held = held & (rows["v"] >= cuts["lo"]) & (rows["v"] <= cuts["hi"])
    met = rows.join(_met(cuts), held).drop(*[cuts[k] for k in group])
    below = F.size(F.filter("cuts", lambda c: c < F.col("v")))
    part = 2 * below + F.array_contains("cuts", F.col("v")).cast("int")
    parts = met.groupBy(*keys, part.alias("part")).agg(F.count("v").alias("n"), F.min("v").alias("least"), F.max("v").alias("most"))
    # At most two parts per cut and one more.
    listed = parts.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("part", "n", "least", "most"))).alias("parts"))
    joined = brackets.join(listed, _same(brackets, listed, keys)).drop(*[listed[k] for k in keys])
    start = F.struct(
        F.col("below").alias("seen"), F.lit(0.0).alias("lo"), F.lit(0.0).alias("hi"),
        F.lit(0).cast("long").alias("below"), F.lit(0).cast("long").alias("size"),
    )

    def step(a: Column, p: Column) -> Column:
        seen = (a["seen"] + p["n"]).alias("seen")
        reached = (a["size"] == 0) & (F.col("k") < a["seen"] + p["n"])
        here = F.struct(seen, p["least"].alias("lo"), p["most"].alias("hi"), a["seen"].alias("below"), p["n"].alias("size"))
        return F.when(reached, here).otherwise(F.struct(seen, *[a[c].alias(c) for c in ("lo", "hi", "below", "size")]))

    found = joined.withColumn("found", F.aggregate("parts", start, step))
    return found.select(*group, "k", *[F.col(f"found.{c}").alias(c) for c in ("lo", "hi", "below", "size")])


def _interpolated(spark, rows, brackets, summary, keys, by, qs) -> DataFrame:
    single = brackets.where("lo = hi").select(*keys, "k", F.col("lo").alias("v"))
    small = brackets.where("lo < hi").select(*keys, "k", "lo", "hi", "below")
    picked = (
        _inside(rows, small, keys)
        .groupBy(*keys, "k", "below")
        .agg(F.array_sort(F.collect_list("v")).alias("sorted"))
        .select(*keys, "k", F.element_at("sorted", (F.col("k") - F.col("below") + 1).cast("int")).alias("v"))
    )
    values = single.unionByName(picked)
    rank = F.col("q") * (F.col("size") - 1)
    wanted = summary.select(*keys, "size", F.explode(F.array(*[F.lit(float(q)) for q in qs])).alias("q"))
    ends = wanted.withColumns({"fraction": rank - F.floor(rank), "k": F.explode(F.array_distinct(F.array(F.floor(rank), F.ceil(rank))))})
    low, high = F.min("v"), F.max("v")
    met = ends.join(values, _same(ends, values, [*keys, "k"])).drop(*[values[k] for k in [*keys, "k"]])
    result = met.groupBy(*keys, "q").agg((low + (high - low) * F.max("fraction")).alias("value"))
    named = [F.col(k).alias(c) for c, k in zip(by, keys)]
    # A row per group and quantile; stored, since what it comes from is cleared.
    return stage(result.select(*named, "q", "value"), "quantiles")[0]
