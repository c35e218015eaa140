"""A uniform shuffle into shards of exact size, by a communication matrix.

Rows are permuted in their partitions; the matrix says how many of each partition go to
each shard and is drawn from the law that a uniform shuffle of all rows would give it
(multivariate hypergeometric); the exchange follows it, and each shard is permuted again.
Everything is DataFrame work: a draw walks the ratios of neighbouring probabilities out
from the mode, so it needs no factorials."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from contrail.llm.common import free_name
from contrail.session import stage

#: A draw looks this many standard deviations to each side: what lies beyond is below the
#: smallest share that a double tells from nothing.
REACH = 12.0
#: Segments of a level that one task draws for; a level is a small table.
TASK_SEGMENTS = 32
#: Rows of a shard that are put in order together.
BLOCK_ROWS = 20_000


def _uniform(seed: int, *of: Column) -> Column:
    """A number in (0, 1) from a hash."""
    return (F.shiftrightunsigned(F.xxhash64(F.lit(seed), *of), 11).cast("double") + 0.5) / F.lit(float(1 << 53))


def hypergeometric(total: Column, marked: Column, drawn: Column, uniform: Column) -> Column:
    """How many marked ones are among ``drawn`` of ``total``, by inverting the distribution.

    All are longs.  The support is walked from the mode to both sides by the ratio of
    neighbouring weights, then the cumulated weights are compared with ``uniform``."""
    n, k, m = total.cast("double"), marked.cast("double"), drawn.cast("double")
    least = F.greatest(F.lit(0).cast("long"), drawn + marked - total)
    most = F.least(drawn, marked)
    mode = F.least(most, F.greatest(least, F.floor((m + 1) * (k + 1) / (n + 2)).cast("long")))
    spread = F.sqrt(m * (k / n) * (1 - k / n) * F.greatest(F.lit(0.0), n - m) / F.greatest(F.lit(1.0), n - 1))
    reach = F.ceil(F.lit(REACH) * (spread + 4)).cast("long")
    low, high = F.greatest(least, mode - reach), F.least(most, mode + reach)

    def up(x: Column) -> Column:
        return (k - x + 1) * (m - x + 1) / (x * (n - k - m + x))

    def down(x: Column) -> Column:
        return (x + 1) * (n - k - m + x + 1) / ((k - x) * (m - x))

    def walk(values: Column, ratio, goal: Column) -> Column:
        """Weights along ``values``, the mode having weight 1: their sum with the mode's, and
        how many values end below ``goal``.  ``sum`` lags one value behind, so that a step
        works out its ratio once."""
        state = [F.lit(1.0).alias("w"), F.lit(0.0).alias("sum"), F.lit(-1).cast("long").alias("passed"), goal.alias("goal")]

        def step(a: Column, w: Column) -> Column:
            below = F.when(a["sum"] + a["w"] < a["goal"], 1).otherwise(0)
            return F.struct(
                w.alias("w"), (a["sum"] + a["w"]).alias("sum"), (a["passed"] + below).alias("passed"),
                a["goal"].alias("goal"),
            )

        return F.aggregate(
            values,
            F.struct(*state),
            lambda a, x: step(a, a["w"] * ratio(x.cast("double"))),
            lambda a: step(a, F.lit(0.0)),
        )

    none = F.array().cast("array<long>")
    above = F.when(high > mode, F.sequence(mode + 1, high)).otherwise(none)
    below = F.when(mode > low, F.sequence(mode - 1, low, F.lit(-1).cast("long"))).otherwise(none)

    # The values in the order mode, above, below; the first whose running sum reaches the goal.
    def found(sums: Column) -> Column:
        goal = uniform * (sums["up"] + sums["down"] - 1.0)
        over = F.least(high, mode + 1 + walk(above, up, goal)["passed"])
        under = F.greatest(low, mode - 1 - walk(below, down, goal - sums["up"] + 1.0)["passed"])
        return (
            F.when(goal <= 1.0, mode)
            .when((goal <= sums["up"]) & (high > mode), over)
            .when(mode > low, under)
            .otherwise(F.least(high, over))
        )

    sums = F.struct(
        walk(above, up, F.lit(0.0))["sum"].alias("up"), walk(below, down, F.lit(0.0))["sum"].alias("down")
    )
    # A lambda variable is worked out once, however often it is used.
    drawn_number = F.transform(F.array(sums), found)[0]
    return F.when(n <= 0, F.lit(0).cast("long")).otherwise(drawn_number)


def communication_matrix(counts: DataFrame, shards: int, seed: int) -> DataFrame:
    """Rows of each partition that go to each shard: ``part, rows, shares`` (array of long).

    ``counts`` has ``part`` (from 0, gapless) and ``rows``.  A segment of partitions is
    halved until it is one partition; at each halving the rows of the left half are drawn
    from what the segment holds for each shard.  All segments of a level are drawn at once."""
    spark = counts.sparkSession
    row = counts.agg(F.count("*").alias("parts"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")).first()
    levels = max(0, math.ceil(math.log2(max(1, row["parts"]))))
    held = [row["rows"] // shards + (1 if s < row["rows"] % shards else 0) for s in range(shards)]
    tree = spark.range(1).select(
        F.lit(0).cast("long").alias("node"), F.array(*[F.lit(h).cast("long") for h in held]).alias("shares")
    )
    for level in range(1, levels + 1):
        height = levels - level
        sizes = counts.groupBy(F.shiftright(F.col("part").cast("long"), height).alias("half")).agg(
            F.sum("rows").alias("rows")
        )
        left = sizes.filter("half % 2 = 0").select(F.shiftright("half", 1).alias("node"), "rows")
        both = tree.join(left, "node", "left").withColumn("rows", F.coalesce("rows", F.lit(0).cast("long")))
        both = both.coalesce(max(1, 2 ** (level - 1) // TASK_SEGMENTS))
        # Shard by shard: of what is left of the segment, so much is this shard's.  Each draw
        # is a column of its own, so that no later one works it out again.
        both = both.withColumns(
            {"_total": F.aggregate("shares", F.lit(0).cast("long"), lambda a, x: a + x), "_drawn": F.col("rows")}
        )
        for s in range(shards):
            share = F.col("shares")[s]
            both = both.withColumn(
                f"_got{s}",
                hypergeometric(
                    F.col("_total"), share, F.col("_drawn"), _uniform(seed, F.lit(level), F.col("node"), F.lit(s))
                ),
            )
            both = both.withColumns({"_total": F.col("_total") - share, "_drawn": F.col("_drawn") - F.col(f"_got{s}")})
        got = F.array(*[F.col(f"_got{s}") for s in range(shards)])
        kept = F.array(*[F.col("shares")[s] - F.col(f"_got{s}") for s in range(shards)])
        halves = both.select(
            F.explode(
                F.array(
                    F.struct((F.col("node") * 2).alias("node"), got.alias("shares")),
                    F.struct((F.col("node") * 2 + 1).alias("node"), kept.alias("shares")),
                )
            ).alias("half")
        ).select("half.*")
        tree, _ = stage(halves, "matrix-level")
    return counts.join(tree.withColumnRenamed("node", "part"), "part").select("part", "rows", "shares")


def shuffle_to_shards(df: DataFrame, shards: int, seed: int = 20_240_101) -> DataFrame:
    """Add ``shard`` (from 0) and ``slot`` (gapless from 0 in each shard) to every row.

    Every assignment of rows to shards of equal size (at most one apart) and every order in
    them is equally likely, as far as Spark's generator allows.  Nulls, empty texts and
    repeated rows are rows like any other; no rows give no rows.  Other columns pass
    through; ``shard`` and ``slot`` may not be among them.  ``df`` is written once to the
    shared folder with its random numbers, so a lost executor cannot change the draw; then
    one shuffle of the rows."""
    for name in ("shard", "slot"):
        if name in df.columns:
            raise ValueError(f"the input already has a column {name}")
    if shards < 1:
        raise ValueError("at least one shard")
    part, rank, order = (free_name(df, c) for c in ("_part", "_rank", "_order"))
    local = free_name(df, "_local")
    # Permuted in the partition: the running number after the sort is the place there.
    mixed = df.withColumns({local: F.rand(seed), order: F.rand(seed + 1)}).sortWithinPartitions(local)
    number = F.monotonically_increasing_id()
    placed = mixed.withColumn(rank, number).drop(local)
    placed = placed.withColumns(
        {part: F.shiftright(rank, 33).cast("int"), rank: F.col(rank).bitwiseAND(F.lit((1 << 33) - 1))}
    )
    table, _ = stage(placed, "shard-rows")
    counts = table.groupBy(F.col(part).alias("part")).agg(F.count("*").alias("rows"))
    # Gapless numbers for the partitions that have rows: a table of one row per partition.
    counts, _ = stage(counts, "shard-counts")
    parts = counts.agg(F.max("part")).first()[0]
    counts = counts.sparkSession.range(0 if parts is None else parts + 1).select(
        F.col("id").alias("part")
    ).join(counts, "part", "left").select("part", F.coalesce("rows", F.lit(0).cast("long")).alias("rows"))
    matrix, _ = stage(communication_matrix(counts, shards, seed), "shard-matrix")
    ends = matrix.select(
        F.col("part").cast("int").alias(part),
        F.array(*[
            F.aggregate(F.slice("shares", 1, s + 1), F.lit(0).cast("long"), lambda a, x: a + x) for s in range(shards)
        ]).alias("_ends"),
    )
    routed = table.join(ends, part)
    routed = routed.withColumn(
        "shard", F.size(F.filter("_ends", lambda e: e <= F.col(rank))).cast("int")
    ).drop("_ends", part, rank)
    return _permute(routed, order)


def _permute(df: DataFrame, order: str) -> DataFrame:
    """Place in the shard by the random number ``order``: its range falls into blocks, rows
    are numbered in their block, and the blocks before it are added."""
    rows = df.groupBy("shard").count().agg(F.max("count")).first()[0] or 0
    blocks = max(1, math.ceil(rows / BLOCK_ROWS))
    block = free_name(df, "_block")
    cut = df.withColumn(block, F.least(F.lit(blocks - 1), F.floor(F.col(order) * blocks)).cast("int"))
    sizes = cut.groupBy("shard", block).agg(F.count("*").alias("_n"))
    before = Window.partitionBy("shard").orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("shard", block, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    in_block = Window.partitionBy("shard", block).orderBy(order)
    return (
        cut.withColumn("slot", F.row_number().over(in_block).cast("long") - 1)
        .join(sizes, ["shard", block])
        .withColumn("slot", F.col("slot") + F.col("_before"))
        .drop("_before", block, order)
    )
