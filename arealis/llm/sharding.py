"""Uniform shuffle of a table into shards of exact sizes by a hypergeometric communication matrix."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arealis.llm.common import fresh, key_uniform, running_sum, staged

ROW_BITS = 33  # bits below the partition number in monotonically_increasing_id


def _ratio_sum(steps: Column, up: bool, mode: Column, marked: Column, drawn: Column, rest: Column) -> Column:
    """Sum of the weights on one side of the mode, the mode's weight being 1."""

    def step(acc: Column, i: Column) -> Column:
        k = mode + i if up else mode - i
        if up:
            weight = acc["w"] * (marked - k + 1) * (drawn - k + 1) / (k * (rest - drawn + k))
        else:
            weight = acc["w"] * (k + 1) * (rest - drawn + k + 1) / ((marked - k) * (drawn - k))
        return F.struct(weight.alias("w"), (acc["sum"] + weight).alias("sum"))

    return F.aggregate(steps, F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("sum")), step, lambda acc: acc["sum"])


def _walk(steps: Column, up: bool, mode: Column, marked: Column, drawn: Column, rest: Column, left: Column) -> Column:
    """The value at which the weights on one side of the mode have used up ``left``."""

    def step(acc: Column, i: Column) -> Column:
        k = mode + i if up else mode - i
        if up:
            weight = acc["w"] * (marked - k + 1) * (drawn - k + 1) / (k * (rest - drawn + k))
        else:
            weight = acc["w"] * (k + 1) * (rest - drawn + k + 1) / ((marked - k) * (drawn - k))
        stays = acc["left"] <= 0
        return F.struct(
            F.when(stays, acc["w"]).otherwise(weight).alias("w"),
            F.when(stays, acc["left"]).otherwise(acc["left"] - weight).alias("left"),
            F.when(stays, acc["k"]).otherwise(k).alias("k"),
        )

    return F.aggregate(steps, F.struct(F.lit(1.0).alias("w"), left.alias("left"), mode.alias("k")), step, lambda acc: acc["k"])


def hypergeometric(u: Column, marked: Column, total: Column, drawn: Column) -> Column:
    """Number of marked items among ``drawn`` of ``total``, by inversion of the uniform ``u``.

    The weights start from 1 at the mode and follow the ratio of neighbours upwards, then downwards; no factorials.
    They are summed as far as 12 standard deviations and 40 steps from the mode, beyond which they vanish in double precision.
    """
    marked, total, drawn = (c.cast("double") for c in (marked, total, drawn))
    rest = total - marked
    low, high = F.greatest(F.lit(0.0), drawn - rest), F.least(marked, drawn)
    mode = F.least(high, F.greatest(low, F.floor((drawn + 1) * (marked + 1) / (total + 2)).cast("double")))
    share = marked / F.greatest(total, F.lit(1.0))
    spread = F.sqrt(drawn * share * (1 - share)) * 12 + 40

    def side(length: Column) -> Column:
        n = F.least(length, spread).cast("long")
        return F.when(n >= 1, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<bigint>"))

    s = F.struct(u.alias("u"), marked.alias("m"), drawn.alias("d"), rest.alias("r"), mode.alias("mode"), side(high - mode).alias("up"), side(mode - low).alias("down"))

    def invert(x: Column) -> Column:
        args = (x["mode"], x["m"], x["d"], x["r"])
        above, below = _ratio_sum(x["up"], True, *args), _ratio_sum(x["down"], False, *args)
        y = F.struct(x["u"].alias("u"), above.alias("above"), below.alias("below"))

        def pick(v: Column) -> Column:
            goal = v["u"] * (1 + v["above"] + v["below"])
            return (
                F.when(goal <= 1, x["mode"])
                .when(goal <= 1 + v["above"], _walk(x["up"], True, *args, goal - 1))
                .otherwise(_walk(x["down"], False, *args, goal - 1 - v["above"]))
            )

        return F.element_at(F.transform(F.array(y), pick), 1)

    return F.element_at(F.transform(F.array(s), invert), 1).cast("long")


def _split(caps: Column, drawn: Column, seed: Column) -> Column:
    """Draw how many of ``drawn`` rows go to each shard when the shards have room for ``caps`` (multivariate hypergeometric)."""

    def step(acc: Column, i: Column) -> Column:
        cap = F.element_at(caps, (i + 1).cast("int"))
        take = hypergeometric(key_uniform(seed, i), cap, acc["room"], acc["left"])
        one = F.struct(take.alias("take"), cap.alias("cap"), acc["left"].alias("left"), acc["room"].alias("room"), acc["out"].alias("out"))
        return F.element_at(
            F.transform(
                F.array(one),
                lambda x: F.struct((x["left"] - x["take"]).alias("left"), (x["room"] - x["cap"]).alias("room"), F.concat(x["out"], F.array(x["take"])).alias("out")),
            ),
            1,
        )

    room = F.aggregate(caps, F.lit(0).cast("long"), lambda a, c: a + c)
    start = F.struct(drawn.cast("long").alias("left"), room.alias("room"), F.array().cast("array<bigint>").alias("out"))
    return F.aggregate(F.sequence(F.lit(0), F.size(caps) - 1), start, step, lambda acc: acc["out"])


def communication_matrix(counts: DataFrame, shards: int, rows: int, seed: int, depth: int) -> DataFrame:
    """Draw how many rows each partition sends to each shard: columns ``part`` and ``sends`` (array of longs).

    Row sums are the partitions' counts and column sums are the shard sizes, which differ by one at most; every such
    matrix is as likely as under a uniform permutation.  ``counts`` has ``part`` and ``n``.  Partitions are the leaves of
    a binary tree ``depth`` levels deep; each level splits every node's room for each shard among its two halves, so the
    levels follow each other but the nodes of a level are drawn side by side.
    """
    spark = counts.sparkSession
    caps = F.array(*[F.lit((rows + shards - 1 - s) // shards).cast("long") for s in range(shards)])
    nodes = spark.range(1).select(F.col("id").alias("node"), caps.alias("caps"))
    for level in range(1, depth + 1):
        sizes = counts.groupBy(F.shiftright("part", depth - level + 1).alias("node")).agg(
            F.sum(F.when(F.shiftright("part", depth - level).bitwiseAND(1) == 0, F.col("n")).otherwise(0)).alias("first")
        )
        drawn = nodes.join(sizes, "node").withColumn("half", _split(F.col("caps"), F.col("first"), F.xxhash64(F.lit(seed), F.lit(level), F.col("node"))))
        other = F.zip_with("caps", "half", lambda a, b: a - b)
        halves = F.array(F.struct((F.col("node") * 2).alias("node"), F.col("half").alias("caps")), F.struct((F.col("node") * 2 + 1).alias("node"), other.alias("caps")))
        nodes = drawn.select(F.inline(halves))
        if level % 3 == 0 or level == depth:
            nodes = staged(nodes)
    return nodes.select(F.col("node").alias("part"), F.col("caps").alias("sends"))


def shard_uniformly(df: DataFrame, shards: int, seed: int = 0, bucket_rows: int = 1 << 15) -> DataFrame:
    """Deal all rows to ``shards`` shards by a uniform random permutation; shard sizes differ by one at most.

    Adds ``shard`` (int, from 0) and ``slot`` (long, the row's place in its shard, gapless from 0); an input column of
    either name is replaced.  Each input partition permutes its rows, sends as many to each shard as the communication
    matrix says, and each shard permutes what it got: its rows are dealt to steps of a second random key, so a shard
    is spread over many tasks.

    Every row counts, repeated rows and rows of nulls too.  An empty table gives an empty result.  The rows with their
    partition numbers are staged once, so a lost executor or another layout of the scan cannot change the outcome; a
    rerun over the same files and settings gives the same shards.  More shards than rows leave shards empty.
    """
    if shards < 1:
        raise ValueError("shards must be at least 1")
    df = df.drop("shard", "slot")
    row, part, place, second, one, before = fresh(df, "row", "part", "place", "second", "one", "before")
    numbered = df.withColumn(row, F.monotonically_increasing_id())
    numbered = numbered.withColumn(part, F.shiftrightunsigned(F.col(row), ROW_BITS).cast("long"))
    # the local permutation: no exchange, each partition sorts its own rows by a random key
    mixed = numbered.sortWithinPartitions(F.xxhash64(F.lit(seed), F.lit("local"), F.col(row)), row)
    kept = staged(mixed.withColumn(place, F.monotonically_increasing_id().bitwiseAND(F.lit((1 << ROW_BITS) - 1))))
    counts = staged(kept.groupBy(F.col(part).alias("part")).agg(F.count(F.lit(1)).alias("n")))
    rows, last = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("part"), F.lit(0))).first()
    matrix = communication_matrix(counts, shards, rows, seed, max(0, int(last).bit_length()))
    # ends[s]: the first place of a partition's rows that goes beyond shard s
    ends = F.aggregate("sends", F.array().cast("array<bigint>"), lambda acc, x: F.concat(acc, F.array(x + F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(0)))))
    matrix = matrix.select(F.col("part").alias(second), ends.alias(one))
    sent = kept.join(matrix, F.col(part) == F.col(second)).withColumn("shard", F.size(F.filter(one, lambda e: e <= F.col(place))).cast("int")).drop(second, one)
    order = key_uniform(seed, "shard", F.col(row))
    counted = running_sum(sent.withColumn(one, F.lit(1)), ["shard"], order, one, "slot", -(-rows // shards), bucket_rows, [row])
    return counted.drop(row, part, place, one, before)
