"""Mixing sources to target weights along a time-varying curriculum."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from arealis.functions.rng import uniform
from arealis.llm.common import fresh, quoted, running_sum, word_count

# multiplier of a source's rate at points of the training time, by weight class: heavy sources first, light ones late
FALLING, EVEN, RISING = ((0.0, 1.5), (0.5, 1.0), (1.0, 0.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.5), (0.5, 1.0), (1.0, 1.5))


def source_targets(sources: DataFrame, weights: tuple[int, ...] = (5, 2, 1), cap: int = 3) -> DataFrame:
    """Share all words among sources by weight; no source gives more than ``cap`` times what it has.

    ``sources`` has one row per ``source`` with ``source_size``.  Sources in order of code points, null last, take the
    weights in turn.  What lies above a cap is shared again by weight until none is above: with the sources ordered by
    size per weight the capped ones come first, and the level of the rest is what remains per unit of weight.  Adds
    ``weight_class``, ``weight`` and ``target``.  This table of one row per source is the only thing that is ordered in
    one task.  Sources without words get the target 0.
    """
    everything = Window.partitionBy()
    named = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sources.withColumn("weight_class", (F.row_number().over(named) - 1) % len(weights))
    ranked = ranked.withColumn("weight", F.element_at(F.array(*[F.lit(int(w)) for w in weights]), F.col("weight_class") + 1).cast("long"))
    by_need = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before = F.coalesce(F.sum("source_size").over(by_need.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    onward = F.sum("weight").over(by_need.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    levels = ranked.withColumn("level", (F.sum("source_size").over(everything) - cap * before) / onward)
    free = F.when(F.col("weight") * F.col("level") <= cap * F.col("source_size"), F.col("level"))
    target = F.least(F.col("weight") * F.max(free).over(everything), (cap * F.col("source_size")).cast("double"))
    return levels.withColumn("target", target).drop("level")


def time_of(share: Column, weight_class: Column, schedules: tuple) -> Column:
    """Training time at which a source has met ``share`` of its demand.

    A schedule is a broken line through (time, rate); its integral is a quadratic on each piece, which is inverted.
    """
    out = F.lit(None).cast("double")
    for cls, line in reversed(list(enumerate(schedules))):
        areas = [(t1 - t0) * (r0 + r1) / 2 for (t0, r0), (t1, r1) in zip(line, line[1:], strict=False)]
        total, met, pieces = sum(areas), 0.0, []
        for ((t0, r0), (t1, r1)), area in zip(zip(line, line[1:], strict=False), areas, strict=True):
            more = share * total - F.lit(met)
            bend = (r1 - r0) / (2 * (t1 - t0))
            root = F.sqrt(F.greatest(F.lit(r0 * r0) + 4 * bend * more, F.lit(0.0)))
            met += area
            pieces.append((met / total, F.lit(t0) + F.when(more <= 0, F.lit(0.0)).otherwise(2 * more / (F.lit(r0) + root))))
        piece = pieces[-1][1]
        for end, value in reversed(pieces[:-1]):
            piece = F.when(share <= end, value).otherwise(piece)
        out = F.when(weight_class == cls, piece).otherwise(out)
    return out


def plan_mix(df: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id", weights: tuple[int, ...] = (5, 2, 1), cap: int = 3, schedules: tuple = (FALLING, EVEN, RISING), seed: str = "mix", bucket_rows: int = 1 << 15, words: str | None = None) -> DataFrame:
    """Plan how often each document is read, how many of its words each time and at what training time.

    The documents of a source stand in a random order that depends on the seed and the row alone and repeats as often as
    the target asks.  The words of a source are numbered along this order; the reading that crosses the target ends there,
    so a source gives the whole words of its target exactly.  A reading's time is where the integral of the source's
    schedule reaches the middle of its words.

    Adds ``size`` (words; null text: 0), ``source_size``, ``target``, ``visits`` (array of ``time`` and ``words``, empty
    where the document is not read) and ``taken``.  ``words`` names a column that holds the number of words already; then
    no text is read.  Rows of the same key and size are read one after the other; a null
    source is a source of its own; documents without words are not read; an empty table gives an empty result.
    """
    if len(schedules) != len(weights):
        raise ValueError("one schedule for each weight")
    counted = word_count(quoted(text).cast("string")) if words is None else quoted(words).cast("long")
    (held,) = fresh(df, "size")
    df = df.withColumn(held, F.coalesce(counted, F.lit(0).cast("long"))).drop("size", "source_size", "target", "visits", "taken")
    name, start, cls = fresh(df, "source", "start", "class")
    sized = df.withColumnRenamed(held, "size")
    sources = sized.groupBy(quoted(source).alias("source")).agg(F.sum("size").alias("source_size"))
    targets = source_targets(sources, weights, cap).select(F.col("source").alias(name), "source_size", F.col("weight_class").alias(cls), "target")
    order = uniform(seed, quoted(key), quoted(source), F.col("size"))
    placed = running_sum(sized, [source], order, "size", start, df.count(), bucket_rows, [key, "size"])
    mixed = placed.join(targets, quoted(source).eqNullSafe(F.col(name)), "left")
    whole = F.floor("target")

    def visit(epoch: Column) -> Column:
        first = epoch * F.col("source_size") + F.col(start)
        taken = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), whole - first))
        time = time_of((first + taken / 2) / F.col("target"), F.col(cls), schedules)
        return F.struct(time.alias("time"), taken.alias("words"))

    visits = F.filter(F.array(*[visit(F.lit(e)) for e in range(cap)]), lambda v: v["words"] > 0)
    mixed = mixed.withColumn("visits", visits)
    return mixed.withColumn("taken", F.aggregate("visits", F.lit(0).cast("long"), lambda a, v: a + v["words"])).drop(name, start, cls)


def training_order(planned: DataFrame, key: str = "doc_id", bucket_rows: int = 1 << 15) -> DataFrame:
    """Add ``time``, the training time of a document's first reading, and ``position``, its place among the first readings.

    Positions are gapless from 0 and null for documents that are not read; ties of time are ordered by key and size.  Readings
    are dealt to equal steps of time, which the curriculum fills evenly, so no task holds more than a step.
    """
    planned = planned.drop("time", "position").withColumn("time", F.try_element_at("visits", F.lit(1))["time"])
    (one,) = fresh(planned, "one")
    read = planned.where("time is not null").withColumn(one, F.lit(1).cast("long"))
    placed = running_sum(read, [], F.col("time"), one, "position", read.count(), bucket_rows, [key, "size"]).drop(one)
    return placed.unionByName(planned.where("time is null").withColumn("position", F.lit(None).cast("long")))


def lay_out(planned: DataFrame, text: str = "text") -> DataFrame:
    """The readings of a planned mix in training order: one row per reading, with ``time``; a reading that its source's target ends is cut after its last word."""
    read, cut = fresh(planned, "read", "cut")
    rows = planned.withColumn(read, F.explode("visits"))
    pieces = F.slice(F.split(quoted(text), r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])"), F.lit(1), F.col(f"{read}.words").cast("int"))
    rows = rows.withColumn(cut, F.when(F.col(f"{read}.words") < F.col("size"), F.array_join(pieces, "")).otherwise(quoted(text)))
    rows = rows.withColumn("time", F.col(f"{read}.time")).withColumn(text, F.col(cut)).drop(read, cut)
    return rows.orderBy("time")
