"""Column expressions and table helpers that the corpus operators share."""

from __future__ import annotations

import string
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from arealis.session import ensure_checkpoint_dir

WORD = r"[^\x20\x09-\x0D]+"
SHINGLE_WORDS = 5


def text_of(col: str | Column) -> Column:
    """The text, with null read as the empty text."""
    return F.coalesce((F.col(col) if isinstance(col, str) else col).cast("string"), F.lit(""))


def lower_ascii(col: Column) -> Column:
    """Lower-case A-Z alone; other letters stay as they are."""
    return F.translate(col, string.ascii_uppercase, string.ascii_lowercase)


def words(col: Column) -> Column:
    return F.regexp_extract_all(col, F.lit(WORD), F.lit(0))


def word_count(col: Column) -> Column:
    return F.regexp_count(col, F.lit(WORD)).cast("long")


def key_uniform(*parts: Column | int | str) -> Column:
    """A uniform in [0, 1) from 53 bits of a 64-bit hash of the parts."""
    cols = [p if isinstance(p, Column) else F.lit(p) for p in parts]
    return F.shiftrightunsigned(F.xxhash64(*cols), 11).cast("double") / F.lit(float(2**53))


def fresh(df: DataFrame, *stems: str) -> list[str]:
    """Names that no column of ``df`` bears (case ignored), one for each stem."""
    taken = {c.lower() for c in df.columns}
    out = []
    for stem in stems:
        name = f"__{stem}"
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def staged(df: DataFrame) -> DataFrame:
    """Write a table once to the shared checkpoint folder and read it back.

    Cuts lineage like a checkpoint, but stays columnar and compressed, and its size is known to the optimizer.
    The files live as long as the checkpoint folder.
    """
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/staged-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema])).parquet(path)


def small_side(df: DataFrame, rows: int, row_bytes: int, limit_bytes: int = 32 << 20) -> DataFrame:
    """Mark a counted table for broadcast while ``rows * row_bytes`` is within the limit; beyond it the join shuffles."""
    return F.broadcast(df) if rows * row_bytes <= limit_bytes else df


def running_sum(df: DataFrame, group: list[str], order: Column, value: str, out: str, rows: int, bucket_rows: int = 1 << 15, ties: list[str] | None = None) -> DataFrame:
    """Add ``out``: the sum of ``value`` over the rows of the group that stand before this one.

    ``order`` is a uniform in [0, 1) that depends on the row alone.  Rows are dealt to equal steps of it, as many as
    ``rows`` asks for, so that a group that holds most of the table is spread over many tasks; a small table of bucket
    sums carries the offsets.  ``ties`` order rows of the same key.  The input must give the same rows each time it is read.
    """
    buckets = max(1, -(-rows // bucket_rows))
    key, b, before, first = fresh(df, "key", "bucket", "before", "first")
    keyed = df.withColumn(key, order).withColumn(b, F.floor(F.col(key) * buckets).cast("int"))
    by = [quoted(g) for g in group]
    sums = keyed.groupBy(*by, b).agg(F.sum(quoted(value)).alias(before))
    prefix = Window.partitionBy(*by).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn(first, F.coalesce(F.sum(before).over(prefix), F.lit(0))).drop(before)
    sums = sums.select(*[quoted(g).alias(f"{first}{i}") for i, g in enumerate(group)], F.col(b).alias(f"{first}b"), first)
    inside = Window.partitionBy(*by, b).orderBy(key, *[quoted(t) for t in ties or []]).rowsBetween(Window.unboundedPreceding, -1)
    ranked = keyed.withColumn(before, F.coalesce(F.sum(quoted(value)).over(inside), F.lit(0)))
    same = F.col(b) == F.col(f"{first}b")
    for i, g in enumerate(group):
        same = same & quoted(g).eqNullSafe(F.col(f"{first}{i}"))
    joined = ranked.join(sums, same, "left")
    return joined.withColumn(out, (F.col(before) + F.col(first)).cast("long")).drop(key, b, before, first, f"{first}b", *[f"{first}{i}" for i in range(len(group))])
