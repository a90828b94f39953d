"""Benchmark decontamination: short test items inside long documents, by exact shingle containment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from arealis.llm.common import SHINGLE_WORDS, lower_ascii, quoted, small_side, staged, text_of, words

THRESHOLD_PERCENT = 80


def _starts(listed: str) -> Column:
    """Places at which the shingles of a word list begin; a list of fewer words is one shingle."""
    return F.expr(f"if(size({listed}) = 0, cast(array() as array<int>), sequence(0, greatest(size({listed}) - {SHINGLE_WORDS}, 0)))")


def _hash_at(listed: str, at: str) -> Column:
    return F.xxhash64(*[F.expr(f"get({listed}, {at} + {i})") for i in range(SHINGLE_WORDS)])


def _shingle_at(listed: str, at: str) -> Column:
    return F.expr(f"array_join(slice({listed}, {at} + 1, {SHINGLE_WORDS}), ' ')")


def item_shingles(items: DataFrame, item: str, text: str) -> DataFrame:
    """Distinct shingles of each item: ``item``, ``shingle``, ``code`` (its hash) and ``n_item`` (how many the item has)."""
    listed = items.select(quoted(item).alias("item"), words(lower_ascii(text_of(quoted(text)))).alias("w"))
    rows = listed.select("item", "w", F.explode(_starts("w")).alias("at")).select("item", _shingle_at("w", "at").alias("shingle"), _hash_at("w", "at").alias("code")).distinct()
    return rows.withColumn("n_item", F.count(F.lit(1)).over(Window.partitionBy("item")))


def size_partitioned_sketches(shingles: DataFrame, percent: int = THRESHOLD_PERCENT, seed: int = 7) -> DataFrame:
    """MinHash sketch of each item: its least shingles under a hashed order, as many as its size partition needs.

    Items are partitioned by the power of two of their size.  In a partition whose largest item has u shingles, a sketch
    holds u - ceil(percent * u / 100) + 1 of them (all, if the item has fewer): a document that lacks them all lacks too
    many of the item, so no document with the asked containment is missed.
    """
    sized = shingles.withColumn("part", F.floor(F.log2("n_item")).cast("int"))
    largest = sized.groupBy("part").agg(F.max("n_item").alias("u"))
    length = F.expr(f"u - (({percent} * u + 99) div 100) + 1")
    least = Window.partitionBy("item").orderBy(F.xxhash64(F.lit(seed), F.col("code")), "shingle")
    ranked = sized.withColumn("rank", F.row_number().over(least)).join(largest, "part")
    return ranked.where(F.col("rank") <= length).select("code", "item", F.expr(f"({percent} * n_item + 99) div 100").alias("needed"))


def contained_items(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", percent: int = THRESHOLD_PERCENT) -> DataFrame:
    """Pairs of document and item where the document holds at least ``percent`` of the item's distinct five-word shingles.

    Returns ``id`` (the key), ``hash`` (of the text: with the key it names the rows), ``item``, ``n_item``, ``n_shared``.
    Words are lower-cased in A-Z.  A document that has a sketch value of an item and is large enough for it is a
    candidate; candidates are counted on the shingles themselves.  The sketches are broadcast while their counted size is
    small, else joined by a shuffle.

    Null or wordless texts and items match nothing; a text of fewer than five words is one shingle; repeated items give
    a pair each, repeated rows one pair together; rows of one key with different texts are judged apart, a null key is
    kept; an empty table gives an empty result.  Other columns are ignored.
    """
    shingles = staged(item_shingles(items, item, item_text))
    n = shingles.count()
    sketches = staged(size_partitioned_sketches(shingles, percent))
    m = sketches.count()
    base = docs.select(quoted(key).alias("id"), text_of(quoted(text)).alias("text"))
    listed = base.select("id", F.xxhash64("text").alias("hash"), words(lower_ascii(F.col("text"))).alias("w"))
    coded = listed.select("id", "hash", "w", F.explode(_starts("w")).alias("at")).select("id", "hash", F.size("w").alias("n_words"), _hash_at("w", "at").alias("code"))
    found = coded.join(small_side(sketches, m, 32), "code").where(F.col("n_words") - SHINGLE_WORDS + 1 >= F.when(F.col("n_words") >= SHINGLE_WORDS, F.col("needed")).otherwise(F.col("n_words") - SHINGLE_WORDS + 1))
    candidates = staged(found.select("id", "hash").distinct())
    chosen = small_side(candidates, candidates.count(), 24)
    again = base.withColumn("hash", F.xxhash64("text"))
    same = again["id"].eqNullSafe(chosen["id"]) & (again["hash"] == chosen["hash"])
    again = again.join(chosen, same, "left_semi").select("id", "hash", words(lower_ascii(F.col("text"))).alias("w"))
    again = again.select("id", "hash", "w", F.explode(_starts("w")).alias("at")).select("id", "hash", _shingle_at("w", "at").alias("shingle"))
    pairs = again.join(small_side(shingles, n, 128), "shingle").select("id", "hash", "item", "n_item", "code").distinct()
    counted = pairs.groupBy("id", "hash", "item", "n_item").agg(F.count(F.lit(1)).alias("n_shared"))
    return counted.where(F.col("n_shared") * 100 >= F.col("n_item") * percent)


def drop_contaminated(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Keep the rows that hold no item; columns are unchanged."""
    bad = staged(contained_items(docs, items, key, text, **options).select("id", "hash").distinct())
    bad = small_side(bad, bad.count(), 24)
    return docs.join(bad, quoted(key).eqNullSafe(bad["id"]) & (F.xxhash64(text_of(quoted(text))) == bad["hash"]), "left_anti")
