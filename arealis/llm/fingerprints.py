"""Document fingerprints by consistent weighted sampling, and the edit test that neighbours provide."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from arealis.llm.common import fresh, quoted, staged, text_of, words

SAMPLES = 32
OFFSET, SCALE = 128.0, float(1 << 23)  # keep a log weight as a positive number of 31 bits
HALF = (1 << 32) - 1
FIELD = (1 << 25) - 1


def _two_uniforms(h: Column) -> Column:
    """Product of two uniforms in (0, 1], of 25 bits each, made of the lower 50 bits of a hash."""
    low = (h.bitwiseAND(F.lit(FIELD)) + 1).cast("double")
    high = (F.shiftrightunsigned(h, 25).bitwiseAND(F.lit(FIELD)) + 1).cast("double")
    return low * high / F.lit(2.0**50)


def weighted_sample(term: Column, ln_weight: Column, sample: int) -> Column:
    """Log weight and identity of a term's consistent sample, packed so that the least is the draw.

    With r and c from Gamma(2, 1) and b uniform, made of separate bits of two hashes of the term and the sample number:
    t = floor(ln w / r + b) and ln a = ln c - r (t - b + 1).  The least a over the terms names the pair (term, t); two
    documents agree on it with a probability equal to their generalised Jaccard similarity.
    """
    h, g = F.xxhash64(term, F.lit(2 * sample)), F.xxhash64(term, F.lit(2 * sample + 1))
    r = -F.ln(_two_uniforms(h))
    ln_c = F.ln(-F.ln(_two_uniforms(g)) + F.lit(1e-30))
    b = F.shiftleft(F.shiftrightunsigned(h, 50), 14).bitwiseOR(F.shiftrightunsigned(g, 50)).cast("double") / F.lit(2.0**28)
    t = F.floor(ln_weight / (r + F.lit(1e-30)) + b)
    ln_a = ln_c - r * (t - b + 1)
    rank = F.floor((ln_a + F.lit(OFFSET)) * F.lit(SCALE)).cast("long")
    return F.shiftleft(rank, 32).bitwiseOR(h.bitwiseXOR(t).bitwiseAND(F.lit(HALF)))


def signatures(df: DataFrame, keys: list[str], text: Column, samples: int = SAMPLES) -> DataFrame:
    """One signature per row: array of ``samples`` integers over the words weighted by their counts; nulls where the text has no word.

    ``keys`` must tell rows apart, and are best of fixed width: every word is aggregated by them.  If the rows lie by one of
    them, nothing is exchanged.
    """
    terms, ends, place, end, term, weight = fresh(df, "terms", "ends", "place", "end", "term", "weight")
    listed = df.select(*[quoted(k) for k in keys], F.sort_array(words(text)).alias(terms))
    ties = F.expr(f"filter(sequence(0, size({terms}) - 1), i -> i = size({terms}) - 1 or {terms}[i] != {terms}[i + 1])")
    listed = listed.withColumn(ends, F.when(F.size(terms) > 0, ties))
    runs = listed.select("*", F.posexplode_outer(ends).alias(place, end))
    runs = runs.select(
        *[quoted(k) for k in keys],
        F.xxhash64(F.expr(f"{terms}[{end}]")).alias(term),
        F.expr(f"ln(cast({end} - if({place} = 0, -1, {ends}[{place} - 1]) as double))").alias(weight),
        F.col(end).isNotNull().alias(end),
    )
    draws = [F.min(F.when(F.col(end), weighted_sample(F.col(term), F.col(weight), k))).alias(f"{weight}{k}") for k in range(samples)]
    least = runs.groupBy(*[quoted(k) for k in keys]).agg(*draws)
    return least.select(*[quoted(k) for k in keys], F.array(*[(F.col(f"{weight}{k}").bitwiseAND(F.lit(HALF)) - F.lit(1 << 31)).cast("int") for k in range(samples)]).alias("signature"))


def fingerprint(signature: Column, samples: int = SAMPLES) -> Column:
    """Hexadecimal text of a signature; the empty text where there is no word."""
    parts = [F.lpad(F.hex(F.element_at(signature, k + 1).cast("long") + F.lit(1 << 31)), 8, "0") for k in range(samples)]
    return F.when(F.element_at(signature, 1).isNull(), F.lit("")).otherwise(F.lower(F.concat(*parts)))


def likeness(a: Column, b: Column, samples: int = SAMPLES) -> Column:
    """Share of samples on which two signatures agree; two empty ones are alike, an empty and another one are not."""
    same = sum((F.when(F.element_at(a, k + 1) == F.element_at(b, k + 1), F.lit(1)).otherwise(F.lit(0)) for k in range(samples)), F.lit(0))
    no_a, no_b = F.element_at(a, 1).isNull(), F.element_at(b, 1).isNull()
    return F.when(no_a & no_b, F.lit(1.0)).when(no_a | no_b, F.lit(0.0)).otherwise(same / F.lit(float(samples)))


def neighbours(ids: DataFrame, key: str) -> DataFrame:
    """Add ``next`` and ``previous`` of each distinct key in descending order, the ends joined to a ring; and ``needs`` of the previous one.

    ``ids`` has ``key`` and ``needs``.  Keys are range-partitioned and staged, so that each task orders its own range; only
    the first and last key of each range are brought together.
    """
    part, row = fresh(ids, "part", "row")
    ordered = ids.repartitionByRange(F.col(key).desc()).sortWithinPartitions(F.col(key).desc())
    ordered = staged(ordered.withColumn(part, F.spark_partition_id()).withColumn(row, F.monotonically_increasing_id()))
    inside = Window.partitionBy(part).orderBy(row)
    me = F.struct(F.col(key).alias("key"), F.col("needs").alias("needs"))
    linked = ordered.withColumn("after", F.lead(me).over(inside)).withColumn("before", F.lag(me).over(inside))
    edges = ordered.groupBy(part).agg(F.min_by(me, row).alias("first"), F.max_by(me, row).alias("last"))
    by_part = Window.orderBy(part)
    whole = by_part.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    edges = edges.select(
        F.col(part).alias("edge"),
        F.coalesce(F.lead("first").over(by_part), F.first("first").over(whole)).alias("coming"),
        F.coalesce(F.lag("last").over(by_part), F.last("last").over(whole)).alias("going"),
    )
    joined = linked.join(edges, F.col(part) == F.col("edge"))
    after, before = F.coalesce("after", "coming"), F.coalesce("before", "going")
    return joined.select(key, after["key"].alias("next"), before["key"].alias("previous"), before["needs"].alias("previous_needs"))


def edit_test(df: DataFrame, key: str = "doc_id", text: str = "text", samples: int = SAMPLES) -> DataFrame:
    """Fingerprint every text and its edited text, and compare with the edited text's and the next document's fingerprints.

    The edited text has the last third of its code points replaced by the first as many (or all) of the next document's, in
    descending order of the key, the last one followed by the first.  Returns the key, ``n_chars``, ``edited_sha256``,
    ``fingerprint``, ``edited_fingerprint``, ``near_edited``, ``near_next``.

    A null text is empty; texts without words have an empty fingerprint, alike only to another empty one.  A null key
    counts as the least.  Where rows repeat a key, each is fingerprinted on its own; they share the next key, whose
    row with the least text hash is the next document.  A single document follows itself.  Other columns are ignored.
    """
    base = df.select(F.coalesce(quoted(key).cast("long"), F.lit(-(1 << 63))).alias("id"), text_of(quoted(text)).alias("text"), F.monotonically_increasing_id().alias("row"))
    slim = base.select("id", F.char_length("text").alias("n"), F.xxhash64("text").alias("h"))
    ids = slim.groupBy("id").agg(F.max("n").alias("most"), F.min("h").alias("h"))
    ring = staged(neighbours(ids.select("id", F.expr("most div 3").alias("needs"), "h"), "id"))
    senders = ring.join(ids.select("id", "h"), "id").select(F.col("id"), F.col("h").alias("chosen"), "previous", "previous_needs")
    # the row number takes part, and the hash is compared by its bits, so that both joins read one exchange of the texts by id
    sent = base.join(senders, "id").where((F.xxhash64("text").bitwiseXOR(F.col("chosen")) == 0) & (F.col("row") + F.col("previous_needs") >= 0))
    sent = sent.select(F.col("previous").alias("id"), F.expr("substring(text, 1, cast(previous_needs as int))").alias("head"))
    heads = sent.groupBy("id").agg(F.max("head").alias("head"))  # repeated rows send the same text
    rows = base.join(heads, "id").withColumn("n", F.char_length("text")).withColumn("hash", F.xxhash64("text"))
    edited = F.expr("concat(substring(text, 1, cast(n - n div 3 as int)), substring(head, 1, cast(n div 3 as int)))")
    both = rows.select("id", "row", F.posexplode(F.array("text", edited)).alias("side", "text"))
    signed = signatures(both, ["id", "row", "side"], F.col("text"), samples)
    mine = signed.groupBy("id", "row").agg(*[F.max(F.when(F.col("side") == i, F.col("signature"))).alias(name) for i, name in enumerate(("own", "changed"))])
    # the same exchanges once more, for what belongs to a row: cheaper than carrying it along with every word
    about = rows.select("id", "row", "hash", F.col("n").alias("n_chars"), F.sha2(edited, 256).alias("edited_sha256"))
    mine = staged(mine.join(about, ["id", "row"]).join(ids.select("id", "h"), "id").join(ring.select("id", "next"), "id"))
    following = mine.where(F.col("hash") == F.col("h")).groupBy("id").agg(F.min("own").alias("following")).withColumnRenamed("id", "next")
    out = mine.join(following, "next")
    real = F.when(F.col("id") != F.lit(-(1 << 63)), F.col("id"))
    return out.select(
        real.alias(key),
        F.col("n_chars").cast("long").alias("n_chars"),
        "edited_sha256",
        fingerprint(F.col("own"), samples).alias("fingerprint"),
        fingerprint(F.col("changed"), samples).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed"), samples).alias("near_edited"),
        likeness(F.col("own"), F.col("following"), samples).alias("near_next"),
    )


def expected_error(similarity: float, samples: int = SAMPLES) -> float:
    """Standard error of a likeness."""
    return math.sqrt(similarity * (1 - similarity) / samples)
