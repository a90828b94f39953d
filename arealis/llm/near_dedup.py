"""Near-duplicate documents by SuperMinHash signatures, banding, exact verification and connected components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arealis.llm.common import fresh, quoted, small_side, staged, text_of
from arealis.llm.components import connected_components
from arealis.llm.wordhash import mix, shingle_set, word_hashes

BANDS, BAND_ROWS = 24, 4
BLOCK_ROWS, BLOCK_SHINGLES = 512, 1 << 20
ROW_BYTES = 80  # of a broadcast row of three longs, as the hash table holds it
STEP = np.uint64(0x9E3779B97F4A7C15)


def super_minhash(elements: np.ndarray, size: int) -> np.ndarray:
    """SuperMinHash signature of a set of 64-bit hashes.

    Each element walks a random permutation of the slots, drawn from its hash, and offers slot p[j] the value j + r; a slot
    keeps its least offer.  All elements take step j together; the walk ends once every slot holds less than the next
    step could offer.  An empty set has infinite slots.
    """
    out = np.full(size, np.inf)
    n = len(elements)
    if n == 0:
        return out
    rows, order = np.arange(n), None
    for j in range(size):
        h = mix(elements + np.uint64(int(STEP) * (2 * j + 1) % (1 << 64)))
        offer = j + (h >> np.uint64(12)) * 2.0**-52
        k = j + (mix(h ^ STEP) % np.uint64(size - j)).astype(np.int64)
        if j == 0:
            slot = first = k
        else:
            if order is None:
                order = np.tile(np.arange(size, dtype=np.uint16), (n, 1))
                order[rows, first], order[:, 0] = 0, first
            slot = order[rows, k].astype(np.int64)
            order[rows, k] = order[:, j]
            order[:, j] = slot
        np.minimum.at(out, slot, offer)
        if out.max() < j + 1:
            break
    return out


def band_keys(signature: np.ndarray, bands: int = BANDS, band_rows: int = BAND_ROWS) -> np.ndarray:
    parts = signature.view(np.uint64).reshape(bands, band_rows)
    key = mix(np.arange(bands, dtype=np.uint64) + STEP)
    for i in range(band_rows):
        key = mix(key * STEP + parts[:, i])
    return key.view(np.int64)


def _marks(s: np.ndarray) -> tuple[int, int]:
    """Two hashes of a whole set."""
    return (int(np.bitwise_xor.reduce(s).view(np.int64)), int(np.add.reduce(mix(s ^ STEP)).view(np.int64))) if len(s) else (0, 0)


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, marks, keys = [], [], []
        for words in word_hashes(batch.column("text")):
            s = shingle_set(words)
            sizes.append(len(s))
            marks.append(_marks(s))
            keys.append(band_keys(super_minhash(s, BANDS * BAND_ROWS)) if len(s) else np.zeros(0, np.int64))
        at = np.cumsum([0] + [len(k) for k in keys]).astype(np.int32)
        bands = pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(keys) if keys else np.zeros(0, np.int64)))
        kept = ["id", "h1", "h2"]
        yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(sizes, pa.int64()), *[pa.array([m[i] for m in marks], pa.int64()) for i in (0, 1)], bands], [*kept, "n", "x1", "x2", "bands"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(0, len(batch), 256):
            part = batch.slice(i, 256)
            sets = [shingle_set(w) for w in word_hashes(part.column("text"))]
            shingles = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, sets)]).astype(np.int32)), pa.array(np.concatenate(sets).view(np.int64)))
            yield pa.RecordBatch.from_arrays([part.column("rep"), shingles], ["rep", "shingles"])


def _linked(shared: Column, a: Column, b: Column, percent: int) -> Column:
    return shared * 100 >= (a + b - shared) * percent


def spanning(a: list[int], b: list[int]) -> np.ndarray:
    """Which edges join what the edges before them have not joined yet."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = x = root[root[x]]
        return x

    kept = np.zeros(len(a), bool)
    for i, (x, y) in enumerate(zip(a, b, strict=True)):
        x, y = find(x), find(y)
        if x != y:
            root[y], kept[i] = x, True
    return kept


def _cross_links(percent: int):
    def links(pdf: pd.DataFrame) -> pd.DataFrame:
        """Links between different components of one block pair: as many as it takes to join those that any link joins."""
        sets = [np.asarray(s) for s in pdf["shingles"]]
        sizes = np.array([len(s) for s in sets])
        flat, who = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
        _, code, count = np.unique(flat, return_inverse=True, return_counts=True)
        common = count[code] > 1
        code, who = np.unique(code[common], return_inverse=True)[1], who[common]
        shared = np.zeros((len(sets), len(sets)), np.float32)
        by = np.argsort(code, kind="stable")
        code, who = code[by], who[by]
        for low in range(0, int(code[-1]) + 1 if len(code) else 0, 2048):
            i, j = np.searchsorted(code, [low, low + 2048])
            held = np.zeros((len(sets), 2048), np.float32)
            held[who[i:j], code[i:j] - low] = 1
            shared += held @ held.T
        comp = pdf["comp"].to_numpy()
        union = sizes[:, None] + sizes[None, :] - shared
        hit = (shared.astype(np.float64) * 100 >= union.astype(np.float64) * percent) & (comp[:, None] != comp[None, :])
        a, b = np.nonzero(np.triu(hit, 1))
        ids = pdf["rep"].to_numpy()
        out = pd.DataFrame({"u": ids[a], "v": ids[b], "ca": np.minimum(comp[a], comp[b]), "cb": np.maximum(comp[a], comp[b])}).drop_duplicates(["ca", "cb"])
        return out[spanning(out["ca"].tolist(), out["cb"].tolist())][["u", "v"]]

    return links


def text_hashes(text: Column) -> tuple[Column, Column]:
    """Two hashes of a text from different starts, so that neither follows from the other."""
    return F.xxhash64(text), F.xxhash64(F.lit(1), text)


def _classes(df: DataFrame, key: str, text: str, percent: int) -> DataFrame:
    """Per row: ``id``, the text's hashes ``h1`` and ``h2``, its set's size ``n``, and ``first``: the id and hashes of the least row of its class (null without words or id)."""
    body = text_of(quoted(text))
    h1, h2 = text_hashes(body)
    base = df.select(quoted(key).cast("long").alias("id"), h1.alias("h1"), h2.alias("h2"), body.alias("text"))
    sketched = staged(base.mapInArrow(_sketch, "id long, h1 long, h2 long, n long, x1 long, x2 long, bands array<long>"))
    # a set, not an id, is what gets compared; it bears a number of its own and is read from its least row
    numbered = sketched.where("id is not null and n > 0").groupBy("n", "x1", "x2").agg(F.min(F.struct("id", "h1", "h2")).alias("first"), F.max("bands").alias("bands"))
    reps = staged(numbered.withColumn("rep", F.monotonically_increasing_id()))
    banded = staged(reps.select("rep", "n", F.col("first.id").alias("low"), F.explode("bands").alias("key")))
    # buckets of the same members need one comparison, so of equal buckets one stays
    buckets = banded.groupBy("key").agg(F.count(F.lit(1)).alias("members"), F.bit_xor(F.xxhash64("rep")).alias("x1"), F.bit_xor(F.xxhash64(F.lit(1), "rep")).alias("x2"), F.min(F.struct("low", "rep")).alias("pivot"))
    buckets = buckets.where("members > 1").groupBy("members", "x1", "x2").agg(F.min("key").alias("key"), F.min("pivot.rep").alias("pivot"))
    placed = staged(banded.drop("low").join(buckets.select("key", "members", "pivot"), "key"))
    candidates = staged(placed.select("rep").distinct().join(reps.select("rep", "first.*"), "rep"))
    chosen = small_side(candidates, candidates.count(), ROW_BYTES)
    sets = base.join(chosen, ["id", "h1", "h2"]).select("rep", "text").mapInArrow(_sets, "rep long, shingles array<long>")
    sets = staged(sets.groupBy("rep").agg(F.max("shingles").alias("shingles")))
    pairs = placed.where("rep != pivot").select("rep", "pivot").distinct()
    joined = pairs.join(sets.select("rep", F.col("shingles").alias("a")), "rep")
    joined = joined.join(sets.select(F.col("rep").alias("pivot"), F.col("shingles").alias("b")), "pivot")
    shared = joined.select(F.col("rep").alias("u"), F.col("pivot").alias("v"), F.size("a").alias("a"), F.size("b").alias("b"), F.size(F.array_intersect("a", "b")).alias("s"))
    stars = staged(shared.where(_linked(F.col("s"), F.col("a"), F.col("b"), percent)).select("u", "v"))
    first_pass = connected_components(stars)
    labelled = placed.where("members > 2").join(first_pass.withColumnRenamed("v", "rep"), "rep", "left").withColumn("comp", F.coalesce("least", "rep")).drop("least")
    open_keys = labelled.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo != hi").select("key")
    rest = staged(labelled.join(open_keys, "key").select("key", "rep", "n", "comp"))
    links = stars
    if not rest.isEmpty():
        links = stars.union(staged(_rest_links(rest, sets, percent)))
    least = connected_components(links).withColumnRenamed("v", "rep")
    grouped = reps.select("n", "x1", "x2", "rep", "first").join(least, "rep", "left").withColumn("group", F.coalesce("least", "rep"))
    firsts = grouped.groupBy("group").agg(F.min("first").alias("low"))
    named = grouped.join(firsts, "group").select("n", "x1", "x2", F.col("low").alias("first"))
    rows = sketched.select("id", "h1", "h2", "n", "x1", "x2")
    kept = rows.join(named, ["n", "x1", "x2"], "left")
    return kept.select("id", "h1", "h2", "n", F.when(F.col("id").isNotNull(), F.col("first")).alias("first"))


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 80) -> DataFrame:
    """Classes of documents joined by links of similar shingle sets: ``id``, ``n_shingles``, ``component``.

    Words are lower-cased in A-Z; a document's set holds its distinct five-word shingles (fewer words: one shingle; no word:
    empty, linked with nothing).  Two documents are linked when 100 times the intersection is at least ``percent`` times
    the union, counted on the full sets; a component bears its least id.

    Equal sets are one representative from the start.  Representatives that share a band of their signatures are
    candidates (24 bands of 4; a pair at 80 % is missed with a chance of 3 in a million).  First each bucket is compared
    with its member of the least id; buckets whose members are then all in one component are done.  In the others the members of
    different components are compared exactly, in blocks; members of the largest component are not compared with each
    other.  No pair is emitted that is not a link, a block pair emits no more
    links than join its components, and no bucket is cut short.

    Every row is a document of its own: rows that repeat an id with different texts are linked by their texts, never by
    the id.  A row without an id has a null component.  An empty table gives an empty result.  Other columns are ignored.
    """
    rows = _classes(df, key, text, percent)
    own = F.when(F.col("id").isNotNull(), F.coalesce("first.id", "id"))
    return rows.select("id", F.col("n").alias("n_shingles"), own.alias("component"))


def _rest_links(rest: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links across components inside buckets, found in block pairs of bounded size.

    The bucket's largest component is one side only: its members meet the others but not each other.
    """
    per = rest.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("w"))
    big = per.groupBy("key").agg(F.max(F.struct("c", "w", "comp")).alias("big"), F.sum("c").alias("members"), F.sum("w").alias("weight"))
    sized = big.select(
        "key",
        F.col("big.comp").alias("main"),
        F.greatest(F.lit(1), F.ceil(F.col("big.c") / BLOCK_ROWS), F.ceil(F.col("big.w") / BLOCK_SHINGLES)).cast("int").alias("main_blocks"),
        F.greatest(F.lit(1), F.ceil((F.col("members") - F.col("big.c")) / BLOCK_ROWS), F.ceil((F.col("weight") - F.col("big.w")) / BLOCK_SHINGLES)).cast("int").alias("blocks"),
    )
    dealt = rest.join(sized, "key").withColumn("major", F.col("comp") == F.col("main"))
    dealt = dealt.withColumn("at", F.pmod(F.xxhash64("rep"), F.when(F.col("major"), F.col("main_blocks")).otherwise(F.col("blocks"))).cast("int"))
    # block pairs are (minor block, minor block) with i <= j and (minor block, major block) with j numbered after the minor ones
    others = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda i: F.struct(F.least(i, F.col("at")).alias("i"), F.greatest(i, F.col("at")).alias("j")))
    with_main = F.transform(F.sequence(F.lit(0), F.col("main_blocks") - 1), lambda j: F.struct(F.col("at").alias("i"), (F.col("blocks") + j).cast("int").alias("j")))
    of_main = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda i: F.struct(i.alias("i"), (F.col("blocks") + F.col("at")).cast("int").alias("j")))
    cells = dealt.withColumn("cell", F.explode(F.when(F.col("major"), of_main).otherwise(F.concat(others, with_main))))
    full = cells.select("key", "cell.i", "cell.j", "rep", "comp").join(sets, "rep")
    return full.groupBy("key", "i", "j").applyInPandas(_cross_links(percent), "u long, v long")


def drop_near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 80) -> DataFrame:
    """Keep one document of each class, the one of the least id; columns are unchanged.

    Rows that repeat an id are judged by their own texts: of one id's rows in a class one stays, and an unrelated text under
    the same id stays too.  Rows that repeat id and text are one document, of which one row stays.  Documents without words
    and rows without an id stay.
    """
    rows = staged(_classes(df, key, text, percent).where("first is not null"))
    me = F.struct("id", "h1", "h2")
    gone = staged(rows.where(me != F.col("first")).select("id", "h1", "h2").distinct())
    again = staged(rows.where(me == F.col("first")).groupBy("id", "h1", "h2").count().where("count > 1").drop("count"))
    names = fresh(df, "id", "h1", "h2")
    hashes = text_hashes(text_of(quoted(text)))
    marked = df.withColumns(dict(zip(names, (quoted(key).cast("long"), *hashes), strict=True)))

    def side(found: DataFrame) -> DataFrame:
        found = found.toDF(*names)
        return small_side(found, found.count(), ROW_BYTES)

    kept = marked.join(side(gone), names, "left_anti")
    if not again.isEmpty():
        kept = kept.join(side(again), names, "left_anti").unionByName(kept.join(side(again), names, "left_semi").dropDuplicates(names))
    return kept.select(*[quoted(c) for c in df.columns])
