"""Removal of repeated passages: bytes covered by a long string that starts earlier in the corpus."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from arealis.llm.common import quoted, small_side, staged, text_of
from arealis.llm.suffix_array import suffix_array
from arealis.llm.wordhash import BASE, mix, text_buffers

LENGTH = 100  # bytes of a string that counts as repeated
SEED = 32  # bytes of an anchor
ANCHORS = LENGTH - SEED + 1  # anchors among which a string chooses its least
PIECE = 1 << 20
BLOCK = 1 << 18  # bytes of one suffix array
CROWD = 1 << 13  # stretches of one anchor that are compared in one task; larger crowds are aggregated by string
PLACE = np.uint64((1 << 24) - 1)
ID_BYTES = 64  # of a broadcast id, as the hash table holds it

_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
_tables: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _tables or len(_tables[0]) < n:
        _tables.clear()
        for step in (BASE, np.uint64(pow(int(BASE), -1, 1 << 64))):
            table = np.full(n, step, np.uint64)
            table[0] = 1
            _tables.append(np.cumprod(table))
    return _tables[0][:n], _tables[1][:n]


def stretches(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Cut the strings of ``LENGTH`` bytes of several texts into stretches that share an anchor.

    The anchor of a string is its ``SEED`` bytes of least hash, the leftmost of equal ones, so equal strings have equal
    anchors at equal places.  Returns for each stretch: text, first string, number of strings, place of the anchor after the
    first string, hash of the anchor, hash of all bytes.
    """
    n = len(data)
    none = np.zeros(0, np.int64)
    if n < LENGTH:
        return none, none, none, none, none, none
    up, down = _powers(max(n, PIECE + LENGTH) + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[:n], out=total[1:])
    code = mix((total[SEED:] - total[: n - SEED + 1]) * down[: n - SEED + 1])
    least = (code & ~PLACE) | np.arange(len(code), dtype=np.uint64)
    span = 1
    while span * 2 <= ANCHORS:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < ANCHORS:
        least = np.minimum(least[: span - ANCHORS], least[ANCHORS - span :])
    anchor = (least & PLACE).astype(np.int64)
    text = np.searchsorted(begins, np.arange(len(anchor)), "right") - 1
    valid = np.arange(len(anchor)) + LENGTH <= ends[text]
    anchor = np.where(valid, anchor, -1)
    cut = np.flatnonzero((np.diff(anchor, prepend=-2) != 0) | (np.diff(text, prepend=-1) != 0))
    stop = np.append(cut[1:], len(anchor))
    keep = anchor[cut] >= 0
    first, count = cut[keep], (stop - cut)[keep]
    at = anchor[first]
    whole = mix((total[first + count + LENGTH - 1] - total[first]) * down[first] + count.astype(np.uint64))
    return text[first], first - begins[text[first]], count, at - first, code[at].view(np.int64), whole.view(np.int64)


SLIM = "key long, form long, id long, start int, count int, off int, decided boolean"


def _cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stretches of all texts; one that repeats an earlier one of the same batch is decided here and need not meet others."""
    for batch in batches:
        ids = np.asarray(batch.column("id"))
        at, data = text_buffers(batch.column("text"))
        parts: list[tuple[np.ndarray, ...]] = []
        row, rows = 0, len(ids)
        while row < rows:
            last = max(row + 1, int(np.searchsorted(at, at[row] + PIECE, "right")) - 1)
            if last == row + 1 and at[last] - at[row] > PIECE:
                for low in range(int(at[row]), int(at[last]), PIECE):
                    piece = data[low : min(low + PIECE + LENGTH - 1, int(at[last]))]
                    t, s, c, o, k, f = stretches(piece, np.zeros(1, np.int64), np.array([len(piece)]))
                    parts.append((ids[t + row], s + low - int(at[row]), c, o, k, f))
            else:
                t, s, c, o, k, f = stretches(data[at[row] : at[last]], at[row:last] - at[row], at[row + 1 : last + 1] - at[row])
                parts.append((ids[t + row], s, c, o, k, f))
            row = last
        if not parts:
            continue
        doc, start, count, off, key, form = (np.concatenate([p[i] for p in parts]) for i in range(6))
        order = np.lexsort((start, doc, form, key))
        same = np.zeros(len(order), bool)
        same[1:] = (key[order][1:] == key[order][:-1]) & (form[order][1:] == form[order][:-1])
        # an equal id and start is no earlier place
        same[1:] &= (doc[order][1:] != doc[order][:-1]) | (start[order][1:] != start[order][:-1])
        decided = np.zeros(len(order), bool)
        decided[order] = same
        columns = [key, form, doc, start.astype(np.int32), count.astype(np.int32), off.astype(np.int32), decided]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["key", "form", "id", "start", "count", "off", "decided"])


def _shared(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n  # a[:low] == b[:low]
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


def _reach(sides: list[bytes]) -> list[int]:
    """For each string the length of the longest prefix that it shares with another one."""
    order = sorted(range(len(sides)), key=sides.__getitem__)
    out = [0] * len(sides)
    for x, y in zip(order, order[1:], strict=False):
        n = _shared(sides[x], sides[y])
        out[x], out[y] = max(out[x], n), max(out[y], n)
    return out


def _later(block: list[tuple[int, int, bytes]]) -> list[tuple[int, int, int]]:
    """Runs of strings (id, start, count) that occur earlier within the block, by a suffix array of all its stretches."""
    text = bytearray()
    begins, lengths = [], []
    for _, _, body in block:
        begins.append(len(text))
        lengths.append(len(body))
        text += body
        text.append(0)
    # bytes are shifted by two, 1 ends a stretch and 0 the block
    codes = np.frombuffer(bytes(text), np.uint8).astype(np.int64) + 2
    codes[np.array(begins) + np.array(lengths)] = 1
    order = np.array(suffix_array([*codes.tolist(), 0]))
    owner = np.searchsorted(begins, order, "right") - 1
    inner = order - np.array(begins)[owner]
    full = inner + LENGTH <= np.array(lengths)[owner]
    order, owner, inner = order[full], owner[full], inner[full]
    if not len(order):
        return []
    views = np.lib.stride_tricks.sliding_window_view(np.frombuffer(bytes(text), np.uint8), LENGTH)
    same = np.zeros(len(order), bool)
    for low in range(1, len(order), 1 << 15):
        high = min(low + (1 << 15), len(order))
        same[low:high] = (views[order[low:high]] == views[order[low - 1 : high - 1]]).all(1)
    group = np.cumsum(~same)
    doc = np.array([b[0] for b in block])[owner]
    start = np.array([b[1] for b in block])[owner] + inner
    by = np.lexsort((start, doc, group))
    first = np.zeros(len(by), bool)
    first[np.flatnonzero(np.diff(group[by], prepend=0))] = True
    head = by[np.maximum.accumulate(np.where(first, np.arange(len(by)), 0))]
    later = by[(doc[by] != doc[head]) | (start[by] != start[head])]
    later = later[np.lexsort((start[later], doc[later]))]
    d, s = doc[later], start[later]
    edge = np.flatnonzero((np.diff(d, prepend=d[:1] - 1) != 0) | (np.diff(s, prepend=-2) != 1))
    stop = np.append(edge[1:], len(d))
    return [(int(d[a]), int(s[a]), int(b - a)) for a, b in zip(edge, stop, strict=True)]


def _compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Decide the stretches of each anchor, which come together and in order.

    A stretch is first cut to what it shares to the left and right of the anchor with any other: further bytes are in no
    string that is repeated.  Equal cuts are decided by place; different ones overlap in part and go to the suffix array.
    """

    def settle(rows: list[tuple[int, int, int, bytes]]) -> None:
        left = _reach([body[:off][::-1] for _, _, off, body in rows])
        right = _reach([body[off + SEED :] for _, _, off, body in rows])
        cuts: dict[bytes, tuple[int, int]] = {}
        for (doc, start, off, body), a, b in zip(rows, left, right, strict=True):
            if a + SEED + b < LENGTH:
                continue
            cut, place = body[off - a : off + SEED + b], (doc, start + off - a)
            if cut not in cuts:
                cuts[cut] = place
            elif cuts[cut] != place:
                first, second = sorted((cuts[cut], place))
                cuts[cut] = first
                out.append((*second, len(cut) - LENGTH + 1))
        if len(cuts) > 1:
            block.extend((*place, cut) for cut, place in cuts.items())

    out: list[tuple[int, int, int]] = []
    block: list[tuple[int, int, bytes]] = []
    held: list[tuple[int, int, int, bytes]] = []
    key = None
    for batch in batches:
        for k, rows in groupby(zip(batch["key"], batch["id"], batch["start"], batch["off"], batch["body"], strict=True), key=lambda r: r[0]):
            if k != key and held:
                settle(held)
                held = []
                if sum(len(b[2]) for b in block) > BLOCK:
                    out += _later(block)
                    block.clear()
            key = k
            held += [r[1:] for r in rows]
        if out:
            yield pd.DataFrame(out, columns=["id", "start", "count"])
            out.clear()
    if held:
        settle(held)
    if block:
        out += _later(block)
    yield pd.DataFrame(out, columns=["id", "start", "count"])


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(0, len(batch), 256):
            part = batch.slice(i, 256)
            removed, spans, digests, kept = [], [], [], []
            for body, runs in zip(part.column("text"), part.column("runs"), strict=True):
                data = body.as_py().encode()
                done, gone, n, pieces = 0, 0, 0, []
                for start, end in sorted((r["start"], r["start"] + r["count"] + LENGTH - 1) for r in runs.as_py() or []):
                    if start > done or n == 0:
                        pieces.append(data[done:start])
                        n += 1
                    gone += max(0, end - max(start, done))
                    done = max(done, end)
                pieces.append(data[done:])
                rest = b"".join(pieces)
                removed.append(gone)
                spans.append(n)
                digests.append(hashlib.sha256(rest).hexdigest())
                kept.append(rest)
            columns = [part.column("id"), pa.array([len(b.as_py().encode()) for b in part.column("text")], pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(digests), pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def _crowds(forms: DataFrame) -> DataFrame:
    """The later strings of anchors with very many stretches, by an aggregate over the strings themselves."""
    at = F.explode(F.sequence(F.lit(0), F.col("count") - 1))
    strings = forms.select("id", "start", "body", at.alias("at")).select("id", (F.col("start") + F.col("at")).alias("start"), F.expr(f"substring(body, at + 1, {LENGTH})").alias("string"))
    first = strings.groupBy("string").agg(F.min(F.struct("id", "start")).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    later = strings.join(first, "string").where(F.struct("id", "start") != F.col("first"))
    return later.select("id", "start", F.lit(1).alias("count"))


def repeated_strings(base: DataFrame) -> DataFrame:
    """Runs (``id``, ``start``, ``count``) of strings of ``LENGTH`` bytes that start earlier; ``base`` has ``id`` (distinct) and ``text``.

    Strings meet by their anchors: equal strings have equal anchors, and a shuffle of slim rows (no text) brings the
    stretches of an anchor together.  A stretch that equals an earlier one whole is decided by its hash of 128 bits with the
    anchor's; only different stretches of one anchor, found at the edges of repeats, are read again and compared.
    """
    cut = base.mapInArrow(_cut_up, SLIM)
    # decided rows lie anywhere, so that no anchor's common stretch gathers in one task
    meet = F.when(F.col("decided"), F.xxhash64("id", "start")).otherwise(F.col("key")).alias("meet")
    inside = Window.partitionBy("meet", "decided")
    ordered = inside.orderBy("form", "id", "start")
    new = F.coalesce(F.lag("form").over(ordered) != F.col("form"), F.lit(True))
    met = cut.select("*", meet).withColumn("new", new)
    met = met.select("*", F.min("form").over(inside).alias("low"), F.max("form").over(inside).alias("high"), F.sum(F.col("new").cast("int")).over(inside).alias("forms"))
    equal = F.col("decided") | ~F.col("new")
    several = F.col("low") != F.col("high")
    met = staged(met.where(equal | several).select("id", "start", "count", "off", "key", "forms", equal.alias("equal")))
    runs = met.where("equal").select("id", "start", "count")
    edges = met.where("not equal")
    ids = staged(edges.select("id").distinct())
    some = base.join(small_side(ids, ids.count(), ID_BYTES), "id", "left_semi").select("id", F.col("text").cast("binary").alias("body"))
    forms = edges.join(some, "id").select("key", "id", "start", "count", "off", "forms", F.expr(f"substring(body, start + 1, count + {LENGTH - 1})").alias("body"))
    forms = staged(forms)
    few = forms.where(F.col("forms") <= CROWD).repartition("key").sortWithinPartitions("key")
    compared = few.select("key", "id", "start", "off", "body").mapInPandas(_compare, "id long, start int, count int")
    return runs.union(compared).union(_crowds(forms.where(F.col("forms") > CROWD)))


def _text_hashes() -> list[Column]:
    """Two hashes of ``text`` from different starts: of the second one the text comes last, so it does not follow from the first."""
    return [F.xxhash64("text").alias("x1"), F.xxhash64(F.lit(1), "text").alias("x2")]


def remove_repeats(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Remove from each text the bytes covered by a string of 100 UTF-8 bytes that also starts earlier: in a document of a smaller key, or before in the same one.

    Strings are judged on the input, so what is removed does not depend on other removals, and overlapping strings count.
    Returns the key, ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed runs), ``kept_sha256`` and ``kept`` (the
    remaining bytes).  Exact copies of a document are removed whole without being cut up.

    Null texts are empty; texts shorter than a string stay; a null key counts as the least.  Rows that repeat a key are
    documents of their own, in the order of their text hashes, and of equal rows the first stays.  An empty table gives
    an empty result; other columns are ignored.
    """
    body = text_of(quoted(text))
    rows = df.select(F.coalesce(quoted(key).cast("long"), F.lit(-(1 << 63))).alias("id"), body.alias("text"))
    named = rows.select("id", F.col("id").alias("name"), "text")
    slim = rows.select("id", F.octet_length("text").alias("n"), *_text_hashes())
    slim = staged(slim)
    repeated = not slim.groupBy("id").count().where("count > 1").isEmpty()
    if repeated:
        named = _numbered(rows)
        slim = staged(named.select("id", F.octet_length("text").alias("n"), *_text_hashes()))
    firsts = slim.groupBy("n", "x1", "x2").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("copies"))
    copies = staged(slim.join(firsts.where((F.col("copies") > 1) & (F.col("n") >= LENGTH)), ["n", "x1", "x2"]).where("id != first").select("id"))
    known = small_side(copies, copies.count(), ID_BYTES)
    alone = named.join(known, "id", "left_anti")
    runs = repeated_strings(alone.select("id", "text"))
    runs = staged(runs.groupBy("id").agg(F.collect_list(F.struct("start", "count")).alias("runs")))
    touched = small_side(runs.select("id"), runs.count(), ID_BYTES)
    changed = alone.join(touched, "id", "left_semi").join(runs, "id").select("id", "text", "runs").mapInArrow(_remove, "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    size = F.octet_length("text").cast("long").alias("n_bytes")
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    same = alone.join(touched, "id", "left_anti").select("id", size, zero.alias("n_removed"), zero.alias("n_spans"), F.sha2("text", 256).alias("kept_sha256"), F.col("text").cast("binary").alias("kept"))
    gone = named.join(known, "id", "left_semi").select("id", size, size.alias("n_removed"), one.alias("n_spans"), F.sha2(F.lit(""), 256).alias("kept_sha256"), F.lit(b"").alias("kept"))
    out = same.union(changed).union(gone)
    real = F.when(F.col("name") != F.lit(-(1 << 63)), F.col("name"))
    if repeated:
        out = out.join(named.select("id", "name"), "id")
    else:
        out = out.withColumn("name", F.col("id"))
    return out.select(real.alias(key), "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")


def _numbered(rows: DataFrame) -> DataFrame:
    """Give every row a number of its own, in the order of ``id`` and text hash; ``name`` keeps the id."""
    ordered = rows.select("id", "text", F.xxhash64("text").alias("h")).repartitionByRange("id", "h").sortWithinPartitions("id", "h", "text")
    ordered = ordered.select(F.col("id").alias("name"), "text", F.monotonically_increasing_id().alias("id"))
    return staged(ordered.select("id", "name", "text"))
