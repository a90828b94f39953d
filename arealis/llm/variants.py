"""Spelling variants of the vocabulary: words one edit apart, found in k-d trees over letter-count vectors."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arealis.llm.common import lower_ascii, quoted, staged, text_of

BINS = 32  # a-z one each, the letters from U+00C0 on share six
PARTS = (None, 2, 1, 3)  # whole word, then its first half, quarter and three quarters
BLOCKS = np.array([0, 0, 1, 2, 3])  # the counts that each of a point's 64-bit words belongs to
LEAF = 24  # points of a leaf inside a task
CELL = 8192  # points that a task should get
SAMPLE = 1 << 16  # expected words of the sample that the cells are fitted on
_BIN = np.zeros(256, np.uint8)
_BIN[97:123] = np.arange(26)
_BIN[192:] = 26 + np.arange(64) % 6


def letters(words: list[str], length: int) -> np.ndarray:
    """Words of one length as rows of Latin-1 codes; all letters of a word are within Latin-1."""
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), length)


def _thermometer(rows: np.ndarray, levels: int) -> list[np.ndarray]:
    """Counts per bin as bits: bit ``t`` of a bin is set if its count is above ``t``; two levels to a 64-bit word."""
    counts = np.zeros((len(rows), BINS), np.int32)
    for column in range(rows.shape[1]):
        np.add.at(counts, (np.arange(len(rows)), _BIN[rows[:, column]]), 1)
    out = []
    for low in range(0, levels, 2):
        bits = np.stack([counts > low, counts > low + 1], axis=2).reshape(len(rows), 2 * BINS)
        out.append(np.packbits(bits, axis=1, bitorder="little").view(np.uint64)[:, 0])
    return out


def points_of(rows: np.ndarray, length: int) -> np.ndarray:
    """Letter-count vectors of words near others of ``length``: whole words, and what stands before fixed places of them.

    An edit adds one letter at most to each count vector and takes one at most from it.  Counts are kept to four (two in
    parts) and some letters share a bin, which only brings vectors closer; exact letters are compared afterwards.
    """
    return np.stack([code for part in PARTS for code in (_thermometer(rows, 4) if part is None else _thermometer(rows[:, : length * part // 4], 2))], axis=1)


def _apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Per block, the counts of ``a`` that exceed those of ``b``; both broadcast, last axis the 64-bit words."""
    over = np.bitwise_count(a & ~b)
    return np.stack([over[..., 0] + over[..., 1], *[over[..., k] for k in range(2, len(BLOCKS))]], axis=-1)


def _near(q: np.ndarray, low: np.ndarray, high: np.ndarray, longer: np.ndarray) -> np.ndarray:
    """Whether queries come within one edit of a box of count vectors; those one letter longer have no count too few in all."""
    few = _apart(low, q)
    return (_apart(q, high) <= 1).all(-1) & (few[..., 0] <= 1 - longer) & (few[..., 1:] <= 1).all(-1)


def _split_bit(points: np.ndarray) -> tuple[int, int, np.ndarray] | None:
    """The count threshold that splits the points most evenly: word, bit and side of each point; None if all are equal."""
    share = np.unpackbits(points.view(np.uint8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    best = int(np.abs(share - len(points) / 2).argmin())
    if share[best] in (0, len(points)):
        return None
    word, bit = divmod(best, 64)
    return word, bit, (points[:, word] >> np.uint64(bit)) & np.uint64(1) == 1


def range_search(points: np.ndarray, queries: np.ndarray, longer: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (query, point) that the count vectors allow to be one edit apart, in batches.

    A k-d tree over the points is walked by all queries together: a node keeps those that come within one edit of its
    bounding box, and its points are split at a count threshold.
    """
    longer = longer.astype(np.int8)
    stack = [(np.arange(len(points)), np.arange(len(queries)))]
    while stack:
        at, ask = stack.pop()
        own = points[at]
        low, high = np.bitwise_and.reduce(own), np.bitwise_or.reduce(own)
        ask = ask[_near(queries[ask], low, high, longer[ask])]
        if not len(ask):
            continue
        split = _split_bit(own) if len(at) > LEAF else None
        if split is None:
            step = max(1, (1 << 18) // len(at))
            for i in range(0, len(ask), step):
                some = ask[i : i + step]
                q, p = queries[some][:, None], own[None]
                over = np.bitwise_count(q[..., 0] & ~p[..., 0]) + np.bitwise_count(q[..., 1] & ~p[..., 1])
                a, b = np.nonzero(over <= 1)
                fits = _near(queries[some[a]], own[b], own[b], longer[some[a]])
                yield some[a[fits]], at[b[fits]]
            continue
        right = split[2]
        stack += [(at[right], ask), (at[~right], ask)]


def one_edit(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Which rows differ by exactly one edit; ``long`` has as many letters as ``short`` or one more."""
    width = short.shape[1]
    if long.shape[1] == width:
        return (short != long).sum(1) == 1
    front = np.argmin(np.column_stack([short == long[:, :-1], np.zeros(len(short), bool)]), axis=1)
    back = np.argmin(np.column_stack([(short == long[:, 1:])[:, ::-1], np.zeros(len(short), bool)]), axis=1)
    return front + back >= width


class Cells:
    """Leaves of a k-d tree over one length's words: where a word lives and which leaves its neighbours can live in."""

    def __init__(self, sample: np.ndarray, words: int, first: int):
        """``sample`` stands for ``words`` words; leaves are numbered from ``first``."""
        self.nodes: list[tuple] = []
        self.leaves, self.first = 0, first
        self._grow(sample, words / max(1, len(sample)))

    def _grow(self, points: np.ndarray, each: float) -> int:
        here = len(self.nodes)
        split = _split_bit(points) if len(points) >= 32 and len(points) * each > CELL else None
        if split is None:
            self.nodes.append((self.first + self.leaves,))
            self.leaves += 1
            return here
        word, bit, right = split
        self.nodes.append(())
        self.nodes[here] = (word, bit, self._grow(points[~right], each), self._grow(points[right], each))
        return here

    def home(self, points: np.ndarray) -> np.ndarray:
        out = np.zeros(len(points), np.int64)
        stack = [(0, np.arange(len(points)))]
        while stack:
            node, at = stack.pop()
            if len(self.nodes[node]) == 1:
                out[at] = self.nodes[node][0]
                continue
            word, bit, left, right = self.nodes[node]
            up = (points[at, word] >> np.uint64(bit)) & np.uint64(1) == 1
            stack += [(left, at[~up]), (right, at[up])]
        return out

    def reach(self, points: np.ndarray, longer: bool) -> Iterator[tuple[int, np.ndarray]]:
        """Leaves within one edit of the points, each with the rows that reach it."""
        n = len(points)
        stack = [(0, np.arange(n), np.zeros((n, 4), np.int8), np.zeros((n, 4), np.int8))]
        while stack:
            node, at, over, under = stack.pop()
            if not len(at):
                continue
            if len(self.nodes[node]) == 1:
                yield self.nodes[node][0], at
                continue
            word, bit, left, right = self.nodes[node]
            block = BLOCKS[word]
            up = ((points[at, word] >> np.uint64(bit)) & np.uint64(1)).astype(np.int8)
            more, less = over.copy(), under.copy()
            more[:, block] += up
            less[:, block] += 1 - up
            fits = more[:, block] <= 1
            stack.append((left, at[fits], more[fits], under[fits]))
            fits = less[:, block] <= (0 if longer and block == 0 else 1)
            stack.append((right, at[fits], over[fits], less[fits]))


def word_counts(df: DataFrame, key: str, text: str, shortest: int, least: int, typo_every: int | None) -> DataFrame:
    """Words (``word``, ``n``) of at least ``shortest`` letters and ``least`` occurrences.

    A word is a maximal run of ``[A-Za-z\\u00C0-\\u00FF]`` with A-Z in lower case.  With ``typo_every`` a run loses one letter
    where the crc32 of ``<key>:<run>`` is a multiple of it.
    """
    runs = F.regexp_extract_all(text_of(quoted(text)), F.lit(f"[A-Za-zÀ-ÿ]{{{shortest},}}"), F.lit(0))
    spread = df.select(F.coalesce(quoted(key).cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    word = lower_ascii(F.col("run")).alias("word")
    if typo_every is None:
        words = spread.select(word)
    else:
        hashed = spread.select("id", word).select("word", F.crc32(F.concat_ws(":", "id", "word").cast("binary")).alias("h"))
        gone = (F.col("h") % F.char_length("word")).cast("int")
        typed = F.concat(F.col("word").substr(F.lit(1), gone), F.col("word").substr(gone + 2, F.char_length("word")))
        words = hashed.select(F.when(F.col("h") % typo_every == 0, typed).otherwise(F.col("word")).alias("word")).where(F.char_length("word") >= shortest)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)


def fit_cells(vocabulary: DataFrame) -> dict[int, Cells]:
    """Cells per word length, fitted on a sample of ``SAMPLE`` expected words chosen by hash; every word is placed in them."""
    sizes = {r["length"]: r["words"] for r in vocabulary.groupBy("length").agg(F.count(F.lit(1)).alias("words")).collect()}
    total = sum(sizes.values())
    below = int(min(1.0, SAMPLE / max(1, total)) * (1 << 31))
    chosen = vocabulary.where(F.pmod(F.xxhash64("word"), F.lit(1 << 31)) < below).select("length", "word").collect() if total else []
    sampled: dict[int, list[str]] = {}
    for r in chosen:
        sampled.setdefault(r["length"], []).append(r["word"])
    cells, first = {}, 0
    for length in sorted(sizes):
        words = sampled.get(length, [])
        cells[length] = Cells(points_of(letters(words, length), length), sizes[length], first)
        first += cells[length].leaves
    return cells


ROUTED = "cell long, longer boolean, home boolean, word string, n long"


def _route(cells: dict[int, Cells]) -> Callable:
    """Send each word to its own cell, and as a query to the cells of its length and of one letter less that it can reach."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, len(batch), 4096):
                part = batch.slice(i, 4096)
                lengths = part.column("length").to_numpy()
                for length in np.unique(lengths):
                    rows = np.flatnonzero(lengths == length)
                    some = part.take(pa.array(rows))
                    own = letters(some.column("word").to_pylist(), length)
                    for base in (length, length - 1):
                        if base not in cells:
                            continue
                        points = points_of(own, base)
                        homes = cells[base].home(points) if base == length else None
                        sent = list(cells[base].reach(points, base != length))
                        if not sent:
                            continue
                        cell = np.repeat([c for c, _ in sent], [len(r) for _, r in sent])
                        who = np.concatenate([r for _, r in sent])
                        home = homes[who] == cell if homes is not None else np.zeros(len(who), bool)
                        take = pa.array(who)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(cell), pa.array(np.full(len(who), base != length)), pa.array(home), some.column("word").take(take), some.column("n").take(take)], ["cell", "longer", "home", "word", "n"]
                        )

    return run


def _search(group: pa.Table) -> pa.Table:
    """Near words inside one cell: per word their number and the best of them (largest count, then smallest word)."""
    words = np.array(group.column("word").to_pylist(), dtype=object)
    n, home, longer = (group.column(c).to_numpy() for c in ("n", "home", "longer"))
    at = np.flatnonzero(home)
    found: dict[str, list] = {"word": [], "near": [], "m": []}
    if len(at):
        length = len(words[at[0]])
        own = letters(list(words[at]), length)
        points = points_of(own, length)
        for kind in (False, True):
            ask = np.flatnonzero(longer == kind)
            if not len(ask):
                continue
            asked = letters(list(words[ask]), length + kind)
            for q, p in range_search(points, points_of(asked, length), np.full(len(ask), kind)):
                same = one_edit(own[p], asked[q])
                a, b = ask[q[same]], at[p[same]]
                found["word"].append(a)
                found["near"].append(b)
                if kind:
                    found["word"].append(b)
                    found["near"].append(a)
    word = np.concatenate(found["word"]) if found["word"] else np.zeros(0, np.int64)
    near = np.concatenate(found["near"]) if found["near"] else np.zeros(0, np.int64)
    rank = np.empty(len(words), np.int64)
    rank[np.lexsort((words, -n))] = np.arange(len(words))
    order = np.lexsort((rank[near], word))
    word, near = word[order], near[order]
    begin = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]])) if len(word) else np.zeros(0, np.int64)
    count = np.diff(np.append(begin, len(word)))
    return pa.table({"word": pa.array(words[word[begin]], pa.string()), "n_near": pa.array(count, pa.int64()), "near": pa.array(words[near[begin]], pa.string()), "m": pa.array(n[near[begin]], pa.int64())})


def near_words(vocabulary: DataFrame) -> DataFrame:
    """Per word of ``vocabulary`` (``word``, ``n``, ``length``) with near words: ``n_near``, and ``near`` and ``m`` of the best one."""
    routed = vocabulary.mapInArrow(_route(fit_cells(vocabulary)), ROUTED)
    parts = routed.groupBy("cell").applyInArrow(_search, "word string, n_near long, near string, m long")
    best = parts.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), "near")).alias("best"))
    return best.select("word", "n_near", F.col("best.near").alias("near"), (-F.col("best.m")).alias("m"))


def last_forms(forms: DataFrame) -> DataFrame:
    """``word`` and ``root`` of every word with a form: the end of its chain, by pointer doubling.

    A form occurs several times as often as its word, so chains are at most as long as the logarithm of the largest count.
    """
    roots = staged(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = roots.select(F.col("word").alias("at"), F.col("root").alias("next"))
        moved = staged(roots.join(ahead, F.col("root") == F.col("at"), "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        roots = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return roots


def spelling_variants(df: DataFrame, key: str = "doc_id", text: str = "text", shortest: int = 6, least: int = 5, factor: int = 5, typo_every: int | None = None) -> DataFrame:
    """Group the spellings of the words of all texts: ``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n``.

    Words are those of :func:`word_counts`.  Two words are near if one code point inserted, deleted or replaced makes one
    the other.  A word's form is its near word of largest count (ties: smallest in code-point order) if that is at least
    ``factor`` times its own; the root is the last form that one reaches, or the word itself.

    An edit moves letter counts by two at most.  Every word goes to the cell of its length that its counts fall in, and as
    a query to all cells of its length and of one letter less whose box comes within one edit; a task searches a k-d tree
    over its cell's words and verifies the letters of what the boxes leave.  No bucket or number of neighbours is bounded.

    Null and empty texts have no words, null keys read as empty, rows that repeat a key count each, an empty table gives an
    empty result; other columns are ignored.  Words whose halves and quarters hold the same letters in other orders are
    one point of the tree: their letters are compared pair by pair, in blocks.
    """
    counted = word_counts(df, key, text, shortest, least, typo_every)
    vocabulary = staged(counted.select("word", "n", F.char_length("word").alias("length")))
    near = staged(near_words(vocabulary))
    joined = vocabulary.join(near, "word", "left").withColumn("formed", F.col("m") >= F.col("n") * factor)
    marked = staged(joined.select("word", F.when(F.col("formed"), F.col("near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(F.col("formed"), F.col("m")).alias("form_n")))
    roots = last_forms(marked.where("form is not null"))
    return marked.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
