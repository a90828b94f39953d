"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals."""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arealis.llm.common import fresh, quoted, staged, text_of
from arealis.llm.near_dedup import super_minhash
from arealis.llm.wordhash import mix, polynomial_sums, shingle_set, text_buffers

PREFIXES = (4, 5, 6, 7)  # bytes at the start of a token, to meet inflected forms
BUCKETS = 1 << 18
QUIET = 0.25  # chances below this do not add up, or every long text would seem toxic
COPY = 0.8  # Jaccard similarity of shingles from which a labelled text is a copy
PIECE = 1 << 18
SLICE = 1500  # rows whose chains run together
FIT_CHAIN = 2048  # tokens of a chain in the fit; longer texts are several chains
FIT_TOKENS = 1 << 18  # tokens whose chains run together in the fit

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LETTER = np.zeros(256, bool)
_LETTER[48:58] = _LETTER[97:123] = True
_LETTER[128:] = True


@dataclass
class ToxicityModel:
    """Weights of the fields over hashed features, scores of moving between clean (0) and toxic (1), and the document scale."""

    weights: np.ndarray
    bias: float
    moves: np.ndarray
    scale: np.ndarray


def _fold(data: np.ndarray) -> np.ndarray:
    """Lower case for A-Z and the two-byte letters from U+00C0 to U+00DE."""
    out = _LOWER[data]
    after = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)) + 1
    out[after] += 32
    return out


def token_features(data: np.ndarray, begins_text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature buckets (tokens x 4: the token and its prefixes; 0 for a prefix it is too short for), starts and ends of tokens."""
    low = _fold(data)
    inside = _LETTER[low]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    cut = begins_text[begins_text < len(data)]
    starts[cut] = inside[cut]
    last = np.zeros(len(data) + 1, bool)
    last[1:] = inside
    last[:-1] &= ~inside
    back = cut[cut > 0]
    last[back[inside[back - 1]]] = True
    begins, ends = np.flatnonzero(starts), np.flatnonzero(last)
    sums, down = polynomial_sums(low)
    size = ends - begins
    out = np.zeros((len(begins), 1 + len(PREFIXES)), np.int32)
    for c, length in enumerate((None, *PREFIXES)):
        stop = ends if length is None else np.minimum(begins + length, len(data))
        code = mix((sums[stop] - sums[begins]) * down[begins] + np.uint64(1000 * c))
        bucket = 1 + (code % np.uint64(BUCKETS - 1)).astype(np.int32)
        out[:, c] = bucket if length is None else np.where(size >= length, bucket, 0)
    return out, begins, ends


def batch_features(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """Pieces of a text column: row, its first code point there, features, and token offsets in code points, text by text."""
    at, data = text_buffers(column)
    row, rows = 0, len(at) - 1
    while row < rows:
        last = max(row + 1, int(np.searchsorted(at, at[row] + PIECE, "right")) - 1)
        if at[row + 1] - at[row] > PIECE:
            place, points = int(at[row]), 0
            while place < at[row + 1]:
                end = min(place + PIECE, int(at[row + 1]))
                while end < at[row + 1] and _LETTER[_LOWER[data[end]]]:
                    end += 1
                part = data[place:end]
                feats, b, e = token_features(part, np.zeros(1, np.int64))
                count = np.concatenate([[0], np.cumsum((part & 0xC0) != 0x80)])
                yield row, points, feats, points + count[b], points + count[e]
                points += int(count[-1])
                place = end
            row += 1
            continue
        part = data[at[row] : at[last]]
        first = at[row:last] - at[row]
        feats, b, e = token_features(part, first)
        count = np.concatenate([[0], np.cumsum((part & 0xC0) != 0x80)])
        bounds = np.searchsorted(b, at[row : last + 1] - at[row])
        for i in range(last - row):
            s = slice(bounds[i], bounds[i + 1])
            yield row + i, 0, feats[s], count[b[s]] - count[first[i]], count[e[s]] - count[first[i]]
        row = last


def marginals(scores: np.ndarray, lengths: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward-backward over many chains at once: chance of the toxic state of each token, and of each move (2 x 2) summed over all.

    ``scores`` are the toxic scores of all tokens, chain after chain.  Chains are aligned at their starts and sorted by
    length, so step t works on those still running.
    """
    order = np.argsort(-lengths, kind="stable")
    n = lengths[order]
    begin = (np.cumsum(lengths) - lengths)[order]
    steps = int(n[0]) if len(n) else 0
    running = np.searchsorted(-n, -np.arange(1, steps + 1), "right")
    weight = np.exp(np.clip(scores, -30, 30))
    m = np.exp(moves)
    ahead = np.empty(len(scores))  # chance of toxic given what came so far
    for t in range(steps):
        at = begin[: running[t]] + t
        if t == 0:
            clean, toxic = np.full(len(at), m[0, 0]), m[0, 1] * weight[at]
        else:
            a = a[: running[t]]
            clean, toxic = (1 - a) * m[0, 0] + a * m[1, 0], ((1 - a) * m[0, 1] + a * m[1, 1]) * weight[at]
        a = toxic / (clean + toxic)
        ahead[at] = a
    out, pairs = np.empty(len(scores)), np.zeros((2, 2))
    back = np.full((len(n), 2), 0.5)
    for t in range(steps - 1, -1, -1):
        at = begin[: running[t]] + t
        b = back[: running[t]]
        toxic, clean = ahead[at] * b[:, 1], (1 - ahead[at]) * b[:, 0]
        out[at] = toxic / (toxic + clean)
        if t:
            g = weight[at] * b[:, 1]
            c = b[:, 0]
            f = ahead[at - 1]
            four = np.stack([(1 - f) * m[0, 0] * c, (1 - f) * m[0, 1] * g, f * m[1, 0] * c, f * m[1, 1] * g])
            pairs += (four / four.sum(0)).sum(1).reshape(2, 2)
            new = np.stack([m[0, 0] * c + m[0, 1] * g, m[1, 0] * c + m[1, 1] * g], 1)
            back[: running[t]] = new / new.sum(1, keepdims=True)
    return out, pairs


def _token_scores(weights: np.ndarray, feats: np.ndarray) -> np.ndarray:
    out = weights[feats[:, 0]]
    for column in feats.T[1:]:
        out += weights[column]
    return out


def _document_inputs(p: np.ndarray) -> tuple[float, float]:
    return (float(p.max()), float(np.log1p(np.maximum(p - QUIET, 0).sum()))) if len(p) else (0.0, 0.0)


def _without_copies(docs: list[np.ndarray], toxic: np.ndarray) -> list[int]:
    """Indices of the documents that are no near copy of a kept one of the same label; copies would make their rare tokens look frequent.

    Copies share 4 of 5 shingles of all; SuperMinHash values only find candidates (at that likeness 2 of 6 agree with a chance of
    99.8 %), which are then compared on their whole shingle sets.
    """
    kept: list[int] = []
    sets: list[np.ndarray] = []
    seen, sizes, labels = np.full((len(docs), 6), np.inf), np.zeros(len(docs)), np.zeros(len(docs))
    for i, feats in enumerate(docs):
        mine = shingle_set(feats[:, 0].astype(np.uint64)) if len(feats) else np.zeros(0, np.uint64)
        n, k = len(mine), len(kept)
        if n:
            values = super_minhash(mine, 6)
            agree = (seen[:k] == values).sum(1)
            like = np.flatnonzero((agree >= 2) & (labels[:k] == toxic[i]) & (np.minimum(sizes[:k], n) >= COPY * np.maximum(sizes[:k], n)))
            for j in like[np.argsort(-agree[like], kind="stable")]:
                shared = len(np.intersect1d(mine, sets[j], assume_unique=True))
                if shared >= COPY * (n + len(sets[j]) - shared):
                    break
            else:
                seen[k], sizes[k], labels[k] = values, n, toxic[i]
                kept.append(i)
                sets.append(mine)
        else:
            seen[k] = np.nan
            kept.append(i)
            sets.append(mine)
    return kept


def _new_tokens(docs: list[np.ndarray], toxic: np.ndarray) -> list[np.ndarray]:
    """For each document, which tokens lie in a shingle that no earlier document of its label holds: a passage that many share is evidence once."""
    lengths = np.array([len(d) for d in docs])
    edges = np.concatenate([[0], np.cumsum(lengths)])
    tokens = mix(np.concatenate([d[:, 0] for d in docs]).astype(np.uint64))
    tokens = np.concatenate([tokens, np.zeros(4, np.uint64)])
    n = int(edges[-1])
    sums = np.repeat(toxic.astype(np.uint64), lengths)
    for i in range(5):
        sums = mix(sums + tokens[i : n + i])
    new = np.zeros(n, bool)
    new[np.unique(sums, return_index=True)[1]] = True
    out = []
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        whole = max(b - 4, min(a + 1, b))  # shingles that start later would reach into the next document
        starts = new[a:whole]
        cover = np.zeros(b - a, bool)
        for i in range(min(5, b - a)):
            part = cover[i : i + len(starts)]
            part |= starts[: len(part)]
        out.append(cover)
    return out


def _chain_slices(lengths: np.ndarray, tokens: int) -> list[tuple[slice, slice]]:
    """Runs of whole chains of at most ``tokens`` tokens (one chain at least), as slices of the chains and of their tokens."""
    ends = np.cumsum(lengths)
    out, at = [], 0
    while at < len(lengths):
        before = int(ends[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + tokens, "right")))
        out.append((slice(at, to), slice(before, int(ends[to - 1]))))
        at = to
    return out


def fit(texts: list[str], toxic: np.ndarray, rounds: int = 30, seed: int = 5) -> ToxicityModel:
    """Learn token labels from document labels, then the field from the tokens, then the document scale.

    A token of a toxic document is labelled toxic if it or a prefix of it marks toxic documents: the likelihood ratio of its
    document counts, in which a passage of many documents of a label counts once, exceeds what the number of features tested
    would give by chance.  The field is fitted by adaptive
    gradient steps on the exact likelihood of these labels, summed
    over slices of whole chains; a text beyond ``FIT_CHAIN`` tokens is several chains.
    """
    toxic = np.asarray(toxic, float)
    if not len(texts) or toxic.min() == toxic.max():
        share = float(toxic.mean()) if len(texts) else 0.0
        return ToxicityModel(np.zeros(BUCKETS, np.float32), -30.0, np.zeros((2, 2)), np.array([np.log((share + 1e-3) / (1 - share + 1e-3)), 0.0, 0.0]))
    rows: list[list[np.ndarray]] = [[] for _ in texts]
    for row, _, feats, _, _ in batch_features(pa.array(texts, pa.large_string())):
        rows[row].append(feats)
    docs = [np.concatenate(r) if r else np.zeros((0, 1 + len(PREFIXES)), np.int32) for r in rows]
    del rows
    alone = _without_copies(docs, toxic)
    docs, toxic = [docs[i] for i in alone], toxic[alone]
    counts, both = np.zeros((2, BUCKETS)), np.zeros(BUCKETS)
    for feats, y, new in zip(docs, toxic, _new_tokens(docs, toxic), strict=True):
        counts[int(y), np.unique(feats[new])] += 1
        both[np.unique(feats)] += 1
    total = np.array([(toxic == 0).sum(), (toxic == 1).sum()], float)
    told_by = counts.sum(0)
    share = total[1] / total.sum()
    with np.errstate(divide="ignore", invalid="ignore"):
        ratio = 2 * (np.nan_to_num(counts[1] * np.log(counts[1] / (told_by * share))) + np.nan_to_num(counts[0] * np.log(counts[0] / (told_by * (1 - share)))))
    tested = max(2, int((both >= 3).sum()))
    odds = (counts[1] + 0.1) / (total[1] + 0.2) / ((counts[0] + 0.1) / (total[0] + 0.2))
    marks = (ratio > 2 * np.log(tested) + 1) & (odds > 8)
    marks[0] = False
    common = both >= max(3, len(docs) // 500)  # rarer features would only let the field learn documents by heart
    common[0] = False
    # a prefix that nearly always begins one and the same token says no more than the token
    forms = np.unique(np.concatenate([d[:, 0] for d in docs]))
    for c in range(1, 1 + len(PREFIXES)):
        pairs, held = np.unique(np.concatenate([np.unique(d[:, 0].astype(np.int64) * BUCKETS + d[:, c]) for d in docs]), return_counts=True)
        most = np.zeros(BUCKETS)
        np.maximum.at(most, pairs % BUCKETS, held)
        alone = (most > 0.8 * both) & (most > 0)
        common &= ~alone
        marks &= ~alone
    common[forms] |= both[forms] >= max(3, len(docs) // 500)
    lengths = np.array([len(d) for d in docs])
    feats = np.concatenate(docs)
    owner = np.repeat(np.arange(len(docs)), lengths)
    del docs
    label = (np.logical_or.reduce([marks[column] for column in feats.T]) & (toxic[owner] == 1)).astype(float)
    weights, bias, moves = np.zeros(BUCKETS), -4.0, np.zeros((2, 2))
    seen_w, seen_b, seen_m = np.full(BUCKETS, 1e-6), 1e-6, np.full((2, 2), 1e-6)
    at, first = label.astype(int), np.zeros(len(label), bool)
    chains = np.array([n for size in lengths.tolist() for n in [FIT_CHAIN] * (size // FIT_CHAIN) + [size % FIT_CHAIN] * (size % FIT_CHAIN > 0)], np.int64)
    first[(np.cumsum(chains) - chains)] = True
    inner = np.flatnonzero(~first)
    told = np.zeros((2, 2))
    np.add.at(told, (at[inner - 1], at[inner]), 1)
    del at, first, inner
    slices = _chain_slices(chains, FIT_TOKENS)
    for _ in range(rounds):
        up, slope, pairs = np.zeros(BUCKETS), 0.0, np.zeros((2, 2))
        for chains_in, tokens_in in slices:
            own = feats[tokens_in]
            p, moved = marginals(_token_scores(weights, own) + bias, chains[chains_in], moves)
            gap = label[tokens_in] - p
            for column in own.T:
                up += np.bincount(column, gap, BUCKETS)
            slope += gap.sum()
            pairs += moved
        up = np.where(common, up - 0.1 * weights, 0.0)
        seen_w += up**2
        weights += 0.6 * up / np.sqrt(seen_w)
        seen_b += slope**2
        bias += 0.3 * slope / np.sqrt(seen_b)
        gap = told - pairs
        seen_m += gap**2
        moves += 0.1 * gap / np.sqrt(seen_m)
    chances = [marginals(_token_scores(weights, feats[tokens_in]) + bias, chains[chains_in], moves)[0] for chains_in, tokens_in in slices]
    p = np.concatenate([np.zeros(0), *chances])
    x = np.array([[1.0, *_document_inputs(q)] for q in np.split(p, np.cumsum(lengths)[:-1])])
    scale = np.zeros(3)
    for _ in range(50):  # Newton steps of a ridge logistic regression
        q = 1 / (1 + np.exp(-x @ scale))
        hess = (x * (q * (1 - q))[:, None]).T @ x + np.diag([1e-4, 0.05, 0.05])
        step = np.linalg.solve(hess, x.T @ (toxic - q) - np.array([1e-4, 0.05, 0.05]) * scale)
        scale += step
        if np.abs(step).max() < 1e-6:
            break
    return ToxicityModel(weights.astype(np.float32), float(bias), moves, scale)


def score_column(column: pa.Array, model: ToxicityModel, least: float = 0.5) -> tuple[np.ndarray, list[list[tuple[int, int]]]]:
    """Document scores, and spans (code points, end exclusive) of tokens that are toxic with a chance of ``least`` or more."""
    rows = len(column)
    lengths, scores, starts, ends = np.zeros(rows, np.int64), [], [], []
    for row, _, feats, b, e in batch_features(column):
        lengths[row] += len(feats)
        scores.append(_token_scores(model.weights, feats))
        starts.append(b)
        ends.append(e)
    flat = np.concatenate(scores) if scores else np.zeros(0, np.float32)
    p, _ = marginals(flat.astype(float) + model.bias, lengths, model.moves)
    begin, end = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (starts, ends))
    edges = np.concatenate([[0], np.cumsum(lengths)])
    top = np.zeros(rows)
    full = np.flatnonzero(lengths)
    if len(full):
        top[full] = np.maximum.reduceat(p, edges[full])
    mass = np.zeros(rows)
    if len(full):
        mass[full] = np.add.reduceat(np.maximum(p - QUIET, 0), edges[full])
    value = model.scale[0] + model.scale[1] * top + model.scale[2] * np.log1p(mass)
    found: list[list[tuple[int, int]]] = [[] for _ in range(rows)]
    hits = np.flatnonzero(p >= least)
    for i, r in zip(hits, np.searchsorted(edges, hits, "right") - 1, strict=True):
        found[r].append((int(begin[i]), int(end[i])))
    return 1 / (1 + np.exp(-value)), found


def fit_on_table(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", keep: str | None = None, rows: tuple[int, int] = (3600, 1200)) -> ToxicityModel:
    """Fit on a bounded sample: at most ``rows`` labelled documents (clean, toxic), chosen by a hash of the key.  Whole texts are
    learned from, however long.

    ``keep`` is an SQL condition on the labels table for the rows that may be learned from.  Rows with a null key, label or
    text are left out, and keys that are labelled both ways; without any labelled text every score is the same.
    """
    marked = labels.where(keep) if keep else labels
    marked = marked.where(quoted(label).isin(0, 1)).groupBy(quoted(key).alias("k")).agg(F.min(quoted(label)).alias("y"), F.max(quoted(label)).alias("z")).where("y = z").select("k", "y")
    texts = docs.select(quoted(key).alias("k"), quoted(text).cast("string").alias("text"))
    fits = texts.select("k", F.length("text").alias("n")).where("n > 0").join(marked, "k").groupBy("k").agg(F.max("y").alias("y"))
    chosen = [fits.where(F.col("y") == y).orderBy(F.xxhash64("k", F.lit(3)), "k").limit(rows[y]) for y in (0, 1)]
    # at most sum(rows) keys, so the sample's keys may be broadcast; texts of other rows do not move
    some = texts.join(F.broadcast(staged(chosen[0].union(chosen[1]))), "k").where(F.length("text") > 0).dropDuplicates(["k"])
    sample = some.repartition(1).sortWithinPartitions(F.xxhash64("k", F.lit(4)), "k").select("text", "y")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = list(batches)
        texts, toxic = [t for p in parts for t in p["text"]], [y for p in parts for y in p["y"]]
        m = fit(texts, np.array(toxic))
        yield pd.DataFrame({"model": [pickle.dumps((m.weights, m.bias, m.moves, m.scale))]})

    # the sample is bounded and fits one task; the model is a megabyte
    fitted = sample.mapInPandas(run, "model binary").first()
    if fitted is None:  # no labelled text, and so no task
        return fit([], np.zeros(0))
    return ToxicityModel(*pickle.loads(fitted["model"]))


def score_toxicity(df: DataFrame, model: ToxicityModel, text: str = "text", least: float = 0.5) -> DataFrame:
    """Add ``toxicity`` (0 to 1) and ``toxic_spans`` (array of ``start`` and ``end`` in code points) to every row.

    Whole texts are read.  Null texts, empty texts and texts without letters have no tokens and get the model's base score.
    Columns of these names are replaced; others, and repeated rows, stay as they are; an empty table stays empty.
    """
    df = df.drop("toxicity", "toxic_spans")
    (body,) = fresh(df, "body")
    shipped = df.sparkSession.sparkContext.broadcast(model)  # bounded: BUCKETS weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(i, SLICE) for whole in batches for i in range(0, len(whole), SLICE)):
            score, spans = score_column(batch.column(body), shipped.value, least)
            value = pa.array([[{"start": s, "end": e} for s, e in row] for row in spans], pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))
            rest = [n for n in batch.schema.names if n != body]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in rest], pa.array(score, pa.float64()), value], [*rest, "toxicity", "toxic_spans"])

    span = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
    schema = T.StructType([*df.schema.fields, T.StructField("toxicity", T.DoubleType()), T.StructField("toxic_spans", T.ArrayType(span))])
    return df.withColumn(body, text_of(quoted(text))).mapInArrow(run, schema)
