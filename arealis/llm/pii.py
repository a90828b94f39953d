"""Personal data: fixed patterns, and a character tagger that learns from them and adds what it finds beyond."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arealis.llm import char_tagger
from arealis.llm.common import quoted, staged
from arealis.llm.spans import Span, add_spans
from arealis.llm.wordhash import text_buffers

KINDS = ["email", "ip", "card", "phone"]
MODEL_KINDS = [f"tagged_{k}" for k in KINDS]
WINDOW, STRIDE = 96, 48

LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TRIGGER = re.compile(r"[0-9@]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    """Leftmost addresses, found from each ``@``: the name before it reaches back to where its run of characters began."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and LOCAL.match(text[start - 1]):
            start -= 1
        m = DOMAIN.match(text, at) if start < at else None
        done = m.end() if m else at + 1
        if m:
            yield "email", start, done
        at = text.find("@", done)


def _ips(text: str) -> Iterator[Span]:
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.groups()):
            yield "ip", *m.span()


def _cards(text: str) -> Iterator[Span]:
    for m in CARD.finditer(text):
        digits = re.sub(r"[\x20-]", "", m[0]) if m.end() - m.start() <= 40 else ""
        if 13 <= len(digits) <= 19 and luhn(digits):
            yield "card", *m.span()


def _phones(text: str) -> Iterator[Span]:
    for m in PHONE.finditer(text):
        if 9 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
            yield "phone", *m.span()


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns, by kind as listed, then start; a failing match is dropped without another try."""
    return [s for find in (_emails, _ips, _cards, _phones) for s in find(text)]


def window_starts(text: str) -> list[int]:
    """Starts of the windows (multiples of ``STRIDE``) that hold a digit or an ``@``; no kind can be without one."""
    starts: set[int] = set()
    place = 0
    while m := _TRIGGER.search(text, place):
        k = m.start() // STRIDE
        starts.update(j * STRIDE for j in (k - 1, k) if j >= 0)
        place = (k + 1) * STRIDE
    return sorted(starts)


def _windows(codes: np.ndarray, starts: list[int]) -> np.ndarray:
    padded = np.concatenate([codes, np.full(WINDOW, char_tagger.PAD, np.int16)])
    return padded[np.asarray(starts, np.int64)[:, None] + np.arange(WINDOW)] if len(starts) else np.zeros((0, WINDOW), np.int16)


def training_windows(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Windows with the tags of the fixed patterns: 0 outside, then the kinds as listed."""
    codes, tags = [], []
    for text in texts:
        gold = np.zeros(len(text) + WINDOW, np.int64)
        for kind, start, end in base_spans(text):
            gold[start:end] = 1 + KINDS.index(kind)
        starts = window_starts(text)
        codes.append(_windows(char_tagger.encode(text), starts))
        tags.append(gold[np.asarray(starts, np.int64)[:, None] + np.arange(WINDOW)] if starts else np.zeros((0, WINDOW), np.int64))
    return (np.concatenate(codes), np.concatenate(tags)) if codes else (np.zeros((0, WINDOW), np.int16), np.zeros((0, WINDOW), np.int64))


def fit(texts: list[str], most_windows: int = 6000, seed: int = 4, **options) -> dict[str, np.ndarray]:
    """Train the tagger on at most ``most_windows`` windows of the texts, as many of each set of kinds as there are, by turns."""
    codes, tags = training_windows(texts)
    if len(codes) > most_windows:
        pick = np.random.default_rng(seed).permutation(len(codes))[:most_windows]
        codes, tags = codes[pick], tags[pick]
    key = (tags[:, :, None] == np.arange(1, 5)).any(1) @ (1 << np.arange(4)) if len(codes) else np.zeros(0, int)
    order = []
    for k in np.unique(key):  # rare sets of kinds are seen as often as common ones
        rows = np.flatnonzero(key == k)
        order.append(np.resize(rows, min(most_windows // 4, max(len(rows), len(codes) // max(1, len(np.unique(key)))))))
    rows = np.concatenate(order) if order else np.zeros(0, int)
    return char_tagger.train(codes[rows], tags[rows], 1 + len(KINDS), seed=seed, **options)


def tagged_spans(texts: list[str], model: dict[str, np.ndarray], batch: int = 512) -> list[list[Span]]:
    """Spans of the tagger.  Scores of overlapping windows are averaged, each weighted by its distance from the window's edge; every run of touching windows is then decoded as one sequence."""
    starts = [window_starts(t) for t in texts]
    tags = 1 + len(KINDS)
    near = np.minimum(np.arange(WINDOW) + 1, WINDOW - np.arange(WINDOW)).astype(np.float32)
    runs: list[tuple[int, int, int]] = []  # text, start, end
    for r, own in enumerate(starts):
        for s in own:
            if runs and runs[-1][0] == r and s <= runs[-1][2]:
                runs[-1] = (r, runs[-1][1], s + WINDOW)
            else:
                runs.append((r, s, s + WINDOW))
    sums = [np.zeros((e - s, tags), np.float32) for _, s, e in runs]
    weights = [np.zeros((e - s, 1), np.float32) for _, s, e in runs]
    places = [(i, s) for i, (r, a, e) in enumerate(runs) for s in starts[r] if a <= s < e]
    codes = [_windows(char_tagger.encode(t), own) if own else None for t, own in zip(texts, starts, strict=True)]
    stacked = np.concatenate([c for c in codes if c is not None]) if places else np.zeros((0, WINDOW), np.int16)
    for low in range(0, len(places), batch):
        scores = char_tagger.emissions(model, stacked[low : low + batch]).transpose(1, 0, 2)
        for (i, s), one in zip(places[low : low + batch], scores, strict=True):
            at = s - runs[i][1]
            sums[i][at : at + WINDOW] += one * near[:, None]
            weights[i][at : at + WINDOW] += near[:, None]
    found: list[list[Span]] = [[] for _ in texts]
    best = char_tagger.decode([a / b for a, b in zip(sums, weights, strict=True)], model["moves"])
    for (r, a, _), path in zip(runs, best, strict=True):
        edge = np.flatnonzero(np.diff(np.concatenate([[-1], path, [-1]])))
        for s, e in zip(edge[:-1], edge[1:], strict=True):
            end = min(a + int(e), len(texts[r]))
            if path[s] and end - a - int(s) >= 5:
                found[r].append((MODEL_KINDS[path[s] - 1], a + int(s), end))
    return found


def rows_with_triggers(column: pa.Array) -> np.ndarray:
    at, data = text_buffers(column)
    hit = np.zeros(len(data) + 1, np.int64)
    np.cumsum(((data >= 48) & (data <= 57)) | (data == 64), out=hit[1:])
    return np.flatnonzero(hit[at[1:]] > hit[at[:-1]])


def fit_on_table(df: DataFrame, text: str = "text", rows: int = 1500, longest: int = 1 << 14) -> dict[str, np.ndarray]:
    """Train on the fixed patterns' spans in at most ``rows`` texts of at most ``longest`` characters, chosen by a hash of the text."""
    some = df.select(quoted(text).cast("string").alias("t")).where((F.length("t") <= longest) & F.col("t").rlike("[0-9@]"))
    picked = some.select(F.xxhash64("t").alias("h")).distinct().orderBy("h").limit(rows)
    # at most ``rows`` hashes, so they may be broadcast; other texts do not move
    sample = some.withColumn("h", F.xxhash64("t")).join(F.broadcast(staged(picked)), "h").dropDuplicates(["h"])
    return fit([r["t"] for r in sample.orderBy("h").collect()])


def find_personal_data(df: DataFrame, model: dict[str, np.ndarray], text: str = "text", out: str = "personal") -> DataFrame:
    """Add the personal data of each whole text: an array of ``kind``, ``start`` and ``end`` (code points, end exclusive).

    Kinds ``email``, ``ip``, ``card`` and ``phone`` are fixed patterns.  The tagger reads every window that holds a digit or
    an ``@`` and adds its spans, with kinds ``tagged_...``, where they touch no span of a pattern.  Spans are ordered by
    kind, then start.

    Null and empty texts have no spans; repeated rows get the same spans; a column named ``out`` is replaced; an empty
    table stays empty.
    """
    shipped = df.sparkSession.sparkContext.broadcast(model)  # bounded: a few thousand weights

    def find(column: pa.Array) -> list[list[Span]]:
        found: list[list[Span]] = [[] for _ in range(len(column))]
        rows = [int(r) for r in rows_with_triggers(column)]
        texts = [column[r].as_py() or "" for r in rows]
        for r, text_of_row, extra in zip(rows, texts, tagged_spans(texts, shipped.value), strict=True):
            base = base_spans(text_of_row)
            taken = np.zeros(len(text_of_row) + 1, bool)
            for _, s, e in base:
                taken[s:e] = True
            spans = base + [x for x in extra if not taken[x[1] : x[2]].any()]
            found[r] = sorted(spans, key=lambda s: ((KINDS + MODEL_KINDS).index(s[0]), s[1]))
        return found

    return add_spans(df, text, out, find)
