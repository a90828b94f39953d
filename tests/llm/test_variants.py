import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from arealis.llm import variants
from arealis.llm.queries import op12_variants

LETTERS = "abcdefgzàéßÿ×"


def edits(a, b):
    """Whether one insertion, deletion or replacement makes one word the other."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(docs, typo_every=199, factor=5):
    counts = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{word}".encode())
            if typo_every and h % typo_every == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            counts[word] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    form, number = {}, {}
    for w in counts:
        near = sorted((-counts[v], v) for v in counts if v != w and edits(w, v))
        number[w] = len(near)
        form[w] = near[0][1] if near and -near[0][0] >= factor * counts[w] else None
    out = []
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, number[w], counts[form[w]] if form[w] else None))
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


def garbled(rng, word):
    i, c = rng.randrange(len(word)), rng.choice(LETTERS)
    return rng.choice([word[:i] + word[i + 1 :], word[:i] + c + word[i:], word[:i] + c + word[i + 1 :], word])


def family(rng, size, length=(5, 11)):
    """Words and garbled words of garbled words, some of them anagrams."""
    out = ["".join(rng.choice(LETTERS) for _ in range(rng.randint(*length))) for _ in range(size // 4)]
    while len(out) < size:
        word = garbled(rng, rng.choice(out))
        out.append("".join(rng.sample(word, len(word))) if rng.random() < 0.1 else word)
    return out


def test_search_finds_all_pairs():
    rng = random.Random(4)
    for size, alphabet in ((400, LETTERS), (300, "ab")):
        words = sorted({w for w in family(rng, size)} | {"".join(rng.choice(alphabet) for _ in range(8)) for _ in range(size)})
        for length in {len(w) for w in words if w}:
            short = [w for w in words if len(w) == length]
            for extra in (0, 1):
                long = [w for w in words if len(w) == length + extra]
                if not long:
                    continue
                p, q = variants.letters(short, length), variants.letters(long, length + extra)
                found = set()
                for a, b in variants.range_search(variants.points_of(p, length), variants.points_of(q, length), np.full(len(long), bool(extra))):
                    ok = variants.one_edit(p[b], q[a])
                    pairs = list(zip(a[ok].tolist(), b[ok].tolist()))
                    assert not found & set(pairs)
                    found |= set(pairs)
                assert found == {(i, j) for i, w in enumerate(long) for j, v in enumerate(short) if w != v and edits(w, v)}


def test_cells_reach_every_neighbour(monkeypatch):
    monkeypatch.setattr(variants, "CELL", 20)
    rng = random.Random(5)
    words = sorted({w for w in family(rng, 1500, (7, 8)) if len(w) in (7, 8)})
    short, long = [[w for w in words if len(w) == n] for n in (7, 8)]
    points = variants.points_of(variants.letters(short, 7), 7)
    cells = variants.Cells(points[::2], len(short), 100)
    assert cells.leaves > 5
    home = cells.home(points)
    for asked, extra in ((short, False), (long, True)):
        reach = [set() for _ in asked]
        for cell, rows in cells.reach(variants.points_of(variants.letters(asked, 7 + extra), 7), extra):
            for r in rows:
                reach[r].add(cell)
        assert all(home[j] in reach[i] for i, w in enumerate(asked) for j, v in enumerate(short) if w == v or edits(w, v))


@pytest.mark.parametrize("cell", [30, 8192])
def test_query_matches_all_pairs(spark, tmp_path, monkeypatch, cell):
    monkeypatch.setattr(variants, "CELL", cell)
    rng = random.Random(6)
    words = family(rng, 500)
    docs = [(i, " ".join(rng.choice([w, w.upper(), w.capitalize()]) for w in rng.choices(words, [1 / (1 + k % 40) ** 2 for k in range(len(words))], k=400)) + "'s, 9x_") for i in range(60)]
    docs += [(100, "letters " * 210), (101, "lettters " * 30), (102, "letttters " * 6)]  # a chain of forms
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = rows_of(op12_variants(spark, str(tmp_path)))
    assert got == plain(docs) and any(r[1] and r[1] != r[2] for r in got) and sum(r[4] for r in got) > 100


def test_awkward_tables(spark, awkward, empty):
    docs = [(r["doc_id"], r["text"]) for r in awkward.select("doc_id", "text").collect()]
    assert rows_of(variants.spelling_variants(awkward, typo_every=199)) == plain(docs)
    assert rows_of(variants.spelling_variants(awkward)) == plain(docs, None)
    assert variants.spelling_variants(empty).count() == 0


def test_one_crowd_and_long_runs(spark):
    """Anagrams of few letters, words of thousands of letters, and one word that holds half of all occurrences."""
    rng = random.Random(8)
    crowd = ["".join(rng.choice("xy") for _ in range(9)) for _ in range(300)]
    long = "".join(rng.choice("pqrs") for _ in range(5000))
    words = crowd * 5 + [long] * 40 + [long[:77] + long[78:]] * 6 + ["common"] * 2000 + ["commons"] * 7
    docs = [(1, " ".join(words)), (2, None), (2, "")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert rows_of(variants.spelling_variants(df)) == plain(docs, None)
