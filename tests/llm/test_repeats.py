import hashlib
import random

import numpy as np
import pytest

from arealis.llm import repeats
from arealis.llm.suffix_array import suffix_array


def test_suffix_array_on_random_texts():
    rng = random.Random(0)
    for _ in range(3000):
        s = [rng.randint(1, rng.choice([1, 2, 3, 8])) for _ in range(rng.randint(0, 40))] + [0]
        assert suffix_array(s) == sorted(range(len(s)), key=lambda i: s[i:])


def brute(rows):
    """Expected results of rows (id, text) in order."""
    seen, out = set(), []
    for key, text in rows:
        body = (text or "").encode()
        gone = np.zeros(len(body), bool)
        for i in range(len(body) - repeats.LENGTH + 1):
            piece = body[i : i + repeats.LENGTH]
            if piece in seen:
                gone[i : i + repeats.LENGTH] = True
            seen.add(piece)
        kept = bytes(b for b, g in zip(body, gone, strict=True) if not g)
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((key, len(body), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), kept))
    return out


def corpus(prose):
    rng = random.Random(3)
    passages = [prose(40) for _ in range(6)]
    rows = []
    for i in range(120):
        text = prose(rng.choice([2, 30, 80]))
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            a = rng.randint(0, len(p) // 2)
            text += rng.choice([" ", "", "é "]) + p[a : rng.randint(a, len(p))]
        rows.append((i, rng.choice([text, text, text[: len(text) // 2], "ab" * 200, "z" * 250])))
    rows += [(200, None), (201, ""), (202, "x" * 99), (203, "x" * 100), (204, rows[5][1]), (205, rows[5][1])]
    return rows


@pytest.mark.parametrize("crowd", [repeats.CROWD, 3])
def test_matches_brute_force(spark, prose, monkeypatch, crowd):
    monkeypatch.setattr(repeats, "CROWD", crowd)
    rows = corpus(prose)
    df = spark.createDataFrame(random.Random(1).sample(rows, len(rows)), "doc_id long, text string").repartition(5)
    got = sorted(tuple(r) for r in repeats.remove_repeats(df).collect())
    assert got == sorted(brute(rows))


def test_texts_beyond_a_piece(spark, prose, monkeypatch):
    part = prose(3000)
    rows = [(1, part), (2, prose(200) + part + part[:5000]), (3, part[200:9000])]
    import pyarrow as pa

    monkeypatch.setattr(repeats, "PIECE", 1000)
    batch = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows])], ["id", "text"])
    covered = {1: 0, 2: 0, 3: 0}
    for out in repeats._cut_up(iter([batch])):
        for i, n in zip(out.column("id").to_pylist(), out.column("count").to_pylist(), strict=True):
            covered[i] += n
    assert covered == {i: len(t.encode()) - repeats.LENGTH + 1 for i, t in rows}
    monkeypatch.undo()
    got = sorted(tuple(r) for r in repeats.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == sorted(brute(rows))


def test_awkward_rows(spark, awkward, empty):
    assert repeats.remove_repeats(empty).count() == 0
    got = repeats.remove_repeats(awkward).collect()
    assert len(got) == awkward.count()
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(r)
    assert by[3][0]["n_bytes"] == by[4][0]["n_removed"] == 0
    assert by[9][0]["n_removed"] > 100_000 and by[8][0]["n_removed"] == 0
    # the two rows that repeat key 13: of three equal rows the first stays
    assert sorted(r["n_removed"] > 0 for r in by[13]) == [False, True, True]
    assert len(by[None]) == 1


def test_shuffled_joins_give_the_same(spark, prose, monkeypatch):
    rows = corpus(prose)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    monkeypatch.setattr(repeats, "small_side", lambda df, rows, row_bytes: df)
    assert sorted(tuple(r) for r in repeats.remove_repeats(df).collect()) == sorted(brute(rows))
