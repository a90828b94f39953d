import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from arealis.llm import near_dedup
from arealis.llm.components import connected_components
from arealis.llm.wordhash import shingle_set, word_hashes

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()


def classes(rows, percent):
    sets = {i: shingles(t) for i, t in rows}
    least = {i: i for i in sets}

    def root(i):
        while least[i] != i:
            i = least[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                s = len(sets[a] & sets[b])
                if 100 * s >= percent * (len(sets[a]) + len(sets[b]) - s):
                    x, y = sorted((root(a), root(b)))
                    least[y] = x
    return {i: (len(sets[i]), root(i)) for i in ids}


def edited(rng, text, n):
    words = text.split()
    for _ in range(n):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


@pytest.mark.parametrize("block", [near_dedup.BLOCK_ROWS, 4])
def test_classes_match_brute_force(spark, prose, monkeypatch, block):
    monkeypatch.setattr(near_dedup, "BLOCK_ROWS", block)
    rng = random.Random(2)
    texts = [prose(rng.choice([3, 5, 8, 60, 120])) for _ in range(60)]
    # a large group whose members are each like some of the others only
    base = prose(120)
    for _ in range(60):
        texts.append(edited(rng, rng.choice([base, texts[-1] if len(texts) > 62 else base]), rng.choice([0, 1, 2, 3])))
    texts += [texts[3].upper(), texts[4], texts[4], None, "", "  "]
    rows = list(enumerate(texts))
    df = spark.createDataFrame(random.Random(4).sample(rows, len(rows)), "doc_id long, text string").repartition(4)
    got = {r["id"]: (r["n_shingles"], r["component"]) for r in near_dedup.near_duplicates(df, percent=85).collect()}
    assert got == classes(rows, 85)


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(0)
    for share in (0.3, 0.8):
        agree = []
        for _ in range(40):
            common = rng.integers(0, 2**63, 400, dtype=np.uint64)
            n = int(400 * share)
            a = np.concatenate([common[:n], rng.integers(0, 2**63, (400 - n) // 2, dtype=np.uint64)])
            b = np.concatenate([common[:n], rng.integers(0, 2**63, (400 - n) // 2, dtype=np.uint64)])
            agree.append((near_dedup.super_minhash(a, 96) == near_dedup.super_minhash(b, 96)).mean())
        truth = n / (n + 2 * ((400 - n) // 2))
        assert abs(np.mean(agree) - truth) < 0.03


def test_signature_does_not_depend_on_order_or_early_stop():
    few = np.arange(3, dtype=np.uint64) * np.uint64(977) + np.uint64(5)
    many = np.arange(500, dtype=np.uint64) * np.uint64(977) + np.uint64(5)
    for s in (few, many):
        a = near_dedup.super_minhash(s, 16)
        assert (a == near_dedup.super_minhash(s[::-1], 16)).all() and np.isfinite(a).all()
    assert np.isinf(near_dedup.super_minhash(many[:0], 16)).all()


def test_hashes_do_not_depend_on_pieces(monkeypatch, prose):
    import pyarrow as pa

    from arealis.llm import wordhash

    texts = [prose(500), None, "", "a", prose(50), " lead", "trail "]
    column = pa.array(texts)
    whole = [shingle_set(h) for h in word_hashes(column)]
    monkeypatch.setattr(wordhash, "PIECE", 64)
    cut = [shingle_set(h) for h in word_hashes(column)]
    assert len(whole) == len(texts) and all((a == b).all() for a, b in zip(whole, cut, strict=True))
    assert [len(w) for w in whole] == [len(shingles(t)) for t in texts]


def test_components(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(1, 5), (5, 9), (9, 2), (7, 7), (3, 4), (3, 4)]
    got = {r["v"]: r["least"] for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {5: 1, 9: 1, 2: 1, 4: 3, **{i: 100 for i in range(101, 141)}}


def test_awkward_rows(spark, awkward, empty):
    assert near_dedup.near_duplicates(empty).count() == 0 and near_dedup.drop_near_duplicates(empty).count() == 0
    got = near_dedup.near_duplicates(awkward).collect()
    assert len(got) == awkward.count()
    by = {r["id"]: r["component"] for r in got}
    assert by[2] == 1 and by[7] == 6 and by[9] == 8 and by[None] is None and by[3] == 3
    kept = near_dedup.drop_near_duplicates(awkward)
    assert kept.columns == awkward.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert not {2, 7, 9} & set(ids) and None in ids and {3, 4, 5} <= set(ids)


def test_repeated_ids(spark, prose):
    """Each row is judged by its own text: an unrelated text under a repeated id stays, a copy under it goes."""
    a, b, c = prose(80), prose(90), prose(70)
    rows = [(1, a), (2, a + " more"), (2, b), (2, b), (3, c), (3, c + " end"), (4, b + " end"), (5, ""), (5, None), (None, a)]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "doc_id long, text string").repartition(3)
        got = sorted((r["id"] or 0, r["n_shingles"], r["component"]) for r in near_dedup.near_duplicates(df).collect())
        assert got == sorted([(1, 76, 1), (2, 77, 1), (2, 86, 2), (2, 86, 2), (3, 66, 3), (3, 67, 3), (4, 87, 2), (5, 0, 5), (5, 0, 5), (0, 76, None)])
        kept = [(r["doc_id"], r["text"]) for r in near_dedup.drop_near_duplicates(df).collect()]
        assert len(kept) == 6 and {(1, a), (2, b), (5, ""), (5, None), (None, a)} < set(kept) and len({t for i, t in kept if i == 3}) == 1


def test_shuffled_joins_give_the_same(spark, awkward, monkeypatch):
    want = sorted(map(str, near_dedup.drop_near_duplicates(awkward).collect()))
    monkeypatch.setattr(near_dedup, "small_side", lambda df, rows, row_bytes: df)
    assert sorted(map(str, near_dedup.drop_near_duplicates(awkward).collect())) == want


def test_text_hashes_do_not_follow_from_each_other(spark, prose):
    """Hashing the first hash again gives what hashing (text, 1) gives, but not the second hash."""
    df = spark.createDataFrame([(prose(n),) for n in range(1, 200)], "text string")
    h1, h2 = near_dedup.text_hashes(F.col("text"))
    chained = F.xxhash64("text", F.lit(1))
    twice = df.select(h1.alias("h1"), h2.alias("h2"), chained.alias("c")).collect()
    again = {spark.range(1).select(F.expr(f"xxhash64(1, {r['h1']}L)")).first()[0] for r in twice[:5]}
    assert len({r["h2"] for r in twice}) == len(twice) and not again & {r["h2"] for r in twice} and all(r["h2"] != r["c"] for r in twice)
    bits = [bin((r["h1"] ^ r["h2"]) & (2**64 - 1)).count("1") for r in twice]
    assert 30 < sum(bits) / len(bits) < 34


def test_spanning_edges_keep_components():
    rng = random.Random(9)
    for _ in range(50):
        edges = [(rng.randrange(20), rng.randrange(20)) for _ in range(rng.randint(0, 60))]
        kept = [e for e, k in zip(edges, near_dedup.spanning([a for a, _ in edges], [b for _, b in edges]), strict=True) if k]

        def parts(links):
            group = {i: i for i in range(20)}
            for a, b in links:
                group = {i: group[a] if g == group[b] else g for i, g in group.items()}
            return {frozenset(i for i in group if group[i] == g) for g in group.values()}

        assert parts(kept) == parts(edges) and len(kept) == 20 - len(parts(edges))
