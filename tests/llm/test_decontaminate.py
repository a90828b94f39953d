import random

from arealis.llm.decontaminate import contained_items, drop_contaminated, item_shingles, size_partitioned_sketches

from .test_near_dedup import shingles


def test_pairs_match_brute_force(spark, prose):
    rng = random.Random(5)
    items = [(i, prose(rng.choice([1, 4, 5, 6, 12, 30, 60]))) for i in range(40)] + [(90, None), (91, " "), (92, "solo")]
    docs = []
    for i in range(150):
        text = prose(rng.choice([3, 60, 400]))
        if rng.random() < 0.5:
            words = (rng.choice(items[:40])[1]).split()
            if rng.random() < 0.6 and len(words) > 8:
                words[rng.randrange(len(words))] = "changed"
            text = text + " " + " ".join(words).upper() + " " + prose(5)
        docs.append((i, text))
    docs += [(500, items[3][1]), (501, "Solo"), (502, None), (503, "")]
    expected = set()
    for d, text in docs:
        have = shingles(text)
        for i, item in items:
            want = shingles(item)
            if want and 100 * len(want & have) >= 80 * len(want):
                expected.add((d, i, len(want), len(want & have)))
    a = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    b = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["id"], r["item"], r["n_item"], r["n_shared"]) for r in contained_items(a, b).collect()}
    assert got == expected and len(expected) > 30
    clean = {r["doc_id"] for r in drop_contaminated(a, b).collect()}
    assert clean == {d for d, _ in docs} - {d for d, *_ in expected}


def test_sketches_meet_every_document_that_holds_enough(spark, prose):
    items = spark.createDataFrame([(i, prose(10 + i)) for i in range(60)], "item_id long, text string")
    sizes = {r["item"]: r["n_item"] for r in item_shingles(items, "item_id", "text").collect()}
    sketches = size_partitioned_sketches(item_shingles(items, "item_id", "text"))
    for r in sketches.groupBy("item").count().collect():
        n = sizes[r["item"]]
        assert r["count"] >= min(n, n - -(-80 * n // 100) + 1)


def test_awkward_rows(spark, awkward, empty):
    items = spark.createDataFrame([(1, "one two three four five six seven", "x"), (1, "one two three four five six seven", "x"), (2, None, "y")], "item_id long, text string, id string")
    assert contained_items(empty, items).count() == 0 and contained_items(awkward, items.limit(0)).count() == 0
    assert {r["id"] for r in contained_items(awkward, items).collect()} == {1, 2}
    kept = drop_contaminated(awkward, items)
    assert kept.columns == awkward.columns and kept.count() == awkward.count() - 3
