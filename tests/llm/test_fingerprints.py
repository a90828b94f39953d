import hashlib
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from arealis.llm.fingerprints import SAMPLES, edit_test, likeness, signatures

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def jaccard(a, b):
    a, b = Counter(WORD.findall(a)), Counter(WORD.findall(b))
    total = sum((a | b).values())
    return sum((a & b).values()) / total if total else 1.0


def test_edits_and_likeness_match_brute_force(spark, prose):
    texts = [prose(n) for n in np.random.default_rng(0).integers(1, 120, 300)]
    texts[5], texts[6], texts[40], texts[41] = texts[7], None, "", "é😀 x"
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: r for r in edit_test(rows).collect()}
    assert len(got) == len(texts)
    errors = []
    order = sorted(range(len(texts)), reverse=True)
    for i, key in enumerate(order):
        text, after = texts[key] or "", texts[order[(i + 1) % len(order)]] or ""
        cut = len(text) // 3
        edited = text[: len(text) - cut] + after[:cut]
        r = got[key]
        assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        errors += [r["near_edited"] - jaccard(text, edited), r["near_next"] - jaccard(text, after)]
    assert got[5]["fingerprint"] == got[7]["fingerprint"] and got[40]["fingerprint"] == ""
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 1.5 * 0.5 / np.sqrt(SAMPLES)


def test_likeness_is_as_exact_as_32_samples(spark):
    # 400 pairs of texts at a similarity of a half; the bound does not follow SAMPLES
    pairs = []
    for k in range(400):
        a, b, c = ([f"w{k}x{i}" for i in range(j, j + 30)] for j in (0, 30, 60))
        pairs.append((k, " ".join(a + b), " ".join(b + a[:10] + c[:20])))
    df = spark.createDataFrame(pairs, "id long, a string, b string")
    a = signatures(df, ["id"], F.col("a")).withColumnRenamed("signature", "x")
    b = signatures(df, ["id"], F.col("b")).withColumnRenamed("signature", "y")
    got = a.join(b, "id").select(likeness(F.col("x"), F.col("y")).alias("l")).toPandas()["l"]
    assert abs(got.mean() - 0.5) < 0.02 and got.std() < 0.095
    assert np.allclose(got * 32, np.round(got * 32)) and not np.allclose(got * 24, np.round(got * 24))


def test_awkward_rows(spark, awkward, empty):
    assert edit_test(empty).count() == 0
    got = edit_test(awkward).toPandas()
    assert len(got) == awkward.count() and got["fingerprint"].notna().all() and got["near_next"].between(0, 1).all()
    assert got[got["doc_id"].isin([1, 2])]["fingerprint"].nunique() == 1
    assert (got[got["doc_id"].isin([3, 4, 5])]["fingerprint"] == "").all() and got["doc_id"].isna().sum() == 1
    one = edit_test(spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")).first()
    assert one["near_next"] == 1.0 and one["n_chars"] == 11
