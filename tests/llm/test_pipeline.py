import check_queries
import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from arealis.llm import registry
from arealis.llm.common import staged

from .test_mixing import WORD, shares
from .test_near_dedup import shingles

DATA = "/root/testdata/sf0.001"
registry.load_all()


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_matches_sql(spark, name):
    ok, note = check_queries.compare(registry.QUERIES[name](spark, DATA), check_queries.connect(DATA), registry.ORACLES[name])
    assert ok and "TYPES" not in note, note


def test_every_operator_has_a_query():
    assert {n.split("_")[0] for n in registry.QUERIES} == {*(f"op{i}" for i in range(1, 14)), "pipeline"}


def test_stages_match_brute_force(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    items = [r["text"] for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, DATA))
        kept[name] = docs.toPandas()
        if name != "sharding":
            assert docs.columns == columns
    near, clean = kept["toxicity"], []
    sets = {i: shingles(t) for i, t in zip(near["doc_id"], near["text"], strict=True)}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                s = len(sets[a] & sets[b])
                if 100 * s >= 80 * (len(sets[a]) + len(sets[b]) - s):
                    x, y = sorted((find(a), find(b)))
                    root[y] = x
    assert sorted(kept["near_dedup"]["doc_id"]) == [i for i in ids if find(i) == i]
    wanted = [w for w in map(shingles, items) if w]
    for i, text in zip(kept["near_dedup"]["doc_id"], kept["near_dedup"]["text"], strict=True):
        have = shingles(text)
        if not any(100 * len(w & have) >= 80 * len(w) for w in wanted):
            clean.append(i)
    assert sorted(kept["decontamination"]["doc_id"]) == sorted(clean)
    before, after = kept["decontamination"], kept["mixing"]
    count = lambda frame: frame["text"].map(lambda t: len(WORD.findall(t or ""))).groupby(frame["source"].fillna("~")).sum().sort_index()
    sizes, taken = count(before), count(after)
    targets = shares(list(sizes))
    assert [int(taken.get(s, 0)) for s in sizes.index] == [int(t) for t in targets]
    assert (after["n_chars"] == after["text"].str.len()).all()
    dealt = kept["sharding"].groupby("shard").size()
    assert len(kept["sharding"]) == len(after) and dealt.max() - dealt.min() <= 1


def test_awkward_and_empty_documents(spark, awkward, empty, tmp_path):
    """All stages on rows with nulls, repeated ids and repeated rows: one row of each text stays, unrelated texts under one id too."""
    for name, docs in (("awkward", awkward), ("empty", empty)):
        folder = f"{tmp_path}/{name}"
        columns = ["doc_id", "text", F.lit("en").alias("lang"), F.col("shard").alias("source"), F.char_length("text").cast("long").alias("n_chars")]
        docs.select(*columns).write.parquet(f"{folder}/documents.parquet")
        for table in ("labels", "benchmark"):
            spark.read.parquet(f"{DATA}/{table}.parquet").write.parquet(f"{folder}/{table}.parquet")
        kept = spark.read.parquet(f"{folder}/documents.parquet")
        for _, stage in corpus_pipeline.STAGES[:3]:
            kept = staged(stage(spark, kept, folder))
        rows = [(r["doc_id"], r["text"]) for r in kept.collect()]
        dealt = corpus_pipeline.run(spark, folder).collect()
        if name == "empty":
            assert rows == dealt == []
        else:
            ids = sorted(str(i) for i, _ in rows)
            assert ids == sorted(map(str, [None, 1, 3, 4, 5, 6, 8, 11, 12, 12, 13]))
            assert dealt and {str(r["doc_id"]) for r in dealt} <= set(ids)  # the mix reads no document without words


def test_run_gives_the_last_stage(spark):
    out = corpus_pipeline.run(spark, DATA)
    assert {"doc_id", "text", "shard", "slot"} <= set(out.columns) and out.count() > 100
    assert out.where(F.col("slot").isNull()).count() == 0
