from itertools import product

import numpy as np
import pyarrow as pa

from arealis.llm import toxicity


def test_marginals_match_enumeration():
    rng = np.random.default_rng(0)
    lengths = np.array([3, 0, 5, 1])
    scores, moves = rng.normal(size=9) * 2, rng.normal(size=(2, 2))
    got, pairs = toxicity.marginals(scores, lengths, moves)
    expected, moved, at = np.zeros(9), np.zeros((2, 2)), 0
    for n in lengths:
        weight = {}
        for path in product((0, 1), repeat=int(n)):
            w = sum(scores[at + t] for t in range(n) if path[t]) + (moves[0, path[0]] if n else 0)
            weight[path] = np.exp(w + sum(moves[a, b] for a, b in zip(path, path[1:], strict=False)))
        total = sum(weight.values())
        for path, w in weight.items():
            for t in range(n):
                expected[at + t] += path[t] * w / total
            for a, b in zip(path, path[1:], strict=False):
                moved[a, b] += w / total
        at += n
    assert np.allclose(got, expected) and np.allclose(pairs, moved)


def writer(prose, rng, bad):
    words = prose(int(rng.integers(30, 200))).split()
    for _ in range(int(rng.integers(2, 6)) if bad else 0):
        words.insert(int(rng.integers(0, len(words))), rng.choice(["Vile!", "grubbler", "grubbing", "grubbed,", "VILE"]))
    return " ".join(words)


def test_learns_words_and_stems_and_finds_offsets(prose):
    rng = np.random.default_rng(1)
    y = rng.random(600) < 0.2
    texts = [writer(prose, rng, b) for b in y]
    model = toxicity.fit(texts[:400], y[:400])
    score, spans = toxicity.score_column(pa.array([*texts[400:], "é😀 so vile, he said grubbest"]), model)
    assert ((score[:-1] >= 0.7) == y[400:]).mean() > 0.98
    tail = "é😀 so vile, he said grubbest"
    assert [tail[a:b] for a, b in spans[-1]] == ["vile", "grubbest"]
    assert ((score >= 0) & (score <= 1)).all()


def test_only_near_copies_of_the_same_label_are_left_out():
    rng = np.random.default_rng(2)

    def doc(*parts):
        out = np.zeros((sum(map(len, parts)), 5), np.int32)
        out[:, 0] = np.concatenate(parts)
        return out

    word = lambda n: rng.integers(1, 1 << 18, n)
    shared = word(80)
    docs = [doc(shared, word(80)) for _ in range(60)]  # one passage in all: pairs at a third
    near = docs[0].copy()
    near[100, 0] += 1
    docs += [near, near, docs[1], np.zeros((0, 5), np.int32)]
    toxic = np.array([i % 2 for i in range(60)] + [0, 1, 1, 0], float)
    # 60 is a copy of 0, and 62 of 1; 61 is one of 0 too, but of the other label
    assert toxicity._without_copies(docs, toxic) == [*range(60), 61, 63]
    new = toxicity._new_tokens(docs[:4], toxic[:4])
    assert new[0].all() and new[1].all()
    assert not new[2][:76].any() and new[2][76:].all() and not new[3][:76].any() and new[3][76:].all()


def test_held_out_accuracy_on_the_documents(spark):
    from arealis.llm.queries import op8_toxicity

    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    held = op8_toxicity(spark, sf).where("held_out").join(labels, "doc_id").toPandas()
    hit = held["predicted"] == held["toxic"]
    assert hit.mean() > 0.97 and held[held["toxic"] == 1]["predicted"].mean() > 0.75 and held[held["toxic"] == 0]["predicted"].mean() < 0.01


def test_pieces_do_not_change_features(prose, monkeypatch):
    texts = pa.array([prose(300), "", None, "ÀÉ x", prose(20)])

    def listed():
        out = {}
        for row, _, feats, b, e in toxicity.batch_features(texts):
            for i in range(len(b)):
                out.setdefault(row, []).append((*feats[i], b[i], e[i]))
        return out

    whole = listed()
    monkeypatch.setattr(toxicity, "PIECE", 50)
    assert listed() == whole


def test_awkward_rows(spark, awkward, empty):
    model = toxicity.fit(["vile words here", "fine words here"] * 30, np.array([1, 0] * 30))
    assert toxicity.score_toxicity(empty, model).count() == 0
    got = toxicity.score_toxicity(awkward, model)
    assert got.columns == [*awkward.columns, "toxicity", "toxic_spans"] and got.count() == awkward.count()
    assert got.where("toxicity is null or toxicity < 0 or toxicity > 1").count() == 0
    same = toxicity.score_toxicity(got, model)
    assert same.columns == got.columns
    labels = spark.createDataFrame([(1, None), (2, 1), (None, 0), (8, 1), (8, 0)], "doc_id long, toxic int")
    base = toxicity.fit_on_table(awkward, labels)
    assert toxicity.score_toxicity(awkward, base).count() == awkward.count()
