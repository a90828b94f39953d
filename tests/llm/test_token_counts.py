import json
import random

import numpy as np
import public_tokenizers
import pytest

from arealis.llm import token_counts, transducer
from arealis.llm.queries import op11_token_counts

PATH = public_tokenizers.path(token_counts.VOCABULARY)
PIECES = ["hello", "World", "'s", "'re", "'", "''", " ", "  ", "\n", "12", "３", "é", "é", "İ", "ß", "ΑΣ", "Σ", "日本", "😀", "<|endoftext|>", "<|startoftext|>", "<|", "aaaa", "!!!", "!'", "_", " ", "​", "ﬁ", "́", "각", "ᄀ", "ᅡ", "zzzz", "ing", "tion", "'ll", "'D", "½", "²", "\x1c", "\x85", "क्षि", "\0"]


@pytest.fixture(scope="module")
def counter():
    return token_counts.Counter(token_counts.compile_rules(open(PATH, "rb").read()))


def library(texts):
    from tokenizers import Tokenizer

    return [len(e.ids) for e in Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)]


def scrambled(rng, most=40):
    return "".join(rng.choice(PIECES) for _ in range(rng.randint(0, most)))


def test_texts_match_the_library(counter):
    rng = random.Random(1)
    texts = [scrambled(rng) for _ in range(2500)]
    want = library(texts)
    for chunk in (64, 2048):
        assert counter.count(texts, chunk).tolist() == want


def test_words_over_many_chunks(counter):
    rng = random.Random(2)
    texts = ["".join(rng.choice(kind) for _ in range(n)) for kind in ("a", "ab", "aeiou", "abcdefghijklmnopqrstuvwxyz", "é日a", "!?.-=", "ing", "xyz'") for n in (1, 63, 64, 65, 300, 4000)]
    want = library(texts)
    for chunk in (64, 101):
        assert counter.count(texts, chunk).tolist() == want


def test_full_table_and_small_pieces(counter, monkeypatch):
    rng = random.Random(3)
    texts = [scrambled(rng, 400) for _ in range(150)]
    monkeypatch.setattr(counter.machine, "most_cells", 1)
    monkeypatch.setattr(token_counts, "PIECE", 17)
    monkeypatch.setattr(token_counts, "STREAM", 1000)
    assert counter.count(texts, 64).tolist() == library(texts)


def test_characters_match_the_library(counter):
    """Every code point between letters and between other characters."""
    points = [chr(c) for c in [*range(0x3000), *range(0xA000, 0xD800, 7), *range(0xE000, 0x30000, 11), *range(0x30000, 0x110000, 4001)]]
    texts = [f"a{c}b !{c}! {c} 1{c}'s" for c in points]
    assert [t for t, a, b in zip(texts, counter.count(texts).tolist(), library(texts), strict=True) if a != b] == []


def merged(symbols, pair):
    """Byte-pair encoding, one merge at a time."""
    out = list(symbols)
    while found := [(pair[p], i) for i, p in enumerate(zip(out, out[1:])) if p in pair]:
        t, i = min(found)
        out[i : i + 2] = [t]
    return out


def test_any_merge_list():
    """Random vocabularies over three letters, with tokens that are never used."""
    rng = random.Random(4)
    for _ in range(25):
        tokens, spelled, merges = [97, 98, 99, 353, 354, 355], {t: (t,) for t in (97, 98, 99, 353, 354, 355)}, []
        for _ in range(300):
            a, b = rng.choice([t for t in tokens if spelled[t][-1] < 256]), rng.choice(tokens)
            s = spelled[a] + spelled[b]
            if len(merges) < 40 and len(s) < 9 and s not in spelled.values():
                tokens.append(512 + len(merges))
                spelled[tokens[-1]] = s
                merges.append((a, b))
        machine = transducer.Transducer(merges)
        words = [[rng.choice((97, 98, 99)) for _ in range(rng.choice([1, 5, 30, 90]))] for _ in range(40)]
        for w in words:
            w[-1] += 256
        want = [len(merged(w, machine.pair)) for w in words]
        symbols = np.array([s for w in words for s in w], np.uint16)
        edges = np.cumsum([0, *map(len, words)])
        for chunk in (1, 37):
            sums = np.concatenate([[0], np.cumsum(machine.count(symbols, chunk))])
            assert (sums[edges[1:]] - sums[edges[:-1]]).tolist() == want


def test_scan_is_the_running_combination():
    for n in range(12):
        items = [(f"{i}",) for i in range(n)]
        assert transducer.prefix_scan(items, lambda a, b: a + b) == [tuple(str(j) for j in range(i + 1)) for i in range(n)]


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError):
        token_counts.compile_rules(open(public_tokenizers.path("byte_bpe_50k.json"), "rb").read())
    spec = json.load(open(PATH))
    spec["added_tokens"][0]["lstrip"] = True
    with pytest.raises(ValueError):
        token_counts.compile_rules(json.dumps(spec).encode())


def test_query_and_awkward_tables(spark, awkward, empty, tmp_path):
    awkward.select("doc_id", "text").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((str(r["doc_id"]), r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in op11_token_counts(spark, str(tmp_path)).collect())
    rows = [(r["doc_id"], r["text"] or "") for r in awkward.collect()]
    want = sorted((str(i), len(t.encode()), n, n > 2048) for (i, t), n in zip(rows, library([t for _, t in rows])))
    assert got == want
    out = token_counts.count_tokens(awkward, out="n")
    assert out.columns == [c for c in awkward.columns if c != "n"] + ["n"] and out.count() == awkward.count()
    assert token_counts.count_tokens(empty).count() == 0
