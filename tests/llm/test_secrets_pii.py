import random
import re
import string

import numpy as np

from arealis.llm import char_tagger, pii, secrets


def plain_secrets(text):
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    out = [(m.start(), 0, "assign", m.end()) for m in assign.finditer(text) if len(m[2]) >= 8]
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return [(k, s, e) for s, _, k, e in sorted(out)]


def plain_personal(text):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[ -]", "", m[0])
        if 13 <= len(digits) <= 19:
            double = [sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits))]
            if sum(double) % 10 == 0:
                out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return out


def scrambled(rng, pieces):
    return "".join(rng.choice(pieces) for _ in range(rng.randint(1, 60)))


SECRET_PIECES = ["token", "API_KEY", "apikey", "password", "secret", ": ", "=", " = ", '"', "'", "AKIA", "ABCDEFGHIJKL", "0123456789abcdef", "é", " ", "\n", "x", "token: token = ", "a1B2c3D4e5", "ſecret", "toKen"]
PERSONAL_PIECES = ["a", "b.c", "@", "@x.org", ".", "-", "10", "255", "256", "1.2.3.4", "4111 1111 1111 1111", "+1 ", "(555) ", "555-0100", " ", "é", "%", "+", "007", "x@y"]


def test_base_spans_match_plain_patterns():
    rng = random.Random(0)
    for _ in range(4000):
        text = scrambled(rng, SECRET_PIECES)
        assert secrets.base_spans(text) == plain_secrets(text), text
        text = scrambled(rng, PERSONAL_PIECES)
        assert pii.base_spans(text) == plain_personal(text), text


def test_no_row_with_a_span_is_passed_over():
    import pyarrow as pa

    rng = random.Random(2)
    texts = [scrambled(rng, [*SECRET_PIECES, "lorem ", "ipsum "]) for _ in range(2000)]
    flagged = secrets.suspicious_rows(pa.array(texts))
    encoding = secrets.encoding_of(open(secrets.VOCABULARY, "rb").read())
    for text, flag in zip(texts, flagged, strict=True):
        assert flag or not (secrets.base_spans(text) or secrets.random_spans(text, encoding, 2.2))


def test_random_strings_and_known_ones(spark):
    rng = random.Random(1)
    letters = string.ascii_letters + string.digits
    random_strings = ["".join(rng.choice(letters) for _ in range(32)) for _ in range(200)]
    known = ["d41d8cd98f00b204e9800998ecf8427e", "550e8400-e29b-41d4-a716-446655440000", "sha256-" + "a" * 44, "2024-01-31T10:20:30", "version-20240131", "internationalization2", "1234567890123456"]
    rows = [(i, f"é {s} end") for i, s in enumerate(random_strings + known)] + [(999, None), (1000, "")]
    found = secrets.find_secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    hits = {r["doc_id"]: [(s["kind"], r["text"][s["start"] : s["end"]]) for s in r["secrets"]] for r in found}
    caught = sum(("random", s) in hits[i] for i, s in enumerate(random_strings))
    assert caught >= 190
    assert not any(k == "random" for i in range(200, 200 + len(known)) for k, _ in hits[i])
    assert hits[999] == hits[1000] == []


def test_random_strings_of_letters_alone():
    import pyarrow as pa

    rng = random.Random(4)
    encoding = secrets.encoding_of(open(secrets.VOCABULARY, "rb").read())
    for alphabet, least in ((string.ascii_letters, 0.98), (string.ascii_uppercase, 0.95), (string.ascii_lowercase, 0.8)):
        for size in (16, 20, 24, 32, 40):
            texts = ["é " + "".join(rng.choice(alphabet) for _ in range(size)) + " end" for _ in range(300)]
            assert secrets.suspicious_rows(pa.array(texts)).all()
            assert sum(secrets.random_spans(t, encoding, 2.2) == [("random", 2, 2 + size)] for t in texts) >= least * 300
    ordinary = "internationalization counterrevolutionaries some/ordinary/path_name ================ self-congratulatory Donaudampfschifffahrt"
    assert secrets.random_spans(ordinary, encoding, 2.2) == []


def test_random_strings_joined_to_their_surroundings():
    """A path, a name or a sign of equality before a random string does not hide it, and ordinary paths stay ordinary."""
    rng = random.Random(5)
    encoding = secrets.encoding_of(open(secrets.VOCABULARY, "rb").read())
    for lead in ("path/to/deployment/", "credential=", "service_account_", "storage-container-production-"):
        for size in (16, 24, 40):
            strings = ["".join(rng.choice(string.ascii_letters + string.digits) for _ in range(size)) for _ in range(300)]
            found = [secrets.random_spans(f"é {lead}{x} end", encoding, 2.2) for x in strings]
            assert sum(len(f) == 1 and f[0][1] <= 2 + len(lead) and f[0][2] == 2 + len(lead) + size for f in found) >= 0.96 * 300
    ordinary = "documentation/internationalization/README user_authentication_configuration https-configuration-management=understanding"
    assert secrets.random_spans(ordinary, encoding, 2.2) == []


def test_tagger_slopes():
    rng = np.random.default_rng(0)
    p = {k: v.astype(float) for k, v in char_tagger.start_parameters(3, 4, 5, 0).items()}
    codes, gold = rng.integers(0, 97, (3, 7)).astype(np.int16), rng.integers(0, 3, (3, 7))
    _, slope = char_tagger.slopes(p, codes, gold)
    for name, values in p.items():
        at = (codes[0, 0], 1) if name == "embed" else tuple(rng.integers(0, s) for s in values.shape)
        up, down = ({**p, name: values.copy()} for _ in range(2))
        up[name][at] += 1e-3
        down[name][at] -= 1e-3
        numeric = (char_tagger.slopes(up, codes, gold)[0] - char_tagger.slopes(down, codes, gold)[0]) / 2e-3
        assert abs(numeric - slope[name][at]) < 1e-4


def test_decode_is_the_best_path():
    from itertools import product

    rng = np.random.default_rng(3)
    moves = rng.normal(size=(3, 3))
    runs = [rng.normal(size=(n, 3)) for n in (4, 1, 6, 0)]
    for scores, path in zip(runs, char_tagger.decode(runs, moves), strict=True):
        ways = {p: sum(scores[t, x] for t, x in enumerate(p)) + sum(moves[a, b] for a, b in zip(p, p[1:], strict=False)) for p in product(range(3), repeat=len(scores))}
        assert tuple(path) == max(ways, key=ways.get)


def test_tagger_finds_held_out_spans(spark):
    texts = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("text rlike '[0-9@]'").orderBy("doc_id").select("text").collect()]
    model = pii.fit([t for t in texts[: len(texts) // 2] if len(t) < 1 << 14])
    rest = texts[len(texts) // 2 :]
    total = hit = 0
    for text, tagged in zip(rest, pii.tagged_spans(rest, model), strict=True):
        for kind, start, end in pii.base_spans(text):
            total += 1
            hit += any(k == f"tagged_{kind}" and a < end and b > start for k, a, b in tagged)
    assert total > 100 and hit / total > 0.9


def test_awkward_rows(spark, awkward, empty, prose):
    model = pii.fit([f"{prose(4)} mail{i}@site{i}.org {prose(3)} 10.0.0.{i} {prose(4)}" for i in range(40)], steps=30)
    assert pii.find_personal_data(empty, model).count() == 0 and secrets.find_secrets(empty).count() == 0
    for out in (pii.find_personal_data(awkward, model), secrets.find_secrets(awkward)):
        assert out.columns[:-1] == awkward.columns and out.count() == awkward.count() and out.where(f"{out.columns[-1]} is null").count() == 0
    assert pii.find_personal_data(awkward, pii.fit([])).count() == awkward.count()
    assert pii.base_spans("1" * 200_000) == [] and pii.base_spans("a" * 200_000) == [] and secrets.base_spans("token" + " " * 100_000) == []
