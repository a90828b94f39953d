"""Token counts under a public vocabulary of byte pairs, by a compiled transducer."""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arealis.llm.common import fresh, quoted, text_of
from arealis.llm.transducer import SYMBOLS, Transducer

VOCABULARY = "word_bpe_49k.json"
VOCABULARY_LIMIT = 64 << 20
PIECE = 1 << 20  # characters cut into words at a time
STREAM = 1 << 21  # characters of short texts counted together
SPACE, LETTER, NUMBER, OTHER = range(4)
# the split and the normalizers of the public word vocabulary, fixed values
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NORMALIZERS = ["NFC", "Replace", "Lowercase"]
WORD_END = "</w>"


@dataclass(frozen=True)
class Rules:
    """What a vocabulary file says, compiled on the driver and sent to the tasks once: its size is bounded by the file's."""

    merges: tuple[tuple[int, int], ...]
    specials: tuple[str, ...]
    class_starts: np.ndarray  # code points where the class changes
    classes: np.ndarray
    lower_from: np.ndarray
    lower_to: np.ndarray


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies: itself if printable, else the next from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = iter(range(256, 512))
    return [chr(b) if b in set(shown) else chr(next(hidden)) for b in range(256)]


def _merge_numbers(model: dict) -> tuple[tuple[int, int], ...]:
    """Merges as pairs of token numbers: bytes, bytes that close a word, then merges in order."""
    number = {c: b for b, c in enumerate(byte_letters())}
    number |= {c + WORD_END: 256 + b for b, c in enumerate(byte_letters())}
    out = []
    for i, merge in enumerate(model["merges"]):
        a, b = merge.split(" ") if isinstance(merge, str) else merge
        out.append((number[a], number[b]))
        if a + b in number:
            raise ValueError(f"the merge of {a!r} and {b!r} gives an earlier token")
        number[a + b] = SYMBOLS + i
    if missing := [t for t in number if t not in model["vocab"]]:
        raise ValueError(f"{len(missing)} symbols or merges are not in the vocabulary")
    return tuple(out)


def _character_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Classes and lower case of all code points, read off the tokenizer library's own parts."""
    from tokenizers import Regex, normalizers, pre_tokenizers

    split, lower = pre_tokenizers.Split(Regex(SPLIT), "removed", invert=True), normalizers.Lowercase()
    shrink = normalizers.Replace(Regex(r"\s+"), " ")
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    classes, pairs = np.full(0x110000, OTHER, np.uint8), []
    for i in range(0, len(points), 1 << 15):
        block = points[i : i + (1 << 15)]
        # private use and planes without letters: one look at the block's ends settles it
        if block[0] >= 0x40000 and not 0xE0000 <= block[0] < 0xF0000:
            block = [block[0], block[-1]]
        low = lower.normalize_str("\0".join(map(chr, block))).split("\0") if 0 not in block else ["\0"] + lower.normalize_str("\0".join(map(chr, block[1:]))).split("\0")
        pairs += [(c, ord(t)) for c, t in zip(block, low, strict=True) if len(t) == 1 and ord(t) != c]
        blank = np.array([shrink.normalize_str(chr(c)) == " " for c in block]) if block[0] < 0x10000 else np.zeros(len(block), bool)
        for tail, kind in (("a", LETTER), ("!", OTHER)):
            whole = {a // 3 for _, (a, b) in split.pre_tokenize_str("".join(f"{chr(c)}{tail} " for c in block)) if a % 3 == 0 and b - a == 2}
            member = np.isin(np.arange(len(block)), list(whole))
            classes[np.array(block)[member]] = kind
            if kind == LETTER:
                letter = member
            else:
                classes[np.array(block)[~member & ~letter & ~blank]] = NUMBER
        classes[np.array(block)[blank]] = SPACE
    starts = np.concatenate([[0], np.flatnonzero(np.diff(classes)) + 1])
    lows = np.array(pairs, np.int64).reshape(-1, 2)
    return starts, classes[starts], lows[:, 0], lows[:, 1]


_compiled: dict[bytes, Rules] = {}


def compile_rules(content: bytes) -> Rules:
    """Read a vocabulary file of the one kind that the transducer covers; anything else raises an error."""
    if content in _compiled:
        return _compiled[content]
    spec = json.loads(content)
    model = spec["model"]
    parts = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
    splits = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
    plain = all(not model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges"))
    if model.get("type", "BPE") != "BPE" or not plain or model.get("end_of_word_suffix") != WORD_END or parts != NORMALIZERS or not splits or splits[0]["pattern"] != {"Regex": SPLIT}:
        raise ValueError("not a vocabulary of byte pairs with word ends, lower case and the known split")
    added = spec["added_tokens"]
    if any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in added):
        raise ValueError("an added token is matched in normalized text or takes its surroundings")
    specials = tuple(sorted((t["content"] for t in added), key=lambda t: (-len(t), t)))
    _compiled[content] = Rules(_merge_numbers(model), specials, *_character_tables())
    return _compiled[content]


class Counter:
    """The compiled rules inside a task: one per process and vocabulary."""

    def __init__(self, rules: Rules):
        self.machine = Transducer(rules.merges)
        spans = np.diff(np.append(rules.class_starts, 0x110000))
        self.classes = np.repeat(rules.classes, spans)
        self.lower = np.arange(0x110000, dtype=np.uint32)
        self.lower[rules.lower_from] = rules.lower_to
        self.special = re.compile("|".join(map(re.escape, rules.specials))) if rules.specials else None

    def normal(self, text: str) -> tuple[str, int]:
        """The text with special tokens as breaks and composed characters, and the number of special tokens."""
        found = 0
        if self.special is not None:
            text, found = self.special.subn(" ", text)
        if not text.isascii():
            if not unicodedata.is_normalized("NFC", text):
                from tokenizers import normalizers

                nfc = normalizers.NFC()
                text = "".join(nfc.normalize_str(text[a:b]) for a, b in _pieces(text, PIECE))
            text = text.replace("İ", "i̇")  # the one character whose lower case is two
        return text, found

    def symbols(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of a normal text, and for each of its characters how many symbols stand before it."""
        out, before, kept, last = [], [], 0, SPACE
        for a, b in _pieces(text, PIECE):
            points = self.lower[np.frombuffer(text[a:b].encode("utf-32-le"), np.uint32)]
            kinds = self.classes[points]
            after = self.classes[self.lower[ord(text[b])]] if b < len(text) else SPACE
            begins = _word_starts(points, kinds, last)
            follows = np.append(begins[1:] | (kinds[1:] == SPACE), after in (SPACE, NUMBER) or after != kinds[-1])
            data = np.frombuffer(points.tobytes().decode("utf-32-le").encode(), np.uint8)
            width = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
            stop = np.cumsum(width) - 1
            words = kinds != SPACE
            symbols = data.astype(np.uint16)
            symbols[stop[words & follows]] += 256
            taken = np.where(words, width, 0)
            out.append(symbols if words.all() else symbols[np.repeat(words, width)])
            before.append(kept + np.cumsum(taken) - taken)
            kept += int(taken.sum())
            last = int(kinds[-1])
        return (np.concatenate(out), np.concatenate(before)) if out else (np.zeros(0, np.uint16), np.zeros(0, np.int64))

    def count(self, texts: list[str], chunk: int = 2048) -> np.ndarray:
        """Tokens of each text.  Short texts share a stream of symbols, in which words never cross texts."""
        total = np.zeros(len(texts), np.int64)
        normal = []
        for i, text in enumerate(texts):
            body, total[i] = self.normal(text)
            normal.append(body)
        at = 0
        while at < len(normal):
            end, size = at + 1, len(normal[at])
            while end < len(normal) and size + len(normal[end]) < STREAM:
                size += len(normal[end]) + 1
                end += 1
            some = normal[at:end]
            symbols, before = self.symbols(" ".join(some))
            begin = np.concatenate([[0], np.cumsum([len(t) + 1 for t in some])])
            edges = np.append(before, len(symbols))[np.minimum(begin, len(before))]
            sums = np.concatenate([[0], np.cumsum(self.machine.count(symbols, chunk))])
            total[at:end] += sums[edges[1:]] - sums[edges[:-1]]
            at = end
        return total


def _word_starts(points: np.ndarray, kinds: np.ndarray, last: int) -> np.ndarray:
    """Where words begin: runs of letters, single numbers, runs of other characters, and short endings after an apostrophe."""
    ahead = np.concatenate([[last], kinds[:-1]])
    begins = (kinds != SPACE) & ((kinds != ahead) | (kinds == NUMBER))
    for i in np.flatnonzero((points == 39) & (ahead != OTHER)).tolist():
        near = points[i + 1 : i + 3].tolist()
        if near and chr(near[0]) in "stmd":
            size = 2
        elif len(near) == 2 and chr(near[0]) + chr(near[1]) in ("re", "ve", "ll"):
            size = 3
        else:
            continue
        begins[i + 1 : i + size] = False
        if i + size < len(kinds) and kinds[i + size] == LETTER:
            begins[i + size] = True
    return begins


def _pieces(text: str, size: int) -> Iterator[tuple[int, int]]:
    """Ranges of about ``size`` characters, cut only where no character composes and no ending after an apostrophe is split."""
    a, n = 0, len(text)
    while a < n:
        b = min(a + size, n)
        while b < n and not (_stands_alone(text[b]) and "'" not in text[b - 3 : b]):
            b += 1
        yield a, b
        a = b


def _stands_alone(c: str) -> bool:
    """Characters that never compose with one before them: up to U+02FF, kana, ideographs and Hangul syllables."""
    return c < "̀" or "ぁ" <= c < "゙" or "゠" <= c < "힤"


_counters: dict[tuple, Counter] = {}


def counter_of(name: bytes, rules) -> Counter:
    """The counter of a vocabulary in this process; ``rules`` is called where there is none yet."""
    if name not in _counters:
        _counters[name] = Counter(rules())
    return _counters[name]


def read_vocabulary(spark: SparkSession, path: str | None) -> bytes:
    """A vocabulary file's bytes: by default the installed public one, else from any store that Spark reads; bounded by ``VOCABULARY_LIMIT``."""
    if path is None:
        import public_tokenizers

        with open(public_tokenizers.path(VOCABULARY), "rb") as f:
            return f.read(VOCABULARY_LIMIT)
    row = spark.read.format("binaryFile").load(path).select("length", "content").where(f"length <= {VOCABULARY_LIMIT}").first()
    if row is None:
        raise ValueError(f"{path} is missing or larger than {VOCABULARY_LIMIT} bytes")
    return bytes(row["content"])


def count_tokens(df: DataFrame, text: str = "text", out: str = "n_tokens", vocabulary: str | None = None) -> DataFrame:
    """Add the number of tokens of each whole text under a vocabulary of byte pairs with word ends, special tokens in texts included.

    The vocabulary is compiled to a transducer (see :mod:`arealis.llm.transducer`); tasks read their texts as chunks of
    symbols, all chunks at once, and compose the chunks' maps where a word is cut.  No text is cut short and memory beyond
    the text itself is bounded.

    Null and empty texts have no tokens; repeated rows get the same count; a column named ``out`` is replaced; an empty table
    stays empty; other columns are kept.
    """
    content = read_vocabulary(df.sparkSession, vocabulary)
    name = hashlib.sha256(content).digest()
    shipped = df.sparkSession.sparkContext.broadcast(compile_rules(content))
    df = df.drop(out)
    (body,) = fresh(df, "body")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, len(whole), 512):
                batch = whole.slice(i, 512)
                counts = counter_of(name, lambda: shipped.value).count(batch.column(body).to_pylist())
                rest = [n for n in batch.schema.names if n != body]
                yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in rest], pa.array(counts, pa.int64())], [*rest, out])

    schema = T.StructType([*df.schema.fields, T.StructField(out, T.LongType())])
    return df.withColumn(body, text_of(quoted(text))).mapInArrow(run, schema)
