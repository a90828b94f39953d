"""Secret scans: fixed patterns, and random strings that a public vocabulary cuts into many short tokens."""

from __future__ import annotations

import base64
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from arealis.llm.spans import Span, add_spans
from arealis.llm.wordhash import text_buffers

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
VOCABULARY_LIMIT = 64 << 20
BASE_KINDS = ["assign", "access", "hex"]
KINDS = [*BASE_KINDS, "random"]

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}")
PART = re.compile(r"[A-Za-z0-9+]{16,}")  # of a candidate, between separators
# the split of the public byte-level vocabulary, a fixed value
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

LETTER_RATIO = 1.9  # ordinary words of 16 letters come down to 2.2
DIGEST_LENGTHS = {32, 40, 56, 64, 96, 128}  # hexadecimal digits of the common digests
_HEXDIGITS = re.compile(r"[0-9a-f]+|[0-9A-F]+")
_UUID = re.compile(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
_NAMED_DIGEST = re.compile(r"(md5|sha1|sha256|sha384|sha512)[-_=][A-Za-z0-9+/=_-]+", re.I)
_NUMBERED = re.compile(r"[A-Za-z]+[-_/]?[0-9]+|[0-9+/_=-]+|[0-9]{4}-[0-9]{2}-[0-9]{2}[A-Za-z0-9+-]*")

_RUN = np.zeros(256, np.uint8)  # 1: in a candidate, 4: hexadecimal digit in lower case
_RUN[[*b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"]] = 1
_RUN[[*b"0123456789abcdef"]] |= 4
_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key", b"akia")


def is_known(string: str) -> bool:
    """Digests, UUIDs, numbers, dates and names with a number: random or dense, but no secrets."""
    return bool((_HEXDIGITS.fullmatch(string) and len(string) in DIGEST_LENGTHS) or any(p.fullmatch(string) for p in (_UUID, _NAMED_DIGEST, _NUMBERED)))


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns, by start and then kind; a failing match is dropped with the text that it took."""
    out = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    out += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    out += [("hex", *m.span()) for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[1], BASE_KINDS.index(s[0])))


def random_spans(text: str, encoding, ratio: float, letter_ratio: float = LETTER_RATIO) -> list[Span]:
    """Unknown strings with at most ``ratio`` characters per token; ``letter_ratio`` for those without a digit.

    Where a whole candidate is neither known nor dense, what stands between its separators is judged by itself, so that a path
    or a name does not hide the random string that it is joined to.
    """

    def dense(string: str) -> bool:
        most = ratio if any(c.isdigit() for c in string) else letter_ratio
        return len(string) <= most * len(encoding.encode_ordinary(string))

    out = []
    for m in CANDIDATE.finditer(text):
        if is_known(m[0]):
            continue
        if dense(m[0]):
            out.append(("random", *m.span()))
            continue
        for part in PART.finditer(m[0]):
            if part.span() != (0, len(m[0])) and not is_known(part[0]) and dense(part[0]):
                out.append(("random", m.start() + part.start(), m.start() + part.end()))
    return out


def suspicious_rows(column: pa.Array) -> np.ndarray:
    """Rows that can hold any span: those with a key word, or with a long run of hexadecimal digits or of characters of a candidate.

    Only whether a row is read in detail depends on this, and no row with a span is passed over.
    """
    at, data = text_buffers(column)
    out = np.zeros(len(at) - 1, bool)
    for r in range(len(at) - 1):
        piece = data[at[r] : at[r + 1]]
        if len(piece) < 12:
            continue
        low = piece.tobytes().lower()
        if any(w in low for w in _WORDS):
            out[r] = True
            continue
        for i in range(0, len(piece), 1 << 20):
            kind = _RUN[piece[max(0, i - 64) : i + (1 << 20)]]
            for bit, length in ((4, 32), (1, 16)):
                inside = np.concatenate([[0], (kind & bit) != 0, [0]]).astype(np.int8)
                edge = np.diff(inside)
                begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
                long = end - begin >= length
                if long.any():
                    out[r] = True
    return out


_encodings: dict[bytes, object] = {}


def encoding_of(ranks: bytes):
    """The tiktoken encoding of a rank file's bytes, made once per process."""
    if ranks not in _encodings:
        import tiktoken

        pairs = (line.split() for line in ranks.splitlines() if line.strip())
        _encodings[ranks] = tiktoken.Encoding("vocabulary", pat_str=SPLIT, mergeable_ranks={base64.b64decode(a): int(b) for a, b in pairs}, special_tokens={})
    return _encodings[ranks]


def read_vocabulary(spark: SparkSession, path: str = VOCABULARY) -> bytes:
    """A rank file's bytes, from any store that Spark reads; refused beyond ``VOCABULARY_LIMIT`` bytes."""
    row = spark.read.format("binaryFile").load(path).select("length", "content").where(f"length <= {VOCABULARY_LIMIT}").first()
    if row is None:
        raise ValueError(f"{path} is missing or larger than {VOCABULARY_LIMIT} bytes")
    return bytes(row["content"])


def find_secrets(df: DataFrame, text: str = "text", out: str = "secrets", vocabulary: str = VOCABULARY, ratio: float = 2.2, letter_ratio: float = LETTER_RATIO) -> DataFrame:
    """Add the secrets of each whole text: an array of ``kind``, ``start`` and ``end`` (code points, end exclusive).

    Kinds ``assign``, ``access`` and ``hex`` are fixed patterns.  ``random`` is a string of at least 16 letters, digits and
    ``+/_=-`` that is no known digest, UUID, number, date or numbered name, and gives at most ``ratio`` characters per token,
    or ``letter_ratio`` if it has no digit; where the whole string is not, its parts between ``/_=-`` are judged.  Spans are ordered by start, then kind as listed.

    Null and empty texts have no spans; repeated rows get the same spans; a column named ``out`` is replaced; an empty
    table stays empty.
    """
    shipped = df.sparkSession.sparkContext.broadcast(read_vocabulary(df.sparkSession, vocabulary))

    def find(column: pa.Array) -> list[list[Span]]:
        found: list[list[Span]] = [[] for _ in range(len(column))]
        for r in np.flatnonzero(suspicious_rows(column)):
            body = column[int(r)].as_py() or ""
            spans = base_spans(body) + random_spans(body, encoding_of(shipped.value), ratio, letter_ratio)
            found[r] = sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))
        return found

    return add_spans(df, text, out, find)
