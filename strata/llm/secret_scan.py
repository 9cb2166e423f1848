"""Secret scan: sliding-window Shannon entropy beside three base patterns.

Base kinds, leftmost and non-overlapping per kind: ``assign`` (a secret's name,
a separator and a value of 12 or more), ``access`` (an access key id of 18 or
more), ``hex`` (16 or more hexadecimal digits).  The method adds ``entropy``:
every run of 20 or more token characters is a candidate; a window slides over
the candidate with running character counts, so each step changes two terms of
the entropy, and windows above the threshold of the candidate's character class
join into one span.  Allow-listed candidates (placeholders, plain words
and names made of them with one digit at most, numbers, identifiers in UUID
form, hosts and paths of web addresses) are suppressed, and so are spans that a
base span already covers.  Letters of one case that could be words are taken
for words.

Null and empty texts have no spans; long texts are scanned whole, in blocks;
repeated rows get equal results; an empty table gives an empty table.
"""

from __future__ import annotations

import math
import re
import string

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.words import Texts, bounded_batches, byte_class, code_points, parts, runs

KINDS = ("assign", "access", "hex", "entropy")
#: Fixed patterns of the base kinds.
ASSIGN = re.compile(
    r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 12, 18, 16
_NAMES = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")

_HEX = byte_class("0123456789abcdef")
_TOKEN = byte_class(string.ascii_letters + string.digits + "+/_=-")
CANDIDATE_LEAST = 20
WINDOW = 20
#: Bits per character from which a window is random, by character class.
THRESHOLDS = {"hex": 3.0, "lower": 3.7, "mixed": 3.8, "base64": 3.9}
#: Allow-list: candidates that look random and are not secret.
ALLOWED = re.compile(r"(?i)^(?:[0-9_=+/-]+|[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12})$", re.ASCII)
#: Words of placeholders: a candidate is one if such a word is a part of its own in it, or if
#: nothing random is left without them.
_WORDS = "example|sample|placeholder|changeme|dummy|redacted|lorem|abcdefgh|12345678"
PLACEHOLDER = re.compile(f"(?i){_WORDS}", re.ASCII)
_OWN_PART = re.compile(f"(?i)(?<![A-Za-z0-9])(?:{_WORDS})(?![A-Za-z0-9])", re.ASCII)
#: Parts of names in one case or camel case; a word has vowels and no long run of consonants.
_PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
_VOWELS = re.compile(r"(?i)[aeiouy]")
_CONSONANTS = re.compile(r"(?i)[^aeiouy]{6}")
#: Share of the letters that lie in words, from which a candidate is made of words.
PLAIN_SHARE = 0.7
#: What ends the surroundings of a candidate.
_EDGE = byte_class(" \t\n\v\f\r\"'<>(),;{}|`[]")
_SCHEME = re.compile(rb"[A-Za-z][A-Za-z0-9+.-]*://[^?#]*\Z")
_HOST = re.compile(rb"(?:[^\s@/]+@)?(?:[a-z0-9_-]+\.)+[a-z]{2,18}\.?(?:[:/?#].*)?\Z", re.DOTALL)
_TERM = [0.0] + [n * math.log2(n) for n in range(1, WINDOW + 1)]

SPAN_TYPE = T.ArrayType(
    T.StructType(
        [
            T.StructField("kind", T.StringType()),
            T.StructField("start", T.IntegerType()),
            T.StructField("end", T.IntegerType()),
        ]
    )
)
_ARROW_SPAN = pa.list_(
    pa.struct([pa.field("kind", pa.string()), pa.field("start", pa.int32()), pa.field("end", pa.int32())])
)


def character_class(word: str) -> str:
    if re.fullmatch(r"[0-9a-fA-F]+", word):
        return "hex"
    if re.fullmatch(r"[a-z0-9_-]+|[A-Z0-9_-]+", word):
        return "lower"
    return "base64" if re.search(r"[+/=]", word) else "mixed"


def random_span(word: str) -> tuple[int, int] | None:
    """The extent of all windows whose entropy reaches the class threshold."""
    least = THRESHOLDS[character_class(word)]
    counts: dict[str, int] = {}
    terms, first, last = 0.0, -1, -1
    for i, c in enumerate(word):
        if i >= WINDOW:
            gone = word[i - WINDOW]
            n = counts[gone]
            terms += _TERM[n - 1] - _TERM[n]
            counts[gone] = n - 1
        n = counts.get(c, 0)
        terms += _TERM[n + 1] - _TERM[n]
        counts[c] = n + 1
        if i >= WINDOW - 1 and math.log2(WINDOW) - terms / WINDOW >= least:
            first = i - WINDOW + 1 if first < 0 else first
            last = i + 1
    return (first, last) if first >= 0 else None


def made_of_words(word: str) -> bool:
    """Whether most letters lie in parts that read like words, with one digit at most."""
    if sum(c.isdigit() for c in word) > 1:
        return False
    found = _PART.findall(word)
    like = sum(
        len(p)
        for p in found
        if len(p) > 2 and len(_VOWELS.findall(p)) >= 0.25 * len(p) and not _CONSONANTS.search(p)
    )
    return like >= PLAIN_SHARE * sum(map(len, found))


def is_placeholder(word: str) -> bool:
    """Whether a word of placeholders stands by itself, or what it is attached to is not random."""
    if _OWN_PART.search(word):
        return True
    rest, n = PLACEHOLDER.subn("", word)
    return n > 0 and (len(rest) < CANDIDATE_LEAST or made_of_words(rest) or random_span(rest) is None)


def _in_address(texts: Texts, edges: np.ndarray, row: int, begin: int, end: int) -> bool:
    """Whether a candidate after ``://``, a stop or an at sign is in the host or path of an address.

    ``edges`` are the places of all bytes that end surroundings, in order.
    """
    low, high = texts.start[row], texts.start[row + 1]
    if not texts.data[max(begin - 3, low) : begin].tobytes().endswith((b"://", b".", b"@")):
        return False
    at = int(np.searchsorted(edges, begin))
    first = max(int(edges[at - 1]) + 1, low) if at else low
    last = min(int(edges[at]), high) if at < len(edges) else high
    if _SCHEME.search(texts.data[first:begin].tobytes()):
        return True
    return _HOST.match(texts.data[first:last].tobytes()) is not None


def _entropy_spans(texts: Texts) -> list[tuple[int, int, int]]:
    found = []
    edges: np.ndarray | None = None
    for row, begin, end in zip(*runs(texts, _TOKEN, CANDIDATE_LEAST), strict=True):
        word = texts.data[begin:end].tobytes().decode("ascii")
        if ALLOWED.match(word) or made_of_words(word) or is_placeholder(word):
            continue
        edges = np.flatnonzero(_EDGE[texts.data]) if edges is None else edges
        if _in_address(texts, edges, row, begin, end):
            continue
        span = random_span(word)
        if span:
            found.append((int(row), int(begin) + span[0], int(begin) + span[1]))
    return found


def _spans(texts: Texts) -> list[list[tuple[int, int, int]]]:
    """Per text: (start, kind number, end) in characters, in order."""
    rows: list[list[tuple[int, int, int]]] = [[] for _ in range(texts.rows)]
    row, begin, end = runs(texts, _HEX, HEX_LEAST)
    extra = _entropy_spans(texts)
    more = [np.array([x[i] for x in extra], np.int64) for i in range(3)]
    every = np.concatenate([row, more[0]])
    starts = code_points(texts, every, np.concatenate([begin, more[1]]))
    ends = code_points(texts, every, np.concatenate([end, more[2]]))
    for i, (r, s, e) in enumerate(zip(every, starts, ends, strict=True)):
        rows[r].append((int(s), 2 if i < len(row) else 3, int(e)))
    for r in range(texts.rows):
        raw = texts.data[texts.start[r] : texts.start[r + 1]].tobytes()
        named = any(name in (low := raw.lower()) for name in _NAMES) if raw else False
        if not named and b"AKIA" not in raw:
            if len(rows[r]) > 1:
                rows[r] = _settled(rows[r])
            continue
        text = raw.decode("utf-8")
        if named:
            rows[r] += [
                (m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= ASSIGN_LEAST
            ]
        rows[r] += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LEAST]
        rows[r] = _settled(rows[r])
    return rows


def _settled(spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """In order of start and kind, without entropy spans that a base span touches."""
    base = [x for x in spans if x[1] < 3]
    return sorted(
        base + [x for x in spans if x[1] == 3 and not any(s < x[2] and x[0] < e for s, _, e in base)]
    )


@F.arrow_udf(SPAN_TYPE)
def _scan(column: pa.Array) -> pa.Array:
    found = [spans for texts in parts(column) for spans in _spans(texts)]
    return pa.array(
        [[{"kind": KINDS[k], "start": s, "end": e} for s, k, e in spans] for spans in found], _ARROW_SPAN
    )


def secret_spans(text: Column) -> Column:
    """All spans of a text, by start and kind: ``array<struct<kind, start, end>>``."""
    return _scan(text)


@F.arrow_udf(T.StringType())
def _redact(column: pa.Array) -> pa.Array:
    out = []
    for texts in parts(column):
        for r, spans in enumerate(_spans(texts)):
            text = texts.data[texts.start[r] : texts.start[r + 1]].tobytes().decode("utf-8")
            if spans:
                kept, at = [], 0
                for start, kind, end in spans:
                    if end <= at:
                        continue
                    kept += [text[at:start], f"[{KINDS[kind].upper()}]" if start >= at else ""]
                    at = end
                text = "".join([*kept, text[at:]])
            out.append(text)
    return pa.array(out, pa.string())


def redact_secrets(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Replace every secret by its kind in brackets; null texts stay null."""
    bounded_batches(docs.sparkSession)
    text = F.col(text_col)
    return docs.withColumn(text_col, F.when(text.isNotNull(), _redact(text)))


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: the id and ``secret_spans``; other columns are not read."""
    bounded_batches(docs.sparkSession)
    return docs.select(F.col(id_col), secret_spans(F.col(text_col)).alias("secret_spans"))
