"""Secret scan with password guess cost.

Three fixed patterns give the base spans (assignments to a credential name,
access keys, long hexadecimal runs). The method adds values that stand in a
wider credential context (a passphrase, a bearer header, a private key) and
would take many guesses: the cost of a value is that of its cheapest
segmentation into dictionary words, dates, repeats, keyboard walks and
brute-force spans, found by dynamic programming in time linear in its length.

Spans are code points of the text, end exclusive, written ``kind:start:end``.

Defined cases: a null text counts as empty and has no spans; equal matches of
different kinds are all listed, by start and then in the order assign, access,
hex, guess; repeated rows are scanned like any others.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from daymatrix.llm.common import map_rows

# The base patterns and their least lengths.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
ASSIGN_CHARS, ACCESS_CHARS = 8, 16
KINDS = ["assign", "access", "hex", "guess"]

#: Names that put the value after them in a credential context.
#: They begin where a word does, or a capital after a small letter.
CONTEXT = re.compile(
    r"""(?:(?<![a-z])|(?-i:(?<=[a-z])(?=[A-Z])))(?:pass(?:phrase|code|word|wd)?|pwd|bearer|auth(?:orization)?|credentials?|private[_-]?key|access[_-]?key|signing[_-]?key|client[_-]?secret|secret|token|api[_-]?key)"""
    r"""["']?\x20*[:=]\x20*["']?(?:bearer\x20+|basic\x20+)?([^\s"'<>,;]{8,})""",
    re.ASCII | re.IGNORECASE)
_NAMES = [b"passw", b"secret", b"token", b"apikey", b"api_key"]
_WIDER = [b"pass", b"pwd", b"bearer", b"auth", b"credential", b"-key", b"_key", b"privatekey", b"accesskey", b"signingkey"]
_HEX_TABLE = bytes(120 if b in b"0123456789abcdef" else 32 for b in range(256))
_HEX_RUN = b"x" * 32

#: Values of at least this many guesses (log10) are reported.
MIN_GUESSES = 10.0
#: Walks end at one of their first so many keys or where they end for good.
WALK_ENDS = 32
#: A letter sequence that reads like a word is one of about a million (log10).
ANY_WORD = 6.0

WORDS = (
    "password pass admin root user guest test example sample demo default changeme secret token key login welcome "
    "hello world letmein master super dragon monkey shadow sunshine princess football baseball soccer hockey love "
    "summer winter spring autumn monday friday money freedom trust batman star wars access server database mysql "
    "postgres oracle redis mongo local host localhost public private value string null none true false your my the "
    "and you here insert replace placeholder dummy foo bar baz qux abc xyz prod production staging stage dev develop "
    "service account client app application config system network cloud"
).split()
_RANK = {w: math.log10(i + 2) for i, w in enumerate(WORDS)}
_ROWS = ["`1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./"]
_KEYS = {c: (y, x) for y, row in enumerate(_ROWS) for x, c in enumerate(row)}
_DATE = re.compile(r"(?:19|20)\d\d[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:0[1-9]|[12]\d|3[01])|(?:0[1-9]|[12]\d|3[01])[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:19|20)\d\d|(?:19|20)\d\d")
#: Longest unit of a repeat.
_UNIT = 64
_REPEAT = re.compile(r"(.{1,%d}?)\1{2,}" % _UNIT, re.DOTALL)
_LETTERS = re.compile(r"[a-z]{4,}|[A-Z]{4,}|[A-Z][a-z]{3,}")
_VOWELS = re.compile(r"[aeiouy]")
_THICK = re.compile(r"[^aeiouy]{5,}|[aeiouy]{4,}|[qxzjk][^aeiouy]{2,}|(.)\1\1")


def _reads_like_a_word(low: str) -> bool:
    """Vowels and consonants alternate as they do in words."""
    share = len(_VOWELS.findall(low)) / len(low)
    return 0.2 <= share <= 0.7 and not _THICK.search(low)


def _brute(c: str) -> float:
    """Guesses for one character, by the alphabet it comes from (log10)."""
    return 1.0 if c.isdigit() else 1.415 if c.isalpha() and c.isascii() else 1.52


def guess_cost(value: str) -> float:
    """log10 of the guesses that the cheapest segmentation of ``value`` needs;
    each segment costs a factor of two on top."""
    n, low = len(value), value.lower()
    pieces: dict[int, list[tuple[int, float]]] = {}  # end -> (start, cost)
    for m in _LETTERS.finditer(value):
        if _reads_like_a_word(m[0].lower()):
            pieces.setdefault(m.end(), []).append((m.start(), ANY_WORD + (0.0 if m[0].islower() else 0.5)))
    walk = list(range(1, n + 1))  # where the walk from each place ends
    for i in range(n - 2, -1, -1):
        if _next_key(low[i], low[i + 1]):
            walk[i] = walk[i + 1]
    quiet = 0  # a repeat that begins within another one is never the cheaper way
    for i in range(n):
        for j in range(i + 3, min(n, i + 12) + 1):
            rank = _RANK.get(low[i:j])
            if rank is not None:
                pieces.setdefault(j, []).append((i, rank + (0.0 if value[i:j] == low[i:j] else 0.5)))
        date = _DATE.match(value, i)
        if date:
            pieces.setdefault(date.end(), []).append((i, math.log10(365 * 120) if len(date[0]) > 4 else 2.1))
        repeat = _REPEAT.match(value, i) if i >= quiet else None
        if repeat:
            unit = repeat[1]
            pieces.setdefault(repeat.end(), []).append((i, guess_cost(unit) + math.log10(len(repeat[0]) // len(unit))))
            quiet = max(quiet, repeat.end() - 3 * _UNIT)
        for j in sorted({*range(i + 3, min(walk[i], i + WALK_ENDS) + 1), walk[i]}):
            if j - i >= 3:
                pieces.setdefault(j, []).append((i, math.log10(47 * 4 * (j - i))))
    best = [0.0] * (n + 1)
    opened = [0.0] * (n + 1)  # cheapest cost with a brute-force span that ends here
    factor = math.log10(2)
    for j in range(1, n + 1):
        start = best[j - 1] + (factor if j > 1 else 0.0)
        opened[j] = (min(start, opened[j - 1]) if j > 1 else 0.0) + _brute(value[j - 1])
        best[j] = opened[j]
        for i, cost in pieces.get(j, ()):
            best[j] = min(best[j], best[i] + (factor if i else 0.0) + cost)
    return best[n]


def _next_key(a: str, b: str) -> bool:
    p, q = _KEYS.get(a), _KEYS.get(b)
    return p is not None and q is not None and p != q and abs(p[0] - q[0]) <= 1 and abs(p[1] - q[1]) <= 1


def scan_text(raw: bytes) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]], float]:
    """Base spans and further spans, as ``(start, kind, end)`` in order, and
    the highest guess cost of a value, of one UTF-8 text."""
    low = raw.lower()
    named = any(x in low for x in _NAMES)
    wider = any(x in low for x in _WIDER)
    keyed = b"AKIA" in raw
    hexed = _HEX_RUN in raw.translate(_HEX_TABLE)
    if not (named or wider or keyed or hexed):
        return [], [], 0.0
    text = raw.decode()
    base, more, top = [], [], 0.0
    if named:
        for m in ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= ASSIGN_CHARS:
                base.append((m.start(), 0, m.end()))
                top = max(top, guess_cost(m[2]))
    if keyed:
        base += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_CHARS]
    if hexed:
        base += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    base.sort()
    if named or wider:
        for m in CONTEXT.finditer(text):
            a, b = m.span(1)
            if any(x <= a and b <= y for x, _, y in base):
                continue
            cost = guess_cost(m[1])
            top = max(top, cost)
            if cost >= MIN_GUESSES:
                more.append((a, 3, b))
    return base, more, top


def _written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, max_log10_guesses double"


def scan(docs: DataFrame) -> DataFrame:
    """Spans of every row of ``docs`` (``doc_id``, ``text``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for raw in pc.fill_null(batch["text"], "").cast(pa.binary()):
                base, more, top = scan_text(raw.as_py())
                n = [sum(k == kind for _, k, _ in base) for kind in range(3)]
                out.append((*n, hashlib.sha256(_written(base).encode()).hexdigest(), _written(sorted(base + more)), top))
            types = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.float64()]
            names = [c.split()[0] for c in SCHEMA.split(", ")]
            yield pa.RecordBatch.from_pydict({"doc_id": batch["doc_id"], **{c: pa.array([r[i] for r in out], t) for i, (c, t) in enumerate(zip(names[1:], types))}})

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """The rows with every span (overlapping ones merged) replaced by ``mark``;
    ``n_chars``, if there is one and it is a number, is counted anew for changed
    texts. Other columns stay as they are."""
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(lo, 500) for whole in batches for lo in range(0, len(whole), 500)):
            at = batch.schema.get_field_index("text")
            texts, changed = [], []
            for value in batch.column(at).cast(pa.binary()):
                raw = value.as_py()
                base, more, _ = scan_text(raw) if raw is not None else ([], [], 0.0)
                text = None if raw is None else raw.decode()
                merged: list[list[int]] = []
                for a, _, b in sorted(base + more):
                    if merged and a < merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], b)
                    else:
                        merged.append([a, b])
                for a, b in reversed(merged):
                    text = text[:a] + mark + text[b:]
                texts.append(text)
                changed.append(bool(merged))
            columns = {c: batch.column(i) for i, c in enumerate(batch.schema.names)}
            columns["text"] = pa.array(texts, pa.string())
            if "n_chars" in columns and pa.types.is_integer(columns["n_chars"].type):
                sizes = [len(t) if c else n for t, c, n in zip(texts, changed, columns["n_chars"].to_pylist())]
                columns["n_chars"] = pa.array(sizes, columns["n_chars"].type)
            yield pa.RecordBatch.from_pydict(columns)

    return map_rows(docs, run)
