"""Byte-level BPE pre-tokens of many texts at once.

The splitting rule is the public one of byte-level BPE vocabularies:
contractions, runs of letters, of digits and of other signs, each with one
leading space if there is one, and white space of which the last character is
left to what follows. Since a pre-token's limits depend on neighbouring
characters only, all limits of a chunk are found by comparing character
classes of neighbours.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from functools import lru_cache

import numpy as np

from daymatrix.llm.kernels import SpanHash

LETTER, NUMBER, OTHER, SPACE = 1, 2, 0, 3
#: White space of the rule: the Unicode property White_Space.
SPACES = [9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
#: Longer pre-tokens are hashed by their bytes instead of the polynomial.
LONG_TOKEN = 256


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """Class of every code point."""
    table = np.zeros(0x110000, np.uint8)
    kind = [unicodedata.category(chr(c))[0] if not 0xD800 <= c < 0xE000 else "C" for c in range(0x110000)]
    first = np.array(kind)
    table[first == "L"] = LETTER
    table[first == "N"] = NUMBER
    table[SPACES] = SPACE
    return table


def starts(cp: np.ndarray, off: np.ndarray, whole: np.ndarray | None = None) -> np.ndarray:
    """Positions in ``cp`` (code points of rows laid end to end, cut at
    ``off``) at which a pre-token starts. Rows flagged ``whole`` are one
    token."""
    n = len(cp)
    if n == 0:
        return np.zeros(0, np.int64)
    head = np.zeros(n + 1, bool)
    head[off] = True
    kind = classes()[cp]
    first = head[:n].copy()
    first[1:] |= kind[1:] != kind[:-1]
    space = kind == SPACE
    # A run after a blank of the same row starts at that blank.
    led = np.zeros(n, bool)
    led[1:] = (cp[:-1] == 32) & ~head[1:n] & ~space[1:]
    first &= ~led
    # The last white-space character before something else stands apart.
    last = np.zeros(n, bool)
    last[:-1] = space[:-1] & ~space[1:] & ~head[1:n]
    first |= last
    quote = np.flatnonzero((cp == 39) & first)
    if len(quote):
        at = lambda k: np.where((quote + k < n) & ~_crosses(head, quote, k), cp[np.minimum(quote + k, n - 1)], 0)
        c1, c2 = at(1), at(2)
        short = np.isin(c1, [ord(x) for x in "stmd"])
        pair = ((c1 == ord("r")) & (c2 == ord("e"))) | ((c1 == ord("v")) & (c2 == ord("e"))) | ((c1 == ord("l")) & (c2 == ord("l")))
        size = np.where(short, 2, np.where(pair, 3, 0))
        hit = size > 0
        first[quote[hit] + 1] = False
        after = quote[hit] + size[hit]
        first[after[after < n]] = True
    if whole is not None:
        for r in np.flatnonzero(whole):
            first[off[r] + 1 : off[r + 1]] = False
    return np.flatnonzero(first)


def _crosses(head: np.ndarray, pos: np.ndarray, k: int) -> np.ndarray:
    """Whether another row starts within ``k`` characters after ``pos``."""
    n = len(head) - 1
    out = np.zeros(len(pos), bool)
    for j in range(1, k + 1):
        out |= head[np.minimum(pos + j, n)]
    return out


class Pretokens:
    """Pre-tokens of some rows: limits, row of each row's first token, and the
    distinct ones by 64-bit hash."""

    def __init__(self, rows: list[str], whole: np.ndarray | None = None, limit: int = 1 << 18):
        self.text = "".join(rows)
        size = np.fromiter(map(len, rows), np.int64, len(rows))
        off = np.concatenate([[0], np.cumsum(size)])
        s_all, h_all, lo = [], [], 0
        while lo < len(rows):  # bounded arrays: about ``limit`` characters at a time
            hi = max(lo + 1, int(np.searchsorted(off, off[lo] + limit, "right")) - 1)
            cp = np.frombuffer("".join(rows[lo:hi]).encode("utf-32-le"), np.uint32)
            s = starts(cp, off[lo : hi + 1] - off[lo], None if whole is None else whole[lo:hi])
            e = np.append(s[1:], len(cp)) if len(s) else s
            h = SpanHash(cp)(s, e)
            for i in np.flatnonzero(e - s > LONG_TOKEN):
                h[i] = np.frombuffer(hashlib.blake2b(cp[s[i] : e[i]].tobytes(), digest_size=8).digest(), np.uint64)[0]
            s_all.append(s + off[lo])
            h_all.append(h)
            lo = hi
        self.start = np.concatenate(s_all) if s_all else np.zeros(0, np.int64)
        self.end = np.append(self.start[1:], len(self.text))[: len(self.start)]
        self.first = np.searchsorted(self.start, off)
        hashes = np.concatenate(h_all) if h_all else np.zeros(0, np.uint64)
        self.keys, self._one, self.of = np.unique(hashes, return_index=True, return_inverse=True)

    def distinct(self) -> list[str]:
        """The distinct pre-tokens, in the order of ``keys``."""
        text = self.text
        return [text[a:b] for a, b in zip(self.start[self._one].tolist(), self.end[self._one].tolist())]


def split_special(texts: list[str], special: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Rows cut at special tokens: ``(pieces, whole flags, first piece of each
    row)``; a special token is a piece of its own."""
    pieces: list[str] = []
    whole: list[bool] = []
    first = [0]
    for text in texts:
        parts, flags = [text], [False]
        for token in special:
            if any(token in p for p, f in zip(parts, flags) if not f):
                new_p, new_f = [], []
                for p, f in zip(parts, flags):
                    cuts = [p] if f else p.split(token)
                    for i, c in enumerate(cuts):
                        if i:
                            new_p.append(token)
                            new_f.append(True)
                        new_p.append(c)
                        new_f.append(f)
                parts, flags = new_p, new_f
        pieces += parts
        whole += flags
        first.append(len(pieces))
    return pieces, np.array(whole, bool), np.array(first)


_LOADED: dict[str, object] = {}


def tokenizer(content: str):
    """The tokenizer of a vocabulary file's content, built once per process,
    without truncation or padding."""
    from tokenizers import Tokenizer

    name = hashlib.blake2b(content.encode(), digest_size=8).hexdigest()
    if name not in _LOADED:
        t = Tokenizer.from_str(content)
        t.no_truncation()
        t.no_padding()
        _follow(t)
        _LOADED[name] = t
    return _LOADED[name]


def _follow(model) -> None:
    """Correct the class table where the library's Unicode version differs
    from Python's: a string of all characters of one class must be one
    pre-token; what it cuts out is classed as the library does."""
    table = classes()
    split = model.pre_tokenizer.pre_tokenize_str
    for kind in (LETTER, NUMBER, OTHER):
        points = np.flatnonzero(table == kind)
        points = points[(points < 0xD800) | (points >= 0xE000)]
        for _, (a, b) in split("".join(map(chr, points.tolist()))):
            sample = chr(points[a])
            real = next((k for k, near in ((LETTER, "a"), (NUMBER, "1"), (OTHER, "!")) if len(split(near + sample)) == 1), SPACE)
            if real != kind:
                table[points[a:b]] = real


def special_tokens(content: str) -> list[str]:
    """Special tokens of the vocabulary, longest first."""
    return sorted((t["content"] for t in json.loads(content)["added_tokens"]), key=lambda x: (-len(x), x))


def pieces(content: str) -> list[bytes]:
    """The bytes that each id stands for."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(printable)]
    byte_of = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}
    data = json.loads(content)
    out: dict[int, bytes] = {i: bytes(byte_of[c] for c in piece) for piece, i in data["model"]["vocab"].items()}
    out |= {t["id"]: t["content"].encode() for t in data["added_tokens"]}
    return [out.get(i, b"") for i in range(max(out) + 1)]
