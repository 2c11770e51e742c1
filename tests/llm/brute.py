"""Plain-Python versions of the operators, for small inputs."""
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def lower_ascii(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingles(text, k=5):
    w = words(lower_ascii(text))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def components(rows):
    """``doc_id -> (set size, component)`` by comparing all pairs."""
    sets = [(i, shingles(t)) for i, t in rows]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, (i, s) in enumerate(sets):
        for j, t in sets[:a]:
            both = len(s & t)
            if both and 100 * both >= 80 * (len(s) + len(t) - both):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets}


def repeated_spans(rows, k=50):
    """``row number -> spans`` covered by k-word windows that another row has."""
    held = defaultdict(set)
    parsed = [[(m.start(), m.end(), m[0]) for m in WORD.finditer(t or "")] for _, t in rows]
    for r, ws in enumerate(parsed):
        for i in range(len(ws) - k + 1):
            held[tuple(w[2] for w in ws[i : i + k])].add(r)
    out = {}
    for r, ws in enumerate(parsed):
        hit = [False] * len(ws)
        for i in range(len(ws) - k + 1):
            if len(held[tuple(w[2] for w in ws[i : i + k])]) > 1:
                hit[i : i + k] = [True] * k
        spans, i = [], 0
        while i < len(ws):
            if hit[i]:
                j = i
                while j + 1 < len(ws) and hit[j + 1]:
                    j += 1
                spans.append((ws[i][0], ws[j][1]))
                i = j
            i += 1
        if spans:
            out[r] = spans
    return out


def base_counts(text):
    """``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words``."""
    w = words(text)
    n = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {p for i in range(len(w) - 2) if n[tuple(w[i : i + 3])] > 1 for p in (i, i + 1, i + 2)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered)


def fewest_edits(item, text):
    """Least edits of ``item`` against any stretch of ``text``."""
    prev = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        cur = [i]
        for j, d in enumerate(text, 1):
            cur.append(min(prev[j - 1] + (c != d), prev[j] + 1, cur[j - 1] + 1))
        prev = cur
    return min(prev)
