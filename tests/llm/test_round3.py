"""Collocations, conversation trie and SimHash against plain-Python versions on
odd rows: nulls, empty and very long texts, ties, repeated rows, empty tables,
clashing extra columns."""
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from daymatrix.llm import collocations, conversation_trie, gray_simhash

from . import brute

DOC = "doc_id long, text string, lang string, source string, w1 string, words string, fp long, n long, score long"


def _docs(spark, rows):
    return spark.createDataFrame([(d, t, lg, "s", "x", "y", 1, 2, 3) for d, t, lg in rows], DOC).repartition(3)


# --- collocations -----------------------------------------------------------

def brute_collocations(rows, least, top):
    f, n = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", brute.lower_ascii(text)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, 6):
                f[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        cand = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        scored = []
        for p, a in cand.items():
            inside = any(len(q) > len(p) and b >= a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in cand.items())
            if not inside:
                score, _, l, r = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
                scored.append((score, a, " ".join(p), l, r))
        scored.sort(key=lambda x: (-x[0], -x[1], x[2].encode()))
        out += [(lang, i, p, a, l, r, n[lang], s) for i, (s, a, p, l, r) in enumerate(scored[:top], 1)]
    return sorted(out)


def _prose(rng, n):
    words = ["alpha", "Beta", "gamma", "New York", "the", "of the", "Ünï", "漢字", "état", "it's", " nbsp"]
    return "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\t ", ", ", ". ", "\n", "\r\n", "? "]) for _ in range(n))


@pytest.mark.parametrize("least,top", [(3, 2000), (12, 7)])
def test_collocations(spark, least, top):
    rng = random.Random(3)
    rows = [(i, _prose(rng, rng.choice([0, 1, 3, 40, 200])), rng.choice(["en", "de", None, "und", ""])) for i in range(60)]
    rows += [(100, None, "en"), (101, "", None), (102, " .,\n", "fr"), (103, "one", "fr"), (None, "the of the of the", "en"), (104, _prose(rng, 20_000), "de"),
             (105, "same same " * 2000, "en"), (1, rows[1][1], "en"), (1, rows[1][1], "en"), (106, None, None)]
    got = collocations.collocations(_docs(spark, rows), least, top)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == brute_collocations(rows, least, top)


def test_collocations_empty(spark):
    assert collocations.collocations(_docs(spark, []), 1).count() == 0


def test_scores_are_exact(spark):
    """Products beyond 64 bits, close to a whole number."""
    a, n, l, r = 10**12 + 39, 10**15 + 37, 10**12 + 61, 10**12 + 63
    row = spark.sql(f"SELECT (CAST({a} * 1000 AS DECIMAL(19,0)) * CAST({n} AS DECIMAL(19,0))) DIV (CAST({l} AS DECIMAL(19,0)) * CAST({r} AS DECIMAL(19,0))) AS s").first()
    assert row.s == 1000 * a * n // (l * r)


# --- conversation trie ------------------------------------------------------

def brute_trie(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(v)] for c, v in convs.items()}
    member, ends = defaultdict(set), defaultdict(list)
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        path = tuple(own.get(c - c % 100, [])[:h] + turns[h:])
        ends[path].append(c)
        for d in range(len(path) + 1):
            member[path[:d]].add(c)
    kids = Counter(p[:-1] for p in member if p)
    leaves, saved = Counter(), Counter()
    for p, m in member.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in kids
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1]) if p else 0
    return sorted((min(m), len(p), min(member[p[:-1]]) if p else -1, len(m), kids[p], leaves[p], saved[p],
                   hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest()) for p, m in member.items())


CONV = "conv_id long, turn long, role string, text string, depth long, x long, pos long, part string"


def _conversations(spark, rows):
    return spark.createDataFrame([(*r, 0, 1, 2, "p") for r in rows], CONV).repartition(5)


def _trie(df):
    return sorted((r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256)
                  for r in df.collect())


def conversation_rows():
    rng = random.Random(5)
    say = ["", "hi", "hello there", "ça va", "漢字 𝒳", None, "x" * 500]
    rows = []
    for c in [*range(0, 12), *range(95, 130), 200, 305, 307, 1001, 1002, 1003]:
        for turn in range(rng.randrange(1, 9)):
            rows.append((c, turn, rng.choice(["user", "bot", None]), rng.choice(say)))
    for c in range(400, 440):  # copies of one conversation
        rows += [(c, t, "user", f"turn {t}") for t in range(7)]
    rows += [(500, None, "user", "first of all"), (500, None, "bot", "a tie of nulls"), (500, 3, "b", "z"), (500, 3, "a", "z"), (500, 3, "a", "z"),
             (None, 0, "user", "nobody's"), (600, 0, "user", "one turn only"), (601, 5, "user", "no base turn at five")]
    rows += [(700, t, "user", f"word {t % 7}") for t in range(900)]  # a conversation that fills partitions
    return rows


def test_trie(spark):
    rows = conversation_rows()
    got = conversation_trie.prefix_trie(_conversations(spark, rows))
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert _trie(got) == brute_trie(rows)


def test_trie_over_many_partitions_and_short_pieces(spark, monkeypatch):
    """Running sums go on over partitions, end ids over pieces."""
    rows = conversation_rows()
    monkeypatch.setattr(conversation_trie, "PIECE", 40)
    keep = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "13")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        assert _trie(conversation_trie.prefix_trie(_conversations(spark, rows))) == brute_trie(rows)
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)


def test_trie_empty(spark):
    assert conversation_trie.prefix_trie(_conversations(spark, [])).count() == 0


def test_trie_raises_on_a_hash_clash(spark, monkeypatch):
    import daymatrix.llm.conversation_trie as trie

    real = trie._turns
    monkeypatch.setattr(trie, "_turns", lambda df: real(df).withColumn("x", F.lit(1).cast("long")).withColumn("y", F.lit(1).cast("long")))
    with pytest.raises(RuntimeError, match="same hashes"):
        trie.prefix_trie(_conversations(spark, conversation_rows()))


# --- SimHash ----------------------------------------------------------------

def brute_simhash(text):
    w = [x.encode() for x in brute.words(brute.lower_ascii(text))]
    if not w:
        return 0
    grams = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or [b" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(g, seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_near(fps):
    label = list(range(len(fps)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 2:
                a, b = find(i), find(j)
                label[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def test_simhash(spark):
    rng = random.Random(11)
    vocab = ["the", "of", "and", "Alpha", "beta", "ÉTÉ", "漢字"]
    base = " ".join(rng.choice(vocab) + str(rng.randrange(30)) for _ in range(400))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "ONE  two\n"), (6, "solo"), (None, "solo"), (None, "nobody else has this text"), (7, base), (7, base)]
    w = base.split(" ")
    for i in range(60):  # near copies
        v = list(w)
        v[rng.randrange(len(v))] = f"edit{i}"
        rows.append((100 + i, "\n".join(v)))
    rows += [(300 + i, " ".join(rng.choice(vocab) for _ in range(rng.randrange(1, 60)))) for i in range(60)]
    rows.append((500, "x1 y2 z3 " * 30_000))
    got = {(r.doc_id, r.fingerprint): r.component_id for r in gray_simhash.near_duplicates(_docs(spark, [(*r, "en") for r in rows])).collect()}
    fps = [brute_simhash(t) for _, t in rows]
    comp = brute_near(fps)
    least = defaultdict(list)
    for (d, _), c in zip(rows, comp):
        least[c] += [] if d is None else [d]
    assert got == {(d, f"{f:016x}"): min(least[c], default=None) for (d, _), f, c in zip(rows, fps, comp)}


@pytest.mark.parametrize("group", [4, 40, 1024])
def test_near_links_join_every_component(spark, monkeypatch, group):
    """Random, chained and dense fingerprints; groups dealt again and again."""
    monkeypatch.setattr(gray_simhash, "GROUP", group)
    monkeypatch.setattr(gray_simhash, "FRONTIER", 500)
    rng = random.Random(group)
    flip = lambda f, k: f ^ sum(1 << b for b in rng.sample(range(64), k))
    fps = {rng.getrandbits(64) for _ in range(200)} | {0, (1 << 64) - 1}
    for seed in list(fps)[:20]:
        f = seed
        for _ in range(8):
            fps.add(f := flip(f, rng.choice([1, 2, 2, 3])))
    hub = rng.getrandbits(64)
    fps |= {hub ^ (1 << i) ^ (1 << j) for i in range(20) for j in range(20)}   # dense
    fps |= {hub ^ (k << 40) for k in range(300)}                                # share most bits
    fps = sorted(fps)
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    at = {f: i for i, f in enumerate(fps)}
    label = np.arange(len(fps))
    pairs = [(at[r.a % (1 << 64)], at[r.b % (1 << 64)]) for r in gray_simhash.near_links(df).collect()]
    label = gray_simhash._merge(label, np.array([p[0] for p in pairs]), np.array([p[1] for p in pairs]))
    assert label.tolist() == brute_near(fps)


def test_tree_finds_every_pair_of_a_group():
    rng = np.random.default_rng(2)
    seeds = rng.integers(0, 1 << 63, 6, dtype=np.uint64)
    fps = np.unique(np.concatenate([seeds[i % 6] ^ (np.uint64(1) << rng.integers(0, 64, 1, dtype=np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 1, dtype=np.uint64)) for i in range(500)]))
    group = np.sort(rng.integers(0, 5, len(fps)))
    tree = gray_simhash.Tree(fps, group)
    got = set(zip(*(x.tolist() for x in tree.near(np.arange(len(fps))))))
    want = {(i, j) for i in range(len(fps)) for j in range(i + 1, len(fps)) if group[i] == group[j] and int(fps[i] ^ fps[j]).bit_count() <= 2}
    assert got == want


def test_simhash_empty(spark):
    assert gray_simhash.near_duplicates(_docs(spark, [])).count() == 0


# --- cuts that were taken out --------------------------------------------------

def test_values_of_words_and_long_repeats_are_no_secrets():
    from daymatrix.llm.secret_scan import MIN_GUESSES, guess_cost, scan_text

    for text in ("He could not surpass: everybody agreed", "compass: northeast", "authorization: required", "pwd = internationalization",
                 "passphrase: " + "!" * 700, "passcode: " + "abcabc" * 20_000, "bearer: " + "qwertyuiop" * 50):
        assert scan_text(text.encode())[1] == [], text[:40]
    for text in ("pwd: kT9xQz27vBmm", "userPass = xk4Vbn!2qRw7", "my_private_key: zq8wTx-41Lpoe"):
        assert len(scan_text(text.encode())[1]) == 1, text
    assert guess_cost("xqvkzbwjhg") >= MIN_GUESSES  # letters that read like no word


def test_short_benchmark_items_are_found_verbatim(spark):
    from daymatrix.llm import qgram_decontam

    items = spark.createDataFrame([(1, "What is the capital of France?"), (2, "Is it 42?"), (3, "yes"), (4, None), (5, "round  off")], "item_id long, text string")
    docs = spark.createDataFrame([
        (1, "Q: what is  the Capital of France? A: Paris"), (2, "What is the capitol of France?"), (3, "is it 42?"), (4, "this is it 42? no"), (5, "sis it 42? is it 42!"),
        (6, "xis it 42?"), (7, "yes"), (8, "the round off error"), (9, "the round offer, round off"), (10, "ground off"), (11, None)], "doc_id long, text string")
    found = {(r.doc_id, r.item_id, r.edits) for r in qgram_decontam.find_leaks(docs, items).collect()}
    assert found == {(1, 1, 0), (3, 2, 0), (4, 2, 0), (8, 5, 0), (9, 5, 0)}
    assert [r.item_id for r in qgram_decontam.unsearched_items(items).orderBy("item_id").collect()] == [3, 4]


def test_one_row_an_id_is_the_same_on_every_run(spark):
    from daymatrix.llm.common import one_row_an_id

    rows = [(1, "a", 1), (2, "b", 2), (2, "c", 3), (2, None, 4), (3, "d", 5), (3, "d", 5)]
    picks = [sorted(map(tuple, one_row_an_id(spark.createDataFrame(rows[k:] + rows[:k], "doc_id long, text string, `x.y` int").repartition(k + 1)).collect()), key=str) for k in range(4)]
    assert all(p == picks[0] for p in picks) and [p[0] for p in picks[0]] == [1, 2, 3]
