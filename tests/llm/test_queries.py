"""The registered queries and the pipeline on the smallest tables."""
import hashlib
import re
import struct

import pytest

import __spark_entry__ as E
import corpus_pipeline
from daymatrix.llm import bpe_words
from daymatrix.llm.queries import REGISTRY, SQL
from daymatrix.plans.verify import compare, duck

from . import brute

SF = "/root/testdata/sf0.001"


def test_all_registered():
    names = E.queries()
    assert set(REGISTRY) <= set(names) and "pipeline" in names
    assert [sum(k.startswith(f"op{n}_") for k in names) for n in range(1, 14)] == [1] * 13


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, name):
    ok, msg = compare(REGISTRY[name](spark, SF), duck(SF), SQL[name])
    assert ok, msg


@pytest.mark.parametrize("name", [n for n in sorted(REGISTRY) if n not in ("pipeline", "op4_suffix_dedup", "op5_qgram_decontam", "op11_collocations", "op12_conversation_trie")])
def test_one_row_per_document(spark, name):
    docs = corpus_pipeline.documents(spark, SF)
    out = REGISTRY[name](spark, SF).select("doc_id")
    assert out.exceptAll(docs.select("doc_id")).count() == 0 and docs.select("doc_id").exceptAll(out).count() == 0


def test_pipeline_against_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in corpus_pipeline.documents(spark, SF).collect()]
    kept = []
    for d, t in docs:
        n = brute.base_counts(t)
        if not (n[0] < 50 or 100 * n[4] > 50 * n[0]):
            kept.append((d, t))
    comp = brute.components(kept)
    kept = [(d, t) for d, t in kept if comp[d][1] == d]
    fold = lambda t: re.sub(r"\s+", " ", t.lower()).strip()
    items = [fold(r.text) for r in corpus_pipeline.benchmark(spark, SF).collect()]
    leaks = {d for d, t in kept if any(i in fold(t) for i in items)}  # the planted ones are verbatim
    kept = [(d, t) for d, t in kept if d not in leaks]
    model = bpe_words.tokenizer(bpe_words.default_vocabulary())
    assign = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{8,}""", re.A | re.I)
    want = {}
    for d, t in kept:
        t = assign.sub("[SECRET]", t)
        ids = model.encode(t, add_special_tokens=False).ids
        want[d] = (hashlib.sha256(b"".join(struct.pack("<I", i) for i in ids)).hexdigest(), hashlib.sha256(t.encode()).hexdigest(), ids)
    got = {r.doc_id: (r.ids_sha256, r.decoded_sha256, list(r.ids)) for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == want
