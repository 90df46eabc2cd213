"""Ranked lexical search against brute force."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from folioflow.llm.lexical_search import lexical_search

DOCS = "doc_id long, text string, _item string, term string, score string"
ITEMS = "item_id long, text string, _block string"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall((text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))


def brute(docs, items, k=20):
    parsed = [(i, terms(t)) for i, t in docs]
    n_docs = sum(1 for _, t in parsed if t)
    total = sum(len(t) for _, t in parsed)
    df = Counter(w for _, t in parsed for w in set(t))
    out = []
    for item_id, text in sorted(set(items), key=str):
        if item_id is None:
            continue
        scores = []
        for doc_id, t in parsed:
            if doc_id is None or not t:
                continue
            tf = Counter(t)
            m = 75 + (25 * len(t) * n_docs) // total
            s = 0
            for w in terms(text):
                if tf[w]:
                    weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1)))
                    s += weight * ((10**9 * tf[w]) // (1000 * tf[w] + 12 * m))
            if s > 0:
                scores.append((-s, doc_id))
        out += [(item_id, r, d, -s) for r, (s, d) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("block_docs", [7, 10_000])
def test_search_equals_brute_force(spark, block_docs):
    rng = np.random.default_rng(11)
    vocab = [f"w{i}" for i in range(60)] + ["Über", "naïve", "x86", "ÉTÉ", "don't"]
    docs = [(i, " ".join(rng.choice(vocab, size=int(rng.integers(1, 40))))) for i in range(300)]
    docs += [(300 + i, docs[5][1]) for i in range(25)]  # ties
    docs += [(400, None), (401, ""), (402, "!!! ..."), (None, "w1 w2 w3"), (403, "W1 w1 w1 " * 500), docs[0]]
    items = [(j, " ".join(rng.choice(vocab, size=int(rng.integers(1, 8))))) for j in range(12)]
    items += [(50, None), (None, "w1"), (51, "nothing here zz"), items[0], (52, docs[5][1])]
    got = lexical_search(
        spark.createDataFrame([(*d, "a", "b", "c") for d in docs], DOCS),
        spark.createDataFrame([(*i, "x") for i in items], ITEMS),
        block_docs=block_docs,
    )
    expected = brute(docs, items)
    assert len(expected) > 150
    assert sorted(map(tuple, got.collect())) == expected


def test_search_of_little(spark):
    no_docs = spark.createDataFrame([], DOCS)
    items = spark.createDataFrame([(1, "a b", "x")], ITEMS)
    assert lexical_search(no_docs, items).count() == 0
    docs = spark.createDataFrame([(1, "a b", "", "", "")], DOCS)
    assert lexical_search(docs, spark.createDataFrame([], ITEMS)).count() == 0
