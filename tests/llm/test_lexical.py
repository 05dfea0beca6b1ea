"""Ranked lexical search against brute force."""

import re
from collections import Counter
from math import floor, log

import numpy as np
import pytest

from tripledger.llm import lexical
from tripledger.llm.oracles import OP12
from tripledger.llm.queries import op12_lexical_search

from compare import differences, duck

DOCS = "doc_id long, text string, item string, block int, term string, score int"
ITEMS = "item_id long, text string, item int, doc_id string"
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k):
    """Best documents of each distinct item as (item_id, score, doc_id), ties by id, nulls last."""
    found = [(d[0], Counter(split(d[1]))) for d in docs]
    found = [(d, c, sum(c.values())) for d, c in found if c]
    n_docs, n_terms = len(found), sum(n for _, _, n in found)
    df = Counter(t for _, c, _ in found for t in c)
    weight = {t: floor(1000 * log((2.0 * n_docs + 2.0) / (2 * f + 1))) for t, f in df.items()}
    out = []
    for item_id, text in {(i[0], i[1]) for i in items}:
        scores = []
        for d, c, n in found:
            m = 100 - 90 + 90 * n * n_docs // n_terms
            s = sum(weight[t] * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t in set(split(text)) if t in c)
            if s > 0:
                scores.append((-s, d is None, d or 0, d))
        out += [(item_id, -s[0], s[3], rank) for rank, s in enumerate(sorted(scores)[:k], 1)]
    return Counter(out)


def run(spark, docs, items, k=10, parts=3):
    got = lexical.search(spark.createDataFrame(docs, DOCS).repartition(parts), spark.createDataFrame(items, ITEMS), k)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    return Counter((r["item_id"], r["score"], r["doc_id"], r["rank"]) for r in got.collect())


def corpus(rng, n, words=60):
    vocabulary = np.array([f"w{i}" for i in range(words)] + ["É", "日本", "Zeta", "İ"])
    odds = 1 / np.arange(1, len(vocabulary) + 1)
    out = [(i, " ".join(rng.choice(vocabulary, int(rng.integers(1, 40)), p=odds / odds.sum())), "x", 1, "t", 1) for i in range(n)]
    passage = " ".join(f"rare{i}" for i in range(8))
    out += [(n + i, passage + " w1 w2", "x", 1, "t", 1) for i in range(25)]
    odd = [None, "", " \n--", "w1", "W1 w1-W1_w1", "w3\x00w4\x7fw5", "é É e", "w2 " * 9000, "🙂 w9"]
    out += [(n + 100 + i, t, None, None, None, None) for i, t in enumerate(odd)]
    return out + [(None, "w1 rare2", "x", 1, "t", 1), (None, passage, "x", 1, "t", 1), out[3], out[3]], passage


def items_of(passage):
    texts = ["w1 w2 w3", passage, passage + " W1", "É é", "unknown words", "", None, "w5,w5;W5", "日本 zeta w9 w40 w41"]
    rows = [(i, t, 1, "d") for i, t in enumerate(texts)]
    return rows + [rows[0], (None, "w4 w6", 2, "d"), (1, "w7", 1, "d")]


@pytest.mark.parametrize("leaf, block", [(4096, 1 << 15), (4, 1 << 15), (1, 16), (30, 7)])
def test_equals_brute_force(spark, monkeypatch, leaf, block):
    monkeypatch.setattr(lexical, "LEAF", leaf)
    monkeypatch.setattr(lexical, "BLOCK_DOCS", block)
    monkeypatch.setattr(lexical, "CHUNK", 2 if block < 100 else 1000)
    docs, passage = corpus(np.random.default_rng(leaf), 250)
    items = items_of(passage)
    assert run(spark, docs, items) == brute(docs, items, 10)


def test_other_numbers_of_places(spark):
    docs, passage = corpus(np.random.default_rng(9), 60)
    items = items_of(passage)
    for k in (1, 200):
        assert run(spark, docs, items, k) == brute(docs, items, k)


def test_search_skips_documents_that_cannot_win(monkeypatch):
    """The bounds save work: most documents of a list with one outstanding document stay unscored."""
    monkeypatch.setattr(lexical, "LEAF", 1)
    rng = np.random.default_rng(1)
    docs = np.arange(20_000)
    impact = rng.integers(1, 1000, 20_000)
    impact[777] = 900_000
    lists = lexical.Lists([(5, docs, impact), (3, docs[::7], impact[::7])])
    seen = []
    peaks = lists.peaks
    monkeypatch.setattr(lists, "peaks", lambda lo, hi: (seen.append(1), peaks(lo, hi))[1])
    assert lists.search(np.array([0, 1]), 1) == [(5 * 900_000 + (3 * 900_000 if 777 % 7 == 0 else 0), 777)]
    assert len(seen) < 10
    full = 5 * impact + np.where(docs % 7 == 0, 3 * impact, 0)
    order = np.lexsort((docs, -full))[:10]
    assert lists.search(np.array([0, 1]), 10) == [(int(full[d]), int(d)) for d in order]
    assert len(seen) < 400


def test_empty_tables(spark):
    docs, passage = corpus(np.random.default_rng(2), 5)
    nothing = run(spark, [], items_of(passage)), run(spark, docs, []), run(spark, [(1, "--", None, None, None, None)], items_of("a"))
    assert nothing == (Counter(), Counter(), Counter())


def test_query_equals_sql(spark):
    sf_dir = "/root/testdata/sf0.001"
    assert differences(op12_lexical_search(spark, sf_dir), duck(sf_dir), OP12) == []
