"""Ranked search against scoring every document."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pandas as pd
import pytest

from tidemark.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id bigint, text string, lang string, id int, n int, terms string, q int, item_id int"
ITEMS = "item_id bigint, text string, id int, terms int, q string"


def terms_of(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, top=50):
    held = [(i, Counter(terms_of(t)), len(terms_of(t))) for i, t in docs]
    n_docs, n_terms = sum(n > 0 for *_, n in held), sum(n for *_, n in held)
    df = Counter(t for _, own, _ in held for t in own)
    out = []
    for item, text in items:
        scored = []
        for i, own, n in held:
            score = 0
            for t in set(terms_of(text)) & set(own):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                m = 50 + 50 * n * n_docs // n_terms
                score += w * (10**9 * own[t] // (1000 * own[t] + 20 * m))
            if score > 0:
                scored.append((-score, i is None, i or 0))
        out += [(item, k, None if null else i, -s) for k, (s, null, i) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out, key=repr)


def corpus(n, seed, words=300):
    dice = random.Random(seed)
    names = [f"{a}{b}" for a in "ba Ce di FO gu é 日 x9".split() for b in range(words // 8)]
    return [(k, " ".join(dice.choice(names[: 1 + int(dice.random() ** 3 * len(names))]) + dice.choice([" ", ", ", "\n"])
                         for _ in range(dice.randrange(1, 120)))) for k in range(n)]


def run(spark, docs, items, **how):
    table = spark.createDataFrame([(i, t, None, 1, 2, "x", 3, 4) for i, t in docs], DOCS).repartition(4)
    asked = spark.createDataFrame([(i, t, 1, 2, "q") for i, t in items], ITEMS)
    return sorted((tuple(r) for r in lexical.rank(table, asked, **how).collect()), key=repr)


def test_equals_brute_force_with_awkward_rows(spark):
    docs = corpus(400, 1)
    docs += [(5, docs[9][1]), (None, docs[9][1]), (None, None), (900, None), (901, ""), (902, "!?\n"), (903, "ba1 " * 50_000), *docs[9:12]]
    items = [(k, t) for k, t in corpus(30, 2)] + [(1, "nowhere to be found"), (2, None), (3, ""), (4, "--"), (None, docs[3][1]), (7, docs[9][1])]
    assert run(spark, docs, items, top=50) == brute(docs, items)
    assert run(spark, docs, items, top=3) == brute(docs, items, 3)


def test_query_sets_are_bounded_without_a_difference(spark, monkeypatch):
    docs, items = corpus(200, 3), corpus(25, 4)
    monkeypatch.setattr(lexical, "QUERY_TERMS", 60)
    assert run(spark, docs, items) == brute(docs, items)


@pytest.mark.parametrize("docs, items", [([], [(1, "a b")]), ([(1, "a b")], []), ([(1, None)], [(1, "a")]), ([(1, "a")], [(1, None)])])
def test_empty_tables(spark, docs, items):
    assert run(spark, docs, items) == []


def test_impacts_beyond_64_bits():
    n, tf = np.array([2 * 10**9, 3]), np.array([10**10, 2])
    got = lexical.impacts(tf, n, np.array([7, 7]), 10**10, 10**13)
    m = [50 + 50 * int(x) * 10**10 // 10**13 for x in n]
    assert got.tolist() == [7 * (10**9 * int(t) // (1000 * int(t) + 20 * k)) for t, k in zip(tf, m)]


def block_of(seed, n_docs=2000, n_terms=12):
    """Lists of one block: terms that rarely occur together have low joint maxima."""
    dice = np.random.default_rng(seed)
    lists, impact = [], []
    for t in range(n_terms):
        own = np.flatnonzero(dice.random(n_docs) < (t + 1) / (2 * n_terms))
        own = own[(own % 2) == t % 2] if t < 8 else own
        lists.append(own)
        impact.append(dice.integers(1, 10 ** (6 - t // 2) + 2, len(own)))
    starts = np.append(0, np.cumsum([len(x) for x in lists]))
    return np.concatenate(lists), np.concatenate(impact), starts, n_docs, n_terms


@pytest.mark.parametrize("seed", range(6))
def test_search_of_a_block_skips_and_stays_exact(seed):
    at, impact, starts, n_docs, n_terms = block_of(seed)
    exact = np.zeros(n_docs, np.int64)
    np.add.at(exact, at, impact)
    most = np.maximum.reduceat(impact, starts[:-1])
    where = np.arange(n_terms)
    by_bound = np.argsort(most)
    table = by_bound.reshape(-1, 2)
    joint = lexical._joint(table, where, starts, at, impact)
    for (a, b), got in zip(table, joint):
        pair = {d: i for d, i in zip(at[starts[a]: starts[a + 1]], impact[starts[a]: starts[a + 1]])}
        assert got == max([pair[d] + i for d, i in zip(at[starts[b]: starts[b + 1]], impact[starts[b]: starts[b + 1]]) if d in pair], default=0)
    for least in (1, int(np.sort(exact)[-50]), int(exact.max()), int(exact.max()) + 1):
        pairs = [(p, a, b) for p, (a, b) in enumerate(table.tolist())]
        docs, scores, read = lexical.search_block(pairs, [], where, starts, at, impact, most, joint, n_docs, least)
        assert sorted(docs) == np.flatnonzero(exact >= least).tolist() and (scores == exact[docs]).all()
        _, _, alone = lexical.search_block([], range(n_terms), where, starts, at, impact, most, joint, n_docs, least)
        assert read <= alone  # pair bounds skip no less than single maxima
        assert least == 1 or read < len(at)


def test_terms_of_a_query_set():
    items = pd.DataFrame({"q": [4, 9], "terms": [np.array([1, 5, 7]), np.array([5, 7, 11, 13])]})
    df = pd.DataFrame({"term": [7, 1, 5, 11], "df": [2000, 1, 50, 20]})
    query = lexical.QuerySet.of(items, df, 2000, 10_000)  # 7 is in all documents and weighs nothing, 13 in none
    assert query.terms.tolist() == [1, 5, 11] and [o.tolist() for o in query.own] == [[1, 0], [1, 2]]
    assert query.pairs == [[(0, 0, 1)], [(1, 1, 2)]] and query.single == [[], []]
