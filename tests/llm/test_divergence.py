"""Divergence against brute force and DuckDB, and the merge by itself."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from reelframe.llm.divergence import ORACLE, divergence, merged_price, overlap, prices, shares

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def share(count, n, v):
    return 1 + 10**9 * (count + 2) // (n + 2 * v)


def price(p, q):
    return (p - q) ** 2 // (p + q)


def brute(rows, min_docs=10, top=10):
    groups, docs = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        words = TERM.findall((text or "").translate(LOWER))
        groups[lang or "", source or ""].update(words)
        docs[lang or ""].update(set(words))
    out = set()
    for lang, seen in docs.items():
        kept = [t for t, n in seen.items() if n >= min_docs]
        v, own = len(kept), {s: c for (g, s), c in groups.items() if g == lang}
        n = {s: sum(c[t] for t in kept) for s, c in own.items()}
        whole, total = {t: sum(c[t] for c in own.values()) for t in kept}, sum(n.values())
        for s, c in own.items():
            pairs = {o: sum(price(share(c[t], n[s], v), share(own[o][t], n[o], v)) for t in kept) for o in own if o != s}
            terms = {}
            for t in kept:
                p, q = share(c[t], n[s], v), share(whole[t], total, v)
                if c[t] and p > q:
                    terms[t] = price(p, q)
            for part, values, ranks in (("pair", pairs, len(pairs)), ("term", terms, top)):
                for k, (item, value) in enumerate(sorted(values.items(), key=lambda x: (-x[1], x[0].encode()))[:ranks], 1):
                    out.add((lang, s, part, item, value, k))
    return out


def rows_of(table):
    return [tuple(r) for r in table.select("text", "lang", "source").collect()]


def got(table, **how):
    rows = [tuple(r) for r in divergence(table, **how).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_whole_tables(docs, odd, none):
    assert got(docs) == brute(rows_of(docs))
    assert got(docs, terms_per_shard=7, min_docs=3, top=2) == brute(rows_of(docs), 3, 2)
    assert got(odd) == brute(rows_of(odd))
    assert got(odd, min_docs=1) == brute(rows_of(odd), 1)
    assert got(none) == set()


def test_groups_without_terms_and_odd_characters(spark):
    rows = [("Ab aB \x7fab_é[É]É ab", "x", "s1")] * 3 + [("ab é\xa0é", "x", "S2")] * 2 + [("12 3", "x", "s3"), (None, "x", None), ("ab", None, "s"),
            ("", None, "t"), ("zz", "y", "only"), ("İ K ß ab", "x", "s1")]
    table = spark.createDataFrame(rows, "text string, lang string, source string")
    for least in (1, 2, 3, 99):
        assert got(table, min_docs=least, terms_per_shard=1) == brute(rows, least)


def test_sql_of_the_query(docs):
    con = duckdb.connect()
    con.register("documents", docs.toArrow())
    assert set(con.execute(ORACLE).fetchall()) == got(docs)


arrays = st.dictionaries(st.integers(0, 60), st.integers(1, 10**6), max_size=40)


@settings(max_examples=300, deadline=None)
@given(arrays, arrays, st.integers(0, 5))
def test_merge_prices_every_term(one, two, absent):
    def sides(x):
        keys = sorted(x)
        return np.array(keys, np.int32), np.array([x[k] for k in keys], np.int64)

    terms = sorted(set(one) | set(two))
    v, n1, n2 = len(terms) + absent, sum(one.values()), sum(two.values())
    if not v:
        return
    want = sum(price(share(one.get(t, 0), n1, v), share(two.get(t, 0), n2, v)) for t in [*terms, *[-1] * absent])
    assert merged_price(sides(one), sides(two), v, n1, n2, v) == want
    assert merged_price(sides(two), sides(one), v, n2, n1, v) == want
    a, b = overlap(sides(one)[0], sides(two)[0])
    assert [sorted(one)[k] for k in a] == [sorted(two)[k] for k in b] == sorted(set(one) & set(two))


@settings(max_examples=300, deadline=None)
@given(st.integers(0, 10**15), st.integers(0, 10**15), st.integers(1, 10**9))
def test_exact_at_scale(count, more, v):
    n = count + more
    assert shares([count], n, v)[0] == share(count, n, v)
    p, q = shares([count], n, v), shares([0], n, v)
    assert prices(p, q)[0] == price(int(p[0]), int(q[0]))
