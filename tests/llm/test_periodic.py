"""Runs against brute force: on number sequences, texts and tables."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from reelframe.llm.periodic import _by_length, digests, periodic_runs, runs_of, tails_repeated


def brute(words, min_words=12):
    """All runs by definition: for each period, maximal stretches of words
    equal to the one a period on; of one stretch the smallest period."""
    n, best = len(words), {}
    for q in range(1, n // 2 + 1):
        x = 0
        while x + q < n:
            if words[x] != words[x + q]:
                x += 1
                continue
            end = x
            while end + q < n and words[end] == words[end + q]:
                end += 1
            if end - x + q >= max(min_words, 2 * q):
                best.setdefault((x, end + q), q)  # q ascends
            x = end
    return sorted((a, b - a, q) for (a, b), q in best.items())


def got(ids, min_words=12, **how):
    return list(zip(*(c.tolist() for c in runs_of(np.array(ids, np.int64), min_words, **how))))


def fibonacci(n):
    a, b = "0", "01"
    while len(b) < n:
        a, b = b, b + a
    return [int(c) for c in b[:n]]


SEQUENCES = {
    "one word": [7] * 300, "two words": [1, 2] * 150, "none": list(range(200)), "fibonacci": fibonacci(400),
    "thue-morse": [bin(i).count("1") % 2 for i in range(512)], "short": [1] * 11, "twelve": [1] * 12,
    "periods inside periods": ([1, 2] * 8 + [3]) * 6, "near": ([1] * 30 + [2]) * 5 + [1] * 14, "empty": [],
    "late": list(range(97)) + list(range(50)) * 3 + [9],
}


@pytest.mark.parametrize("name", SEQUENCES)
@pytest.mark.parametrize("min_words", [2, 12])
def test_known_sequences(name, min_words):
    ids = SEQUENCES[name]
    want = brute(ids, min_words)
    assert got(ids, min_words) == want
    assert got(ids, min_words, chunk=1) == want  # word by word
    assert got(ids, min_words, chunk=37) == want


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=9), st.integers(1, 9)), max_size=8), st.integers(1, 60))
def test_any_sequence(parts, chunk):
    ids = [w for block, times in parts for w in block * times]
    want = brute(ids)
    assert got(ids) == want and got(ids, chunk=chunk) == want


def test_long_periods():
    rnd = random.Random(3)
    for _ in range(12):
        p, a = rnd.randint(20, 140), rnd.randint(0, 50)
        block = [rnd.randint(0, 40) for _ in range(p)]
        ids = [rnd.randint(50, 90) for _ in range(a)] + (block * 5)[:rnd.randint(2 * p - 3, 5 * p)] + [rnd.randint(0, 40) for _ in range(30)]
        assert got(ids) == brute(ids)


def test_misleading_hashes_change_nothing():
    rnd = random.Random(4)
    for bits in (1, 4, 10):
        ids = [rnd.randint(0, 2) for _ in range(150)] + [1, 2, 5] * 9
        assert got(ids, mask=2**bits - 1 << 40) == brute(ids)


def test_work_grows_in_proportion():
    """A long stretch of one word catches every period; it stays one run."""
    assert got([3] * 300_000) == [(0, 300_000, 1)]


def test_groups_hold_every_text_once():
    sizes = np.array([0, 5, 1, 700, 5, 64, 63, 0])
    groups = [g.tolist() for g in _by_length(sizes)]
    assert sorted(d for g in groups for d in g) == list(range(8))


def wrapped(doc_id, text):
    words = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not words:
        return [w.decode() for w in words]
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [(words[i] if i < a else words[a + (i - a) % p]).decode() for i in range(n)]


def row(doc_id, words, runs):
    dropped = {i for a, n, q in runs for i in range(a + q, a + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    listed = "".join(f"{a},{n},{q}\n" for a, n, q in runs)
    collapsed = " ".join(w for i, w in enumerate(words) if i not in dropped)
    return (str(doc_id), len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(collapsed.encode()).hexdigest())


def compared(table, limit=10_000):
    want = []
    for r in table.select("doc_id", "text").collect():
        words = wrapped(r.doc_id, r.text)
        numbers = {w: i for i, w in enumerate(dict.fromkeys(words))}
        ids = [numbers[w] for w in words]
        # Too long for brute force: the wrapped or plain text by itself.
        runs = brute(ids) if len(ids) < limit else got(ids)
        want.append(row(r.doc_id, words, runs))
    have = [tuple(str(v) if i == 0 else v for i, v in enumerate(r)) for r in digests(periodic_runs(tails_repeated(table))).collect()]
    assert sorted(have, key=str) == sorted(want, key=str)
    return want


def test_whole_tables(docs, odd, none):
    some = compared(docs, 700)
    assert sum(r[1] > 0 for r in some) > 0.08 * len(some)
    compared(odd)
    assert compared(none) == []


def test_planted_documents(spark):
    rnd = random.Random(8)
    line = " ".join(f"w{k}" for k in range(20))
    rows = [(i, " ".join(rnd.choice(["", f"{line}\n" * rnd.randint(1, 4)]) + " ".join(f"x{rnd.randint(0, 400)}" for _ in range(rnd.randint(0, 90)))
                         for _ in range(3))) for i in range(120)]
    rows += [(900, "a " * 40), (901, "a\x0bb\x0c" * 9), (902, "é ñ\t" * 7), (903, "a\x1cb " * 12), (904, "\xa0 " * 13), (905, " "), (906, None)]
    compared(spark.createDataFrame(rows, "doc_id long, text string"))


def test_runs_and_texts(spark):
    table = spark.createDataFrame([(1, "start " + "ab cd ef " * 5 + "end"), (None, "x " * 3)], "doc_id long, text string")
    found = {r.doc_id: r for r in periodic_runs(table).collect()}
    assert [tuple(r) for r in found[1].runs] == [(1, 15, 3)] and found[1].collapsed == "start ab cd ef end"
    assert found[None].runs == [] and found[None].collapsed == "x x x"
