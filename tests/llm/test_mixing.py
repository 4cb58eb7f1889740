"""Targets against step-by-step sharing, multipliers, copies."""

from __future__ import annotations

import math
from collections import defaultdict

import pytest

from reelframe.llm.mixing import balance, mix, mixed, water_filling


def shared(sizes: dict, weights=(5, 2, 1), cap=3) -> dict:
    """Resharing as described: by weight, the excess over the cap again by
    weight among the rest, until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, free, left = dict.fromkeys(names, 0.0), set(names), float(sum(sizes.values()))
    while free:
        total = sum(weight[s] for s in free)
        over = {s for s in free if left * weight[s] / total > cap * sizes[s]}
        if not over:
            for s in free:
                target[s] = left * weight[s] / total
            break
        for s in over:
            target[s] = cap * sizes[s]
            left -= target[s]
        free -= over
    return target


@pytest.mark.parametrize("sizes", [
    {"a": 10, "b": 1000, "c": 500}, {"a": 1, "b": 1, "c": 1, "d": 10_000}, {"a": 0, "b": 7, None: 3}, {"z": 5},
    {"é": 100, "a": 3, "Z": 50, None: 900, "": 20}, {"a": 0, "b": 0}])
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
    got = {r.source: r.target for r in water_filling(df).collect()}
    want = shared(sizes)
    assert got.keys() == want.keys() and all(math.isclose(got[s], want[s], abs_tol=1e-6) for s in want)


def test_newton_meets_two_margins(spark):
    cells = spark.createDataFrame([("a", "x", 100.0), ("a", "y", 50.0), ("b", "x", 30.0), ("b", "y", 80.0), (None, "x", 40.0)],
                                  "s string, l string, mass double")
    s = spark.createDataFrame([("a", 120.0), ("b", 140.0), (None, 40.0)], "category string, target double")
    lang = spark.createDataFrame([("x", 180.0), ("y", 120.0)], "category string, target double")
    lam = {m: {r.category: r.lam for r in t.collect()} for m, t in balance(cells, {"s": s, "l": lang}).items()}
    sums = defaultdict(float)
    for c in cells.collect():
        w = c.mass * math.exp(lam["s"][c.s] + lam["l"][c.l])
        sums["s", c.s] += w
        sums["l", c.l] += w
    for m, t in (("s", s), ("l", lang)):
        for r in t.collect():
            assert math.isclose(sums[m, r.category], r.target, rel_tol=1e-6)


def test_impossible_targets_are_an_error(spark):
    cells = spark.createDataFrame([("a", 10.0)], "s string, mass double")
    goal = spark.createDataFrame([("a", 31.0)], "category string, target double")
    with pytest.raises(RuntimeError):
        balance(cells, {"s": goal}, max_rate=3, max_iterations=8)


@pytest.mark.parametrize("which", ["docs", "odd"])
def test_mix(request, which):
    table = request.getfixturevalue(which)
    rows = mix(table).collect()
    sizes = defaultdict(int)
    words = sorted((r.doc_id or 0, len((r.text or "").encode().split())) for r in table.select("doc_id", "text").collect())
    assert sorted((r.doc_id or 0, r["size"]) for r in rows) == words
    for r in rows:
        sizes[r.source] += r["size"]
        assert r.taken == r.copies * r["size"] and 0 <= r.copies <= 3
    target = shared(sizes)
    taken = defaultdict(int)
    for r in rows:
        assert r.source_size == sizes[r.source] and math.isclose(r.target, target[r.source], abs_tol=1e-6)
        taken[r.source] += r.taken
    if which == "docs":
        gap = [abs(taken[s] - target[s]) / target[s] for s in sizes]
        assert max(gap) < 0.1 and sorted(gap)[len(gap) // 2] < 0.02
    key = lambda r: str(tuple(r))
    assert sorted(map(key, rows)) == sorted(map(key, mix(table.repartition(5)).collect()))


def test_mixed_rows_are_the_copies(odd, none):
    out = mixed(odd)
    assert out.columns == odd.columns
    assert out.count() == sum(r.copies for r in mix(odd).collect())
    assert mix(none).count() == 0 and mixed(none).count() == 0


def test_slack_margin_is_the_optimum(spark):
    """Optimality of the cut problem: the first margin met exactly, the second
    but for slack * multiplier * target, rates between 0 and the cut."""
    import random

    rnd = random.Random(5)
    mass = {(s, b): rnd.choice([0, 5, 40, 900]) * rnd.random() for s in range(40) for b in range(6)}
    mass = {k: m for k, m in mass.items() if m}
    size = defaultdict(float)
    for (s, _), m in mass.items():
        size[s] += m
    goal_s = {s: m * rnd.choice([0.2, 0.9, 1.5, 2.9, 3.0]) for s, m in size.items()}
    scale = sum(goal_s.values()) / sum(size.values())
    goal_b = defaultdict(float)
    for (_, b), m in mass.items():
        goal_b[b] += m * scale
    cells = spark.createDataFrame([(s, b, m) for (s, b), m in mass.items()], "s int, b int, mass double")
    frame = lambda goal: spark.createDataFrame(list(goal.items()), "category int, target double")
    lam = {m: {r.category: r.lam for r in t.collect()}
           for m, t in balance(cells, {"s": frame(goal_s), "b": frame(goal_b)}, slack=0.1).items()}
    sums = defaultdict(float)
    for (s, b), m in mass.items():
        x = m * min(3.0, math.exp(lam["s"][s] + lam["b"][b]))
        sums["s", s] += x
        sums["b", b] += x
    assert all(math.isclose(sums["s", s], t, rel_tol=1e-9) for s, t in goal_s.items())
    assert all(math.isclose(sums["b", b] - t, -0.1 * lam["b"][b] * t, abs_tol=1e-5 * t) for b, t in goal_b.items())
    assert max(map(abs, lam["b"].values())) > 0.01


def test_rates_differ_by_length_and_long_documents_are_taken(spark):
    """Sources of short and of long documents mostly: within a source the
    rates tilt against the lengths that its weight favours, and where a rate is
    below a half the longest documents of the blocks are still taken."""
    rows = [(i, "w " * (20 + i % 50 if i % 10 else 300 + i % 400), "a" if i < 5000 else "b") for i in range(7000)]
    rows += [(i, "w " * (200 + i % 700 if i % 4 else 20), "c") for i in range(7000, 9000)]
    out = mix(spark.createDataFrame(rows, "doc_id bigint, text string, source string")).collect()
    rates, taken, target, longest = defaultdict(set), defaultdict(int), {}, defaultdict(list)
    for r in out:
        rates[r.source].add(r.rate)
        taken[r.source] += r.taken
        target[r.source] = r.target
        longest[r.source].append((r["size"], r.copies, r.rate))
    assert all(len(v) > 1 for s, v in rates.items() if min(v) < 3)
    assert all(abs(taken[s] - target[s]) < 0.01 * target[s] for s in target)
    top = sorted(longest["c"], reverse=True)[:400]
    assert top[0][2] < 0.5
    assert math.isclose(sum(c for _, c, _ in top), sum(r for _, _, r in top), rel_tol=0.3)


def test_many_copies_of_one_row(spark, monkeypatch):
    from reelframe.llm import mixing

    monkeypatch.setattr(mixing, "CHUNK", 7)
    rows = [(1, "a b c", "x")] * 100 + [(i, "one two three four", "y") for i in range(2, 40)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    out = mix(table).collect()
    assert len(out) == len(rows) and max(r.copies for r in out) <= 3
    again = defaultdict(int)
    for r in mixed(table).collect():
        again[r.doc_id] += 1
    want = defaultdict(int)
    for r in out:
        want[r.doc_id] += r.copies
    assert again == {i: n for i, n in want.items() if n}
