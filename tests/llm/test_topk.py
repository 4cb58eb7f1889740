"""Top-k against all inner products in whole numbers."""

from __future__ import annotations

import math

import duckdb
import numpy as np
import pytest

from reelframe.llm.queries import op8_branch_and_bound_top_k
from reelframe.llm.topk import ORACLE, _Best, search_block, top_k


def brute(queries, vectors, k=10):
    def whole(v):
        ok = v is not None and all(x is not None and math.isfinite(x) for x in v)
        return [math.floor(1024 * x) for x in v] if ok else None

    out = []
    for q, qv in sorted(set((i, tuple(v)) for i, v in queries if i is not None and whole(v) is not None)):
        qs = whole(qv)
        found = []
        for i, v in vectors:
            if i is not None and i != q and (vs := whole(v)) is not None and len(vs) == len(qs):
                found.append((-max(-2**63, min(2**63 - 1, sum(a * b for a, b in zip(qs, vs)))), i))
        for rank, (s, i) in enumerate(sorted(found)[:k], 1):
            out.append((q, rank, i, -s))
    return out


def test_query_matches_sql(spark):
    sf = "/root/testdata/sf0.001"
    db = duckdb.connect()
    db.sql(f"create view embeddings as select * from '{sf}/embeddings.parquet'")
    want = db.sql(ORACLE)
    got = op8_branch_and_bound_top_k(spark, sf).select(*want.columns).collect()
    assert sorted(map(tuple, got)) == sorted(want.fetchall())


def test_odd_vectors(spark):
    rows = [(0, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, None), (None, [1.0, 1.0]), (4, [math.nan, 1.0]), (5, [1.0, None]),
            (6, []), (100, []), (7, [1e30, -1e30]), (200, [1e30, 1e-3]), (0, [1.0, 2.0]), (300, [math.inf, 0.0]), (-100, [0.5, -0.5]),
            (400, [1.0, 2.0, 3.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").selectExpr("*", "1 as id", "2 as score", "3 as dims")
    got = top_k(df.filter("vec_id % 100 = 0"), df, 10).collect()
    want = brute([r for r in rows if r[0] is not None and r[0] % 100 == 0], rows)
    assert sorted(map(tuple, got)) == sorted(want)
    assert top_k(df.limit(0), df, 10).count() == 0 and top_k(df, df.limit(0), 10).count() == 0


@pytest.mark.parametrize("block_rows, query_rows, broadcast_bytes", [(7, 3, 1 << 20), (64, 64, 1 << 20), (7, 3, 0), (64, 64, 0)])
def test_blocks_and_ties(spark, block_rows, query_rows, broadcast_bytes):
    rnd = np.random.default_rng(2)
    rows = [(i, rnd.integers(-3, 4, 6).astype(float).tolist()) for i in range(150)] + [(1000 + i, [1.0] * 6) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").repartition(4)
    found = top_k(df.filter("vec_id % 10 = 0"), df, 5, block_rows=block_rows, query_rows=query_rows, broadcast_bytes=broadcast_bytes)
    assert ("BroadcastHashJoin" in found._jdf.queryExecution().executedPlan().toString()) == (broadcast_bytes > 0)
    got = found.collect()
    assert sorted(map(tuple, got)) == sorted(brute([r for r in rows if r[0] % 10 == 0], rows, 5))


def test_pruning_keeps_every_winner():
    rnd = np.random.default_rng(3)
    cells = np.floor(1024 * rnd.normal(size=(48, 500)) * np.linspace(2, 0.05, 48)[:, None])
    ids = np.arange(500, dtype=np.int64)
    best = _Best(np.arange(5, dtype=np.int64), 10)
    search_block(best, cells[:, :5], ids, cells, slab=4)
    for i in range(5):
        scores = (cells[:, i] @ cells).astype(np.int64)
        want = sorted((-int(s), j) for j, s in enumerate(scores) if j != i)[:10]
        assert best.found[i] == [(-s, j) for s, j in want]


def test_the_bound_goes_on_from_block_to_block():
    rnd = np.random.default_rng(5)
    cells = np.floor(1024 * rnd.normal(size=(64, 4000)) * np.linspace(2, 0.02, 64)[:, None])
    ids = np.arange(4000, dtype=np.int64)
    blocks = [slice(a, a + 500) for a in range(0, 4000, 500)]
    queries = [np.arange(5, dtype=np.int64), np.arange(5, 10, dtype=np.int64)]
    kept = [_Best(q, 10) for q in queries]
    read = sum(search_block(b, cells[:, b.ids], ids[at], cells[:, at], slab=4) for at in blocks for b in kept)
    fresh = [_Best(q, 10) for q in queries for _ in blocks]
    alone = sum(search_block(b, cells[:, b.ids], ids[at], cells[:, at], slab=4) for b, at in zip(fresh, 2 * blocks))
    assert read < 0.85 * alone and alone < 0.85 * 10 * cells.size
