"""Exact top-k by inner product: columnar branch and bound.

Vectors are stored in blocks in vertical layout: all values of a dimension
side by side. For a query and a block, inner products are accumulated one
slab of dimensions at a time, heaviest dimensions of the query first. What
the remaining dimensions can still add or take is bounded by the product of
the remaining norms (Cauchy-Schwarz); candidates whose upper bound falls
below the k-th best lower bound seen so far are dropped, and the survivors
compacted, before the next slab is read. The bound only skips what cannot
be among the k best, so results are exact.

The queries are a stated set, compared with all rows block by block. Query
blocks whose bytes, as counted, are few are broadcast, and a task keeps the
best k of every query while it reads its candidate blocks; more of them are
dealt to every stripe of candidates and sorted there, so a task reads the
stripe for one query block after the other. Either way the k-th best score
goes on from block to block, and the winners meet in a last top-k per query.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_arrow, stored

BLOCK_ROWS = 4096
QUERY_ROWS = 256
SLAB = 16          # dimensions accumulated between two rounds of pruning
BROADCAST_BYTES = 16 << 20  # of query blocks; more are sorted by stripe
EXACT = 2.0 ** 53  # integers up to here are exact in double precision


def vertical_blocks(vectors: DataFrame, rows: int, scale: float, *, id_col: str, vector_col: str) -> DataFrame:
    """``(dims, ids, cells)``: blocks of up to ``rows`` vectors of one length.

    ``ids`` are int64, ``cells`` the values floor(scale * x) dimension by
    dimension, as float32 where that is exact (below 2**24), else float64.
    Rows without an id, and vectors that are null or hold a null or
    non-finite component, are left out.
    """
    import pyarrow as pa

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            lists = batch.column(1)
            offsets = lists.offsets.to_numpy()
            values = lists.values.to_numpy(zero_copy_only=False).astype(np.float64)  # nulls become nan
            lengths = np.diff(offsets)
            known = lists.is_valid().to_numpy(zero_copy_only=False)
            finite = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
            known &= finite[offsets[1:]] == finite[offsets[:-1]]
            out = []
            for d in np.unique(lengths[known]).tolist():
                at = np.flatnonzero(known & (lengths == d))
                for part in (at[i:i + rows] for i in range(0, len(at), rows)):
                    cells = np.floor(scale * values[offsets[part][:, None] + np.arange(d)]).T
                    kind = "<f4" if not cells.size or np.abs(cells).max() < 2 ** 24 else "<f8"
                    out.append((d, ids[part].astype("<i8").tobytes(), np.ascontiguousarray(cells, kind).tobytes()))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([o[0] for o in out], pa.int32()), pa.array([o[1] for o in out], pa.binary()),
                     pa.array([o[2] for o in out], pa.binary())], ["dims", "ids", "cells"])

    rows_in = vectors.filter(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull()).select(
        F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    return map_arrow(rows_in, build, "dims int, ids binary, cells binary")


class _Best:
    """The best k (score, smaller id first) of each query of a block."""

    def __init__(self, ids, k: int):
        self.ids, self.k = ids, k
        self.found: list[list[tuple[int, int]]] = [[] for _ in ids]

    def floor(self, i: int) -> float:
        return self.found[i][-1][0] if len(self.found[i]) >= self.k else float("-inf")

    def add(self, i: int, scores, ids) -> None:
        rows = self.found[i] + list(zip(scores, ids))
        rows.sort(key=lambda x: (-x[0], x[1]))
        self.found[i] = rows[:self.k]


def _matrix(cells: bytes, dims: int, n: int):
    import numpy as np

    return np.frombuffer(cells, "<f4" if len(cells) == 4 * dims * n else "<f8").reshape(dims, n).astype(np.float64)


def search_block(best: _Best, queries, ids, cells, slab: int = SLAB) -> int:
    """Offer every candidate of a block (``cells``: dims x n) to every query
    (``queries``: dims x m); a query's own id is no candidate. Returns the
    number of candidates' values that were read."""
    import numpy as np

    dims, n = cells.shape
    largest = max(float(np.abs(x).max()) if x.size else 0.0 for x in (queries, cells))
    if dims * largest * largest >= EXACT:
        # Beyond double precision: whole Python integers, no bounds.
        columns = cells.T.astype(object)
        columns = np.array([[int(v) for v in c] for c in columns], dtype=object).reshape(n, dims)
        for i, own in enumerate(best.ids.tolist()):
            q = [int(v) for v in queries[:, i]]
            other = np.flatnonzero(ids != own)
            scores = [sum(a * b for a, b in zip(q, columns[j])) for j in other]
            best.add(i, [max(-2 ** 63, min(2 ** 63 - 1, s)) for s in scores], ids[other].tolist())
        return dims * n * len(best.ids)
    norms, read = (cells * cells).sum(axis=0), 0
    for i, own in enumerate(best.ids.tolist()):
        q = queries[:, i]
        order = np.argsort(-np.abs(q), kind="stable")
        alive = np.flatnonzero(ids != own)
        acc, rest = np.zeros(len(alive)), norms[alive]
        left = float(q @ q)
        for at in range(0, dims, slab):
            part = order[at:at + slab]
            values = cells[part] if len(alive) == n else cells[np.ix_(part, alive)]
            read += values.size
            acc = acc + q[part] @ values
            if at + slab >= dims:
                break
            left -= float(q[part] @ q[part])
            rest = rest - (values * values).sum(axis=0)
            # Sums of squares are whole numbers below 2**53, so only the root
            # and the product round; the slack covers both.
            slack = np.sqrt(max(left, 0.0) * np.maximum(rest, 0.0)) * (1 + 1e-12) + 1e-6
            lower = best.floor(i)
            if len(alive) > best.k:
                lower = max(lower, float(np.partition(acc - slack, len(alive) - best.k)[len(alive) - best.k]))
            keep = acc + slack >= lower
            if keep.sum() < 0.75 * len(alive):
                alive, acc, rest = alive[keep], acc[keep], rest[keep]
        keep = acc >= best.floor(i)
        if len(acc) > best.k:
            keep &= acc >= np.partition(acc, len(acc) - best.k)[len(acc) - best.k]
        scores, names = acc[keep].astype(np.int64), ids[alive[keep]]
        first = np.lexsort((names, -scores))[:best.k]  # a tie may be very long
        best.add(i, scores[first].tolist(), names[first].tolist())
    return read


def top_k(queries: DataFrame, vectors: DataFrame, k: int = 10, scale: float = 1024.0, *, id_col: str = "vec_id",
          vector_col: str = "embedding", block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS,
          broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``(query_id, rank, id, score)``: for each row of ``queries`` the ``k``
    rows of ``vectors`` with another id that have the largest integer inner
    product of floor(scale * x), ties to the smaller id; fewer if there are
    fewer.

    Only vectors of equal length are compared. Null ids, and vectors that
    are null or hold null or non-finite components, take no part; empty
    vectors all score 0 with each other; a repeated row of ``vectors`` is a
    candidate each time, a repeated query is answered once, by the union of
    its rows' candidates; empty tables give no rows; scores beyond 64 bits
    are cut there before they are ranked. Other columns are not read.
    """
    import pyarrow as pa

    spark = vectors.sparkSession
    cand = stored(vertical_blocks(vectors, block_rows, scale, id_col=id_col, vector_col=vector_col), "candidates")
    ask = queries.dropDuplicates([id_col, vector_col])
    asked = stored(vertical_blocks(ask, query_rows, scale, id_col=id_col, vector_col=vector_col), "queries")
    size = asked.agg(F.sum(F.length("ids") + F.length("cells"))).first()[0] or 0
    # As many stripes as there are tasks for them; a candidate is in one.
    stripes = max(1, min(cand.count(), int(spark.conf.get("spark.sql.shuffle.partitions"))))
    block = F.monotonically_increasing_id()
    left = asked.select("dims", block.alias("block"), F.col("ids").alias("q_ids"), F.col("cells").alias("q_cells"))
    right = cand.withColumn("stripe", F.pmod(F.xxhash64("ids"), F.lit(stripes)))
    small = size <= broadcast_bytes
    if small:
        pairs = right.repartition(stripes, "stripe").join(F.broadcast(left), "dims")
    else:
        every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(stripes - 1).cast("bigint")))
        pairs = left.withColumn("stripe", every).hint("merge").join(right, ["dims", "stripe"])
    pairs = pairs.select("dims", "stripe", "block", "q_ids", "q_cells", "ids", "cells")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        def winners(best: _Best) -> pa.RecordBatch:
            rows = [(int(q), int(v), int(s)) for q, found in zip(best.ids, best.found) for s, v in found]
            return pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], pa.int64()) for j in range(3)],
                                              ["query_id", "id", "score"])

        open_blocks: dict = {}
        for batch in batches:
            for row in range(batch.num_rows):
                dims, stripe, number, q_ids, q_cells, ids, cells = (batch.column(j)[row] for j in range(7))
                key = number.as_py() if small else (stripe.as_py(), number.as_py())
                if key not in open_blocks:
                    if not small:  # sorted: the last query block has met its stripe
                        yield from map(winners, (best for best, _ in open_blocks.values()))
                        open_blocks.clear()
                    best = _Best(np.frombuffer(q_ids.as_py(), "<i8"), k)
                    open_blocks[key] = best, _matrix(q_cells.as_py(), dims.as_py(), len(best.ids))
                best, q = open_blocks[key]
                names = np.frombuffer(ids.as_py(), "<i8")
                search_block(best, q, names, _matrix(cells.as_py(), dims.as_py(), len(names)))
        yield from map(winners, (best for best, _ in open_blocks.values()))

    rows = map_arrow(pairs, search, "query_id bigint, id bigint, score bigint")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    ranked = rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("id").alias(id_col), "score")


ORACLE = """
with v as (select vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)) as e from embeddings
           where vec_id is not null and embedding is not null
             and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
p as (select q.vec_id as query_id, c.vec_id, list_dot_product(q.e, c.e)::bigint as score
      from v q join v c on q.vec_id % 100 = 0 and c.vec_id <> q.vec_id and len(q.e) = len(c.e)),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from p)
select query_id, rank, vec_id, score from r where rank <= 10
"""
