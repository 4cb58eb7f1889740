"""Best-fit packing of token pieces into sequences by sum of squares.

An open sequence is known by its gap (free tokens); N(g) counts the open
sequences of gap g. A piece goes where the sum of N(g)^2 over all gaps
becomes smallest: putting length s into gap g changes the sum by
2 (N(g-s) - N(g)) + 2, filling a gap exactly by 1 - 2 N(g), and a new
sequence by 2 N(capacity-s) + 1. Ties go to the smallest gap.

The work is dealt in two rounds, each over buckets of bounded size whose
number follows the number of pieces. Round one packs each bucket by itself;
since buckets are dealt by hash, each sees the same mix of lengths. Round
two takes the badly filled sequences of all buckets apart and packs their
pieces again, so that what a bucket leaves over is not lost.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, ship, stored

BUCKET_PIECES = 16384    # pieces that one task packs at a time, on average
WELL_FILLED = 0.95       # sequences below this share are packed again in round two
_ENCODERS: dict = {}


def sum_of_squares(lengths, capacity: int):
    """Bin and offset of each length (numpy arrays), placed longest first.

    Lengths lie in 0..capacity. A length of ``capacity`` takes a bin of its
    own; one of 0 takes room nowhere and goes with the next bin made.
    """
    import numpy as np

    n = len(lengths)
    bins, offsets = np.zeros(n, np.int64), np.zeros(n, np.int64)
    count = np.zeros(capacity + 1, np.int64)  # N(g); N(0) and N(capacity) stay 0
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    made = 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        s = int(lengths[i])
        gap, change = capacity, (2 * int(count[capacity - s]) + 1 if s < capacity else 0)
        if s < capacity:
            # Gaps s..capacity-1; the first of the smallest is the tightest.
            delta = 2 * (count[: capacity - s] - count[s:capacity]) + 2
            delta[0] = 1 - 2 * count[s]
            delta[count[s:capacity] == 0] = np.iinfo(np.int64).max
            g = int(delta.argmin())
            if delta[g] <= change:
                gap = g + s
        if gap == capacity:
            b, made = made, made + 1
        else:
            b = open_bins[gap].pop()
            count[gap] -= 1
        bins[i], offsets[i] = b, capacity - gap
        left = gap - s
        if left and left < capacity:
            open_bins[left].append(b)
            count[left] += 1
    return bins, offsets


def _ids_encoder(name: str):
    """The worker's function from texts to their ids as little-endian bytes."""
    if name not in _ENCODERS:
        import numpy as np

        from .tokens import PieceEncoder, load_tokenizer

        _ENCODERS[name] = PieceEncoder(load_tokenizer(name), lambda e: np.array(e.ids, "<u4").tobytes()).ids
    return _ENCODERS[name]


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int, *,
                 id_col: str = "doc_id", text_col: str = "text", slice_bytes: int = 8 << 20,
                 with_ids: bool = False) -> DataFrame:
    """Pieces ``(id, piece, start, length, ids_crc32, deal)`` of each text.

    A document is its ids and then ``end_id``. Only a document longer than
    ``capacity`` is cut: into pieces of ``capacity`` ids, of which the first
    is shorter where the length asks for it. ``deal`` numbers the pieces of
    a task and spreads repeated rows. ``with_ids`` adds the ids themselves.
    """
    id_type = docs.schema[id_col].dataType.simpleString()

    def cut(batches: Iterator) -> Iterator:
        import struct
        import zlib

        import pyarrow as pa
        import pyarrow.compute as pc

        from .tokens import byte_slices

        encode, end, made = _ids_encoder(tokenizer), struct.pack("<I", end_id), 0
        for batch in batches:
            texts = pc.fill_null(batch.column(1), "")
            sizes = pc.binary_length(texts).to_pylist()
            for a, b in byte_slices(sizes, slice_bytes):
                row, piece, start, length, crc, ids = [], [], [], [], [], []
                for i, raw in enumerate(encode(texts.slice(a, b - a)), a):
                    raw += end
                    total, at, k = len(raw) // 4, 0, 0
                    while at < total:
                        to = min(total, at + (((total - 1) % capacity + 1) if at == 0 else capacity))
                        part = raw[4 * at:4 * to]
                        row.append(i)
                        piece.append(k)
                        start.append(at)
                        length.append(to - at)
                        crc.append(zlib.crc32(part))
                        if with_ids:
                            ids.append(part)
                        at, k = to, k + 1
                cols = [batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                        pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
                        pa.array(range(made, made + len(row)), pa.int64())]
                names = ["id", "piece", "start", "length", "ids_crc32", "deal"]
                if with_ids:
                    cols, names = [*cols, pa.array(ids, pa.binary())], [*names, "ids"]
                made += len(row)
                yield pa.RecordBatch.from_arrays(cols, names)

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return map_arrow(rows, cut, f"id {id_type}, piece int, start bigint, length bigint, ids_crc32 bigint, deal bigint"
                           + ", ids binary" * with_ids)


def _packed(pieces: DataFrame, buckets: int, capacity: int, round_id: int) -> DataFrame:
    """``pieces`` with their sequence, offset and the sequence's fill, packed
    bucket by bucket. Sequence ids of different rounds and buckets differ."""
    kept = [f for f in pieces.schema.fields if f.name not in ("sequence_id", "offset", "fill")]
    names = [f.name for f in kept]

    ship(pieces.sparkSession)

    def pack(key, pdf):
        import numpy as np

        pdf = pdf.sort_values(["length", "id", "piece", "deal"], ascending=[False, True, True, True], kind="stable")
        lengths = pdf["length"].to_numpy()
        bins, offsets = sum_of_squares(lengths, capacity)
        fill = np.bincount(bins, weights=lengths).astype(np.int64)
        # 2 rounds, up to 2**26 buckets and 2**36 sequences in each.
        return pdf[names].assign(sequence_id=(round_id << 62) + (int(key[0]) << 36) + bins, offset=offsets, fill=fill[bins])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    bucket: Column = F.pmod(F.xxhash64("id", "piece", "deal"), F.lit(buckets))
    return (pieces.select(*names).groupBy(bucket.alias("bucket"))
            .applyInPandas(pack, f"{schema}, sequence_id bigint, offset bigint, fill bigint"))


def pack_documents(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", capacity: int = 1024, end_id: int = 2, *,
                   id_col: str = "doc_id", text_col: str = "text", bucket_pieces: int = BUCKET_PIECES) -> DataFrame:
    """Rows ``(id, piece, start, length, ids_crc32, sequence_id, offset)``:
    every piece of every document and its place in a sequence of at most
    ``capacity`` ids; a sequence is filled gapless from offset 0.

    A null or empty text is a document of the end id alone. Null ids stay
    null, repeated rows are packed each, an empty table gives no rows, and
    other columns of ``docs`` are not read. Which of several equal pieces
    gets which place is not defined, nor are the sequence numbers.
    """
    pieces = stored(token_pieces(docs, tokenizer, capacity, end_id, id_col=id_col, text_col=text_col), "pieces")
    buckets = max(1, -(-pieces.count() // bucket_pieces))
    first = stored(_packed(pieces, buckets, capacity, 0), "packed")
    good = F.col("fill") >= WELL_FILLED * capacity
    loose = first.filter(~good)
    again = _packed(loose, max(1, -(-loose.count() // (4 * bucket_pieces))), capacity, 1)
    out = first.filter(good).unionByName(again)
    return out.select(F.col("id").alias(id_col), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
