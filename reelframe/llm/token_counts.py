"""Token counts: Arrow functions that return lengths only.

Each Arrow batch is dealt into slices of about ``slice_bytes`` of text, so a
batch of long documents is no larger a job than one of short ones; texts are
cut at safe boundaries (``tokens.py``), encoded in batches, and only numbers
leave the task. No shuffle: one scan, one row out per row in.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow

SLICE_BYTES = 8 << 20
_ENCODERS: dict = {}


def _length_encoder(name: str):
    """The worker's function from texts to token counts, made once."""
    if name not in _ENCODERS:
        if name.endswith(".model"):
            from sentencepiece import SentencePieceProcessor

            from .tokens import tokenizer_path

            model = SentencePieceProcessor(model_file=tokenizer_path(name))
            _ENCODERS[name] = lambda texts: [len(ids) for ids in model.encode(texts.to_pylist(), num_threads=1)]
        else:
            from .tokens import PieceEncoder, load_tokenizer

            _ENCODERS[name] = PieceEncoder(load_tokenizer(name), len).counts
    return _ENCODERS[name]


def token_counts(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", limit: int = 1024, *,
                 id_col: str = "doc_id", text_col: str = "text", slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """Rows ``(id, n_bytes, n_tokens, over_limit)``, one per row of ``docs``.

    ``tokenizer`` is a path or the name of a public file: .json is read by
    tokenizers, .model by sentencepiece. Tokens are counted without begin,
    end or other added special tokens; special strings inside a text are
    handled as the library does by default. ``n_bytes`` is the UTF-8 length.

    Null and empty texts count 0 bytes and 0 tokens; a null id stays null;
    repeated rows are counted each; an empty table gives no rows. Other
    columns of ``docs`` are not read, whatever they are called.
    """
    id_type = docs.schema[id_col].dataType.simpleString()

    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc

        from .tokens import byte_slices

        encode = _length_encoder(tokenizer)
        for batch in batches:
            texts = pc.fill_null(batch.column(1), "")
            sizes = pc.binary_length(texts).cast(pa.int64())
            counts: list[int] = []
            for a, b in byte_slices(sizes.to_pylist(), slice_bytes):
                counts += encode(texts.slice(a, b - a))
            n = pa.array(counts, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), sizes, n, pc.greater(n, limit)], ["id", "n_bytes", "n_tokens", "over_limit"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    out = map_arrow(rows, count, f"id {id_type}, n_bytes bigint, n_tokens bigint, over_limit boolean")
    return out.withColumnRenamed("id", id_col)
