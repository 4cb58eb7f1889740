"""Language identification by compression.

Each language has a raw-content zstandard dictionary made of training text.
A text is encoded block by block with every dictionary; the language whose
dictionary gives the fewest bytes is the prediction, and the share by which
it beats the runner-up is the margin. A narrow margin rejects the text.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_arrow

# The classifier is fitted on a bounded sample of the labelled rows: of each
# language the SAMPLE_DOCS training rows with the smallest hash (texts of at
# most SAMPLE_BYTES first), until its dictionary holds DICT_BYTES; and of the
# MAX_LANGS languages with the most training rows (a dirty column may have any
# number of values, and each dictionary goes to every task).
MAX_LANGS = 256
SAMPLE_DOCS = 256
SAMPLE_BYTES = 4096
DICT_BYTES = 64 << 10
BLOCK_BYTES = 4096
LEVEL = 6
MIN_MARGIN = 0.005

_NOT_LETTERS = re.compile(r"[\W\d_]+")
_COMPRESSORS: dict = {}


def letters_only(text: str) -> str:
    """Lower case, with one space for every run of anything but letters."""
    return " " + _NOT_LETTERS.sub(" ", text.lower()).strip() + " "


def fit(train: DataFrame, *, text_col: str = "text", lang_col: str = "lang",
        order_cols: tuple[str, ...] = ("doc_id",), sample_docs: int = SAMPLE_DOCS,
        dict_bytes: int = DICT_BYTES, max_langs: int = MAX_LANGS) -> dict[str, bytes]:
    """Dictionaries by language, from the rows whose language and text are
    not null, for the ``max_langs`` languages of most such rows (ties by
    name), the language of most rows first. Texts are reduced to letters and
    cut where they lie: the driver gets what the dictionaries hold, at most
    ``dict_bytes`` for each language and the rest of one text. Equal inputs
    give equal dictionaries, whatever the order of the rows. A language none
    of whose texts has a letter gets a dictionary of spaces; no rows give no
    languages.
    """
    import pyarrow as pa

    rows = train.select(F.col(lang_col).alias("lang"), F.col(text_col).cast("string").alias("text"),
                        F.xxhash64(F.lit(7), *order_cols).alias("h"))
    rows = rows.filter("lang is not null and text is not null").select(
        "lang", "h", (F.octet_length("text") > SAMPLE_BYTES).alias("is_long"),
        F.substring("text", 1, dict_bytes).alias("text"))
    rank = Window.partitionBy("lang").orderBy("is_long", "h", "text")
    chosen = rows.withColumn("n", F.row_number().over(rank)).filter(F.col("n") <= sample_docs)

    def letters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            plain = [letters_only(t.as_py()).encode()[:dict_bytes] for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(plain, pa.binary())], ["lang", "n", "plain"])

    common = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(max_langs).collect()
    # Languages by name, at most max_langs of them.
    chosen = chosen.filter(F.col("lang").isin([row["lang"] for row in common])) if common else chosen
    kind = rows.schema["lang"].dataType.simpleString()
    plain = map_arrow(chosen.select("lang", "n", "text"), letters, f"lang {kind}, n int, plain binary")
    before = Window.partitionBy("lang").orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    plain = plain.withColumn("before", F.coalesce(F.sum(F.octet_length("plain")).over(before), F.lit(0))).filter(F.col("before") < dict_bytes)
    texts: dict[str, bytes] = defaultdict(bytes)
    for lang, part in plain.orderBy("lang", "n").select("lang", "plain").collect():
        texts[lang] += bytes(part)
    return {row["lang"]: texts[row["lang"]][:dict_bytes] for row in common}


def _compressors(dictionaries: dict[str, bytes]) -> list:
    """One compressor per language, in the dictionaries' order, made once per
    worker and set of dictionaries."""
    key = tuple(dictionaries.items())
    if key not in _COMPRESSORS:
        import zstandard as zstd

        _COMPRESSORS.clear()
        made = []
        for lang, raw in key:
            params = zstd.ZstdCompressionParameters.from_level(
                LEVEL, dict_size=len(raw), source_size=BLOCK_BYTES, write_content_size=False,
                write_dict_id=False, write_checksum=False)
            known = {}
            if len(raw) >= 8:  # shorter content is no dictionary for the library
                known["dict_data"] = zstd.ZstdCompressionDict(raw, dict_type=zstd.DICT_TYPE_RAWCONTENT)
                known["dict_data"].precompute_compress(compression_params=params)
            made.append((lang, zstd.ZstdCompressor(compression_params=params, **known)))
        _COMPRESSORS[key] = made
    return _COMPRESSORS[key]


def classify(text: str | None, compressors: list) -> tuple[str, float]:
    """Language and margin (0 to 1) of one whole text; ``und`` and 0 for a
    text without a letter. The language of more training rows wins a tie."""
    plain = letters_only(text or "")
    if not compressors or not any(map(str.isalpha, plain)):
        return "und", 0.0
    raw = plain.encode()
    blocks = [raw[i:i + BLOCK_BYTES] for i in range(0, len(raw), BLOCK_BYTES)]
    sizes = sorted((sum(len(c.compress(b)) for b in blocks), i) for i, (_, c) in enumerate(compressors))
    margin = 1.0 - sizes[0][0] / sizes[1][0] if len(sizes) > 1 else 1.0
    return compressors[sizes[0][1]][0], margin


def identify(docs: DataFrame, dictionaries: dict[str, bytes], *, text_col: str = "text",
             min_margin: float = MIN_MARGIN) -> DataFrame:
    """``docs`` with ``lang_pred`` string, ``score`` double (the margin) and
    ``lang_rejected`` boolean (``und``, or a margin below ``min_margin``).

    Each whole text is read once, in its scan's own tasks: no shuffle. The
    dictionaries travel with the task, ``DICT_BYTES`` for each language.
    Null and empty texts are ``und`` and rejected; repeated rows get equal
    answers; an empty table stays empty; columns of these three names that
    ``docs`` already has are replaced.
    """
    import pyarrow as pa

    own = [f for f in docs.schema.fields if f.name.lower() not in ("lang_pred", "score", "lang_rejected")]
    at = next(i for i, f in enumerate(own) if f.name.lower() == text_col.lower())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressors = _compressors(dictionaries)
        for batch in batches:
            found = [classify(t.as_py(), compressors) for t in batch.column(at)]
            langs, scores = [f[0] for f in found], [f[1] for f in found]
            rejected = [lang == "und" or score < min_margin for lang, score in found]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())],
                [*batch.schema.names, "lang_pred", "score", "lang_rejected"])

    from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

    schema = StructType([*own, StructField("lang_pred", StringType()), StructField("score", DoubleType()),
                         StructField("lang_rejected", BooleanType())])
    return map_arrow(docs.select(*[F.col(f"`{f.name}`") for f in own]), run, schema)


def held_out(docs: DataFrame, id_col: str = "doc_id"):
    """True where crc32 of the id as text is divisible by 5 (null id: false)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def training_rows(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Rows that may be learned from: an id, not held out."""
    return docs.filter(F.col(id_col).isNotNull() & ~held_out(docs, id_col))
