"""Byte-level BPE encoding and decoding by recursive queries.

Each task opens a DuckDB of its own, in memory, with three tables: ``merges``
(every pair of tokens that makes a token, with its rank), ``vocab`` and
``known`` (the words met so far and their ids; at first the tokens
themselves, which a word equal to one takes at once). A word is a set of
token-position rows, at first one row per byte; a recursive query joins
neighbouring rows with ``merges`` and contracts each word's leftmost pair of
the lowest rank until no word has a pair left. Decoding joins ids with
``vocab`` and aggregates the bytes in the order of their positions.

A word of more than ``LONG_BYTES`` bytes takes a second form of the query,
keyed by (word, position) so that only the latest state is held: a round
contracts the pairs of the lowest rank from left to right, up to and with the
first contraction that makes a pair of a lower rank possible, which is the
same sequence of contractions in fewer rounds.

Texts are cut into words in chunks that begin and end at safe boundaries
(``tokens.py`` says why), so neither a text nor its ids need to be in memory
at once, and no document leaves its task: there is no shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow

RANKS = "byte_bpe_multi_50k.tiktoken"
CHUNK_CHARS = 1 << 20   # characters cut into words at once
LONG_BYTES = 64         # longer words take the keyed query
ROUND_ROWS = 3_000_000  # rows that one recursive query may make, as bounded by its words' lengths
KNOWN_WORDS = 300_000   # words kept by a task besides the vocabulary
MEMORY = "400MB"

_ENGINES: dict = {}

# One contraction a round: the leftmost pair of the lowest rank of each word.
# A row knows its right neighbour's token, and the right one of the two rows
# stays, so a row changes by what it has itself. Ranks and positions share one
# number, so that one minimum finds both.
_SHORT = """
WITH RECURSIVE s(round, w, i, tok, next_tok) AS (
  SELECT 0, w, i, tok, next_tok FROM start
  UNION ALL
  (WITH best AS MATERIALIZED (
     SELECT w, min(m::BIGINT * 1048576 + i) AS pair FROM s JOIN merges ON tok = l AND next_tok = r GROUP BY w),
   chosen AS (SELECT w, (pair & 1048575)::INT AS p, (pair >> 20)::INT AS merged FROM best)
   SELECT round + 1, s.w, CASE WHEN i > p THEN i - 1 ELSE i END,
          CASE WHEN i = p + 1 THEN merged ELSE tok END, CASE WHEN i = p - 1 THEN merged ELSE next_tok END
   FROM s JOIN chosen ON s.w = chosen.w WHERE i <> p))
SELECT s.w, i, tok FROM s JOIN (SELECT w, max(round) AS round FROM s GROUP BY w) AS last USING (w, round)
"""

# All contractions of the lowest rank that nothing lower can come between.
# A null token marks a position that its left neighbour has taken in.
_KEYED = """
WITH RECURSIVE s(w, i, tok) USING KEY (w, i) AS (
  SELECT w, i, tok FROM start
  UNION
  (WITH live AS (
     SELECT w, i, tok, row_number() OVER o AS k, lag(tok) OVER o AS left_tok, lead(i) OVER o AS next_i,
            lead(tok) OVER o AS next_tok, lead(tok, 2) OVER o AS right_tok
     FROM recurring.s WHERE tok IS NOT NULL WINDOW o AS (PARTITION BY w ORDER BY i)),
   lowest AS (
     SELECT *, k - row_number() OVER (PARTITION BY w ORDER BY k) AS stretch
     FROM (SELECT live.*, m, min(m) OVER (PARTITION BY w) AS best
           FROM live JOIN merges ON tok = l AND next_tok = r) WHERE m = best),
   apart AS (
     SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY w, stretch ORDER BY k) AS nth FROM lowest) WHERE nth % 2 = 1),
   beside AS (
     SELECT *, CASE WHEN lag(k) OVER (PARTITION BY w ORDER BY k) = k - 2 THEN best ELSE left_tok END AS left_now FROM apart),
   judged AS (
     SELECT beside.*, coalesce(x.m < best, false) OR coalesce(y.m < best, false) AS opens
     FROM beside LEFT JOIN merges x ON x.l = left_now AND x.r = best LEFT JOIN merges y ON y.l = best AND y.r = right_tok),
   safe AS (
     SELECT * FROM (SELECT *, coalesce(sum(opens::INT) OVER (
       PARTITION BY w ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS opened FROM judged) WHERE opened = 0)
   SELECT w, i, best FROM safe UNION ALL SELECT w, next_i, NULL FROM safe))
SELECT w, i, tok FROM s WHERE tok IS NOT NULL
"""

_LEARN = """
INSERT INTO known SELECT piece, ids, array_to_string(ids, ',') FROM (
  SELECT piece, list(tok ORDER BY i) AS ids FROM ({}) JOIN fresh USING (w) GROUP BY w, piece)
"""
_DECODE = """
SELECT d, unhex(array_to_string(list(hexed ORDER BY pos), '')) AS decoded
FROM ids LEFT JOIN vocab USING (tok) GROUP BY d ORDER BY d
"""


def _loaded(name: str) -> dict:
    """What a worker keeps of a rank file: tables, byte ids, word pattern."""
    if name not in _ENGINES:
        import base64

        import numpy as np
        import public_tokenizers
        import pyarrow as pa
        import regex

        from .tokens import tokenizer_path

        with open(tokenizer_path(name), "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        pairs = [(ranks[t[:k]], ranks[t[k:]], rank) for t, rank in ranks.items()
                 for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks]
        left, right, rank = zip(*pairs) if pairs else ((), (), ())
        _ENGINES[name] = {
            "merges": pa.table({"l": pa.array(left, pa.int32()), "r": pa.array(right, pa.int32()), "m": pa.array(rank, pa.int32())}),
            "vocab": pa.table({"tok": pa.array(ranks.values(), pa.int32()), "piece": pa.array(ranks, pa.binary())}),
            "bytes": np.array([ranks[bytes([b])] for b in range(256)], np.int32),
            "words": regex.compile(public_tokenizers.PATTERN),
            "stand_ins": _stand_ins(public_tokenizers.PATTERN),
        }
    return _ENGINES[name]


def _stand_ins(pattern: str) -> tuple:
    """The characters that the two libraries' Unicode tables class apart, and
    for each a plain character of the class that the rank files' library has
    it in. Only characters that Python's own table does not have are asked.
    Second, the lowest first byte that such a character has in UTF-8.
    """
    import sys
    import unicodedata

    import regex
    import tiktoken

    def classes(chars: list[str]) -> list[str]:
        """A letter, a digit or a mark for each of ``chars``: the first beside
        which the library's pattern does not cut."""
        found = ["!"] * len(chars)
        for plain in "a1":
            joined = {bytes([b]): b for b in range(256)} | {plain.encode() + bytes([b]): 256 + b for b in range(256)}
            probe = tiktoken.Encoding("probe", pat_str=pattern, mergeable_ranks=joined, special_tokens={})
            ids = [probe.encode_ordinary(plain + c) for c in chars]
            found = [plain if i[0] >= 256 else f for i, f in zip(ids, found)]
        return found

    new = "".join(c for c in map(chr, range(sys.maxunicode + 1)) if unicodedata.category(c) == "Cn")
    asked = regex.findall(r"[\p{L}\p{N}]", new)
    own = ["a" if regex.match(r"\p{L}", c) else "1" for c in asked]
    table = {ord(c): theirs for c, ours, theirs in zip(asked, own, classes(asked)) if ours != theirs}
    return table, min(map(chr, table), default="\U0010ffff").encode()[0]


def words_of(text: str, loaded: dict) -> list[str]:
    """The pattern's matches in ``text``, as the rank files' library has them."""
    import numpy as np

    table, lowest = loaded["stand_ins"]
    if not text.isascii() and int(np.frombuffer(text.encode(), np.uint8).max()) >= lowest:  # may have such a character
        return [text[m.start():m.end()] for m in loaded["words"].finditer(text.translate(table))]
    return loaded["words"].findall(text)


def safe_parts(text: str, size: int = CHUNK_CHARS) -> Iterator[str]:
    """``text`` in parts of about ``size`` characters: a cut is made before a
    space with something else than white space on both sides."""
    start = 0
    while len(text) - start > size:
        cut = start + size
        while True:
            cut = text.find(" ", cut)
            if cut < 0 or cut == len(text) - 1:
                cut = len(text)
                break
            if not text[cut - 1].isspace() and not text[cut + 1].isspace():
                break
            cut += 1
        yield text[start:cut]
        start = cut
    if start < len(text) or not text:
        yield text[start:]


class Coder:
    """Encoding and decoding in one task."""

    def __init__(self, name: str = RANKS, *, known_words: int = KNOWN_WORDS, long_bytes: int = LONG_BYTES):
        import duckdb

        self.loaded, self.known_words, self.long_bytes = _loaded(name), known_words, long_bytes
        self.con = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": MEMORY, "temp_directory": ""})
        for table in ("merges", "vocab"):
            self.con.register("given", self.loaded[table])
            self.con.execute(f"CREATE TABLE {table} AS SELECT * FROM given")
        self.con.execute("ALTER TABLE vocab ADD COLUMN hexed VARCHAR")
        self.con.execute("UPDATE vocab SET hexed = hex(piece)")
        self._forget()

    def _forget(self) -> None:
        """Only the vocabulary's own words are known."""
        self.con.execute("CREATE OR REPLACE TABLE known AS SELECT piece, [tok] AS ids, tok::VARCHAR AS listed FROM vocab")
        self.n_known = 0

    def _arrays(self, query: str) -> list:
        """The columns of a query's result as plain Arrow arrays."""
        import pyarrow as pa

        found = self.con.sql(query).to_arrow_table()
        return [pa.concat_arrays(c.chunks) if c.num_chunks else pa.array([], c.type) for c in found.columns]

    def _learn(self) -> None:
        """Encode the words of ``distinct`` that are not known yet."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        (fresh,) = self._arrays("SELECT piece FROM distinct_words ANTI JOIN known USING (piece)")
        if not len(fresh):
            return
        sizes = pc.binary_length(fresh).to_numpy().astype(np.int64)
        order = np.argsort(sizes, kind="stable")
        sizes = sizes[order]
        split = int(np.searchsorted(sizes, self.long_bytes, "right"))
        for query, a, b, cost in ((_SHORT, 0, split, sizes[:split] ** 2 // 2 + 1), (_KEYED, split, len(sizes), sizes[split:] * 8)):
            part = np.cumsum(cost) // ROUND_ROWS
            for rows in np.split(np.arange(a, b), np.flatnonzero(np.diff(part)) + 1):
                if len(rows):
                    self._contract(query, fresh.take(pa.array(order[rows])), sizes[rows])
        self.n_known += len(fresh)

    def _contract(self, query: str, pieces, sizes) -> None:
        import numpy as np
        import pyarrow as pa

        raw = np.frombuffer(b"".join(pieces.to_pylist()), np.uint8)
        w = np.arange(len(sizes), dtype=np.int32)
        at = np.arange(len(raw)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        tok = self.loaded["bytes"][raw]
        next_tok = np.append(tok[1:], -1)
        next_tok[np.cumsum(sizes) - 1] = -1  # none
        self.con.register("start", pa.table({"w": np.repeat(w, sizes), "i": at.astype(np.int32), "tok": tok,
                                             "next_tok": next_tok.astype(np.int32)}))
        self.con.register("fresh", pa.table({"w": w, "piece": pieces}))
        self.con.execute(_LEARN.format(query))

    def encode_words(self, words: list[str]):
        """``(ids, listed, which)``: id lists of the distinct words, the same
        as text, and for each word the distinct one it is."""
        import pyarrow as pa

        coded = pa.array(words, pa.string()).dictionary_encode()
        if self.n_known > self.known_words:
            self._forget()
        self.con.register("distinct_words", pa.table({
            "k": pa.array(range(len(coded.dictionary)), pa.int32()), "piece": coded.dictionary.cast(pa.binary())}))
        self._learn()
        ids, listed = self._arrays("SELECT ids, listed FROM distinct_words JOIN known USING (piece) ORDER BY k")
        return ids, listed, coded.indices

    def decode(self, rows, ids) -> dict[int, bytes]:
        """The bytes of each row's ids, which stand in order in ``ids``. An
        id that no token has fails."""
        import numpy as np
        import pyarrow as pa

        self.con.register("ids", pa.table({"d": rows, "pos": np.arange(len(ids), dtype=np.int32), "tok": ids}))
        unknown = self.con.sql("SELECT count(*) FROM ids ANTI JOIN vocab USING (tok)").fetchall()[0][0]
        if unknown:
            raise ValueError(f"{unknown} ids that no token has")
        return dict(self.con.sql(_DECODE).fetchall())

    def chunks(self, texts: list[str]) -> Iterator[tuple]:
        """``(rows, ids, row_of_id, listed)`` of consecutive parts of the
        texts: the rows in the chunk, all their ids, the row each id belongs
        to, and per row its ids as text. A long text is in several chunks."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        def emit():
            counts = np.array([len(p) for p in pending])
            ids, listed, which = self.encode_words([w for p in pending for w in p])
            each = pc.list_value_length(ids).to_numpy()[which.to_numpy()] if len(which) else np.zeros(0, np.int64)
            flat = ids.take(which).flatten().to_numpy() if len(which) else np.zeros(0, np.int32)
            row_of = np.repeat(np.repeat(np.array(rows, np.int32), counts), each)
            offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
            joined = pc.binary_join(pa.ListArray.from_arrays(offsets, listed.take(which)), ",")
            return rows, flat, row_of, joined

        rows, pending, size = [], [], 0
        for row, text in enumerate(texts):
            for part in safe_parts(text):
                if size and size + len(part) > CHUNK_CHARS:
                    yield emit()
                    rows, pending, size = [], [], 0
                rows.append(row)
                pending.append(words_of(part, self.loaded))
                size += len(part)
        if rows:
            yield emit()


def _rows(docs: DataFrame, id_col: str, value):
    return docs.select(F.col(id_col).alias("id"), value.alias("value"))


def encode(docs: DataFrame, ranks: str = RANKS, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows ``(id, n_tokens bigint, ids array<int>)``, one per row of
    ``docs``: the ids of the whole text, without special tokens.

    Null and empty texts have no ids; a null id stays null; repeated rows are
    encoded each; an empty table gives no rows; other columns are not read.
    """
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        coder = Coder(ranks)
        for batch in batches:
            parts: list[list] = [[] for _ in range(batch.num_rows)]
            for rows, flat, row_of, _ in coder.chunks([t or "" for t in batch.column(1).to_pylist()]):
                for row in rows:
                    parts[row].append(flat[np.searchsorted(row_of, row):np.searchsorted(row_of, row, "right")])
            ids = pa.array([np.concatenate(p) for p in parts], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pc.list_value_length(ids).cast(pa.int64()), ids],
                                             ["id", "n_tokens", "ids"])

    out = map_arrow(_rows(docs, id_col, F.col(text_col).cast("string")), run,
                    f"id {id_type}, n_tokens bigint, ids array<int>")
    return out.withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, ranks: str = RANKS, *, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Rows ``(id, decoded binary)``: the bytes of the ids, in order.

    A null or empty list decodes to no bytes; an id that no token has fails.
    """
    id_type = encoded.schema[id_col].dataType.simpleString()

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        coder = Coder(ranks)
        for batch in batches:
            lists = [np.array(v or [], np.int32) for v in batch.column(1).to_pylist()]
            sizes = [len(v) for v in lists]
            found = coder.decode(np.repeat(np.arange(len(lists), dtype=np.int32), sizes),
                                 np.concatenate(lists)) if sum(sizes) else {}
            decoded = pa.array([found.get(k, b"") for k in range(len(lists))], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), decoded], ["id", "decoded"])

    out = map_arrow(_rows(encoded, id_col, F.col(ids_col).cast("array<int>")), run, f"id {id_type}, decoded binary")
    return out.withColumnRenamed("id", id_col)


def round_trip(docs: DataFrame, ranks: str = RANKS, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows ``(id, n_tokens, ids_sha256, decoded_sha256)``, one per row of
    ``docs``: how many ids its text has, the digest of the ids (decimal,
    joined by commas) and of the bytes that they decode to, chunk by chunk.

    Null and empty texts have no ids and the digests of nothing; a null id
    stays null; repeated rows are coded each; an empty table gives no rows;
    other columns are not read.
    """
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        coder = Coder(ranks)
        for batch in batches:
            n = batch.num_rows
            counts = np.zeros(n, np.int64)
            listed, decoded = [hashlib.sha256() for _ in range(n)], [hashlib.sha256() for _ in range(n)]
            for rows, flat, row_of, texts in coder.chunks([t or "" for t in batch.column(1).to_pylist()]):
                for row, text in zip(rows, texts):
                    if len(text.as_py()):
                        listed[row].update((b"," if counts[row] else b"") + text.as_py().encode())
                for row, raw in coder.decode(row_of, flat).items():
                    decoded[row].update(raw)
                counts += np.bincount(row_of, minlength=n)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts), pa.array([h.hexdigest() for h in listed]),
                 pa.array([h.hexdigest() for h in decoded])], ["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    out = map_arrow(_rows(docs, id_col, F.col(text_col).cast("string")), run,
                    f"id {id_type}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
    return out.withColumnRenamed("id", id_col)
