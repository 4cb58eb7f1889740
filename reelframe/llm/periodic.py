"""Runs of repeated word sequences, caught online by dyadic blocks.

A run is a stretch of words with smallest period ``q`` that is at least
``max(min_words, 2 q)`` words long and that no neighbouring word extends. The
words of a task's documents are appended to a stream. At each level ``k`` the
stream's completed blocks of ``2**k`` words are catchers: the block that
begins at ``b`` waits for squares of a period between ``2 * 2**k`` and ``4 *
2**k - 1``, whose first half holds such a block. Appending a word completes
one window of ``2**k`` words per level, the stream's suffix, and only two
catchers of the level can wait for it; where the suffix equals a catcher's
block, a square of that period may go through the block. Neighbouring blocks
caught with the same period are one stretch; it grows by less than a block to
either side, is kept if it is long enough, and stretches over the same words
merge into the run of the smallest period.

Windows are compared by rolling hashes, so a chunk of any length is appended
by a few vector operations per level. Every run is then compared word by
word; should a hash have misled, the stream is read again with other hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD, map_arrow

MIN_WORDS = 12
SLICE_BYTES = 4 << 20  # text whose words are in memory at once (one document at least)
ATTEMPTS = 8  # hash functions tried on one sequence
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


class Misled(Exception):
    """Two different windows had one hash."""


class Catchers:
    """A stream of word numbers and what its catchers have caught."""

    def __init__(self, seed: int = 0, mask: int = 2**64 - 1):
        import numpy as np

        self.n, self.mask = 0, np.uint64(mask)
        self.base = np.uint64(0x9E3779B97F4A7C15 + 2 * seed * 0x5851F42D4C957F2D & 2**64 - 1 | 1)
        self.ids = np.zeros(0, np.int64)
        self.sums = np.zeros(1, np.uint64)     # of value * base**position, up to each position
        self.grow = np.ones(1, np.uint64)      # base**position
        self.shrink = np.ones(1, np.uint64)    # base**-position
        self.caught: dict[int, list] = {}      # level -> (period, block) arrays

    def _grow(self, size: int) -> None:
        import numpy as np

        if size > len(self.ids):
            size = max(size, 2 * len(self.ids))
            self.ids = np.concatenate([self.ids, np.zeros(size - len(self.ids), np.int64)])
            self.sums = np.concatenate([self.sums, np.zeros(size + 1 - len(self.sums), np.uint64)])
            self.grow = _powers(self.base, size + 1)
            self.shrink = _powers(np.uint64(pow(int(self.base), -1, 2**64)), size + 1)

    def windows(self, starts, width: int):
        """Hashes of the windows of ``width`` words at ``starts`` (a slice or
        an array of positions)."""
        if isinstance(starts, slice):
            ends = slice(starts.start + width, starts.stop + width)
        else:
            ends = starts + width
        return ((self.sums[ends] - self.sums[starts]) * self.shrink[starts]) & self.mask

    def append(self, ids) -> None:
        """Append words (numbers, equal for equal words only)."""
        import numpy as np

        old, n = self.n, self.n + len(ids)
        self._grow(n)
        self.ids[old:n] = ids
        grown = _mixed(self.ids[old:n].astype(np.uint64), self.base) * self.grow[old:n]
        self.sums[old + 1:n + 1] = self.sums[old] + np.cumsum(grown, dtype=np.uint64)
        self.n = n
        level = 0
        while level == 0 or 3 << level <= n:
            self._advance(level, old)
            level += 1

    def _advance(self, level: int, old: int) -> None:
        """Compare the level's newly completed windows with their catchers."""
        import numpy as np

        width = 1 << level
        for ahead in (1, 2, 3) if level == 0 else (2, 3):
            first, stop = max(old - width + 1, ahead << level), self.n - width + 1
            if first >= stop:
                continue
            block = (first >> level) - ahead
            catchers = self.windows(slice(block << level, (((stop - 1) >> level) - ahead << level) + 1), width)[::width]
            if width > 1:  # each catcher waits for a whole block of windows
                catchers = np.repeat(catchers, width)[first - (first >> level << level):][:stop - first]
            at = np.flatnonzero(self.windows(slice(first, stop), width) == catchers) + first
            if len(at):
                blocks = (at >> level) - ahead
                self.caught.setdefault(level, []).append((at - (blocks << level), blocks))

    def _same(self, left, periods, width: int):
        return self.windows(left, width) == self.windows(left + periods, width)

    def stretches(self, min_words: int = MIN_WORDS):
        """``(start, end, period)`` arrays of all stretches with a caught
        period that are long enough and that no word extends."""
        import numpy as np

        found = []
        for level, hits in self.caught.items():
            width, blocks = 1 << level, (self.n >> level) + 2
            key = np.sort(np.concatenate([p * blocks + b for p, b in hits]))
            first = np.flatnonzero(np.diff(key, prepend=-2) != 1)  # neighbouring blocks, one period
            count = np.diff(np.append(first, len(key)))
            period, block = key[first] // blocks, key[first] % blocks
            need = np.maximum(min_words - period, period)  # words equal to the one a period on
            enough = count * width + 2 * (width - 1) >= need
            period, need, start = period[enough], need[enough], block[enough] * width
            stop = start + count[enough] * width
            for step in (1 << k for k in reversed(range(level))):
                fits = np.flatnonzero(start >= step)
                start[fits[self._same(start[fits] - step, period[fits], step)]] -= step
                fits = np.flatnonzero(stop + period + step <= self.n)
                stop[fits[self._same(stop[fits], period[fits], step)]] += step
            enough = stop - start >= need
            found.append((start[enough], (stop + period)[enough], period[enough]))
        return tuple(np.concatenate(c) for c in zip(*found)) if found else (np.zeros(0, np.int64),) * 3

    def runs(self, min_words: int = MIN_WORDS):
        """``(start, length, period)`` arrays of all runs, by start and period;
        raises ``Misled`` where the words do not bear a hash out."""
        import numpy as np

        start, end, period = self.stretches(min_words)
        order = np.lexsort((period, end, start))
        start, end, period = start[order], end[order], period[order]
        head = np.ones(len(start), bool)
        head[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
        smallest = period[head][np.cumsum(head) - 1] if len(start) else period
        if np.any(period % smallest):
            raise Misled  # two periods of one stretch have a common divisor that is one too
        start, end, period = start[head], end[head], period[head]
        ids, n = self.ids, self.n
        for a, b, q in zip(start.tolist(), end.tolist(), period.tolist()):
            if (not np.array_equal(ids[a:b - q], ids[a + q:b]) or a and ids[a - 1] == ids[a + q - 1]
                    or b < n and ids[b] == ids[b - q]):
                raise Misled
        order = np.lexsort((period, start))
        return start[order], (end - start)[order], period[order]


def _powers(base, count: int):
    """``base**0 ... base**(count - 1)``, modulo 2**64."""
    import numpy as np

    out = np.ones(max(count, 1), np.uint64)
    have, factor = 1, int(base)
    while have < count:
        more = min(have, count - have)
        out[have:have + more] = out[:more] * np.uint64(factor)
        have, factor = have + more, factor * factor % 2**64
    return out


def _mixed(values, seed):
    """A 64-bit hash of each number."""
    import numpy as np

    x = (values + seed) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def runs_of(ids, min_words: int = MIN_WORDS, *, chunk: int | None = None, mask: int = 2**64 - 1):
    """``(start, length, period)`` arrays of the runs of a sequence of word
    numbers, appended in chunks of ``chunk`` words (all at once: none).
    ``mask`` weakens the first attempt's hashes, for tests."""
    for attempt in range(ATTEMPTS):
        stream = Catchers(attempt, 2**64 - 1 if attempt else mask)
        for k in range(0, len(ids), chunk or max(len(ids), 1)):
            stream.append(ids[k:k + (chunk or len(ids))])
        try:
            return stream.runs(min_words)
        except Misled:
            continue
    raise Misled(f"{ATTEMPTS} hash functions misled on one sequence")


def _word_lists(texts):
    """``(words, ids, ends)``: the distinct words of Arrow texts without
    nulls, the number of each word in order, and where each text ends."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    lists = pc.ascii_split_whitespace(texts)  # space, \t, \n, \v, \f, \r; empty strings at a text's ends
    coded = lists.flatten().dictionary_encode()
    ids = coded.indices.to_numpy()
    empty = pc.index(coded.dictionary, pa.scalar("", coded.dictionary.type)).as_py()
    real = ids != empty
    ends = np.concatenate([[0], np.cumsum(real)])[lists.offsets.to_numpy()[1:] - lists.offsets[0].as_py()]
    return coded.dictionary, ids[real].astype(np.int64), ends


def _by_length(sizes) -> Iterator:
    """Groups of texts of about one length, the shortest first: a stream has
    as many levels as its longest text needs."""
    import numpy as np

    order = np.argsort(sizes, kind="stable")
    classes = np.frexp(sizes[order])[1]
    return (order[g] for g in np.split(np.arange(len(order)), np.flatnonzero(np.diff(classes)) + 1) if len(g))


def _document_runs(ids, ends, min_words: int):
    """``(document, start, length, period)`` arrays of all documents' runs, by
    document, start and period. A number that no other place has stands
    between two documents, so no run goes over it."""
    import numpy as np

    begins = np.concatenate([[0], ends[:-1]])
    sizes = ends - begins
    found = []
    for group in _by_length(sizes):
        if sizes[group[-1]] < min_words:
            continue
        parts = [np.append(ids[begins[d]:ends[d]], -1 - d) for d in group.tolist()]
        start, length, period = runs_of(np.concatenate(parts), min_words)
        offsets = np.concatenate([[0], np.cumsum(sizes[group] + 1)])
        which = np.searchsorted(offsets, start, "right") - 1
        found.append((group[which], start - offsets[which], length, period))
    if not found:
        return (np.zeros(0, np.int64),) * 4
    columns = [np.concatenate(c) for c in zip(*found)]
    order = np.lexsort((columns[3], columns[1], columns[0]))
    return tuple(c[order] for c in columns)


def periodic_runs(docs: DataFrame, min_words: int = MIN_WORDS, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows ``(id, runs, collapsed)``, one per row of ``docs``: all runs of
    the whole text's words as structs ``(start, length, period)`` in words, by
    start and period, and the text without the repeats: a word that a run
    holds after its first period goes, the others are joined by one space.

    Null and empty texts have no runs and an empty ``collapsed``; a null id
    stays null; repeated rows are read each; an empty table gives no rows;
    other columns are not read. No shuffle; a task has ``SLICE_BYTES`` of text
    in memory, or one document if that is longer.
    """
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc

        from .tokens import byte_slices

        for batch in batches:
            texts = pc.fill_null(batch.column(1), "")
            for a, b in byte_slices(pc.binary_length(texts).to_pylist(), SLICE_BYTES):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *_answers(texts.slice(a, b - a), min_words)],
                                                 ["id", "runs", "collapsed"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    out = map_arrow(rows, run, f"id {id_type}, runs {RUNS}, collapsed string")
    return out.withColumnRenamed("id", id_col)


def _answers(texts, min_words: int) -> tuple:
    """The runs and the collapsed text of each of some Arrow texts."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    words, ids, ends = _word_lists(texts)
    doc, start, length, period = _document_runs(ids, ends, min_words)
    begins = np.concatenate([[0], ends[:-1]])
    edges = np.zeros(len(ids) + 1, np.int64)
    np.add.at(edges, begins[doc] + start + period, 1)
    np.add.at(edges, begins[doc] + start + length, -1)
    kept = np.cumsum(edges[:-1]) == 0
    offsets = np.concatenate([[0], np.cumsum(kept)])[np.concatenate([[0], ends])]
    lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), words.take(pa.array(ids[kept])))
    structs = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in (start, length, period)], ["start", "length", "period"])
    of_doc = np.searchsorted(doc, np.arange(len(ends) + 1))
    return pa.ListArray.from_arrays(pa.array(of_doc, pa.int32()), structs), pc.binary_join(lists, " ")


def tails_repeated(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, text)`` with planted runs: with h the crc32 of the id as text, g
    a tenth of it and n the number of words, a text with h divisible by 10
    repeats, from word a = g % n on, its next 1 + (n - a) / (3 + g % 8) words
    up to its length. Other texts, and those without words or an id, stay."""
    text = F.col(text_col).cast("string")
    words = F.regexp_extract_all(text, F.lit(f"({WORD})"))
    h = F.crc32(F.col(id_col).cast("string"))
    chosen = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.floor(h / 10).alias("g"),
                         F.when((h % 10 == 0) & text.rlike(WORD), words).alias("words"))
    n, g = F.size("words"), F.col("g")
    a = (g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    times = F.ceil((n - a) / p).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(F.slice("words", a + 1, p), times)), F.lit(1), n - a)
    made = F.concat_ws(" ", F.slice("words", F.lit(1), a), tail)
    return chosen.select(F.col("id").alias(id_col), F.when(F.col("words").isNotNull(), made).otherwise(F.col("text")).alias(text_col))


def digests(found: DataFrame, *, id_col: str = "doc_id") -> DataFrame:
    """Per document the number of runs, the longest one (then the first, then
    that of the smallest period) and digests of the runs and of the collapsed
    text."""
    ranks = F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.when(F.size("runs") > 0, F.concat(F.concat_ws("\n", lines), F.lit("\n"))).otherwise("")
    best = found.withColumn("best", F.array_max(ranks))
    start, length, period = -F.col("best.start"), F.col("best.length"), -F.col("best.period")
    return best.select(
        id_col, F.size("runs").cast("bigint").alias("n_runs"), start.alias("start"), length.alias("length"), period.alias("period"),
        F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"))
