"""Divergence between sources of one language, term by term.

Terms are counted per (lang, source) inside the scan's tasks. Each language
keeps the terms that enough of its documents have; they are dealt into shards
by hash and numbered there, so a group's counts are sorted (term number,
count) arrays of a bounded length. A task takes an unordered pair of groups
and a shard: the two arrays are co-grouped, the shorter one is looked up in
the longer one, and the terms that both, one or none of the groups have are
priced; the pair's value is written for both of its groups.

All arithmetic is on whole numbers. A term's price between shares p and q is
floor((p - q)^2 / (p + q)), with p = 1 + floor(10^9 (count + 2) / (N + 2 V))
for V kept terms and N occurrences of them in the group.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import map_arrow, ship, stored

MIN_DOCS = 10
TERMS_PER_SHARD = 1 << 16
SLICE_BYTES = 8 << 20
SCALE = 1_000_000_000

# A-Z in lower case, other letters and every byte of a character beyond ASCII
# as they are, the rest a space.
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def term_counts(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """Rows ``(lang, source, term, count, docs)``: how often a group has a
    term, and in how many of its documents. Every group also has one row of
    the empty term, with zeros."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc

        from .tokens import byte_slices

        for batch in batches:
            texts, langs, sources = (pc.fill_null(c, "") for c in batch.columns)
            for a, b in byte_slices(pc.binary_length(texts).to_pylist(), SLICE_BYTES):
                yield pa.RecordBatch.from_arrays(
                    _slice_counts(texts.slice(a, b - a), langs.slice(a, b - a), sources.slice(a, b - a)),
                    ["lang", "source", "term", "count", "docs"])

    rows = docs.select(*[F.col(c).cast("string").alias(n) for c, n in ((text_col, "text"), (lang_col, "lang"), (source_col, "source"))])
    part = map_arrow(rows, run, "lang string, source string, term string, count bigint, docs bigint")
    return part.groupBy("lang", "source", "term").agg(F.sum("count").alias("count"), F.sum("docs").alias("docs"))


def _slice_counts(texts, langs, sources) -> list:
    """The columns of ``term_counts`` for some documents (Arrow, no nulls)."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    texts = pa.concat_arrays([texts])  # its own offsets and bytes
    lower = pa.py_buffer(texts.buffers()[2].to_pybytes().translate(_TERM_BYTES) if texts.buffers()[2] else b"")
    lists = pc.ascii_split_whitespace(pa.StringArray.from_buffers(len(texts), texts.buffers()[1], lower, None, 0, texts.offset))
    coded = lists.flatten().dictionary_encode()
    terms, ids = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
    doc = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy())

    lang, source = langs.dictionary_encode(), sources.dictionary_encode()
    n_sources, n_terms = max(len(source.dictionary), 1), max(len(terms), 1)
    group = lang.indices.to_numpy().astype(np.int64) * n_sources + source.indices.to_numpy()

    pairs, count = np.unique(doc * n_terms + ids, return_counts=True)  # of documents and terms
    keys, which = np.unique(group[pairs // n_terms] * n_terms + pairs % n_terms, return_inverse=True)
    counts = np.bincount(which, weights=count, minlength=len(keys)).astype(np.int64)  # exact below 2**53
    docs = np.bincount(which, minlength=len(keys))
    empty = pc.index(terms, pa.scalar("", pa.string())).as_py()
    real = keys % n_terms != empty
    groups = np.unique(group)
    all_groups = np.concatenate([keys[real] // n_terms, groups])
    zeros = np.zeros(len(groups), np.int64)
    names = pa.concat_arrays([terms.take(pa.array(keys[real] % n_terms)), pa.array([""] * len(groups), pa.string())])
    return [lang.dictionary.take(pa.array(all_groups // n_sources)), source.dictionary.take(pa.array(all_groups % n_sources)), names,
            pa.array(np.concatenate([counts[real], zeros])), pa.array(np.concatenate([docs[real], zeros]))]


def _share(count: Column, n: Column, v: Column) -> Column:
    """p of a count, as a whole number."""
    return F.lit(1).cast("bigint") + _div((count + 2).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)"),
                                          (n + 2 * v).cast("decimal(20,0)"))


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def _price(p: Column, q: Column) -> Column:
    return _div((p - q) * (p - q), p + q)


def shares(counts, n: int, v: int):
    """``_share`` of an array of counts. Three steps of long division keep
    every product below 2**63 for up to 9 * 10**15 words."""
    import numpy as np

    rest, out = np.asarray(counts, np.int64) + 2, 0
    for _ in range(3):
        out, rest = out * 1000 + rest * 1000 // (n + 2 * v), rest * 1000 % (n + 2 * v)
    return out + 1


def prices(p, q):
    return (p - q) * (p - q) // (p + q)


def overlap(left, right):
    """Positions of the common numbers of two sorted arrays, in each: the
    shorter one's numbers are searched in the longer one."""
    import numpy as np

    if len(left) > len(right):
        return overlap(right, left)[::-1]
    at = np.searchsorted(right, left)
    hit = np.flatnonzero(np.append(right, -1)[at] == left)
    return hit, at[hit]


def merged_price(left, right, v_shard: int, n1: int, n2: int, v: int) -> int:
    """The price between two groups over the ``v_shard`` kept terms of a
    shard, from their sorted ``(numbers, counts)``."""
    import numpy as np

    (ids1, counts1), (ids2, counts2) = left, right
    a, b = overlap(ids1, ids2)
    p1, p2, none1, none2 = shares(counts1, n1, v), shares(counts2, n2, v), shares([0], n1, v), shares([0], n2, v)
    only1, only2 = np.delete(p1, a), np.delete(p2, b)
    absent = v_shard - len(a) - len(only1) - len(only2)
    return int(prices(p1[a], p2[b]).sum() + prices(only1, none2).sum() + prices(only2, none1).sum()
               + absent * prices(none1, none2).sum())


def divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = 10, *, text_col: str = "text", lang_col: str = "lang",
               source_col: str = "source", terms_per_shard: int = TERMS_PER_SHARD) -> DataFrame:
    """Rows ``(lang, source, part, item, value bigint, rank int)``.

    Part ``pair``: for each group (lang, source) every other source of the
    language, with the price between the two over all kept terms. Part
    ``term``: the ``top`` kept terms that the group has and uses more than
    its language does, with their price against the language. Ranks go from 1
    by value, highest first, then by item in code point order.

    Null texts, langs and sources count as empty; a group without a kept term
    takes part with zeros; the values of a language without kept terms are 0;
    repeated rows count each; an empty table gives no rows; other columns are
    not read.
    """
    spark = docs.sparkSession
    counts = stored(term_counts(docs, text_col=text_col, lang_col=lang_col, source_col=source_col), "divergence-counts")
    kept = stored(counts.filter("term <> ''").groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("count").alias("lang_count"))
                  .filter(F.col("docs") >= min_docs).select("lang", "term", "lang_count"), "divergence-kept")
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("lang_count").alias("lang_n"))
    most = langs.agg(F.max("v")).first()[0] or 0
    n_shards = 1 + most // terms_per_shard
    shard = F.pmod(F.xxhash64("term"), F.lit(n_shards)).cast("int")
    numbered = kept.withColumn("shard", shard).withColumn(
        "number", F.row_number().over(Window.partitionBy("lang", "shard").orderBy("term")))
    entries = stored(counts.join(numbered, ["lang", "term"]), "divergence-entries")

    sizes = entries.groupBy("lang", "source").agg(F.sum("count").alias("n"))
    groups = (counts.filter("term = ''").select("lang", "source").join(sizes, ["lang", "source"], "left")
              .join(langs, "lang", "left").na.fill(0, ["n", "v", "lang_n"]))

    rank = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    own, whole = _share(F.col("count"), F.col("n"), F.col("v")), _share(F.col("lang_count"), F.col("lang_n"), F.col("v"))
    terms = (entries.join(groups, ["lang", "source"]).select("lang", "source", F.col("term").alias("item"), own.alias("p"), whole.alias("q"))
             .filter("p > q").select("lang", "source", "item", _price(F.col("p"), F.col("q")).alias("value"))
             .withColumn("rank", F.row_number().over(rank)).filter(F.col("rank") <= top))

    pairs = stored(_pair_prices(spark, groups, entries, numbered, n_shards), "divergence-pairs")
    both = pairs.select("lang", F.explode(F.array(
        F.struct(F.col("s1").alias("source"), F.col("s2").alias("item")),
        F.struct(F.col("s2").alias("source"), F.col("s1").alias("item")))).alias("side"), "value")
    ranked = both.select("lang", "side.source", "side.item", "value").withColumn("rank", F.row_number().over(rank))

    def part(df: DataFrame, name: str) -> DataFrame:
        return df.select("lang", "source", F.lit(name).alias("part"), "item", F.col("value").cast("bigint").alias("value"), "rank")

    return part(ranked, "pair").unionByName(part(terms, "term"))


def _pair_prices(spark, groups: DataFrame, entries: DataFrame, numbered: DataFrame, n_shards: int) -> DataFrame:
    """``(lang, s1, s2, value)`` of each unordered pair of a language's sources."""
    arrays = entries.groupBy("lang", "source", "shard").agg(
        F.array_sort(F.collect_list(F.struct("number", "count"))).alias("terms"))
    shard_sizes = numbered.groupBy("lang", "shard").agg(F.count(F.lit(1)).alias("v_shard"))
    sides = groups.select("lang", "source", "n", "v")
    tasks = (sides.select("lang", F.col("source").alias("s1"), "n", "v")
             .join(sides.select("lang", F.col("source").alias("s2"), F.col("n").alias("n2")), "lang").filter("s1 < s2")
             .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1))))
             .join(shard_sizes, ["lang", "shard"], "left").na.fill(0, ["v_shard"]))
    key = ["lang", "s1", "s2", "shard"]

    def side(name: str, *more: str) -> DataFrame:
        found = tasks.join(arrays.withColumnRenamed("source", name), ["lang", name, "shard"], "left")
        return found.select(*key, F.coalesce(F.col("terms.number"), F.array().cast("array<int>")).alias("numbers"),
                            F.coalesce(F.col("terms.count"), F.array().cast("array<bigint>")).alias("counts"), *more)

    def price(left, right):
        import pyarrow as pa

        task = left.slice(0, 1).select([*key, "n", "n2", "v", "v_shard"]).to_pylist()[0]
        sorted_counts = ([t.column(c)[0].values.to_numpy() for c in ("numbers", "counts")] for t in (left, right))
        value = merged_price(*sorted_counts, task["v_shard"], task["n"], task["n2"], task["v"]) if task["v"] else 0
        return pa.table({**{c: [task[c]] for c in ("lang", "s1", "s2")}, "value": pa.array([value], pa.int64())})

    ship(spark)
    one, two = side("s1", "n", "n2", "v", "v_shard"), side("s2").toDF(*(f"{c}_2" for c in key), "numbers", "counts")
    prices_of = (one.groupBy(*key).cogroup(two.groupBy(*(f"{c}_2" for c in key)))
                 .applyInArrow(price, "lang string, s1 string, s2 string, value bigint"))
    return prices_of.groupBy("lang", "s1", "s2").agg(F.sum("value").alias("value"))


# The same by a full outer product of groups and kept terms.
ORACLE = r"""
WITH d AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
counted AS (SELECT lang, source, term, count(*) AS count FROM (SELECT lang, source, unnest(terms) AS term FROM d) GROUP BY ALL),
kept AS (
  SELECT lang, term FROM (SELECT lang, unnest(list_distinct(terms)) AS term FROM d) GROUP BY lang, term HAVING count(*) >= 10),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
cell AS (
  SELECT g.lang, g.source, k.term, coalesce(c.count, 0) AS count
  FROM g JOIN kept k USING (lang) LEFT JOIN counted c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
p AS (
  SELECT lang, source, term, count,
         1 + (1000000000::HUGEINT * (count + 2)) // (sum(count) OVER (PARTITION BY lang, source) + 2 * v) AS p
  FROM cell JOIN v USING (lang)),
q AS (
  SELECT lang, term, 1 + (1000000000::HUGEINT * (count + 2)) // (sum(count) OVER (PARTITION BY lang) + 2 * v) AS q
  FROM (SELECT lang, term, sum(count) AS count FROM cell GROUP BY lang, term) JOIN v USING (lang)),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(f.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT x.lang, x.source, y.source AS item, sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)) AS value
             FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL) f
    ON f.lang = a.lang AND f.source = a.source AND f.item = b.source),
terms AS (
  SELECT lang, source, term AS item, (p - q) * (p - q) // (p + q) AS value FROM p JOIN q USING (lang, term) WHERE count > 0 AND p > q),
ranked AS (
  SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM pairs
  UNION ALL
  SELECT lang, source, 'term', item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM terms
  QUALIFY rank <= 10)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked
"""
