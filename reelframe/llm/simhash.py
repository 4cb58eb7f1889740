"""SimHash near-duplicates by multi-index hashing.

A 64-bit fingerprint is cut into two segments of 32 bits. If two
fingerprints differ in at most two bits, either their first segments differ
in at most one bit or their second segments are equal. So each fingerprint
probes the table of first segments with the ball of radius one around its
own, and the table of second segments with its own value; what it fetches
is verified over all 64 bits.

A pair whose segments differ in one bit is found by the side that has the
bit set, an equal segment by the smaller fingerprint, so no pair is fetched
twice from one table. A table entry may hold very many fingerprints (a
group of near copies shares a segment); beyond ``max_entry`` its
fingerprints, and those that probe it, meet in a finer table instead: each
enumerates the ball of radius one over both segments. Two fingerprints at
distance two have a value in common there, and an entry of that table holds
at most 65 fingerprints, so no group is ever expanded into all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import keyed, map_arrow, same_key, stored, text_digest
from .components import connected_components

MAX_ENTRY = 64
_HASHES_AT_ONCE = 1 << 16


def simhash(text: str | None, shingle: int, seed: int = 42) -> int:
    """Unsigned fingerprint of a whole text: A-Z in lower case, words split
    at ASCII white space, a bit set where over half of the shingles' XXH64
    have it. Fewer words than ``shingle`` are one shingle, none give 0."""
    from itertools import repeat

    import numpy as np
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, _HASHES_AT_ONCE):
        part = words[at:at + _HASHES_AT_ONCE + shingle - 1]
        runs = zip(*(part[i:] for i in range(shingle))) if len(words) >= shingle else [tuple(words)]
        h = np.fromiter(map(xxh64_intdigest, map(b" ".join, runs), repeat(seed)), np.uint64)
        bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, digest, fp)`` of every row; ``fp`` is the fingerprint's 64 bits
    as bigint, ``digest`` tells texts of one id apart."""
    import pyarrow as pa

    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for batch in batches:
            found = np.fromiter((simhash(t.as_py(), shingle) for t in batch.column(2)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found.view(np.int64))],
                                             ["id", "digest", "fp"])

    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).alias("id"), text_digest(text).alias("digest"), text.alias("text"))
    return map_arrow(rows, run, f"id {id_type}, digest bigint, fp bigint")


def _segments(fp: str = "fp") -> list[Column]:
    return [F.shiftrightunsigned(fp, 32), F.col(fp).bitwiseAND(F.lit(0xFFFFFFFF))]


def hamming_links(nodes: DataFrame, max_bits: int = 2, max_entry: int = MAX_ENTRY) -> DataFrame:
    """Links ``(a, b)`` between the distinct fingerprints ``nodes.fp`` that
    connect every pair at most ``max_bits`` (0 to 2) apart: the pairs
    themselves, or where they meet in a full entry, paths of such pairs."""
    if not 0 <= max_bits <= 2:
        raise ValueError("max_bits must be 0, 1 or 2")
    radius = [max_bits // 2, 0]  # radii add up to max_bits - segments + 1 or more
    table, probes = [], []
    for s, value in enumerate(_segments()):
        table.append(nodes.select("fp", F.lit(s).alias("segment"), value.alias("key")))
        own = nodes.select("fp", F.lit(s).alias("segment"), value.alias("key"), F.lit(False).alias("flipped"))
        probes.append(own)
        if radius[s]:
            ball = nodes.select("fp", value.alias("value"), F.explode(F.sequence(F.lit(0), F.lit(31))).alias("bit"))
            one = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("bit"))
            probes.append(ball.filter(F.col("value").bitwiseAND(one) != 0).select(
                "fp", F.lit(s).alias("segment"), F.col("value").bitwiseXOR(one).alias("key"), F.lit(True).alias("flipped")))
    entries, asked = reduce(DataFrame.unionByName, table), reduce(DataFrame.unionByName, probes)

    full = stored(entries.groupBy("segment", "key").count().filter(F.col("count") > max_entry).drop("count"), "entries")
    here = ["segment", "key"]
    a, b = asked.join(full, here, "left_anti"), entries.join(full, here, "left_anti").withColumnRenamed("fp", "other")
    apart = F.bit_count(F.col("fp").bitwiseXOR(F.col("other")))
    pairs = (a.join(b, here).filter((F.col("flipped") | (F.col("fp") < F.col("other"))) & apart.between(1, max_bits))
             .select(F.col("fp").alias("a"), F.col("other").alias("b")))
    if full.isEmpty():
        return pairs

    dense = asked.join(full, here, "left_semi").select("fp").distinct()
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("bit"))
    ball = dense.select("fp", F.explode(F.sequence(F.lit(-1), F.lit(63))).alias("bit")).select(
        "fp", F.when(F.col("bit") < 0, F.col("fp")).otherwise(F.col("fp").bitwiseXOR(bit)).alias("key"))
    # At most 65 distinct fingerprints lie within one bit of a value.
    met = ball.groupBy("key").agg(F.collect_list("fp").alias("fps")).filter(F.size("fps") > 1)
    star = met.select(F.explode("fps").alias("a"), F.array_min("fps").alias("least"),
                      F.when(F.array_contains("fps", F.col("key")), F.col("key")).alias("centre"))
    apart = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    return pairs.unionByName(star.select("a", F.explode(F.array("least", "centre")).alias("b"))
                             .filter(apart.between(1, max_bits)))


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 2, *, id_col: str = "doc_id",
                    text_col: str = "text", max_entry: int = MAX_ENTRY) -> DataFrame:
    """``(id, digest, fp, component_id, root)``, one row per row of ``docs``:
    component_id is the smallest id among the rows whose fingerprints are
    linked with this one's, over any number of links; root is the component
    itself, its least fingerprint (components that share an id, or have none
    but null, have equal component_ids).

    Null and empty texts have fingerprint 0 and are linked like any other;
    null ids are never a component's id unless it has no other; repeated
    rows are returned each; an empty table gives no rows; other columns are
    not read. Copies share one fingerprint, and only distinct fingerprints
    are looked up and linked.
    """
    prints = stored(fingerprints(docs, shingle, id_col=id_col, text_col=text_col), "fingerprints")
    nodes = stored(prints.groupBy("fp").agg(F.min("id").alias("least")), "nodes")
    roots = connected_components(hamming_links(nodes, max_bits, max_entry)).withColumnRenamed("node", "fp")
    labelled = nodes.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    labelled = stored(labelled, "labels")
    named = stored(labelled.groupBy("root").agg(F.min("least").alias("component_id")), "components")
    label = stored(labelled.join(named, "root").select("fp", "component_id", "root"), "labels")
    return prints.join(label, "fp").select(F.col("id").alias(id_col), "digest", "fp", "component_id", "root")


def hex_fingerprint(fp: Column | str = "fp") -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def one_per_component(docs: DataFrame, shingle: int = 3, max_bits: int = 2, *, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component of near-duplicates, also where
    components share an id or have none: the one of the smallest id (null
    before any), then text digest. Of rows equal in both, one stays."""
    return _one_per("root", docs, shingle, max_bits, id_col, text_col)


def one_per_group(docs: DataFrame, shingle: int = 3, max_bits: int = 2, *, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """As ``one_per_component``, but one row per component_id: for tables
    whose ids are unique and not null, where both are the same."""
    return _one_per("component_id", docs, shingle, max_bits, id_col, text_col)


def _one_per(group: str, docs: DataFrame, shingle: int, max_bits: int, id_col: str, text_col: str) -> DataFrame:
    found = near_duplicates(docs, shingle, max_bits, id_col=id_col, text_col=text_col)
    found = found.select(F.col(id_col).alias("id"), "digest", F.col(group).alias("group"))
    best = found.groupBy("group").agg(F.min(F.struct("id", "digest")).alias("best"))
    rows_of = found.groupBy("id", "digest").agg(F.count("*").alias("rows"))
    best = best.select("best.*").alias("b").join(rows_of.alias("n"), same_key("b", "n")).select("b.*", "rows")
    kept = keyed(docs, id_col, text_col).alias("r").join(stored(best, "kept").alias("k"), same_key("r", "k")).select("r.*", "rows")
    # Both branches read the same shuffled texts; only repeated rows move again.
    one = kept.filter("rows = 1").unionByName(kept.filter("rows > 1").dropDuplicates(["id", "digest"]))
    return one.select("doc.*")
