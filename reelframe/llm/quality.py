"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger keeps the measured
numbers and one bit per failed rule, so a policy (a named, versioned set of
rules) is a mask applied to stored bits, and ablations are sums over the at
most ``2 ** rules`` distinct masks. Only built-in column functions: one scan,
no shuffle up to the ledger.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE_CLASS, once, word_count

WINDOW = 5  # words that a repeated passage has at least
SYMBOLS = "[#*$%&|<>]"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper")

# Rules by bit, as SQL over the measurements (true: failed). New rules go to
# the end, so that stored bits keep their meaning.
RULES: dict[str, str] = {
    "few_words": "n_words < 10",
    "repeated_passages": "100 * n_repeat_words > 20 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "repeated_lines": "10 * n_dup_lines > 3 * n_lines",
    "word_length": "2 * word_chars < 5 * n_words or word_chars > 12 * n_words",
    "capitals": "2 * n_upper > word_chars and n_words > 0",
}
BASE = ("few_words", "repeated_passages")

# Versions of the policy: the rules that each applies.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": BASE,
    "v1": (*BASE, "symbols", "repeated_lines"),
    "v2": tuple(RULES),
}
CURRENT = "v2"


def mask(rules: tuple[str, ...]) -> int:
    names = list(RULES)
    return sum(1 << names.index(r) for r in rules)


def _covered(windows: Column) -> Column:
    """Words covered by the windows (hashes by place) that occur twice."""
    def places(t: Column) -> Column:
        twice = F.filter(t, lambda x, j: (x["h"] == F.get(t, j - 1)["h"]) | (x["h"] == F.get(t, j + 1)["h"]))
        return F.sort_array(F.transform(twice, lambda x: x["i"]))

    def length(p: Column) -> Column:
        # A window covers its words up to where the next such window begins.
        each = F.transform(p, lambda x, j: F.coalesce(F.least(F.lit(WINDOW), F.get(p, j + 1) - x), F.lit(WINDOW)))
        return F.aggregate(each, F.lit(0), lambda a, x: a + x)

    by_hash = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return once(once(by_hash, places), length)


def repeated_words(text: Column) -> Column:
    """Number of words that lie in a window of ``WINDOW`` words which the text
    holds at least twice, its first occurrence included (int)."""
    def windows(h: Column) -> Column:
        first = F.slice(h, 1, F.size(h) - (WINDOW - 1))
        return F.transform(first, lambda v, i: F.xxhash64(v, *(F.get(h, i + k) for k in range(1, WINDOW))))

    def found(w: Column) -> Column:
        return F.when(F.size(F.array_distinct(w)) == F.size(w), 0).otherwise(_covered(w))

    words = F.array_remove(F.split(text, SPACE_CLASS + "+"), "")
    return once(F.transform(words, lambda v: F.xxhash64(v)),
                lambda h: F.when(F.size(h) < WINDOW, 0).otherwise(once(windows(h), found)))


def ledger(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows ``(id, measurements..., fail_bits)``, one per row of ``docs``.

    Measured over the whole text: ``n_words``, ``word_chars`` (code points
    in words), ``n_symbols``, ``n_lines`` and ``n_dup_lines`` (lines with a
    word; those equal to an earlier one), ``n_repeat_words`` and ``n_upper``
    (upper-case letters). Windows are compared by a 64-bit hash of their
    words' 64-bit hashes. Null counts as empty: every measure 0, failing
    ``few_words``. Repeated rows are measured each, an empty table gives no
    rows, and other columns are not read.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    n_lines, n_dup = F.size("_lines"), F.size("_lines") - F.size(F.array_distinct("_lines"))
    rows = docs.select(F.col(id_col), text.alias("_text"), lines.alias("_lines"))
    measured = rows.select(
        F.col(id_col), word_count(F.col("_text")).alias("n_words"),
        F.length(F.regexp_replace("_text", SPACE_CLASS + "+", "")).cast("bigint").alias("word_chars"),
        F.regexp_count("_text", F.lit(SYMBOLS)).cast("bigint").alias("n_symbols"),
        n_dup.cast("bigint").alias("n_dup_lines"), repeated_words(F.col("_text")).cast("bigint").alias("n_repeat_words"),
        n_lines.cast("bigint").alias("n_lines"), F.regexp_count("_text", F.lit(r"\p{Lu}")).cast("bigint").alias("n_upper"))
    bits = F.lit(0)
    for bit, rule in enumerate(RULES.values()):
        bits = bits.bitwiseOR(F.when(F.expr(rule), 1 << bit).otherwise(0))
    return measured.withColumn("fail_bits", bits)


def failed(policy: str = CURRENT, bits: Column | str = "fail_bits") -> Column:
    """True where a row fails a rule of the policy."""
    column = F.col(bits) if isinstance(bits, str) else bits
    return column.bitwiseAND(F.lit(mask(POLICIES[policy]))) != 0


def ablations(book: DataFrame, policy: str = CURRENT) -> DataFrame:
    """Per rule of the policy: documents that fail it (``n_failed``), that
    fail no other rule of the policy (``n_alone``: what leaving the rule out
    would bring back), and all documents kept without it (``n_kept_without``).
    One aggregation over the ledger to at most ``2 ** rules`` masks."""
    spark, full = book.sparkSession, mask(POLICIES[policy])
    masks = book.groupBy(F.col("fail_bits").bitwiseAND(F.lit(full)).alias("bits")).agg(F.count("*").alias("n"))
    rules = F.explode(F.array(*(F.struct(F.lit(r).alias("rule"), F.lit(mask((r,))).alias("bit")) for r in POLICIES[policy])))
    each = masks.select("bits", "n", rules.alias("r")).select("bits", "n", "r.rule", "r.bit")
    count = lambda where: F.sum(F.when(where, F.col("n")).otherwise(0))
    return each.groupBy("rule").agg(
        count(F.col("bits").bitwiseAND(F.col("bit")) != 0).alias("n_failed"),
        count(F.col("bits") == F.col("bit")).alias("n_alone"),
        count(F.col("bits").bitwiseAND(F.lit(full).bitwiseXOR(F.col("bit"))) == 0).alias("n_kept_without"))


def failing_rules(book: DataFrame, by: str) -> DataFrame:
    """Per value of ``by``: the rules that some row fails and the rules that
    every row fails, as masks."""
    return book.groupBy(by).agg(F.bit_or("fail_bits").alias("any_bits"), F.bit_and("fail_bits").alias("all_bits"))


ORACLE = f"""
with d as (select row_number() over () as r, doc_id, coalesce(text, '') as t from documents),
w as (select *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') as ws,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as ls from d),
win as (select r, i, ws[i:i + 4] as five from (select r, ws, unnest(range(1, len(ws) - 3)) as i from w where len(ws) >= 5)),
dup as (select r, i from (select r, i, count(*) over (partition by r, five) as c from win) where c > 1),
rep as (select r, count(distinct p) as n from (select r, unnest(range(i, i + 5)) as p from dup) group by r),
m as (select doc_id, len(ws)::bigint as n_words,
             coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::bigint as word_chars,
             (length(t) - length(regexp_replace(t, '{SYMBOLS}', '', 'g')))::bigint as n_symbols,
             (len(ls) - len(list_distinct(ls)))::bigint as n_dup_lines,
             coalesce(rep.n, 0)::bigint as n_repeat_words, len(ls)::bigint as n_lines,
             len(regexp_extract_all(t, '\\p{{Lu}}'))::bigint as n_upper
      from w left join rep using (r)),
b as (select *, ({" + ".join(f"case when {rule} then {1 << bit} else 0 end" for bit, rule in enumerate(RULES.values()))})::int as fail_bits from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, fail_bits & {mask(BASE)} <> 0 as base_failed,
       fail_bits & {mask(POLICIES[CURRENT])} = 0 as kept, fail_bits from b
"""
