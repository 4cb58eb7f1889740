"""Films whose genre text contains a genre name.

The source semantics are ``genres like '%name%'`` for every distinct genre
name: a film counts once per name found anywhere in its text, so a name that
is a substring of another name matches both. Names are decoded from JSON,
where the text may spell them with escapes, so a film matches when its text
or one of its decoded names contains the name. ``contains`` gives the test
without treating ``%``, ``_`` or quotes in a name as syntax.

One lazy plan for any number of names, by a factored index. Films are counted
per distinct text. A text is cut at its quotes into strings: the JSON strings
and the fixed text between them. A name without a quote that is in the text is
in one of these strings, so names are matched once against the *distinct*
strings of all texts (a few, where every text lists entries of one
vocabulary), and an inverted (string, text) table maps the hits back. Only
names with a quote of their own are matched against whole texts, which are not
even listed when there is no such name.

Names meet strings through an equi-join: a string is listed with its distinct
grams (substrings of ``GRAM`` characters, shorter ones only if there are
shorter names), a name is keyed by its first ``GRAM`` characters, and the
exact test runs on these candidates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.json import entry_names, exploded_name

GRAM = 3
QUOTE = '"'


def distinct_names(films: DataFrame, column: str = "genres") -> DataFrame:
    return (films.select(exploded_name(column, films=films).alias("name"))
            .filter(F.col("name").isNotNull() & (F.col("name") != ""))
            .distinct())


def _key(text: Column) -> list[Column]:
    """128 bits that stand for a text where the text itself need not travel."""
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2")]


def _grams(text: Column, gram: int, shortest: Column) -> Column:
    """Distinct substrings of ``gram`` characters, and of fewer (the empty one
    too) as far as the ``shortest`` name asks for them."""
    def of_length(k: int) -> Column:
        def starts(t: Column) -> Column:
            at = F.sequence(F.lit(1), F.greatest(F.length(t) - k + 1, F.lit(1)))
            return F.array_distinct(F.transform(at, lambda p: F.substring(t, p, F.lit(k))))

        return F.element_at(F.transform(F.array(text), starts), 1)  # ``text`` is computed once

    none = F.array().cast("array<string>")
    short = [F.when(shortest <= k, of_length(k) if k else F.array(F.lit(""))).otherwise(none) for k in range(gram)]
    return F.concat(of_length(gram), *short)


def _containing(strings: DataFrame, names: DataFrame, gram: int) -> DataFrame:
    """``(k1, k2, name)``: the keys of the ``strings`` (distinct, columns
    ``k1``, ``k2`` and the array ``parts``) one of whose parts contains the
    name; a string of one part meets a name at most once."""
    shortest = names.agg(F.min(F.length("name")).alias("n")).scalar()
    parts = strings.select("k1", "k2", F.explode("parts").alias("part"))
    grams = parts.select("k1", "k2", F.explode(F.array_distinct(_grams(F.col("part"), gram, shortest))).alias("gram"))
    keyed = names.select("name", F.substring("name", 1, gram).alias("gram"))
    candidates = grams.join(keyed, "gram").select("k1", "k2", "name")
    return (candidates.join(strings, ["k1", "k2"])
            .filter(F.exists("parts", lambda s: s.contains(F.col("name")))).select("k1", "k2", "name"))


def containment_counts(films: DataFrame, names: DataFrame, text: str, *carry: str, gram: int = GRAM) -> DataFrame:
    """``(name, *carry, count)``: films by the names (distinct, column
    ``name``) that their JSON ``text`` or one of its decoded names contains.

    Null texts match nothing; text that does not parse is searched as it is;
    an empty name is contained in every text.
    """
    counted = films.filter(F.col(text).isNotNull()).groupBy(F.col(text).alias("_text"), *carry).agg(
        F.count(F.lit(1)).alias("_n"))
    quoted, plain = names.filter(F.col("name").contains(QUOTE)), names.filter(~F.col("name").contains(QUOTE))
    # Names that the text spells with escapes are strings of it as well.
    escaped = F.coalesce(F.filter(entry_names("_text"), lambda n: ~F.col("_text").contains(n)), F.array().cast("array<string>"))
    unit = [*carry, "_n"]  # a text's films of one carried value

    def inverted(strings: Column) -> DataFrame:
        listed = counted.select(*[k.alias(f"t{i}") for i, k in enumerate(_key(F.col("_text")))], *unit,
                                F.explode(F.array_distinct(strings)).alias("s"))
        return listed.select("t0", "t1", *unit, *_key(F.col("s")), "s")

    strings = F.concat(F.split("_text", QUOTE, -1), escaped)
    distinct = inverted(strings).select("k1", "k2", F.array("s").alias("parts")).distinct()
    index = inverted(strings).select("t0", "t1", *unit, "k1", "k2")
    in_strings = index.join(_containing(distinct, plain, gram), ["k1", "k2"])

    any_quoted = quoted.agg(F.count(F.lit(1)).alias("n")).scalar() > 0
    whole = counted.filter(any_quoted).select(*_key(F.col("_text")), F.concat(F.array("_text"), escaped).alias("parts"), *unit)
    in_whole = (whole.select(F.col("k1").alias("t0"), F.col("k2").alias("t1"), *unit, "k1", "k2")
                .join(_containing(whole.select("k1", "k2", "parts").distinct(), quoted, gram), ["k1", "k2"]))

    hits = in_strings.unionByName(in_whole).select("t0", "t1", *unit, "name").distinct()
    return hits.groupBy("name", *carry).agg(F.sum("_n").alias("count"))


def counts_contains(films: DataFrame, column: str, key: str) -> DataFrame:
    """Films per distinct entry name of ``column``, by containment."""
    return containment_counts(films, distinct_names(films, column), column).withColumnRenamed("name", key)


def genre_counts_contains(films: DataFrame) -> DataFrame:
    """A2: films per genre name by containment. Output ``genre, count``."""
    return counts_contains(films, "genres", "genre")


def genre_year_counts(films: DataFrame) -> DataFrame:
    """Films per genre name (containment) and release-year text.

    ``release_year`` is the first four characters of the release-date text;
    missing dates form the null group. Ordered by genre, then year.
    """
    dated = films.withColumn("release_year", F.substring("release_date", 1, 4))
    hits = containment_counts(dated, distinct_names(films), "genres", "release_year")
    return hits.withColumnRenamed("name", "genre").orderBy("genre", "release_year")
