"""Line dedup with a log-template tree.

A line goes down a tree of fixed depth: by its number of tokens, then by its
leading tokens (a line with fewer has a shorter path, all of its tokens).
Tokens with a digit are variable fields from the start. In a leaf, a token
that recurs at its place in enough documents is a constant of the leaf's
lines; any other is generalised to a variable field, as long as enough
constants remain. Constants and documents are counted over all lines of the
leaf, so a rare line of a template whose other lines are common is one of
many. Templates found in at least ``min_docs`` documents are recurring: their
lines are dropped, all but the first occurrence. A line with fields and fewer
than ``MIN_CONSTANTS`` other tokens (a table row) says too little without its
fields: it recurs only with the same tokens, unmasked.

Statistics per leaf, place and token replace the usual one-by-one matching
against the templates found so far, so the result depends on no order and a
leaf may be of any size: all of it is pre-aggregated sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import keyed, once, same_key, stored, text_digest

DEPTH = 3             # leading tokens that choose the leaf
MIN_DOCS = 5
MIN_CONSTANTS = 4     # words that a template with fields keeps at least,
CONSTANT_SHARE = 0.75  # and the share of constants in a generalised one's tokens
BROADCAST_LEAVES = 500_000  # leaf keys (8 bytes each) that may be broadcast

FIELD = "<*>"


def _tidy(line: Column) -> Column:
    """One space between tokens."""
    untidy = line.startswith(" ") | line.endswith(" ")
    for blank in ("  ", "\t", "\r", "\x0b", "\x0c"):
        untidy = untidy | line.contains(blank)
    return F.when(untidy, F.trim(F.regexp_replace(line, r"[\x20\x09-\x0D]+", " "))).otherwise(line)


def _masked(tidy: Column) -> Column:
    """Tokens with a digit replaced; not in lines that keep too few others."""
    def enough(m: Column) -> Column:
        return F.when(F.size(F.array_remove(F.split(m, " "), FIELD)) >= MIN_CONSTANTS, m).otherwise(tidy)

    masked = F.regexp_replace(tidy, r"(?<![^ ])[^ 0-9]*+[0-9][^ ]*+", FIELD)
    return F.when(tidy.rlike("[0-9]"), once(masked, enough)).otherwise(tidy)


def template_lines(docs: DataFrame, depth: int = DEPTH, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, digest, pos, masked, tokens, leaf, shape)`` of every line that
    is not blank: ``leaf`` is the 64-bit key of its leaf, ``shape`` that of
    its masked tokens. A line left unmasked for its few words is a leaf of its
    own, and so is one of up to ``depth`` tokens: they are never generalised."""
    text = F.col(text_col).cast("string")

    def parsed(line: Column) -> Column:
        def placed(m: Column, n: Column) -> Column:
            way = F.when(m.rlike("[0-9]"), m).otherwise(F.substring_index(m, " ", depth))
            return F.struct(m.alias("masked"), n.alias("tokens"), F.xxhash64(n, way).alias("leaf"), F.xxhash64(m).alias("shape"))

        spaces = lambda m: F.length(m) - F.length(F.replace(m, F.lit(" "), F.lit("")))
        return once(_tidy(line), lambda t: once(_masked(t), lambda m: once(spaces(m) + 1, lambda n: placed(m, n))))

    rows = docs.select(F.col(id_col).alias("id"), text_digest(text).alias("digest"),
                       F.posexplode(F.transform(F.split(text, "\n"), parsed)).alias("pos", "line"))
    return rows.filter(F.col("line.masked") != "").select("id", "digest", "pos", "line.*")


def _shared(lines: DataFrame, key: list[str]) -> DataFrame:
    """Per key: the number of documents that have it, and its first line."""
    per_doc = lines.groupBy(*key, "id", "digest").agg(F.min("pos").alias("pos"))
    return per_doc.groupBy(*key).agg(F.count("*").alias("n_docs"), F.min(F.struct("id", "digest", "pos")).alias("first"))


def _generalised(docs: DataFrame, shapes: DataFrame, min_docs: int, depth: int, id_col: str, text_col: str) -> DataFrame:
    """``(leaf, shape, template, rare)``: the templates of the rare shapes that
    have enough constants in their leaf, and the common shapes of the leaf
    that a template fits."""
    rare = F.col("n_docs") < min_docs
    leaves = shapes.groupBy("leaf").agg(F.sum("n_docs").alias("n"), F.count("*").alias("k"), F.count_if(rare).alias("r")).filter(
        (F.col("n") >= min_docs) & (F.col("k") > 1) & (F.col("r") > 0)).select("leaf")
    leaves = stored(leaves, "leaves")
    wanted = stored(shapes.join(leaves, "leaf", "left_semi").select("leaf", "shape", "n_docs"), "shapes")
    small = leaves.count() <= BROADCAST_LEAVES
    lines = template_lines(docs, depth, id_col=id_col, text_col=text_col).select("leaf", "shape", "masked")
    # Only lines of these leaves go on; the filter is a broadcast while small.
    lines = lines.join(F.broadcast(leaves) if small else leaves, "leaf", "left_semi").distinct()
    tokens = lines.join(wanted, ["leaf", "shape"]).select(
        "leaf", "shape", "n_docs", F.posexplode(F.split("masked", " ")).alias("at", "token"))
    tokens = stored(tokens.select("leaf", "shape", "n_docs", "at", F.xxhash64("token").alias("token")), "tokens")
    frequent = tokens.groupBy("leaf", "at", "token").agg(F.sum("n_docs").alias("n")).filter(F.col("n") >= min_docs)
    marked = tokens.join(stored(frequent.select("leaf", "at", "token", F.lit(True).alias("constant")), "constants"),
                         ["leaf", "at", "token"], "left")
    constant = F.coalesce("constant", F.lit(False))
    # One line's tokens at a time; a variable field is a place without token.
    whole = marked.groupBy("leaf", "shape").agg(
        F.min("n_docs").alias("n_docs"), F.count("*").alias("n"), F.sum(constant.cast("int")).alias("fixed"),
        F.count_if(constant & (F.col("token") != F.xxhash64(F.lit(FIELD)))).alias("words"),
        F.sort_array(F.collect_list(F.struct("at", "token"))).alias("all"),
        F.sort_array(F.collect_list(F.when(constant, F.col("at")))).alias("places"))
    fitted = lambda places: F.xxhash64("leaf", F.filter("all", lambda t: F.array_contains(places, t["at"])))
    enough = (F.col("words") >= MIN_CONSTANTS) & (F.col("fixed") >= CONSTANT_SHARE * F.col("n"))
    whole = stored(whole.withColumn("template", F.when(rare & enough, fitted(F.col("places")))), "whole")
    general = whole.filter("template is not null").select("leaf", "shape", "template", F.lit(True).alias("rare"))
    # A template's places without their fields: few per leaf.
    forms = whole.filter("template is not null").select("leaf", "places").distinct()
    common = (whole.filter(~rare).select("leaf", "shape", "all").join(forms, "leaf")
              .select("leaf", "shape", fitted(F.col("places")).alias("template"))
              .join(general.select("leaf", "template").distinct(), ["leaf", "template"], "left_semi"))
    return general.unionByName(common.distinct().select("leaf", "shape", "template", F.lit(False).alias("rare")))


def _found(lines: DataFrame, shapes: DataFrame, wider: DataFrame) -> DataFrame:
    """``(leaf, template, n_docs, first)`` of generalised templates: the
    documents that hold any of a template's shapes, and its first line.

    A common shape has very many lines and fits very many templates, so its
    lines never meet its templates: documents are folded by the set of common
    shapes that they hold in a leaf, templates by the set that fits them, and
    the sets are compared. A rare shape has one template, and its lines are few."""
    members = wider.groupBy("leaf", "shape").agg(F.max(F.when(F.col("rare"), F.col("template"))).alias("template"))
    rows = lines.join(members, ["leaf", "shape"]).groupBy("leaf", "shape", "template", "id", "digest").agg(F.min("pos").alias("pos"))
    rows = stored(rows.select("*", F.struct("id", "digest", "pos").alias("line")), "members")
    of_rare, of_common = rows.filter("template is not null"), rows.filter("template is null")
    common = wider.filter(~F.col("rare")).select("leaf", "template", "shape")
    fits = stored(common.groupBy("leaf", "template").agg(F.sort_array(F.collect_set("shape")).alias("fitting")), "fits")
    held = stored(of_common.groupBy("leaf", "id", "digest").agg(F.sort_array(F.collect_list("shape")).alias("held")), "held")
    # Each pair of sets with a shape in common once; a document has one set.
    sets = held.groupBy("leaf", "held").count().select("*", F.explode("held").alias("shape"))
    kinds = fits.select("leaf", "fitting").distinct().select("*", F.explode("fitting").alias("shape"))
    holders = (sets.join(kinds, ["leaf", "shape"]).select("leaf", "fitting", "held", "count").distinct()
               .groupBy("leaf", "fitting").agg(F.sum("count").alias("holders")))
    firsts = of_common.groupBy("leaf", "shape").agg(F.min("line").alias("first"))
    early = kinds.join(firsts, ["leaf", "shape"]).groupBy("leaf", "fitting").agg(F.min("first").alias("early"))
    fits = fits.join(holders.join(early, ["leaf", "fitting"]), ["leaf", "fitting"])
    # Documents with the template's rare shapes alone.
    o = of_rare.groupBy("leaf", "template", "id", "digest").agg(F.min("line").alias("line")).alias("o")
    h = held.alias("h")
    of_rare = o.join(h, (F.col("o.leaf") == F.col("h.leaf")) & same_key("o", "h"), "left").select("o.*", "held")
    alone = ~F.coalesce(F.arrays_overlap("held", "fitting"), F.lit(False))
    return of_rare.join(fits, ["leaf", "template"], "left").groupBy("leaf", "template").agg(
        (F.count_if(alone) + F.coalesce(F.max("holders"), F.lit(0))).alias("n_docs"),
        F.least(F.min("line"), F.min("early")).alias("first"))


def recurring_lines(docs: DataFrame, min_docs: int = MIN_DOCS, depth: int = DEPTH, *, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """``(id, digest, pos, template, n_docs, is_first)`` of every line of a
    recurring template; ``digest`` tells texts of one id apart."""
    lines = template_lines(docs, depth, id_col=id_col, text_col=text_col)
    lines = stored(lines.select("id", "digest", "pos", "leaf", "shape"), "lines")
    shapes = stored(_shared(lines, ["leaf", "shape"]), "shapes")
    exact = shapes.filter(F.col("n_docs") >= min_docs).select("leaf", "shape", F.col("shape").alias("template"), "n_docs", "first")
    wider = stored(_generalised(docs, shapes, min_docs, depth, id_col, text_col), "templates")
    found = _found(lines, shapes, wider).filter(F.col("n_docs") >= min_docs)
    wide = wider.filter("rare").join(found, ["leaf", "template"]).select("leaf", "shape", "template", "n_docs", "first")
    every = stored(exact.unionByName(wide), "recurring")
    hit = lines.join(every, ["leaf", "shape"])
    return hit.select("id", "digest", "pos", "template", "n_docs",
                      F.struct("id", "digest", "pos").eqNullSafe(F.col("first")).alias("is_first"))


def drop_recurring(docs: DataFrame, min_docs: int = MIN_DOCS, depth: int = DEPTH, *, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """``docs`` with the lines of recurring templates taken out of the text,
    except each template's first line (by id, null before any, then text and
    place), and with ``n_lines`` and ``n_dropped`` (replacing columns of
    these names).

    Every line of every whole text takes part; blank lines stay. A null text stays null (0 lines), a
    text that loses all its lines becomes empty, its row stays. Rows equal
    in id and text count as one document and get equal answers; an empty
    table stays empty.
    """
    gone = recurring_lines(docs, min_docs, depth, id_col=id_col, text_col=text_col).filter(~F.col("is_first"))
    gone = stored(gone.groupBy("id", "digest").agg(F.collect_list("pos").alias("gone")), "dropped")
    rows = keyed(docs, id_col, text_col).alias("r").join(gone.alias("g"), same_key("r", "g"), "left").select("doc", "gone")
    own = [c for c in docs.columns if c.lower() not in ("n_lines", "n_dropped")]
    text = F.col(f"doc.`{text_col}`").cast("string")
    lines, n = F.split(text, "\n"), F.size(F.split(text, "\n"))
    kept = F.array_except(F.sequence(F.lit(0), n - 1), "gone")
    left = once(lines, lambda a: F.array_join(F.transform(kept, lambda i: F.get(a, i)), "\n"))
    new = {c: F.col(f"doc.`{c}`") for c in own}
    new[next(c for c in own if c.lower() == text_col.lower())] = F.when(F.col("gone").isNull(), text).otherwise(left)
    return rows.select(*[v.alias(c) for c, v in new.items()],
                       F.when(text.isNull(), 0).otherwise(n).cast("bigint").alias("n_lines"),
                       F.coalesce(F.size("gone"), F.lit(0)).cast("bigint").alias("n_dropped"))


# The same rules in SQL, for texts without repeated ids.
ORACLE = f"""
with d as (select doc_id, text, string_split(text, chr(10)) as ls from documents),
l as (select doc_id, unnest(range(len(ls))) as pos, unnest(ls) as line from d),
t as (select doc_id, pos, regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+') as raw from l),
u as (select doc_id, pos, raw, list_transform(raw, lambda w: case when regexp_matches(w, '[0-9]') then '{FIELD}' else w end) as masked
      from t where len(raw) > 0),
v as (select doc_id, pos, case when len(list_filter(masked, lambda w: w <> '{FIELD}')) >= {MIN_CONSTANTS} then masked else raw end as w from u),
k as (select *, array_to_string(w, ' ') as shape,
             len(w) || ' ' || case when regexp_matches(array_to_string(w, ' '), '[0-9]') then array_to_string(w, ' ')
                                   else array_to_string(w[1:{DEPTH}], ' ') end as leaf from v),
s as (select shape, any_value(leaf) as leaf, any_value(w) as w, count(distinct doc_id) as c from k group by shape),
wide as (select leaf from s group by leaf having sum(c) >= {MIN_DOCS} and count(*) > 1 and min(c) < {MIN_DOCS}),
p as (select shape, leaf, c, unnest(range(1, len(w) + 1)) as i, unnest(w) as token from s semi join wide using (leaf)),
f as (select leaf, i, token from p group by all having sum(c) >= {MIN_DOCS}),
g as (select p.shape, any_value(p.leaf) as leaf, any_value(p.c) as c, count(*) as n, count(f.token) as fixed,
             count(case when f.token <> '{FIELD}' then 1 end) as words,
             list(p.i order by p.i) filter (where f.token is not null) as places
      from p left join f on p.leaf = f.leaf and p.i = f.i and p.token = f.token group by p.shape),
rare as (select g.shape, g.leaf, g.places, leaf || ' ' || array_to_string(list_transform(g.places, lambda i: i || ':' || s.w[i]), ' ') as template
         from g join s using (shape, leaf)
         where g.c < {MIN_DOCS} and words >= {MIN_CONSTANTS} and fixed >= {CONSTANT_SHARE} * n),
fits as (select shape, leaf || ' ' || array_to_string(list_transform(places, lambda i: i || ':' || w[i]), ' ') as template
         from (select distinct leaf, places from rare) join s using (leaf) where c >= {MIN_DOCS}),
m as (select shape, 'general ' || template as template, true as own from rare
      union all select distinct shape, 'general ' || template, false from fits semi join rare using (template)
      union all select shape, 'exact ' || shape, true from s where c >= {MIN_DOCS}),
h as (select doc_id, pos, template, own, min(struct_pack(doc_id, pos)) over (partition by template) as first from k join m using (shape)),
r as (select template from h group by template having count(distinct doc_id) >= {MIN_DOCS}),
gone as (select doc_id, list(pos) as pos, count(*) as n from h semi join r using (template)
         where own and struct_pack(doc_id, pos) <> first group by doc_id)
select d.doc_id, coalesce(len(d.ls), 0)::bigint as n_lines, coalesce(gone.n, 0)::bigint as n_dropped,
       case when gone.n is null then d.text else coalesce(array_to_string(list_transform(
            list_filter(range(len(d.ls)), lambda i: not list_contains(gone.pos, i)), lambda i: d.ls[i + 1]), chr(10)), '') end as text
from d left join gone using (doc_id)
"""
