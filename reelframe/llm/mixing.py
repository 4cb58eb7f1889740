"""Mixing sources to target weights by entropy balancing.

Documents carry tokens as base mass. Among all rates that meet the token
constraints, the one of least relative entropy to the base mass tilts a
document's rate exponentially: rate = exp(multiplier of its source +
multiplier of its length band), cut at the greatest rate. Two margins are
constrained: a source's tokens (exactly) and a length band's tokens, which
are to stay what they are in the corpus, so that weighing sources does not
by itself shift the mix to short or to long documents.

The multipliers solve the convex dual by Newton's method. For given band
multipliers each source's own multiplier has a closed form, so sources (any
number, each one row of at most ``MAX_BANDS`` cells) are eliminated where
they lie; the gradient and the joint Hessian's Schur complement over the
bands are sums over sources, at most MAX_BANDS squared numbers. Rates are
then rounded into whole copies.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import keyed, same_key, stored, text_digest, word_count

WEIGHTS = (5, 2, 1)   # of the sources by code point, null last, repeating
MAX_RATE = 3
TOLERANCE = 1e-9
MAX_ITERATIONS = 60
MAX_BANDS = 32        # categories of the second margin that the driver may hold
BAND_STARTS = tuple(4 ** k for k in range(1, 8))  # words at which the next length band begins
SLACK = 0.1           # a band may miss its tokens by SLACK times its multiplier
BLOCK_DOCS = 256      # documents whose copies are rounded together, on average
CHUNK = 4096          # copies of one row that a task makes


def _ranked(sources: DataFrame) -> DataFrame:
    """``sources`` with ``nr``, each one's place by code point, null last,
    from 0: counted within range partitions, then over the partitions."""
    name = F.asc_nulls_last("source")
    parts = stored(sources.repartitionByRange(name).withColumn("part", F.spark_partition_id()), "ranges")
    sizes = parts.groupBy("part").count()
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    sizes = sizes.select("part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("part").orderBy(name))
    return parts.join(sizes, "part").withColumn("nr", F.col("before") + inside - 1).drop("part", "before")


def water_filling(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_rate: int = MAX_RATE) -> DataFrame:
    """``(source, source_size, target)``: targets by weight that add up to
    the whole size, none above ``max_rate`` times its source's size; what
    exceeds that is shared by weight among the rest.

    ``sources`` has one row per source (source, source_size). Each round is
    one sum over the sources: those above the level so far are capped, which
    raises the level of the rest, until none is above.
    """
    cyclic = F.element_at(F.array(*(F.lit(w) for w in weights)), (F.col("nr") % len(weights) + 1).cast("int"))
    rows = _ranked(sources.select("source", "source_size")).select(
        "source", "source_size", cyclic.cast("decimal(38,0)").alias("weight"),
        (F.lit(max_rate) * F.col("source_size")).cast("decimal(38,0)").alias("cap"))
    rows = stored(rows, "weights")
    whole = int(rows.agg(F.sum("source_size")).first()[0] or 0)

    def number(n: int) -> Column:
        return F.lit(str(n)).cast("decimal(38,0)")

    capped, n_capped = F.lit(False), 0
    while True:
        size, weight, n = rows.agg(F.sum(F.when(capped, F.col("cap"))), F.sum(F.when(~capped, F.col("weight"))),
                                   F.count(F.when(capped, F.lit(1)))).first()
        left, free = whole - int(size or 0), int(weight or 0)
        if not free or (n == n_capped and n):
            break
        n_capped, capped = n, F.col("cap") * number(free) <= F.col("weight") * number(left)
        if not n and rows.filter(capped).isEmpty():
            break
    level = F.lit(left / free) if free else F.lit(0.0)
    target = F.when(capped, F.col("cap").cast("double")).otherwise(F.col("weight").cast("double") * level)
    return rows.select("source", "source_size", target.alias("target"))


def _solved(groups: DataFrame, mu: list[float], max_rate: float) -> DataFrame:
    """``groups`` (category, target, cells of (at, mass)) with ``lam``, the
    multiplier that meets the target with band multipliers ``mu``, and its
    cells as ``(at, mass, tilt, rate)``.

    Cells are cut at ``max_rate`` from the greatest ``mu`` down: with j of
    them cut, exp(lam) follows from what the others must make up; the least j
    whose next cell is not above the cut is the one.
    """
    tilt = F.array(*(F.lit(float(m)) for m in mu))
    cells = F.transform("cells", lambda c: F.struct((-F.get(tilt, c["at"])).alias("minus"), c["at"].alias("at"), c["mass"].alias("mass")))
    rows = groups.withColumn("sorted", F.sort_array(cells))
    # Relative to the greatest tilt, so that no exponential overflows.
    rows = rows.withColumn("top", F.get("sorted", F.lit(0))["minus"])
    weight = lambda c: F.exp(F.col("top") - c["minus"])
    total = lambda array, value: F.aggregate(array, F.lit(0.0), lambda acc, c: acc + value(c))

    def scale(j: Column) -> Column:
        cut, rest = F.slice("sorted", F.lit(1), j), F.slice("sorted", j + 1, F.size("sorted"))
        return F.try_divide(F.col("target") - max_rate * total(cut, lambda c: c["mass"]), total(rest, lambda c: c["mass"] * weight(c)))

    scales = F.transform(F.sequence(F.lit(0), F.size("sorted") - 1),
                         lambda j: F.struct(scale(j).alias("scale"), weight(F.get("sorted", j)).alias("w")))
    fits = F.filter(scales, lambda x: x["scale"] * x["w"] < max_rate)
    rows = rows.withColumn("fit", F.get(fits, F.lit(0))["scale"])
    # All at the cut: the multiplier that brings the least tilted cell there.
    last = F.element_at("sorted", -1)["minus"]
    # A target is nothing, or log(scale) stands for the top cell's exponent.
    lam = (F.when(F.col("target") <= 0, F.lit(float("-inf")))
           .when(F.col("fit").isNull(), F.lit(math.log(max_rate)) + last)
           .otherwise(F.log(F.greatest(F.col("fit"), F.lit(1e-300))) + F.col("top")))
    rows = rows.withColumn("lam", lam)
    cells = F.transform("sorted", lambda c: F.struct(
        c["at"].alias("at"), c["mass"].alias("mass"), (-c["minus"]).alias("tilt"),
        F.least(F.exp(F.col("lam") - c["minus"]), F.lit(float(max_rate))).alias("rate")))
    return rows.select("category", "target", "lam", cells.alias("cells"))


def _dual(groups: DataFrame, mu: list[float], goals: list[float], max_rate: float, slack: float):
    """Dual objective, gradient and Hessian in the bands' multipliers, the
    other margin eliminated: one aggregation over its categories."""
    import numpy as np

    log_max = math.log(max_rate)
    rows = _solved(groups, mu, max_rate).filter("target > 0")
    free = lambda c: F.when(c["rate"] < max_rate, c["mass"] * c["rate"]).otherwise(0.0)
    total = lambda value: F.aggregate("cells", F.lit(0.0), lambda acc, c: acc + value(c))
    entry = lambda i, j, v: F.struct(i.alias("i"), j.alias("j"), v.alias("v"))
    rows = rows.withColumn("free", total(free))
    value = total(lambda c: c["mass"] * (c["rate"] + F.when(c["rate"] < max_rate, 0.0).otherwise(
        max_rate * (F.col("lam") + c["tilt"] - log_max)))) - F.col("lam") * F.col("target")
    none = F.lit(-1)
    parts = F.concat(
        F.array(entry(none, none, value)),
        F.transform("cells", lambda c: entry(c["at"], none, c["mass"] * c["rate"])),
        F.transform("cells", lambda c: entry(none, c["at"], free(c))),
        F.flatten(F.transform("cells", lambda c: F.transform("cells", lambda d: entry(
            c["at"], d["at"], F.when(F.col("free") > 0, free(c) * free(d) / F.col("free")).otherwise(0.0))))))
    sums = rows.select(F.explode(parts).alias("x")).groupBy("x.i", "x.j").agg(F.sum("x.v").alias("v")).collect()
    n = len(mu)
    tilt, goal = np.array(mu), np.array(goals)
    value, gradient, hessian = 0.0, -goal + slack * goal * tilt, np.diag(slack * goal)
    for i, j, v in sums:
        if i < 0 and j < 0:
            value = v
        elif j < 0:
            gradient[i] += v
        elif i < 0:
            hessian[j, j] += v
        else:
            hessian[i, j] -= v
    value += float(-goal @ tilt + slack / 2 * goal @ tilt ** 2)
    return value, gradient, hessian + np.eye(n) * max(1e-12, 1e-10 * float(np.trace(hessian)) / n)


def balance(cells: DataFrame, targets: dict[str, DataFrame], max_rate: float = MAX_RATE, *, slack: float = 0.0,
            tolerance: float = TOLERANCE, max_iterations: int = MAX_ITERATIONS) -> dict[str, DataFrame]:
    """Dual multipliers ``(category, lam)`` of one margin or two.

    ``cells`` has the margins' columns and ``mass`` (above 0), one row per
    distinct combination; ``targets[margin]`` has ``(category, target)``.
    Rates are exp(sum of multipliers), cut at ``max_rate``. The first margin
    may have any number of categories and is met exactly; the second at most
    ``MAX_BANDS``, and with ``slack`` above 0 it gives way where the two
    conflict: a category misses its target by slack * multiplier * target.
    A null category is one of its own. Categories without mass are left out;
    a target of 0 has the multiplier minus infinity. Targets above
    ``max_rate`` times the mass, or not met within ``tolerance`` of the whole
    after ``max_iterations``, are an error.
    """
    import numpy as np

    if not 1 <= len(targets) <= 2:
        raise ValueError("one margin or two")
    first, *second = targets
    spark = cells.sparkSession
    bands, goals = [None], [0.0]
    at = F.lit(0)
    if second:
        known = targets[second[0]].orderBy("category").limit(MAX_BANDS + 1).collect()
        if len(known) > MAX_BANDS:
            raise ValueError(f"the second margin has more than {MAX_BANDS} categories")
        bands, goals = [r["category"] for r in known], [float(r["target"]) for r in known]
        at = reduce(lambda rest, i: F.when(F.col(second[0]).eqNullSafe(F.lit(bands[i])), F.lit(i)).otherwise(rest),
                    range(len(bands)), F.lit(None).cast("int"))
    # Cells of a band that has no target keep their mass out of it all.
    inside = cells.filter("mass > 0").withColumn("at", at).filter("at is not null")
    sides = inside.groupBy(F.col(first).alias("_c")).agg(
        F.sort_array(F.collect_list(F.struct("at", F.col("mass").cast("double").alias("mass")))).alias("cells"))
    groups = sides.join(targets[first].withColumnRenamed("category", "_t"), F.col("_c").eqNullSafe(F.col("_t")))
    groups = stored(groups.select(F.col("_c").alias("category"), F.col("target").cast("double").alias("target"), "cells"), "duals")
    mass = F.aggregate("cells", F.lit(0.0), lambda acc, c: acc + c["mass"])
    if not groups.filter(F.col("target") > max_rate * mass * (1 + tolerance)).isEmpty():
        raise RuntimeError(f"a target is above {max_rate} times its mass")

    mu = np.zeros(len(bands))
    if second:
        whole = sum(goals) or 1.0
        value, gradient, hessian = _dual(groups, list(mu), goals, max_rate, slack)
        for _ in range(max_iterations):
            if np.abs(gradient).max() <= tolerance * whole:
                break
            step = -np.linalg.solve(hessian, gradient)
            step /= max(1.0, np.abs(step).max())
            for _ in range(30):
                now = _dual(groups, list(mu + step), goals, max_rate, slack)
                if now[0] <= value + 1e-4 * float(gradient @ step) + 1e-12 * abs(value):
                    break
                step /= 2
            mu, (value, gradient, hessian) = mu + step, now
        else:
            raise RuntimeError(f"targets not met after {max_iterations} iterations; largest gap {np.abs(gradient).max():g}")
        # Sums of doubles depend on their order: digits beyond these are noise.
        mu = np.round(mu, 9)
    lam = _solved(groups, list(mu), max_rate).select("category", "lam")
    out = {first: lam}
    if second:
        kind = targets[second[0]].schema["category"].dataType.simpleString()
        rows = [F.struct(F.lit(c).cast(kind).alias("category"), F.lit(float(m)).alias("lam")) for c, m in zip(bands, mu)]
        out[second[0]] = spark.range(1).select(F.inline(F.array(*rows)))
    return out


def _copies(docs: Column, start: Column, max_rate: int) -> Column:
    """Whole copies of a block's documents (size descending): each takes what
    brings the block's tokens so far nearest to rate times its sizes so far,
    so the block ends within half a copy of its smallest document. ``start``
    is due from the beginning and taken back before the smaller half."""
    def state(due: Column, copies: Column) -> Column:
        return F.struct(due.alias("due"), copies.alias("copies"))

    def take(acc: Column, doc: Column) -> Column:
        size, due = doc["size"].cast("double"), acc["due"] + doc["rate"] * doc["size"] * doc["rows"]
        most = F.lit(max_rate) * doc["rows"]
        n = F.when(size > 0, F.greatest(F.lit(0), F.least(most, F.round(due / size).cast("bigint")))).otherwise(doc["rows"])
        return state(due - n * size, F.concat(acc["copies"], F.array(n)))

    half = F.ceil(F.size(docs) / 2).cast("int")
    longer, shorter = F.slice(docs, F.lit(1), half), F.slice(docs, half + 1, F.size(docs))
    begun = F.aggregate(longer, state(start, F.array().cast("array<bigint>")), take,
                        lambda acc: state(acc["due"] - start, acc["copies"]))
    return F.aggregate(shorter, begun, take, lambda acc: acc["copies"])


def _start(docs: Column, hashed: Column, max_rate: int) -> Column:
    """Due at a block's beginning: up to half its longest document, by hash,
    either way (so that this document is not always passed over where the
    rate is below a half), and no more than the smaller half can make up."""
    half = F.ceil(F.size(docs) / 2).cast("int")
    room = F.aggregate(F.slice(docs, half + 1, F.size(docs)), F.lit(0.0), lambda acc, d: acc + d["size"] * d["rows"]
                       * F.least(d["rate"], F.lit(float(max_rate)) - d["rate"]))
    share = F.pmod(hashed, F.lit(1 << 20)) / F.lit(float(1 << 20)) - 0.5
    return share * F.least(F.get(docs, F.lit(0))["size"].cast("double"), room)


def length_band(size: Column) -> Column:
    """Number of the band of a document of ``size`` words, from 0."""
    return reduce(lambda n, start: n + (size >= start).cast("int"), BAND_STARTS, F.lit(0))


def _each_copy(rows: DataFrame, number: str) -> DataFrame:
    """``rows`` as often as their column ``number`` says, ``k`` from 1; many
    copies of a row are made by many tasks."""
    one, n = F.lit(1).cast("bigint"), F.col(number)
    few = rows.filter(n.between(1, CHUNK)).withColumn("k", F.explode(F.sequence(one, n)))
    chunks = rows.filter(n > CHUNK).withColumn("from", F.explode(F.sequence(one, n, F.lit(CHUNK).cast("bigint"))))
    many = chunks.repartition("from").withColumn("k", F.explode(F.sequence("from", F.least(F.col("from") + CHUNK - 1, n))))
    return few.unionByName(many.drop("from"))


def copy_plan(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_rate: int = MAX_RATE, *, id_col: str = "doc_id",
              text_col: str = "text", source_col: str = "source", block_docs: int = BLOCK_DOCS) -> DataFrame:
    """``(id, digest, source, size, rows, source_size, target, rate, copies)``
    for every distinct (id, text, source): ``rows`` rows of ``docs`` that
    together get ``copies`` copies, at most ``max_rate * rows``."""
    text = F.col(text_col).cast("string")
    sizes = docs.select(F.col(id_col).alias("id"), text_digest(text).alias("digest"),
                        F.col(source_col).alias("source"), word_count(text).alias("size"))
    sizes = sizes.groupBy("id", "digest", "source", "size").agg(F.count("*").alias("rows"))
    sizes = stored(sizes.withColumn("band", length_band(F.col("size"))), "sizes")
    words = F.sum(F.col("size") * F.col("rows")).cast("bigint")
    cells = stored(sizes.groupBy("source", "band").agg(words.alias("mass"), F.count("*").alias("n_docs")), "cells")
    per_source = cells.groupBy("source").agg(F.sum("mass").alias("source_size"), F.sum("n_docs").alias("n_docs"))
    goals = stored(water_filling(per_source, weights, max_rate), "targets")
    # Sources without words have no constraint to meet, those at the greatest
    # rate no choice: the length bands are balanced over the others.
    open_ = (F.col("source_size") > 0) & (F.col("target") < max_rate * F.col("source_size"))
    free = cells.join(goals.filter(open_).select(F.col("source").alias("_source"), "source_size", "target"),
                      F.col("source").eqNullSafe(F.col("_source"))).filter("mass > 0")
    total, mixed_words = goals.filter(open_).agg(F.sum("source_size"), F.sum("target")).first()
    cells = free.select("source", "band", "mass")
    bands = cells.groupBy(F.col("band").alias("category")).agg(
        (F.sum("mass") * F.lit((mixed_words or 0.0) / (total or 1))).alias("target"))
    lams = {"source": None, "band": None}
    if total:
        lams = balance(cells, {"source": goals.filter(open_).select(F.col("source").alias("category"), "target"), "band": bands},
                       max_rate, slack=SLACK)
    return _rounded(sizes, per_source, goals, lams, max_rate, block_docs)


def _rounded(sizes: DataFrame, per_source: DataFrame, goals: DataFrame, lams: dict, max_rate: int, block_docs: int) -> DataFrame:
    """The plan's rows: rates of the multipliers, copies block by block."""
    known = per_source.select("source", "n_docs").alias("p").join(goals.alias("g"), F.col("p.source").eqNullSafe(F.col("g.source")))
    lam, top = F.lit(None).cast("double"), F.lit(float(max_rate))
    tilt = F.lit(0.0)
    if lams["source"] is not None:
        known = known.join(lams["source"].alias("l"), F.col("p.source").eqNullSafe(F.col("l.category")), "left")
        lam = F.col("l.lam")
        # At most MAX_BANDS numbers.
        for row in lams["band"].collect():
            tilt = F.when(F.col("band") == row["category"], F.lit(row["lam"])).otherwise(tilt)
    known = stored(known.select(F.col("p.source").alias("_source"), "g.source_size", "g.target", lam.alias("lam"),
                                F.ceil(F.col("n_docs") / block_docs).alias("blocks")), "rates")
    # Without a multiplier: no words, or all of them as often as may be.
    rate = F.when(F.col("lam").isNotNull(), F.least(F.exp(F.col("lam") + tilt), top)).when(F.col("source_size") > 0, top).otherwise(1.0)
    rated = sizes.join(known, F.col("source").eqNullSafe(F.col("_source"))).drop("_source").withColumn("rate", rate)
    block = F.pmod(F.xxhash64("id", "digest"), F.col("blocks"))
    doc = F.struct((-F.col("size")).alias("minus"), F.xxhash64("id", "digest", F.lit(1)).alias("h"), "id", "digest", "size",
                   "rows", "rate", "source_size", "target")
    blocks = rated.groupBy("source", block.alias("block")).agg(F.sort_array(F.collect_list(doc)).alias("docs"))
    blocks = blocks.withColumn("start", _start(F.col("docs"), F.xxhash64("source", "block"), max_rate))
    each = blocks.withColumn("copies", _copies(F.col("docs"), F.col("start"), max_rate)).select(
        "source", F.explode(F.arrays_zip("docs", "copies")).alias("x"))
    return each.select("x.docs.id", "x.docs.digest", "source", "x.docs.size", "x.docs.rows", "x.docs.source_size",
                       "x.docs.target", "x.docs.rate", "x.copies")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_rate: int = MAX_RATE, *, id_col: str = "doc_id",
        text_col: str = "text", source_col: str = "source", block_docs: int = BLOCK_DOCS) -> DataFrame:
    """``(id, source, size, source_size, target, rate, copies, taken)`` for
    every row of ``docs``: taken = copies * size, copies 0 to ``max_rate``.

    A size is the number of words of the whole text (null: 0). Every
    source's taken words lie within about half of the smallest document per
    ``block_docs`` documents of its target. A large source is dealt over
    many blocks by hash. Rounding depends only on the rows, so reruns agree.
    Null ids and sources are values of their own; rows equal in id, text and
    source share their copies evenly; a document without words is taken once
    at no cost; an empty table gives no rows; other columns are not read.
    """
    plan = copy_plan(docs, weights, max_rate, id_col=id_col, text_col=text_col, source_col=source_col, block_docs=block_docs)
    each = _each_copy(stored(plan, "plan"), "rows")
    copies = F.floor(F.col("copies") / F.col("rows")) + (F.col("k") <= F.col("copies") % F.col("rows")).cast("bigint")
    return each.withColumn("copies", copies).select(
        F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target", "rate", "copies",
        (F.col("copies") * F.col("size")).alias("taken"))


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_rate: int = MAX_RATE, *, id_col: str = "doc_id",
          text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``docs`` with each row as often as the mix takes it, 0 to ``max_rate``
    times. Of several rows equal in id, text and source, one stands for all
    their copies. Null ids and sources are values of their own; a row without
    words (null or empty text) is taken once; an empty table stays empty."""
    plan = copy_plan(docs, weights, max_rate, id_col=id_col, text_col=text_col, source_col=source_col)
    plan = stored(plan.filter("copies > 0").select("id", "digest", "source", "rows", "copies"), "copies")
    rows = keyed(docs, id_col, text_col).withColumn("source", F.col(f"doc.`{source_col}`"))
    taken = rows.alias("r").join(plan.alias("p"), same_key("r", "p") & F.col("r.source").eqNullSafe(F.col("p.source")))
    taken = taken.select("r.*", "p.rows", "p.copies")
    one = taken.filter("rows = 1").unionByName(taken.filter("rows > 1").dropDuplicates(["id", "digest", "source"]))
    again = F.explode(F.sequence(F.lit(1).cast("bigint"), F.least("copies", F.lit(CHUNK).cast("bigint"))))
    out = one.select("doc", again)
    if not plan.filter(F.col("copies") > CHUNK).isEmpty():
        more = one.filter(F.col("copies") > CHUNK).withColumn("more", F.col("copies") - CHUNK)
        out = out.select("doc").unionByName(_each_copy(more.select("doc", "more"), "more").select("doc"))
    return out.select("doc.*")
