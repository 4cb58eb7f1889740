"""Film count and mean rating per production company.

Explode the company names of the qualifying films and aggregate
``avg``/``count`` per name. Partial aggregation runs before the shuffle, so
a company present in a third of all films costs one partial row per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.json import exploded_name
from ..functions.predicates import above, all_of, nonzero


def company_rating(films: DataFrame, min_votes: int = 100, *, drop_unrated: bool = True) -> DataFrame:
    """A14 (``drop_unrated=True``: a zero rating is excluded) and A14p
    (``drop_unrated=False``). Output ``company, average, count``.

    The source also requires the companies text to be present (A14) or
    non-empty (A14p); ``explode`` of a null, empty or unparseable list
    yields no rows, so both tests hold without reading the text again.
    """
    keep = [above("vote_count", min_votes)]
    if drop_unrated:
        keep.append(nonzero("vote_average"))
    entries = films.filter(all_of(*keep)).select(
        exploded_name("production_companies", films=films).alias("company"), "vote_average")
    # Ratings are added up as decimals, exactly; a sum of doubles depends on
    # the order of the rows. A null rating is counted as an entry, not rated.
    exact = F.col("vote_average").cast("decimal(38,18)")
    return (entries.groupBy("company").agg(F.sum(exact).alias("_s"), F.count("vote_average").alias("_n"), F.count(F.lit(1)).alias("count"))
            .select("company", F.try_divide(F.col("_s").cast("double"), F.col("_n").cast("double")).alias("average"), "count"))
