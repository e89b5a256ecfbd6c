"""Page links (src, dst)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from skytally.plans.joins import fits_broadcast
from skytally.plans.ranking import count_below, top_k


def _ends(links: DataFrame) -> DataFrame:
    """Every end of every link, with 1 for a target and 0 for a source."""
    end = lambda column, linked: F.struct(F.col(column).alias("id"), F.lit(linked).alias("linked"))
    return links.select(F.inline(F.array(end("src", 0), end("dst", 1)))).where(F.col("id").isNotNull())


def vertices(links: DataFrame) -> DataFrame:
    """All ids that occur on either side."""
    return links.select(F.explode(F.array("src", "dst")).alias("id")).where(F.col("id").isNotNull()).distinct()


def _count_links(ends: DataFrame) -> DataFrame:
    return ends.groupBy("id").agg(F.sum("linked").alias("inlinks"))


def inlink_count(links: DataFrame) -> DataFrame:
    """Number of links to each page, 0 for a page that is only a source: one scan and one exchange."""
    return _count_links(_ends(links))


def orphan_pages(links: DataFrame) -> DataFrame:
    """Pages that no link points to."""
    return _ends(links).groupBy("id").agg(F.max("linked").alias("l")).where(F.col("l") == 0).select("id")


def top_popular_links(links: DataFrame, n: int = 10) -> DataFrame:
    return top_k(inlink_count(links), n, F.desc("inlinks"), F.desc("id"))


def popularity_league(links: DataFrame, league: DataFrame) -> DataFrame:
    """For each listed page that occurs, the number of listed pages with strictly fewer links to them.

    A short list is broadcast and drops the other pages before they are counted; a long one is joined to the counts,
    where each page is one row.
    """
    listed = league.select("id").distinct()
    if fits_broadcast(listed):
        counted = _count_links(_ends(links).join(F.broadcast(listed), "id", "left_semi"))
    else:
        counted = inlink_count(links).join(listed, "id", "left_semi")
    return count_below(counted, "inlinks").select("id", "rank")
