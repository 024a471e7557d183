"""Connected components of links between keys, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketline.session import cut_lineage


def components(links: DataFrame) -> DataFrame:
    """(key, root) of every key in the links (a, b); the root is the smallest key of the component.

    Each round hangs the larger end's root under the smallest root met across a link, then shortens paths by one
    jump. No group is gathered: a round is sums and joins on keys, cut off by a checkpoint.
    """
    both = cut_lineage(links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).distinct())
    state = cut_lineage(both.groupBy(F.col("a").alias("key")).agg(F.least(F.col("a"), F.min("b")).alias("root")))
    while True:
        heard = both.join(state.select(F.col("key").alias("b"), "root"), "b").groupBy(F.col("a").alias("key")).agg(F.min("root").alias("heard"))
        moved = state.join(heard, "key").select("key", "root", F.least("root", "heard").alias("next"))
        # an old root also hears of the smallest root that one of its keys has met
        lower = moved.groupBy(F.col("root").alias("key")).agg(F.min("next").alias("low"))
        moved = moved.join(lower, "key", "left").select("key", "root", F.least("next", F.coalesce("low", "next")).alias("next"))
        jump = moved.select(F.col("key").alias("next"), F.col("next").alias("far"))
        step = cut_lineage(moved.join(jump, "next").select("key", "root", F.least("next", "far").alias("next")))
        changed = step.filter("root <> next").limit(1).count()
        state = step.select("key", F.col("next").alias("root"))
        if not changed:
            return state
