"""Joins of positions and intervals.

All have chromosome and strand as real keys, so that Catalyst plans hash or sort-merge joins. Where one
side's intervals have a known greatest length, keys also hold a bin of positions, which spreads a
chromosome over tasks; a pair is found once, as one side is put into a single bin.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEYS = ("chrom", "strand")


def bins(first: Column, last: Column, width: int) -> Column:
    """The bins that first to last (both within) touch."""
    return F.sequence(F.floor(first / width), F.floor(F.greatest(first, last) / width))


def stab(points: DataFrame, pos: str, spans: DataFrame, first: str, last: str, keys=KEYS, how: str = "inner", width: int = 4096) -> DataFrame:
    """Points with the spans (first to last, both within) that they lie in; ``how`` as in join(), from the
    points' side. Columns of spans that points have too, other than keys, must have been renamed."""
    right = spans.filter(F.col(last) >= F.col(first)).withColumn("__bin", F.explode(bins(F.col(first), F.col(last), width)))
    left = points.withColumn("__bin", F.floor(F.col(pos) / width))
    inside = (F.col(pos) >= F.col(first)) & (F.col(pos) <= F.col(last))
    on = [left[k] == right[k] for k in (*keys, "__bin")]
    out = left.join(right, [*on, inside], how)
    if how not in ("left_semi", "left_anti"):
        for k in (*keys, "__bin"):
            out = out.drop(right[k])
    return out.drop("__bin")


def overlaps(a: DataFrame, b: DataFrame, a_first: str, a_last: str, b_first: str, b_last: str, keys=KEYS, width: int = 4096) -> DataFrame:
    """Pairs of spans that share a position; a pair is found in the first bin that both touch."""
    left = a.withColumn("__bin", F.explode(bins(F.col(a_first), F.col(a_last), width)))
    right = b.withColumn("__bin", F.explode(bins(F.col(b_first), F.col(b_last), width)))
    on = [left[k] == right[k] for k in (*keys, "__bin")]
    both = (F.col(a_first) <= F.col(b_last)) & (F.col(b_first) <= F.col(a_last))
    first = left["__bin"] == F.floor(F.greatest(F.col(a_first), F.col(b_first)) / width)
    out = left.join(right, [*on, both, first])
    for k in (*keys, "__bin"):
        out = out.drop(right[k])
    return out.drop("__bin")


def nearest_before(points: DataFrame, pos: str, starts: DataFrame, start: str, name: str, keys=KEYS, width: int = 4096) -> DataFrame:
    """points with ``name``: the greatest start that isn't beyond the position, null without one. Both are
    sorted within bins of positions; a row for each bin carries the greatest start of those before it."""
    here = points.select(*keys, F.col(pos).alias("__p")).distinct().withColumns({"__k": F.lit(1), "__s": F.lit(None).cast("int")})
    there = starts.select(*keys, F.col(start).cast("int").alias("__p")).distinct().withColumns({"__k": F.lit(0), "__s": F.col("__p")})
    both = here.unionByName(there).withColumn("__bin", F.floor(F.col("__p") / width))
    before = Window.partitionBy(*keys).orderBy("__bin").rowsBetween(Window.unboundedPreceding, -1)
    each = both.groupBy(*keys, "__bin").agg(F.max("__s").alias("__top")).select(*keys, "__bin", F.last("__top", ignorenulls=True).over(before).alias("__carried"))
    along = Window.partitionBy(*keys, "__bin").orderBy("__p", "__k").rowsBetween(Window.unboundedPreceding, 0)
    found = both.withColumn("__own", F.last("__s", ignorenulls=True).over(along)).filter("__k = 1").join(each, [*keys, "__bin"])
    found = found.select(*keys, F.col("__p").alias(pos), F.coalesce("__own", "__carried").alias(name))
    return points.join(found, [*keys, pos], "left")
